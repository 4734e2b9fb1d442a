"""Sea-lice queries."""

from brinewave.fixtures import SEASON
from brinewave.functions.labels import SALMON_LABELS
from brinewave.plans import lice
from brinewave.plans.survey import survey_seines
from brinewave.queries.catch import SS, SURVEY, strict
from brinewave.queries.registry import query

PARTS = lice.FIELD_SHEETS[2018]
SUM = {g: " + ".join(c) for g, c in PARTS.items()}
TOTALS = f"""totals AS (
  SELECT ufn, l.seine_id, species, {SUM["cope"]} + {SUM["chal"]} + {SUM["caligus"]} + {SUM["lep"]} AS total_lice,
         {SUM["cope"]} AS copepodid, {SUM["chal"]} AS chalimus, {SUM["caligus"]} + {SUM["lep"]} AS motile,
         {SUM["caligus"]} AS motile_caligus, {SUM["lep"]} AS motile_lep, ss.region, ss.sampling_week
  FROM lice_2018 l LEFT JOIN ss ON l.seine_id = ss.seine_id WHERE species IN ('SO', 'PI', 'CU'))"""
WEEKLY_VIEWS = ("lice_2018", *SURVEY)


def weekly(name, sql, f, **options):
    def run(counts, surveys, seines, sites):
        return f(lice.stage_totals(counts), survey_seines(surveys, seines, sites))

    return query(name, WEEKLY_VIEWS, sql, extra=(SS, TOTALS), **options)(run)


def mean_se(c):
    return f"avg({c}) AS {c}_m, stddev_samp({c}) / sqrt(count(*)) AS {c}_e"


def long_sql(keys, measures, label, value, inner):
    parts = [f"SELECT {keys}, '{k}' AS {label}, {m}_m AS {value}, {m}_e AS se FROM w" for k, m in measures.items()]
    return f"WITH w AS ({inner}) " + " UNION ALL ".join(parts)


query(
    "q26_stage_totals",
    ["lice_2018"],
    f"""SELECT ufn, seine_id, species, {SUM["cope"]} + {SUM["chal"]} + {SUM["caligus"]} + {SUM["lep"]} AS total_lice,
        {SUM["cope"]} AS copepodid, {SUM["chal"]} AS chalimus, {SUM["caligus"]} + {SUM["lep"]} AS motile,
        {SUM["caligus"]} AS motile_caligus, {SUM["lep"]} AS motile_lep
        FROM lice_2018 WHERE species IN ('SO', 'PI', 'CU')""",
    integers=lice.MEASURES,
)(lambda counts: lice.stage_totals(counts).select("ufn", "seine_id", "species", *lice.MEASURES))

STAGES = {"cope": "copepodid", "chal": "chalimus", "mot": "motile"}
weekly(
    "q27_stage_abundance",
    f"""SELECT *, CASE life_stage WHEN 'cope' THEN 1 WHEN 'chal' THEN 2 ELSE 3 END AS stage_order FROM (
        {long_sql("region, sampling_week", STAGES, "life_stage", "abundance",
                  f"SELECT region, sampling_week, {', '.join(mean_se(c) for c in STAGES.values())} "
                  "FROM totals WHERE species = 'SO' GROUP BY ALL")}) u""",
    lice.stage_abundance,
    doubles=["abundance", "se"],
    integers=["stage_order"],
)
MOTILE = {"cal": "motile_caligus", "lep": "motile_lep"}
for suffix, where, flag in (("", "true", False), ("_placed", "region IS NOT NULL", True)):
    weekly(
        f"q28_motile_abundance{suffix}",
        long_sql(
            "region, species, sampling_week", MOTILE, "lice_species", "abundance",
            f"SELECT region, species, sampling_week, {', '.join(mean_se(c) for c in MOTILE.values())} "
            f"FROM totals WHERE {where} GROUP BY ALL",
        ),
        lambda t, ss, flag=flag: lice.motile_abundance(t, ss, drop_unplaced=flag),
        doubles=["abundance", "se"],
    )
    weekly(
        f"q30_weekly_prevalence{suffix}",
        f"""SELECT *, n_infected / CAST(n_examined AS DOUBLE) AS prevalence FROM (
            SELECT region, species, sampling_week, count(*) AS n_examined,
                   count(*) FILTER (motile_caligus >= 1) AS n_caligus_infected,
                   count(*) FILTER (motile_lep >= 1) AS n_lep_infected
            FROM totals WHERE {where} GROUP BY ALL HAVING count(*) >= 3) g
            UNPIVOT (n_infected FOR lice_spp IN (n_caligus_infected, n_lep_infected))""",
        lambda t, ss, flag=flag: lice.weekly_prevalence(t, ss, drop_unplaced=flag),
        doubles=["prevalence"],
    )
weekly(
    "q29_infection_intensity",
    " UNION ALL ".join(
        f"""SELECT region, species, sampling_week, '{k}' AS lice_spp, avg({m}) AS intensity,
            stddev_samp({m}) / sqrt(count(*)) AS se FROM totals WHERE {m} > 0 GROUP BY ALL"""
        for k, m in {"all": "total_lice", **MOTILE}.items()
    ),
    lice.infection_intensity,
    doubles=["intensity", "se"],
)
weekly(
    "q31_any_louse_prevalence",
    f"""SELECT region, sampling_week, p AS lice_present,
        CASE WHEN count(p) OVER w = count(*) OVER w THEN stddev_samp(p) OVER w END / sqrt(count(*) OVER w) AS se
        FROM (SELECT region, sampling_week, {strict("avg", "any_louse")} AS p
              FROM (SELECT *, CAST(total_lice > 0 AS INTEGER) AS any_louse FROM totals) t GROUP BY ALL) g
        WINDOW w AS (PARTITION BY region)""",
    lice.any_louse_prevalence,
    doubles=["lice_present", "se"],
)

FISH = ("fish", *SURVEY)
LABEL = "CASE lice_presence WHEN 'A' THEN 'Absent' WHEN 'P' THEN 'Present' ELSE lice_presence END AS lice_presence"
query(
    "q32_presence_by_zone",
    FISH,
    f"""SELECT sampling_week, species, zone, {LABEL}, n AS "count",
               n / CAST(sum(n) OVER (PARTITION BY sampling_week, species, zone) AS DOUBLE) AS prop
        FROM (SELECT sampling_week, species, zone, lice_presence, count(*) AS n
              FROM fish LEFT JOIN ss ON fish.seine_id = ss.seine_id
              WHERE field_lice_id_protocol = 'presence/absence' GROUP BY ALL) c""",
    extra=(SS,),
    doubles=["prop"],
)(lambda fish, *s: lice.presence_by_zone(fish, survey_seines(*s)))
query(
    "q32_presence_by_year",
    FISH,
    f"""SELECT year, species, {LABEL}, n AS "count",
               n / CAST(sum(n) OVER (PARTITION BY year, species) AS DOUBLE) AS prop
        FROM (SELECT year, species, lice_presence, count(*) AS n FROM fish LEFT JOIN ss ON fish.seine_id = ss.seine_id
              WHERE lice_presence <> 'NA' AND species IN ('SO', 'PI', 'CU') GROUP BY ALL) c""",
    extra=(SS,),
    doubles=["prop"],
)(lambda fish, *s: lice.presence_by_year(fish, survey_seines(*s)))

# ---- yearly series ----

CATCHES = """catches AS (
  SELECT ufn, f.seine_id, species, survey_date, site_id, region FROM fish f LEFT JOIN ss ON f.seine_id = ss.seine_id)"""
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in lice.CURRENT_COUNTS)


AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in lice.CURRENT_COUNTS[:8])


def current_ctes(leps_share: str) -> list[str]:
    return [
        f"""loused AS (
  SELECT c.survey_date, c.seine_id, c.species, l.*  EXCLUDE (seine_id), lep_cope + lam + laf + lgf AS leps,
         cal_cope + cam + caf + cgf AS cal, chal_a_b + unid_cope + unid_chal AS unk
  FROM lice l JOIN catches c ON l.ufn = c.ufn AND l.seine_id = c.seine_id
  WHERE year(c.survey_date) = {SEASON} AND {COMPLETE})""",
        f"""odds AS (SELECT {leps_share} AS r
          FROM (SELECT CAST(sum(leps) AS DOUBLE) AS leps, CAST(sum(cal) AS DOUBLE) AS cal FROM loused) s)""",
        f"""counted AS (
  SELECT survey_date, seine_id, species, ufn, {AS_DOUBLE}, unk * r AS inferred_leps, unk * (1 - r) AS inferred_cal FROM loused, odds)""",
        """current_lice AS (
  SELECT survey_date, seine_id, species, ufn,
         CASE WHEN part IN ('cal_cope', 'inferred_cal', 'cam', 'caf', 'cgf') THEN 'Caligus clemensi'
              ELSE 'Lepeophtheirus salmonis' END AS louse_species,
         CASE WHEN part IN ('cal_cope', 'lep_cope', 'inferred_leps', 'inferred_cal') THEN 'attached'
              ELSE 'motile' END AS life_stage,
         sum(n) AS "count", 'current_lice' AS origin
  FROM counted w
  UNPIVOT (n FOR part IN (lep_cope, lam, laf, lgf, cal_cope, cam, caf, cgf, inferred_leps, inferred_cal))
  GROUP BY ALL)""",
    ]


LEPS_SHARES = {"odds": "leps / nullif(cal, 0)", "share": "leps / nullif(leps + cal, 0)"}
CURRENT = current_ctes(LEPS_SHARES["odds"])
CURRENT_VIEWS = ("lice", "fish", *SURVEY)
for mode, leps_share in LEPS_SHARES.items():
    query(
        f"q33_current_lice_{mode}",
        CURRENT_VIEWS,
        """SELECT *, year(survey_date) AS year FROM current_lice WHERE species IN ('SO', 'PI', 'CU')""",
        extra=(SS, CATCHES, *current_ctes(leps_share)),
        doubles=['"count"'],
    )(
        lambda counts, fish, *s, mode=mode: lice.current_lice(
            counts, fish, survey_seines(*s), SEASON, ratio_mode=mode
        )
    )

# the attached columns that the laboratory sheet of the tables has
LAB_LEPS = ["lep_cop", "lep_chal_a", "lep_chal_b"]
LAB_CALS = ["cal_cop", "cal_chal_a_1", "cal_chal_b_3"]

LAB = """lab AS (
  SELECT survey_date, seine_id, species, ufn,
         CASE WHEN part LIKE 'lep%' THEN 'Lepeophtheirus salmonis' ELSE 'Caligus clemensi' END AS louse_species,
         'attached' AS life_stage, CAST(sum(n) AS DOUBLE) AS "count", 'sealice_lab_fs' AS origin
  FROM (SELECT l.*, survey_date, seine_id, species FROM lice_lab l JOIN catches USING (ufn)
        WHERE region = 'DI' AND site_id IN (SELECT site_id FROM consistent_sites)) j
  UNPIVOT (n FOR part IN (lep_cop, lep_chal_a, lep_chal_b, lep_a_m, lep_grav_f, cal_cop, cal_chal_a_1, cal_chal_b_3,
                          cal_mot_unid))
  WHERE part NOT IN ('lep_a_m', 'lep_grav_f', 'cal_mot_unid') GROUP BY ALL)"""
query(
    "q34_lab_attached_lice",
    ["lice_lab", "fish", "consistent_sites", *SURVEY],
    "SELECT * FROM lab",
    extra=(SS, CATCHES, LAB),
    doubles=['"count"'],
)(lambda lab, fish, alike, *s: lice.lab_attached(lab, lice.catch_data(fish, survey_seines(*s)), alike, LAB_LEPS, LAB_CALS))

SERIES = """series AS (
  SELECT l.survey_date, c.seine_id, l.species, l.ufn,
         CASE WHEN louse_species = 'motile_caligus' THEN 'Caligus clemensi' ELSE 'Lepeophtheirus salmonis' END
           AS louse_species,
         'motile' AS life_stage, CAST(n_lice AS DOUBLE) AS "count", 'lab_mots_ts' AS origin
  FROM lice_series l LEFT JOIN catches c USING (ufn)
  WHERE l.region = 'DI' AND l.year = year(l.survey_date) AND louse_species <> 'all_lice')"""
query(
    "q35_lab_motile_series",
    ["lice_series", "fish", *SURVEY],
    "SELECT * FROM series",
    extra=(SS, CATCHES, SERIES),
    doubles=['"count"'],
)(lambda series, fish, *s: lice.motile_series(series, lice.catch_data(fish, survey_seines(*s))))

FIELD = [
    """field_rows AS (
  SELECT f.*, survey_date, seine_id, species, year(survey_date) AS year,
         lep_cope_field + lpam_field + lpaf_field + lam_field + laf_field + lgf_field AS leps,
         cal_cope_field + cal_mot_field + cgf_field AS cal,
         chal_a_field + chal_b_field + unid_cope_field + unid_chal_field AS unk
  FROM lice_field f JOIN catches USING (ufn)
  WHERE region = 'DI' AND site_id IN (SELECT site_id FROM consistent_sites))""",
    """field AS (
  SELECT survey_date, seine_id, species, ufn,
         CASE WHEN part LIKE '%cal%' THEN 'Caligus clemensi' ELSE 'Lepeophtheirus salmonis' END AS louse_species,
         'attached' AS life_stage, sum(n) AS "count", 'sealice_field' AS origin
  FROM (SELECT survey_date, seine_id, species, ufn, CAST(lep_cope_field AS DOUBLE) AS lep_cope,
               CAST(cal_cope_field AS DOUBLE) AS cal_cope, unk * r AS inferred_leps, unk * (1 - r) AS inferred_cal
        FROM field_rows JOIN (SELECT year, CAST(sum(leps) AS DOUBLE) / nullif(CAST(sum(cal) AS DOUBLE), 0) AS r
                              FROM field_rows GROUP BY year) y USING (year)) w
  UNPIVOT (n FOR part IN (lep_cope, cal_cope, inferred_leps, inferred_cal)) GROUP BY ALL)""",
]
FIELD_VIEWS = ["lice_field", "fish", "consistent_sites", *SURVEY]
query("q36_field_attached_lice", FIELD_VIEWS, "SELECT * FROM field", extra=(SS, CATCHES, *FIELD), doubles=['"count"'])(
    lambda field, fish, alike, *s: lice.field_attached(field, lice.catch_data(fish, survey_seines(*s)), alike)
)

DUPS = """dups AS (
  SELECT DISTINCT ufn FROM (SELECT ufn FROM (SELECT * FROM lab UNION ALL SELECT * FROM field) u
                            GROUP BY ufn, louse_species, life_stage HAVING count(*) > 1) d)"""


def by_fish(counts, lab, series, field, fish, alike, *s):
    sheets = [
        lice.lab_sheet(lab, LAB_LEPS, LAB_CALS), lice.current_sheet(counts), lice.field_sheet(field), lice.series_sheet(series)
    ]
    return lice.lice_by_fish(sheets, lice.catch_data(fish, survey_seines(*s)), alike, SEASON)


query(
    "q37_cross_source_duplicates",
    ["lice_lab", *FIELD_VIEWS],
    "SELECT ufn FROM dups",
    extra=(SS, CATCHES, LAB, *FIELD, DUPS),
)(
    lambda lab, field, fish, alike, *s: lice.cross_source_duplicates(
        lice.lab_sheet(lab, LAB_LEPS, LAB_CALS), lice.field_sheet(field), lice.catch_data(fish, survey_seines(*s)), alike
    )
)

ALL_VIEWS = ["lice", "lice_lab", "lice_series", "lice_field", "fish", "consistent_sites", *SURVEY]
ALL_CTES = [
    SS,
    CATCHES,
    *CURRENT,
    LAB,
    SERIES,
    *FIELD,
    DUPS,
    "field_kept AS (SELECT * FROM field WHERE ufn NOT IN (SELECT ufn FROM dups))",
    """long AS (
  SELECT * FROM lab UNION ALL SELECT * FROM current_lice UNION ALL SELECT * FROM field_kept
  UNION ALL SELECT * FROM series)""",
    """host_counts AS (
  SELECT year, species, n AS a, n AS m FROM (SELECT year(survey_date) AS year, species, count(DISTINCT ufn) AS n
                                             FROM current_lice GROUP BY ALL) c
  UNION ALL SELECT year(d), species, count(*), 0 FROM (SELECT ufn, species, min(survey_date) AS d FROM lab
                                                       GROUP BY ALL) l GROUP BY ALL
  UNION ALL SELECT year(d), species, 0, count(*) FROM (SELECT ufn, species, min(survey_date) AS d FROM series
                                                       GROUP BY ALL) l GROUP BY ALL
  UNION ALL SELECT year(d), species, count(*), 0 FROM (SELECT ufn, species, life_stage, min(survey_date) AS d
                                                       FROM field_kept GROUP BY ALL) l GROUP BY ALL)""",
    """hosts AS (
  SELECT species, year, 'attached' AS life_stage, CAST(sum(a) AS BIGINT) AS n_hosts FROM host_counts GROUP BY ALL
  UNION ALL SELECT species, year, 'motile', CAST(sum(m) AS BIGINT) FROM host_counts GROUP BY ALL)""",
]
query("q38_hosts_examined", ALL_VIEWS, "SELECT * FROM hosts", extra=ALL_CTES, integers=["n_hosts"])(
    lambda *v: lice.hosts_examined(by_fish(*v))
)
SHOWN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SALMON_LABELS.items())
ORDER = " ".join(f"WHEN '{k}' THEN {i + 1}" for i, k in enumerate(SALMON_LABELS))
SPECIES = f"CASE species {SHOWN} ELSE species END AS species, CASE species {ORDER} END AS species_order"
STAGE = "CASE life_stage WHEN 'motile' THEN 'Motile' ELSE 'Attached' END AS life_stage"


@query(
    "q39_yearly_abundance",
    ALL_VIEWS,
    f"""SELECT year, {SPECIES}, louse_species, {STAGE}, mean_abundance, sd, n_hosts, sd / sqrt(n_hosts) AS se,
               greatest(mean_abundance - sd / sqrt(n_hosts), 0) + 0 * sd AS lower,
               mean_abundance + sd / sqrt(n_hosts) AS upper
        FROM (SELECT year(survey_date) AS year, species, louse_species, life_stage, avg("count") AS mean_abundance,
                     stddev_samp("count") AS sd
              FROM long WHERE species <> 'CO' AND "count" IS NOT NULL GROUP BY ALL) a
        LEFT JOIN hosts USING (species, year, life_stage) WHERE n_hosts >= 3""",
    extra=ALL_CTES,
    doubles=["mean_abundance", "sd", "se", "lower", "upper"],
    integers=["species_order"],
)
def yearly_abundance(*v):
    return lice.yearly_abundance(by_fish(*v))


@query(
    "q40_yearly_prevalence",
    ALL_VIEWS,
    f"""SELECT year, {SPECIES}, louse_species, {STAGE}, mean_prev, sd, n, sd / sqrt(n) AS se,
               CASE WHEN sd IS NOT NULL THEN greatest(mean_prev - sd / sqrt(n), 0) END AS lower,
               mean_prev + sd / sqrt(n) AS upper,
               CAST(0.1 AS DOUBLE) * count(*) OVER (PARTITION BY year, louse_species, life_stage) AS width
        FROM (SELECT year(survey_date) AS year, species, louse_species, life_stage, {strict("avg", "p")} AS mean_prev,
                     {strict("stddev_samp", "p")} AS sd, count(*) AS n
              FROM (SELECT survey_date, seine_id, species, louse_species, life_stage,
                           CASE WHEN count("count") = count(*)
                                THEN count(*) FILTER ("count" > 0) / CAST(count(*) AS DOUBLE) END AS p
                    FROM long GROUP BY ALL) s GROUP BY ALL) g
        WHERE n > 1 AND species <> 'CO'""",
    extra=ALL_CTES,
    doubles=["mean_prev", "sd", "se", "lower", "upper", "width"],
    integers=["species_order"],
)
def yearly_prevalence(*v):
    return lice.yearly_prevalence(by_fish(*v))
