"""Catch and migration timing queries."""

from brinewave.fixtures import SEASON
from brinewave.functions.labels import CATCH_LABELS, SAMPLING_WEEK_LABELS
from brinewave.functions.numeric import T_TABLE_MAX, t_quantile
from brinewave.plans import catch, timing
from brinewave.plans.survey import survey_seines
from brinewave.queries.registry import query

SURVEY = ("surveys", "seines", "sites")
WEEK_CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in SAMPLING_WEEK_LABELS.items())
SS = f"""ss AS (
  SELECT s.survey_id, s.survey_date, s.site_id, e.seine_id, e.so_total, e.pi_total, e.cu_total, e.co_total,
         e.he_total, e.ck_total, t.site_name, t.region, t.zone, year(s.survey_date) AS year,
         dayofyear(s.survey_date) AS yday, (dayofyear(s.survey_date) + 4) // 7 AS week_number,
         CASE (dayofyear(s.survey_date) + 4) // 7 {WEEK_CASE} END AS sampling_week
  FROM surveys s LEFT JOIN seines e ON s.survey_id = e.survey_id LEFT JOIN sites t ON s.site_id = t.site_id)"""
EXCLUDED = (457, 458, 459, 460, 461, 462, 463, 464)


def strict(aggregate: str, c: str) -> str:
    return f"CASE WHEN count({c}) = count(*) THEN {aggregate}({c}) END"


def on_ss(f, *args, **kwargs):
    return lambda surveys, seines, sites: f(survey_seines(surveys, seines, sites), *args, **kwargs)


def ss_query(name, sql, extra=(), **options):
    return query(name, SURVEY, sql, extra=(SS, *extra), **options)


ss_query("q00_survey_seines", "SELECT * FROM ss", integers=["week_number", "year", "yday"])(
    lambda surveys, seines, sites: survey_seines(surveys, seines, sites).drop("crew")
)

ss_query(
    "q12_catch_table",
    f"""SELECT survey_date AS "Survey Date", site_id AS "Site ID", site_name AS "Site", so_total AS "Sockeye",
        pi_total AS "Pink", cu_total AS "Chum" FROM ss WHERE year = {SEASON}""",
)(on_ss(catch.catch_table, SEASON))

ss_query(
    "q13_weekly_catch",
    f"""SELECT year, region, sampling_week, avg(so_total) AS mean, count(*) AS n,
        {strict("stddev_samp", "so_total")} / sqrt(count(*)) AS se
        FROM ss WHERE year IS NOT NULL GROUP BY ALL""",
    doubles=["mean", "se"],
)(on_ss(catch.weekly_catch))

ss_query(
    "q13_weekly_catch_with_sd",
    """SELECT year, region, sampling_week, avg(so_total) AS so_cpue, stddev_samp(so_total) AS so_cpue_sd,
        count(*) AS n, stddev_samp(so_total) / sqrt(count(*)) AS se FROM ss GROUP BY ALL""",
    doubles=["so_cpue", "so_cpue_sd", "se"],
)(on_ss(catch.weekly_catch_with_sd))

ss_query(
    "q14_weekly_cpue_of_daily_means",
    """SELECT year, region, sampling_week, avg(c) AS so_cpue, stddev_samp(c) AS so_cpue_sd, count(*) AS n FROM (
        SELECT year, coalesce(region, '0') AS region, survey_date, coalesce(sampling_week, '0') AS sampling_week,
               avg(coalesce(so_total, 0)) AS c FROM ss GROUP BY ALL) d GROUP BY ALL""",
    doubles=["so_cpue", "so_cpue_sd"],
)(on_ss(catch.weekly_cpue))


def cumulative_sql(totals, keys, where, value):
    daily = ", ".join(f"{value(t)} AS {t}" for t in totals)
    w = f"OVER (PARTITION BY {keys} ORDER BY survey_date ROWS UNBOUNDED PRECEDING)"
    runs = ", ".join(
        f"CASE WHEN count({t}) {w} = count(*) {w} THEN sum({t}) {w} END AS {t[:2]}_cum_abund" for t in totals
    )
    names = ", ".join(f"{t[:2]}_cum_abund" for t in totals)
    return f"""SELECT * FROM (
        SELECT {keys}, survey_date, {runs} FROM (
            SELECT {keys}, survey_date, {daily} FROM ss WHERE {where} GROUP BY {keys}, survey_date) d) c
        UNPIVOT INCLUDE NULLS (cum_abund FOR species IN ({names}))"""


ALL = ["so_total", "pi_total", "cu_total", "co_total", "he_total", "ck_total"]
COMPLETE = " AND ".join(f"{t} IS NOT NULL" for t in ALL[:5])
ss_query(
    "q15_cumulative_abundance_filled",
    cumulative_sql(
        ALL,
        "year, region",
        f"region IN ('DI', 'JS') AND (survey_id IS NULL OR survey_id NOT IN {EXCLUDED})",
        lambda t: f"avg(coalesce({t}, 0))",
    ),
    doubles=["cum_abund"],
    digits=6,
)(on_ss(catch.cumulative_abundance, excluded_surveys=EXCLUDED))

ss_query(
    "q15_cumulative_abundance_strict",
    cumulative_sql(ALL, "year, region", "region IN ('DI', 'JS')", lambda t: strict("avg", t)),
    doubles=["cum_abund"],
    digits=6,
)(on_ss(catch.cumulative_abundance, missing="keep"))

ss_query(
    "q16_cumulative_abundance_all_regions",
    cumulative_sql(ALL[:5], "year", COMPLETE, lambda t: f"avg({t})"),
    doubles=["cum_abund"],
    digits=6,
)(on_ss(catch.cumulative_abundance, totals=ALL[:5], by_region=False, missing="drop"))

ss_query(
    "q16_cumulative_abundance_by_region",
    cumulative_sql(ALL[:5], "year, region", f"region IN ('DI', 'JS') AND {COMPLETE}", lambda t: f"avg({t})"),
    doubles=["cum_abund"],
    digits=6,
)(on_ss(catch.cumulative_abundance, totals=ALL[:5], missing="drop"))


def timing_ctes(season, source="ss"):
    return (
        f"""one AS (
  SELECT * FROM {source} WHERE survey_date > DATE '{season}-01-01' AND survey_date < DATE '{season}-12-31'
  QUALIFY row_number() OVER (PARTITION BY survey_id ORDER BY survey_date, seine_id) = 1)""",
        f"""groups AS (
  SELECT site_id, week(survey_date) AS week, round_even({strict("avg", "so_total")}, 0) AS so_total,
         round_even({strict("avg", "pi_total")}, 0) AS pi_total, count(*) AS "count"
  FROM one GROUP BY site_id, week(survey_date) HAVING count(*) > 1)""",
        """doubled AS (
  SELECT o.survey_id, o.seine_id, o.survey_date, o.site_id, g.week, g."count", g.so_total, g.pi_total
  FROM one o JOIN groups g ON o.site_id IS NOT DISTINCT FROM g.site_id AND week(o.survey_date) = g.week)""",
        f"""corrected AS (
  SELECT survey_date, CAST(so_total AS DOUBLE) AS so_total FROM {source}
  WHERE survey_id NOT IN (SELECT survey_id FROM doubled) AND region = 'DI' AND so_total > 0
  UNION ALL
  (SELECT survey_date, so_total FROM doubled
   QUALIFY row_number() OVER (PARTITION BY site_id, week ORDER BY survey_date, survey_id) = 1))""",
        """timing AS (
  SELECT year(survey_date) AS year, survey_date, dayofyear(survey_date) AS yday, so_total,
         sum(so_total / total * 100) OVER (PARTITION BY year(survey_date) ORDER BY survey_date
                                           ROWS UNBOUNDED PRECEDING) AS percent,
         so_total / total AS non_cumul_prop
  FROM (SELECT survey_date, so_total, sum(so_total) OVER (PARTITION BY year(survey_date)) AS total
        FROM (SELECT survey_date, avg(so_total) AS so_total FROM corrected
              WHERE so_total IS NOT NULL GROUP BY survey_date) a) b)""",
    )


ss_query(
    "q17_double_effort",
    "SELECT * FROM doubled",
    extra=timing_ctes(SEASON),
    doubles=["so_total", "pi_total"],
    integers=["week"],
)(on_ss(lambda ss: timing.double_effort(ss, SEASON).drop("cu_total", "co_total", "he_total")))

ss_query(
    "q17_corrected_catch",
    "SELECT survey_date, so_total, year(survey_date) AS year, dayofyear(survey_date) AS yday FROM corrected",
    extra=timing_ctes(SEASON),
    doubles=["so_total"],
)(on_ss(timing.corrected_catch, SEASON))

ss_query(
    "q18_migration_timing",
    "SELECT * FROM timing",
    extra=timing_ctes(SEASON),
    doubles=["so_total", "percent", "non_cumul_prop"],
)(on_ss(lambda ss: timing.migration_timing(timing.corrected_catch(ss, SEASON))))

PROGRESS = f"""
SELECT survey_date, seine_id, so_total, yday,
       100 * CAST(sum(so_total) OVER (ORDER BY survey_date, seine_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           / CAST(sum(so_total) OVER () AS DOUBLE) AS percent
FROM ss WHERE year = {SEASON} AND so_total > 0"""
ss_query("q18_season_progress", PROGRESS, doubles=["percent"])(on_ss(timing.season_progress, SEASON))

CORRECTED = SEASON - 2
PAST = "past AS (SELECT * FROM ss WHERE year < 2001)"
ss_query(
    "q19_timing_points",
    f"""SELECT 'predicted_percent' AS period, yday, percent FROM timing
        UNION ALL SELECT 'predicted_current', yday, percent FROM ({PROGRESS}) p""",
    extra=(PAST, *timing_ctes(CORRECTED, "past")),
    doubles=["percent"],
)(on_ss(timing.timing_points, SEASON, CORRECTED))

_CURVE = "(1 / (1 + exp((mid - x) / scale)))"
_SUMS = ", ".join(
    [f"sum(n * j{i} * j{j}) AS a{i}{j}" for i in range(3) for j in range(i, 3)] + [f"sum(n * j{i} * r) AS r{i}" for i in range(3)]
)
#: The logistic fits by recursion over steps: normal equations, adjugate, all halvings of the step, the largest accepted.
FITS = f"""WITH points AS (
  SELECT 'predicted_percent' AS period, CAST(yday AS DOUBLE) AS x, percent AS y FROM timing
  UNION ALL SELECT 'predicted_current', CAST(yday AS DOUBLE), percent FROM ({{progress}}) p),
days AS MATERIALIZED (
  SELECT period, x, CAST(count(*) AS DOUBLE) AS n, avg(y) AS mean, var_pop(y) * count(*) AS noise FROM points GROUP BY period, x),
fit_groups AS MATERIALIZED (
  SELECT period, max(y) AS top, median(x) AS middle, count(*) AS n, min(x) AS x_min, max(x) AS x_max, count(DISTINCT x) AS n_x
  FROM points WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY period),
noise AS MATERIALIZED (SELECT period, sum(noise) AS noise FROM days GROUP BY period),
steps AS (
  SELECT period, 0 AS step, top AS asym, middle AS mid, CAST(1 AS DOUBLE) AS scale, CAST(1 AS DOUBLE) AS factor, false AS converged,
         n_x > 2 AS open FROM fit_groups
  UNION ALL
  SELECT period, step + 1, CASE WHEN stays THEN asym ELSE asym + best * d0 END, CASE WHEN stays THEN mid ELSE mid + best * d1 END,
         CASE WHEN stays THEN scale ELSE scale + best * d2 END, CASE WHEN stays THEN factor ELSE least(2 * best, 1) END,
         ended, NOT stays
  FROM (
    SELECT *, ended OR NOT regular OR best IS NULL AS stays FROM (
      SELECT period, step, asym, mid, scale, factor, d0, d1, d2, regular, ended,
             max(k) FILTER (WHERE trial <= rss) AS best
      FROM (
        SELECT m.*, k, sum(days.n * (days.mean - (m.asym + k * d0) / (1 + exp((m.mid + k * d1 - days.x) / (m.scale + k * d2)))) ** 2)
               AS trial
        FROM (
          SELECT s.* EXCLUDE (noise), rss, coalesce(regular, false) AS regular,
                 coalesce(regular AND (explained <= 1e-10 * greatest(rss + s.noise - explained, 1e-300)
                   OR greatest(abs(d0), abs(d1), abs(d2)) <= 1e-12 * greatest(abs(asym), abs(mid), abs(scale))), false) AS ended
          FROM (
            SELECT period, step, asym, mid, scale, factor, noise, rss, det > 1e-18 * a00 * a11 * a22 AS regular,
                   u0 / nullif(det, 0) AS d0, u1 / nullif(det, 0) AS d1, u2 / nullif(det, 0) AS d2,
                   (u0 * r0 + u1 * r1 + u2 * r2) / nullif(det, 0) AS explained
            FROM (
              SELECT *, a00 * c00 + a01 * c01 + a02 * c02 AS det, c00 * r0 + c01 * r1 + c02 * r2 AS u0,
                     c01 * r0 + c11 * r1 + c12 * r2 AS u1, c02 * r0 + c12 * r1 + c22 * r2 AS u2
              FROM (
                SELECT *, a11 * a22 - a12 * a12 AS c00, a02 * a12 - a01 * a22 AS c01, a01 * a12 - a02 * a11 AS c02,
                       a00 * a22 - a02 * a02 AS c11, a01 * a02 - a00 * a12 AS c12, a00 * a11 - a01 * a01 AS c22
                FROM (
                  SELECT period, step, asym, mid, scale, factor, noise, sum(n * r * r) AS rss, {_SUMS}
                  FROM (
                    SELECT *, mean - asym * f AS r, f AS j0, -asym * f * (1 - f) / scale AS j1,
                           asym * f * (1 - f) / scale * (mid - x) / scale AS j2
                    FROM (SELECT steps.*, noise.noise, days.x, days.n, days.mean, {_CURVE} AS f
                          FROM steps JOIN days USING (period) JOIN noise USING (period) WHERE open AND step < 50) w) g
                  GROUP BY ALL) a) b) c) s) m
          JOIN days ON days.period = m.period JOIN (SELECT 1 / 2 ** unnest(range(11)) AS k) halvings ON k <= m.factor
        GROUP BY ALL) t
      GROUP BY ALL) u) v),
fits AS (
  SELECT period, asym, mid, scale, converged, n, x_min, x_max
  FROM (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY period ORDER BY step DESC) = 1) JOIN fit_groups USING (period))"""


def fits_ctes() -> tuple[str, ...]:
    return (PAST, *timing_ctes(CORRECTED, "past"), FITS.replace("{progress}", PROGRESS).removeprefix("WITH "))


ss_query(
    "q19_timing_fits",
    "SELECT * FROM fits",
    extra=fits_ctes(),
    doubles=["asym", "mid", "scale", "x_min", "x_max"],
    digits=4,
    recursive=True,
)(on_ss(timing.timing_fits, SEASON, CORRECTED))

ss_query(
    "q19_timing_curves",
    """SELECT period, point, yday, asym / (1 + exp((mid - yday) / scale)) AS predicted FROM (
         SELECT f.*, CAST(point AS BIGINT) AS point, b.x_min + point * (b.x_max - b.x_min) / 99 AS yday
         FROM fits f, (SELECT x_min, x_max FROM fits WHERE period = 'predicted_percent') b, range(100) r(point)) c""",
    extra=fits_ctes(),
    doubles=["yday", "predicted"],
    digits=4,
    recursive=True,
)(on_ss(timing.timing_curves, SEASON, CORRECTED))

ss_query(
    "q20_rolling_catch",
    f"""SELECT survey_date AS date, CAST(so_total AS DOUBLE) AS so_total, '{SEASON}' AS "group",
               CASE WHEN count(so_total) OVER w = 5 THEN avg(so_total) OVER w END AS seven_avg
        FROM ss WHERE year = {SEASON}
        WINDOW w AS (ORDER BY survey_date, coalesce(seine_id, survey_id), seine_id NULLS FIRST
                     ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
        UNION ALL
        SELECT date, so_total, 'all years', CASE WHEN count(so_total) OVER v = 5 THEN avg(so_total) OVER v END
        FROM (SELECT date, {strict("avg", "so_total")} AS so_total FROM (
                SELECT TRY_CAST(concat('{SEASON}-', month(survey_date), '-', day(survey_date)) AS DATE) AS date, so_total
                FROM (SELECT survey_date, {strict("avg", "so_total")} AS so_total FROM ss GROUP BY survey_date) a) b
              GROUP BY date) c
        WINDOW v AS (ORDER BY date NULLS LAST ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
    doubles=["so_total", "seven_avg"],
)(on_ss(catch.rolling_catch, SEASON))

T_VALUES = ", ".join(f"({d}, {t_quantile(0.975, d)!r})" for d in range(1, T_TABLE_MAX + 1))
INTENSITY = f"""
SELECT year, species, {strict("avg", "catch")} AS mean_catch, {strict("stddev_samp", "catch")} AS sd, count(*) AS n,
       {strict("stddev_samp", "catch")} / sqrt(count(*)) AS se
FROM (SELECT year, so_total AS "Sockeye", pi_total AS "Pink", cu_total AS "Chum" FROM ss WHERE so_total > 0) a
UNPIVOT INCLUDE NULLS (catch FOR species IN ("Sockeye", "Pink", "Chum")) GROUP BY year, species"""
# the expansion around the normal quantile, for more degrees of freedom than the table has
LARGE_T = "(1.9599639845400536 + 2.3722712302985607 / d + 2.8224986157396086 / d ** 2 + 2.555849679507719 / d ** 3)"


@ss_query(
    "q21_catch_intensity",
    """SELECT *, CASE species WHEN 'Sockeye' THEN 1 WHEN 'Pink' THEN 2 WHEN 'Chum' THEN 3 END AS species_order FROM (
        SELECT year, species, mean_catch, sd, n, se, NULL AS lower_ci, NULL AS upper_ci FROM intensity WHERE year < 2001
        UNION ALL
        SELECT year, species, round_even(mean_catch, 1), round_even(sd, 1), n, round_even(se, 1),
               round_even(tv * se, 1), round_even(tv * se, 1)
        FROM (SELECT i.*, coalesce(t.v, CASE WHEN d > 200 THEN """
    + LARGE_T
    + """ END) AS tv
              FROM (SELECT *, CAST(n - 1 AS DOUBLE) AS d FROM intensity) i LEFT JOIN t ON t.df = i.n - 1) j
        WHERE year = 2001) u""",
    extra=(f"intensity AS ({INTENSITY})", f"t(df, v) AS (VALUES {T_VALUES})"),
    doubles=["mean_catch", "sd", "se", "lower_ci", "upper_ci"],
    integers=["species_order"],
)
def catch_intensity(surveys, seines, sites):
    ss = survey_seines(surveys, seines, sites)
    return catch.catch_intensity(ss, SEASON, history=catch.intensity_counts(ss.filter(f"year < {SEASON}")))


LABEL_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATCH_LABELS.items())
ORDER_CASE = " ".join(f"WHEN '{k}' THEN {i + 1}" for i, k in enumerate(CATCH_LABELS))


@ss_query(
    "q22_species_proportion",
    f"""SELECT year, CASE species {LABEL_CASE} ELSE species END AS species, n,
               n / CAST(sum(n) OVER (PARTITION BY year) AS DOUBLE) AS proportion,
               CASE species {ORDER_CASE} END AS species_order
        FROM (SELECT year, species, CAST(sum(n) AS BIGINT) AS n
              FROM (SELECT year, {", ".join(ALL)} FROM ss WHERE so_total > 0 AND {COMPLETE}
                    AND ck_total IS NOT NULL AND seine_id IS NOT NULL) a
              UNPIVOT (n FOR species IN ({", ".join(ALL)})) GROUP BY year, species HAVING sum(n) > 0) b""",
    doubles=["proportion"],
    integers=["species_order"],
)
def species_proportion(surveys, seines, sites):
    ss = survey_seines(surveys, seines, sites)
    return catch.species_proportion(ss, SEASON, history=catch.proportion_counts(ss.filter(f"year < {SEASON}")))


query(
    "q41_crew_effort",
    ["surveys"],
    """SELECT CASE name WHEN 'Crew 3' THEN 'Crew Three' ELSE name END AS name, count(*) AS n
       FROM (SELECT trim(unnest(string_split(crew, ','))) AS name FROM surveys) a GROUP BY name""",
)(lambda surveys: catch.crew_effort(surveys, {"Crew 3": "Crew Three"}))

query(
    "q42_survey_calendar",
    ["surveys", "sites"],
    """SELECT survey_id, dayofyear(survey_date) AS yday, region
       FROM surveys LEFT JOIN sites ON surveys.site_id = sites.site_id""",
)(catch.survey_calendar)
