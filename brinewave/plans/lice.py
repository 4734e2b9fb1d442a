"""Sea-lice products: weekly abundance, intensity and prevalence, and the multi-source yearly series.

Weekly products read the lice table alone, shrink it to sums by seine and species, and only then
attach region and week. The yearly series needs single fish; its sources are reduced to one row a
fish by arithmetic over columns before anything is turned long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinewave.functions.dates import in_season
from brinewave.functions.labels import PRESENCE_LABELS, SALMON_LABELS, position, recode
from brinewave.functions.nulls import (
    as_col,
    complete,
    ratio,
    row_sum,
    row_sum_present,
    rows,
    strict_mean,
    strict_sd,
    strict_sum,
)
from brinewave.functions.numeric import lower_bar
from brinewave.operators.grouping import (
    mean_of_parts,
    merged_parts,
    moment_parts,
    sd_of_parts,
    share_within,
)
from brinewave.operators.joins import null_safe_join
from brinewave.operators.reshape import bind, longer, longer_structs
from brinewave.plans.survey import counted_by_seine, seine_attributes

SALMON = ["SO", "PI", "CU"]
# Species labels.
LEP = "Lepeophtheirus salmonis"
CAL = "Caligus clemensi"

# Count columns of each field sheet, by louse stage and species.
FIELD_SHEETS = {
    2017: {
        "cope": ["cal.cope", "lep.cope", "unid.cope"],
        "chal": ["chal.a", "chal.b", "unid.chal"],
        "caligus": ["cal.mot", "gc"],
        "lep": ["palm", "palf", "lam", "laf", "gl"],
    },
    2018: {
        "cope": ["cal_cope", "lep_cope", "unid_cope"],
        "chal": ["chal_a", "chal_b", "unid_chal"],
        "caligus": ["cm", "cpaf", "caf", "cgf"],
        "lep": ["lpam", "lpaf", "lam", "laf", "lgf"],
    },
    2019: {
        "cope": ["cal_cope", "lep_cope", "unid_cope"],
        "chal": ["chal_a", "chal_b", "unid_chal"],
        "caligus": ["cal_mot", "cpaf", "caf", "cgf"],
        "lep": ["lpam", "lpaf", "lam", "laf", "lgf"],
    },
}
# Count columns of the current sheet.
CURRENT_COUNTS = [
    "lep_cope", "lam", "laf", "lgf", "cal_cope", "cam", "caf", "cgf", "chal_a_b", "unid_cope", "unid_chal",
]
# Count columns of the laboratory sheet.
LAB_ATTACHED_LEP = ["lep_cop", "lep_cunifer_cop", "lep_chal_a", "lep_chal_b"]
LAB_ATTACHED_CAL = [
    "cal_cop", "cal_chal_a_1", "cal_chal_a_2", "cal_chal_b_3", "cal_chal_b_4_f", "cal_chal_b_4_m",
    "cal_chal_4_unid", "cal_chal_a_unid", "cal_chal_b_unid",
]
MEASURES = ["total_lice", "copepodid", "chalimus", "motile", "motile_caligus", "motile_lep"]
# the order hosts_examined takes them in
FISH_KEYS = ["survey_date", "seine_id", "species", "ufn"]


def stage_totals(lice: DataFrame, sheet: int = 2018) -> DataFrame:
    """Lice totals of each salmon by stage and species; missing if any part is missing."""
    parts = FIELD_SHEETS[sheet]

    def total(*groups: str) -> Column:
        return row_sum([f"`{c}`" for g in groups for c in parts[g]])

    salmon = lice.filter(F.col("species").isin(*SALMON)) if "species" in lice.columns else lice
    return salmon.withColumns(
        {
            "total_lice": total("cope", "chal", "caligus", "lep"),
            "copepodid": total("cope"),
            "chalimus": total("chal"),
            "motile": total("caligus", "lep"),
            "motile_caligus": total("caligus"),
            "motile_lep": total("lep"),
        }
    )


def _weekly_parts(
    totals: DataFrame, ss: DataFrame, keys: Sequence[str], columns: dict[str, Column | str], drop_unplaced: bool
) -> DataFrame:
    """Row count and moments by key group, combined by seine before the survey join."""
    own = [k for k in keys if k in totals.columns]
    placed = [k for k in keys if k not in own]
    small = counted_by_seine(totals, ss, own, placed, [rows().alias("n"), *moment_parts(columns)])
    if drop_unplaced:
        small = complete(small, ["region"])
    return small.groupBy(*keys).agg(F.sum("n").alias("n"), *merged_parts(list(columns)))


def _abundance(parts: DataFrame, keys: Sequence[str], named: dict[str, str], label: str) -> DataFrame:
    """Mean and standard error (over all rows of the group) of each measure, long."""
    wide = parts.select(
        *keys,
        *[mean_of_parts(m).alias(f"{k}_mean") for k, m in named.items()],
        *[(sd_of_parts(m) / F.sqrt("n")).alias(f"{k}_se") for k, m in named.items()],
    )
    return longer_structs(wide, {k: {"abundance": f"{k}_mean", "se": f"{k}_se"} for k in named}, label)


def stage_abundance(totals: DataFrame, ss: DataFrame, species: str | None = "SO") -> DataFrame:
    """Weekly abundance of the three life stages by region."""
    base = totals.filter(F.col("species") == species) if species else totals
    keys = ["region", "sampling_week"]
    named = {"cope": "copepodid", "chal": "chalimus", "mot": "motile"}
    parts = _weekly_parts(base, ss, keys, {m: m for m in named.values()}, False)
    out = _abundance(parts, keys, named, "life_stage")
    return out.withColumn("stage_order", position("life_stage", list(named)))


def motile_abundance(
    totals: DataFrame,
    ss: DataFrame,
    keys: Sequence[str] = ("region", "species", "sampling_week"),
    drop_unplaced: bool = False,
) -> DataFrame:
    """Weekly abundance of motile lice by louse species."""
    named = {"cal": "motile_caligus", "lep": "motile_lep"}
    parts = _weekly_parts(totals, ss, list(keys), {m: m for m in named.values()}, drop_unplaced)
    return _abundance(parts, list(keys), named, "lice_species")


def infection_intensity(
    totals: DataFrame, ss: DataFrame, keys: Sequence[str] = ("region", "species", "sampling_week")
) -> DataFrame:
    """Mean lice of the infected fish only, for all lice and motile lice of each species."""
    named = {"all": "total_lice", "cal": "motile_caligus", "lep": "motile_lep"}
    infected = {m: F.when(F.col(m) > 0, F.col(m)) for m in named.values()}
    parts = _weekly_parts(totals, ss, list(keys), infected, False)
    wide = parts.select(
        *keys,
        *[mean_of_parts(m).alias(f"{k}_mean") for k, m in named.items()],
        *[ratio(sd_of_parts(m), F.sqrt(f"{m}__n")).alias(f"{k}_se") for k, m in named.items()],
    )
    long = longer_structs(wide, {k: {"intensity": f"{k}_mean", "se": f"{k}_se"} for k in named}, "lice_spp")
    return long.filter(F.col("intensity").isNotNull())


def weekly_prevalence(totals: DataFrame, ss: DataFrame, least: int = 3, drop_unplaced: bool = False) -> DataFrame:
    """Share of examined fish with motile lice, by louse species, where enough fish were examined."""
    counts = {"n_caligus_infected": F.col("motile_caligus") >= 1, "n_lep_infected": F.col("motile_lep") >= 1}
    keys = ["region", "species", "sampling_week"]
    tallies = [rows().alias("n_examined"), *[F.count_if(c).alias(n) for n, c in counts.items()]]
    small = counted_by_seine(totals, ss, ["species"], ["region", "sampling_week"], tallies)
    if drop_unplaced:
        small = complete(small, ["region"])
    names = ["n_examined", *counts]
    groups = small.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names]).filter(F.col("n_examined") >= least)
    return longer(groups, list(counts), "lice_spp", "n_infected").withColumn(
        "prevalence", ratio("n_infected", "n_examined")
    )


def any_louse_prevalence(totals: DataFrame, ss: DataFrame) -> DataFrame:
    """Weekly share of fish with any louse (missing if a count is), and its standard error over the
    weeks of the region."""
    tallies = [rows().alias("n"), F.count("total_lice").alias("c"), F.count_if(F.col("total_lice") > 0).alias("s")]
    small = counted_by_seine(totals, ss, [], ["region", "sampling_week"], tallies)
    weekly = small.groupBy("region", "sampling_week").agg(*[F.sum(c).alias(c) for c in ("n", "c", "s")])
    weekly = weekly.select(
        "region", "sampling_week", F.when(F.col("c") == F.col("n"), ratio("s", "n")).alias("lice_present")
    )
    w = Window.partitionBy("region")  # the weeks of one region: about a dozen rows
    whole = F.count("lice_present").over(w) == F.count(F.lit(1)).over(w)
    se = F.when(whole, F.stddev_samp("lice_present").over(w)) / F.sqrt(F.count(F.lit(1)).over(w))
    return weekly.withColumn("se", se)


def presence_by_zone(fish: DataFrame, ss: DataFrame) -> DataFrame:
    """Share of fish with and without lice by week, species and zone, of the fish so inspected."""
    base = fish.filter(F.col("field_lice_id_protocol") == "presence/absence")
    small = counted_by_seine(
        base, ss, ["species", "lice_presence"], ["sampling_week", "zone"], [rows().alias("count")]
    )
    keys = ["sampling_week", "species", "zone"]
    counts = small.groupBy(*keys, "lice_presence").agg(F.sum("count").alias("count"))
    shares = share_within(counts, keys, "count", "prop")
    return shares.withColumn("lice_presence", recode("lice_presence", PRESENCE_LABELS))


def presence_by_year(fish: DataFrame, ss: DataFrame) -> DataFrame:
    """Share of salmon with and without lice by year and species, unknown presence left out."""
    base = fish.filter((F.col("lice_presence") != "NA") & F.col("species").isin(*SALMON))
    small = counted_by_seine(base, ss, ["species", "lice_presence"], ["year"], [rows().alias("count")])
    counts = small.groupBy("year", "species", "lice_presence").agg(F.sum("count").alias("count"))
    shares = share_within(counts, ["year", "species"], "count", "prop")
    return shares.withColumn("lice_presence", recode("lice_presence", PRESENCE_LABELS))


# ---- the yearly series from four sources -------------------------------------------------------


#
# A sheet is narrowed to one schema first: what it counts of either louse, attached and motile, what could not be told
# apart (``unk``), and the sums whose ratio splits that. All sheets then meet the fish in one join on ``ufn``, and whatever
# is asked of single fish (copies, duplicates between sources, first records) stays in that partitioning.


def _sheet(df: DataFrame, origin: str, **columns: Column) -> DataFrame:
    numbers = {k: c.cast("double") if k in _MEASURES else c for k, c in columns.items()}
    return df.select("ufn", F.lit(origin).alias("origin"), *[c.alias(k) for k, c in numbers.items()])


_MEASURES = ("lep", "cal", "lep_motile", "cal_motile", "unk", "leps", "cals")


def current_sheet(lice: DataFrame) -> DataFrame:
    """This season's field counts of fish that were counted in full."""
    return _sheet(
        complete(lice, CURRENT_COUNTS), "current_lice", own_seine=F.col("seine_id"), lep=F.col("lep_cope"), cal=F.col("cal_cope"),
        lep_motile=row_sum(["lam", "laf", "lgf"]), cal_motile=row_sum(["cam", "caf", "cgf"]),
        unk=row_sum(["chal_a_b", "unid_cope", "unid_chal"]),
        leps=row_sum(["lep_cope", "lam", "laf", "lgf"]), cals=row_sum(["cal_cope", "cam", "caf", "cgf"]),
    )


def lab_sheet(
    lab: DataFrame, leps: Sequence[str] = tuple(LAB_ATTACHED_LEP), cals: Sequence[str] = tuple(LAB_ATTACHED_CAL)
) -> DataFrame:
    """Attached lice of the laboratory sheet; a missing column is an error."""
    absent = [c for c in [*leps, *cals] if c not in lab.columns]
    if absent:
        raise ValueError(f"the laboratory sheet has no column {', '.join(absent)}")
    return _sheet(lab, "sealice_lab_fs", lep=row_sum_present(list(leps)), cal=row_sum_present(list(cals)))


def field_sheet(field: DataFrame) -> DataFrame:
    """Attached lice of the field sheet."""
    return _sheet(
        field, "sealice_field", lep=F.col("lep_cope_field"), cal=F.col("cal_cope_field"),
        unk=row_sum([f"{c}_field" for c in ("chal_a", "chal_b", "unid_cope", "unid_chal")]),
        leps=row_sum([f"{c}_field" for c in ("lep_cope", "lpam", "lpaf", "lam", "laf", "lgf")]),
        cals=row_sum([f"{c}_field" for c in ("cal_cope", "cal_mot", "cgf")]),
    )


def series_sheet(series: DataFrame) -> DataFrame:
    """The published motile counts, one row a fish and louse."""
    kept = series.filter(
        (F.col("region") == "DI") & (F.col("year") == F.year("survey_date")) & (F.col("louse_species") != "all_lice")
    )
    is_cal = F.col("louse_species") == "motile_caligus"
    return _sheet(
        kept, "lab_mots_ts", own_date=F.col("survey_date"), own_species=F.col("species"), louse=F.when(is_cal, CAL).otherwise(LEP),
        lep_motile=F.when(~is_cal, F.col("n_lice")), cal_motile=F.when(is_cal, F.col("n_lice")),
    )


def _placed(sheets: Sequence[DataFrame], catches: DataFrame, sites: DataFrame | None, season: int | None) -> DataFrame:
    """The rows of the sheets with their fish: this season's seines for the current sheet, comparable sites for the two of
    attached lice; the published series keeps its own date and species and needs no fish."""
    hosts = catches.withColumn("_alike", F.lit(False)) if sites is None else catches.join(
        sites.select("site_id").distinct().withColumn("_alike", F.lit(True)), "site_id", "left"
    )
    hosts = hosts.select(
        "ufn", "seine_id", F.col("species").alias("_species"), F.col("survey_date").alias("_date"),
        F.coalesce((F.col("region") == "DI") & F.col("_alike"), F.lit(False)).alias("_alike"),
    )
    rows_ = bind(*sheets)
    for name, kind in (("own_seine", dict(hosts.dtypes)["seine_id"]), ("own_date", "date"), ("own_species", "string"),
                       ("louse", "string"), *((m, "double") for m in _MEASURES)):
        if name not in rows_.columns:
            rows_ = rows_.withColumn(name, F.lit(None).cast(kind))
    is_series = F.col("origin") == "lab_mots_ts"
    current = (F.col("seine_id") == F.col("own_seine")) & (in_season("_date", season) if season else F.lit(True))
    wanted = F.when(F.col("origin") == "current_lice", current).otherwise(is_series | F.col("_alike"))
    joined = rows_.join(hosts, "ufn", "left")
    # behind a generator the columns of the fish are not pruned: all readers of these rows need the same exchanges of the
    # fish, so Spark writes them once
    joined = joined.select(*rows_.columns, F.inline(F.array(F.struct(*[c for c in hosts.columns if c != "ufn"]))))
    return joined.filter(wanted).select(
        "ufn", "origin", "seine_id", F.when(is_series, F.col("own_date")).otherwise(F.col("_date")).alias("survey_date"),
        F.when(is_series, F.col("own_species")).otherwise(F.col("_species")).alias("species"), "louse", *_MEASURES,
    )


def lice_by_fish(
    sheets: Sequence[DataFrame],
    catches: DataFrame,
    sites: DataFrame | None = None,
    season: int | None = None,
    ratio_mode: str = "odds",
    distinct_sources: bool = True,
) -> DataFrame:
    """One row a fish and source: its keys, ``origin``, ``entries`` (louse species, life stage, count) and whether it is
    the ``first`` record of its host in the source. Rows of the published series are kept one by one.

    Unidentified lice are split by the ratio of both species' sums of the year, in the current sheet (one season) and in the field
    sheet. "odds" is the published form: leps/cal for one species and one minus it for the other, which goes negative when leps
    outnumber caligus. "share" uses leps/(leps + cal) instead, 1 where there is no caligus. Copies of a fish are added up.
    Attached lice that were not counted give no entry. With ``distinct_sources``, field rows of fish that have the same louse and stage
    in more than one row of laboratory and field are left out; ``twice`` marks such fish.
    """
    if ratio_mode not in ("odds", "share"):
        raise ValueError(f"ratio_mode must be odds or share, not {ratio_mode}")
    origin = F.col("origin")
    field, series = origin == "sealice_field", origin == "lab_mots_ts"
    placed = _placed(sheets, catches, sites, season).withColumn("_year", F.year("survey_date"))
    sums = placed.filter(origin.isin("current_lice", "sealice_field")).groupBy("origin", "_year").agg(
        F.sum("leps").alias("_leps"), F.sum("cals").alias("_cals")
    )
    both = F.col("_leps") + F.col("_cals") if ratio_mode == "share" else F.col("_cals")
    # two rows a calendar year at most: by any other join all rows would move to these few keys, and back to their fish
    placed = null_safe_join(placed.drop("leps", "cals"), F.broadcast(sums), ["origin", "_year"])
    for name, inferred in (("lep", F.col("unk") * ratio("_leps", both)), ("cal", F.col("unk") * (1 - ratio("_leps", both)))):
        present = F.when(F.coalesce(name, inferred).isNotNull(), F.coalesce(name, F.lit(0.0)) + F.coalesce(inferred, F.lit(0.0)))
        total = F.when(origin == "current_lice", F.col(name) + inferred).when(field, present).otherwise(F.col(name))
        placed = placed.withColumn(f"_{name}", total)
    copy = F.when(series, F.monotonically_increasing_id())  # rows of the series are not added up
    fish = placed.groupBy(*FISH_KEYS, "origin", "louse", copy.alias("_copy")).agg(
        F.sum("_lep").alias("lep"), F.sum("_cal").alias("cal"), F.sum("lep_motile").alias("lep_motile"), F.sum("cal_motile").alias("cal_motile")
    )
    attached = lambda c: ~series & ((origin == "current_lice") | F.col(c).isNotNull())
    motile = lambda louse: (origin == "current_lice") | (series & (F.col("louse") == louse))
    cells = [
        (attached("lep"), LEP, "attached", "lep"), (attached("cal"), CAL, "attached", "cal"),
        (motile(LEP), LEP, "motile", "lep_motile"), (motile(CAL), CAL, "motile", "cal_motile"),
    ]
    entries = F.array_compact(F.array(*[
        F.when(there, F.struct(F.lit(louse).alias("louse_species"), F.lit(stage).alias("life_stage"), F.col(c).alias("count")))
        for there, louse, stage, c in cells
    ]))
    fish = fish.withColumn("entries", entries).filter(F.size("entries") > 0)
    # from here on by fish: a few rows each
    one_fish = Window.partitionBy("ufn")
    checked = origin.isin("sealice_lab_fs", "sealice_field")
    times = [F.sum((checked & F.col(c).isNotNull()).cast("int")).over(one_fish) > 1 for c in ("lep", "cal")]
    fish = fish.withColumn("twice", times[0] | times[1])
    if distinct_sources:
        fish = fish.filter(~(field & F.col("twice")))
    records = Window.partitionBy("ufn", "origin", "species").orderBy(F.col("survey_date").asc_nulls_last(), "_copy")
    return fish.select(*FISH_KEYS, "origin", "entries", "twice", (F.row_number().over(records) == 1).alias("first"))


def long_lice(by_fish: DataFrame) -> DataFrame:
    """One row per louse species and stage of a fish."""
    return by_fish.select(*FISH_KEYS, F.inline("entries"), "origin")


def current_lice(
    lice: DataFrame, fish: DataFrame, ss: DataFrame, season: int, ratio_mode: str = "odds", salmon_only: bool = True
) -> DataFrame:
    """This season's field counts, long, with unidentified lice split by species."""
    catches = catch_data(fish, ss.filter(in_season("survey_date", season)), "inner")
    out = long_lice(lice_by_fish([current_sheet(lice)], catches, season=season, ratio_mode=ratio_mode, distinct_sources=False))
    out = out.withColumn("year", F.year("survey_date"))
    return out.filter(F.col("species").isin(*SALMON)) if salmon_only else out


def catch_data(fish: DataFrame, ss: DataFrame, how: str = "left") -> DataFrame:
    """One row a fish with its survey date and site."""
    places = seine_attributes(ss, ["survey_date", "site_id", "region"])
    return complete(fish, ["ufn"]).select("ufn", "seine_id", "species").join(places, "seine_id", how)


def lab_attached(
    lab: DataFrame,
    catches: DataFrame,
    sites: DataFrame,
    leps: Sequence[str] = tuple(LAB_ATTACHED_LEP),
    cals: Sequence[str] = tuple(LAB_ATTACHED_CAL),
) -> DataFrame:
    """Attached lice of the laboratory sheet, long; missing counts are left out, a missing column is an error."""
    return long_lice(lice_by_fish([lab_sheet(lab, leps, cals)], catches, sites))


def motile_series(series: DataFrame, catches: DataFrame) -> DataFrame:
    """The published motile counts with their seine."""
    return long_lice(lice_by_fish([series_sheet(series)], catches))


def field_attached(field: DataFrame, catches: DataFrame, sites: DataFrame, ratio_mode: str = "odds") -> DataFrame:
    """Attached lice of the field sheet, long, unidentified ones split by each year's ratio."""
    return long_lice(lice_by_fish([field_sheet(field)], catches, sites, ratio_mode=ratio_mode, distinct_sources=False))


def cross_source_duplicates(lab: DataFrame, field: DataFrame, catches: DataFrame, sites: DataFrame) -> DataFrame:
    """Fish that have the same louse species and stage in more than one row of the laboratory and field sheets."""
    return lice_by_fish([lab, field], catches, sites, distinct_sources=False).filter("twice").select("ufn").distinct()


def _stages_examined(by_fish: DataFrame) -> DataFrame:
    origin = F.col("origin")
    return by_fish.withColumns(
        {"attached": origin != "lab_mots_ts", "motile": origin.isin("current_lice", "lab_mots_ts")}
    )


def hosts_examined(by_fish: DataFrame, least: int | None = None) -> DataFrame:
    """Hosts examined by species, year of their first record and stage, over all sources."""
    both = ["attached", "motile"]
    counts = _stages_examined(by_fish.filter("first")).groupBy("species", F.year("survey_date").alias("year")).agg(
        *[F.sum(F.col(c).cast("bigint")).alias(c) for c in both]
    )
    long = longer(counts, both, "life_stage", "n_hosts")
    return long if least is None else long.filter(F.col("n_hosts") >= least)


def _stage_label(c: Column | str = "life_stage") -> Column:
    return F.when(as_col(c) == "motile", "Motile").otherwise("Attached")


def _species_shown(df: DataFrame) -> DataFrame:
    shown = df.withColumn("species", recode("species", SALMON_LABELS))
    return shown.withColumn("species_order", position("species", list(SALMON_LABELS.values())))


def yearly_abundance(by_fish: DataFrame, least: int = 3) -> DataFrame:
    """Mean lice a fish by year, species, louse and stage; the error counts the hosts examined.

    One aggregation gives both: the first record of a host is counted with its first entry of each stage.
    """
    keys = ["year", "species", "louse_species", "life_stage"]
    place = F.posexplode("entries").alias("at", "e")
    rows_ = by_fish.filter(F.col("species") != "CO").select("species", "survey_date", "first", "entries", place)
    counted = F.col("first") & (F.array_position(F.transform("entries", lambda e: e["life_stage"]), F.col("e.life_stage")) == F.col("at") + 1)
    rows_ = rows_.select(F.year("survey_date").alias("year"), "species", "e.*", counted.cast("bigint").alias("_host"))
    stats = rows_.groupBy(*keys).agg(
        F.avg("count").alias("mean_abundance"), F.stddev_samp("count").alias("sd"), F.sum("_host").alias("_hosts")
    )
    stage = Window.partitionBy("species", "year", "life_stage")  # one row a louse species
    stats = stats.withColumn("n_hosts", F.sum("_hosts").over(stage)).drop("_hosts")
    joined = stats.filter(F.col("mean_abundance").isNotNull() & (F.col("n_hosts") >= least))
    out = joined.withColumns({"se": ratio("sd", F.sqrt("n_hosts")), "life_stage": _stage_label()})
    bars = {"lower": lower_bar("mean_abundance", "se"), "upper": F.col("mean_abundance") + F.col("se")}
    return _species_shown(out.withColumns(bars))


def yearly_prevalence(by_fish: DataFrame) -> DataFrame:
    """Mean over seines of the share of infected hosts, by year, species, louse and stage."""
    seine = ["survey_date", "seine_id", "species", "louse_species", "life_stage"]
    infected = F.when(F.col("count") > 0, 1).when(F.col("count") <= 0, 0)
    per_seine = long_lice(by_fish).groupBy(*seine).agg(rows().alias("n_hosts"), strict_sum(infected).alias("n_infected"))
    per_seine = per_seine.withColumns(
        {"prop_infected": ratio("n_infected", "n_hosts"), "year": F.year("survey_date")}
    )
    keys = ["year", "species", "louse_species", "life_stage"]
    stats = per_seine.groupBy(*keys).agg(
        strict_mean("prop_infected").alias("mean_prev"),
        strict_sd("prop_infected").alias("sd"),
        rows().alias("n"),
    )
    stats = stats.filter((F.col("n") > 1) & (F.col("species") != "CO"))
    stats = stats.withColumns({"se": F.col("sd") / F.sqrt("n"), "life_stage": _stage_label()})
    panel = Window.partitionBy("year", "louse_species", "life_stage")  # one row a species
    bars = {"lower": lower_bar("mean_prev", "se"), "upper": F.col("mean_prev") + F.col("se")}
    stats = stats.withColumns({"width": F.lit(0.1) * F.count(F.lit(1)).over(panel), **bars})
    return _species_shown(stats)

