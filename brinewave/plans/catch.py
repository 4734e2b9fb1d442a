"""Catch products: tables, weekly catch, cumulative abundance, intensity, proportions, effort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from brinewave.functions.dates import in_season, in_year
from brinewave.functions.labels import CATCH_LABELS, position, recode
from brinewave.functions.nulls import complete, not_in, rows, standard_error
from brinewave.functions.numeric import half_even, with_t_quantile
from brinewave.operators.columns import change_numeric, rename
from brinewave.operators.grouping import mean_sd_se, means, share_within, uncounted
from brinewave.operators.joins import lookup_join
from brinewave.operators.ordered import BLOCK_ROWS, blocked_centred_mean, centred_mean, range_blocks, running_total
from brinewave.operators.reshape import bind, longer, split_rows
from brinewave.plans.survey import TOTALS

# Order of the species in the charts.
INTENSITY_SPECIES = ["Sockeye", "Pink", "Chum"]


def with_place(df: DataFrame, unique_id: Column, day: Sequence[str], every: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_place``, the order of rows within a day, and ``_block``, a range of places.

    ``day`` are the columns that name a day. Number ids keep their order; text ids are put in the order of their hash,
    which is stable. The ranges follow the ids that are there (``range_blocks``), be they dense or sparse.
    """
    placed = df.withColumn("_place", unique_id)
    if not isinstance(placed.schema["_place"].dataType, NumericType):
        placed = placed.withColumn("_place", F.xxhash64("_place"))
    return range_blocks(placed, day, ["_place"], every=every)


def filled(df: DataFrame) -> DataFrame:
    """Zero for every missing number and the text 0 for every missing text."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.fillna(0, subset=numbers).fillna("0", subset=texts)


def catch_table(ss: DataFrame, season: int) -> DataFrame:
    """Dates, sites and catches of one season's seines, in date order."""
    picked = ss.filter(in_season("survey_date", season)).orderBy("survey_date", "seine_id")
    picked = picked.select("survey_date", "site_id", "site_name", "so_total", "pi_total", "cu_total")
    return rename(
        picked,
        **{
            "Survey Date": "survey_date",
            "Site ID": "site_id",
            "Site": "site_name",
            "Sockeye": "so_total",
            "Pink": "pi_total",
            "Chum": "cu_total",
        },
    )


def weekly_catch(ss: DataFrame, keys: Sequence[str] = ("year", "region", "sampling_week")) -> DataFrame:
    """Mean sockeye catch a seine by week; the standard error is missing where a catch is."""
    out = ss.groupBy(*keys).agg(
        F.avg("so_total").alias("mean"), rows().alias("n"), standard_error("so_total", strict=True).alias("se")
    )
    return complete(out, ["year"])


def weekly_cpue(ss: DataFrame) -> DataFrame:
    """Weekly mean, sd and number of daily mean catches; missing catches count as zero."""
    base = filled(ss.select("year", "region", "survey_date", "sampling_week", "so_total"))
    daily = means(base, ["year", "region", "survey_date", "sampling_week"], {"so_cpue": "so_total"})
    return daily.groupBy("year", "region", "sampling_week").agg(
        F.avg("so_cpue").alias("so_cpue"), F.stddev_samp("so_cpue").alias("so_cpue_sd"), rows().alias("n")
    )


def weekly_catch_with_sd(ss: DataFrame) -> DataFrame:
    """Weekly mean, sd and standard error straight from the seines, missing catches skipped."""
    return ss.groupBy("year", "region", "sampling_week").agg(
        F.avg("so_total").alias("so_cpue"),
        F.stddev_samp("so_total").alias("so_cpue_sd"),
        rows().alias("n"),
        standard_error("so_total").alias("se"),
    )


def cumulative_abundance(
    ss: DataFrame,
    totals: Sequence[str] = tuple(TOTALS),
    by_region: bool = True,
    missing: str = "zero",
    excluded_surveys: Sequence[int] = (),
    regions: Sequence[str] = ("DI", "JS"),
) -> DataFrame:
    """Running total of daily mean catches, long by species, within each season (and region).

    ``missing``: "zero" fills, "drop" drops incomplete seines, "keep" lets a missing catch make the
    total missing from that day on. The windows run over daily means: at most 366 rows each.
    """
    keys = ["year", *(["region"] if by_region else [])]
    base = ss.filter(not_in("survey_id", excluded_surveys)) if excluded_surveys else ss
    if by_region:
        base = base.filter(F.col("region").isin(*regions))
    base = base.select(*keys, "survey_date", *totals)
    if missing == "zero":
        base = filled(base)
    elif missing == "drop":
        base = complete(base)
    daily = means(base, [*keys, "survey_date"], {t: t for t in totals}, strict=True)
    cumulated = daily.select(
        *keys,
        "survey_date",
        *[running_total(t, keys, ["survey_date"], strict=True).alias(f"{t[:2]}_cum_abund") for t in totals],
    )
    return longer(cumulated, [f"{t[:2]}_cum_abund" for t in totals], "species", "cum_abund")


def rolling_catch(ss: DataFrame, season: int, reference_year: int | None = None) -> DataFrame:
    """One season's catches against the all-year daily average, each with a five-row centred mean.

    The season part is raw seines and may be long: its windows are blocked. The other part is one row
    a day of the year. The mean does not run across the two groups.
    """
    # a survey without a seine takes its own id as place within the day
    season_rows = (
        ss.filter(in_season("survey_date", season))
        .select(F.col("survey_date").alias("date"), "seine_id", "survey_id", "so_total")
        .withColumn("group", F.lit(str(season)))
    )
    season_rows = with_place(season_rows, F.coalesce("seine_id", "survey_id"), ["date"])
    current = blocked_centred_mean(
        season_rows, ["group"], ["date", "_block"], ["_place", "seine_id"], "so_total", "seven_avg"
    ).drop("_block", "_place", "seine_id", "survey_id")
    daily = means(ss, ["survey_date"], {"so_total": "so_total"}, strict=True)
    moved = daily.select(in_year("survey_date", reference_year or season).alias("date"), "so_total")
    average = means(moved, ["date"], {"so_total": "so_total"}, strict=True).withColumn("group", F.lit("all years"))
    average = average.withColumn(
        "seven_avg", centred_mean("so_total", ["group"], [F.col("date").asc_nulls_last()], width=5)
    )
    return bind(current, average)


def intensity_counts(ss: DataFrame) -> DataFrame:
    """Mean catch by species over the seines that caught sockeye: mean, sd, n, se."""
    caught = rename(ss, Sockeye="so_total", Pink="pi_total", Chum="cu_total").filter("Sockeye > 0")
    long = longer(caught.select("year", *INTENSITY_SPECIES), INTENSITY_SPECIES, "species", "catch")
    return mean_sd_se(long, ["year", "species"], "catch", mean="mean_catch")


def catch_intensity(ss: DataFrame, season: int, history: DataFrame | None = None) -> DataFrame:
    """Catch intensity of the season with 95 % t intervals, rounded to one digit, under the history."""
    current = intensity_counts(ss.filter(in_season("survey_date", season)))
    current = with_t_quantile(current, 0.975, F.col("n") - 1, "_t")
    half = F.col("_t") * F.col("se")
    current = current.withColumns({"lower_ci": half, "upper_ci": half}).drop("_t")
    current = change_numeric(current, lambda c: half_even(c, 1))
    out = current if history is None else bind(history, current)
    return out.withColumn("species_order", position("species", INTENSITY_SPECIES))


def proportion_counts(ss: DataFrame, totals: Sequence[str] = tuple(TOTALS)) -> DataFrame:
    """Share of each species in the year's catch, over fully counted seines that caught sockeye.

    The reference repeats a row for every fish and counts rows; the sum is that count.
    """
    base = complete(ss.select("survey_date", "seine_id", *totals).filter("so_total > 0"))
    long = longer(base.withColumn("year", F.year("survey_date")), list(totals), "species", "n")
    return share_within(uncounted(long, ["year", "species"], "n"), ["year"], "n", "proportion")


def species_proportion(ss: DataFrame, season: int, history: DataFrame | None = None) -> DataFrame:
    current = proportion_counts(ss.filter(in_season("survey_date", season)))
    out = current if history is None else bind(history, current)
    return out.withColumns(
        {"species": recode("species", CATCH_LABELS), "species_order": position("species", list(CATCH_LABELS))}
    )


def crew_effort(surveys: DataFrame, spellings: dict[str, str] | None = None) -> DataFrame:
    """Field days of each crew member, most first; spellings are mended after counting."""
    counts = split_rows(surveys.select("crew"), "crew", "name").groupBy("name").agg(rows().alias("n"))
    if spellings:
        counts = counts.withColumn("name", recode("name", spellings))
    return counts.orderBy(F.desc("n"), "name")


def survey_calendar(surveys: DataFrame, sites: DataFrame) -> DataFrame:
    """Day of year and region of every survey."""
    located = lookup_join(surveys, sites, "site_id", ["region"])
    return located.select("survey_id", F.dayofyear("survey_date").alias("yday"), "region")
