"""Migration timing: double-effort correction, cumulative percent and logistic curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.functions.dates import between_open, in_season, iso_week
from brinewave.functions.nulls import complete, ratio, strict_mean
from brinewave.functions.numeric import half_even
from brinewave.operators.grouping import duplicated_groups, first_per_key, means
from brinewave.operators.growth import curve_points, logistic_fits
from brinewave.operators.joins import null_safe_join
from brinewave.operators.ordered import blocked_running_total, cumulative_percent, share_of_total
from brinewave.operators.reshape import bind
from brinewave.plans.catch import with_place

AVERAGED = ["so_total", "pi_total", "cu_total", "co_total", "he_total"]


def _double_effort(ss: DataFrame, season: int) -> DataFrame:
    """``double_effort`` with ``_first``, the first visit (survey_date, survey_id) of the site and week."""
    columns = ["survey_id", "seine_id", "survey_date", "site_id", *AVERAGED]
    in_season = ss.select(*columns).filter(between_open("survey_date", f"{season}-01-01", f"{season}-12-31"))
    one = first_per_key(in_season, ["survey_id"], ["survey_date", "seine_id"])
    one = one.withColumn("week", iso_week("survey_date"))
    group_means = [half_even(strict_mean(c)).alias(c) for c in AVERAGED]
    first = F.min(F.struct("survey_date", "survey_id")).alias("_first")
    groups = duplicated_groups(one, ["site_id", "week"], [*group_means, first])
    return null_safe_join(one.drop(*AVERAGED), groups, ["site_id", "week"], "inner")


def double_effort(ss: DataFrame, season: int) -> DataFrame:
    """Surveys of one season whose site was visited more than once in an ISO week.

    Each carries the rounded mean catch of its site and week. Groups are aggregated and joined back,
    which keeps a busy site and week distributed.
    """
    return _double_effort(ss, season).drop("_first")


def corrected_catch(ss: DataFrame, season: int, region: str = "DI") -> DataFrame:
    """Sockeye catches with double effort replaced by one averaged record a site and week.

    Surveys of double effort are flagged in one join: the first visit's first seine takes the mean, the others go.
    """
    double = _double_effort(ss, season)
    is_first = F.struct("survey_date", "survey_id") == F.col("_first")
    flags = double.select("survey_id", is_first.alias("_is_first"), F.col("seine_id").alias("_seine"), F.col("so_total").alias("_mean"))
    flagged = ss.select("survey_id", "seine_id", "survey_date", "region", "so_total").join(flags, "survey_id", "left")
    single = F.col("_is_first").isNull() & (F.col("region") == region) & (F.col("so_total") > 0)
    averaged = F.col("_is_first") & F.col("seine_id").eqNullSafe(F.col("_seine"))
    kept = flagged.filter(single | averaged)
    caught = F.when(F.col("_is_first").isNull(), F.col("so_total")).otherwise(F.col("_mean"))
    both = kept.select("survey_date", caught.cast("double").alias("so_total")).filter(F.col("survey_date").isNotNull())
    return both.withColumns({"year": F.year("survey_date"), "yday": F.dayofyear("survey_date")})


def migration_timing(catches: DataFrame) -> DataFrame:
    """Daily mean catch with its share and the cumulative percent within each year."""
    daily = means(complete(catches, ["so_total"]), ["year", "survey_date"], {"so_total": "so_total"})
    return daily.withColumns(
        {
            "percent": cumulative_percent("so_total", ["year"], ["survey_date"]),
            "non_cumul_prop": share_of_total("so_total", ["year"]),
            "yday": F.dayofyear("survey_date"),
        }
    )


def season_progress(ss: DataFrame, season: int) -> DataFrame:
    """Cumulative percent of one season's raw catches, in date and seine order, blocked."""
    caught = ss.filter(in_season("survey_date", season) & (F.col("so_total") > 0))
    caught = caught.select("year", "survey_date", "seine_id", "so_total", "yday")
    caught = with_place(caught, F.col("seine_id"), ["survey_date"])
    summed = blocked_running_total(
        caught, ["year"], ["survey_date", "_block"], ["_place", "seine_id"], "so_total", "_upto", total="_total"
    )
    percent = ratio("_upto", "_total") * 100
    return summed.withColumn("percent", percent).drop("_place", "_block", "_upto", "_total", "year")


def timing_points(ss: DataFrame, season: int, corrected: int) -> DataFrame:
    """Points to fit: all earlier years pooled, double effort of the ``corrected`` season averaged, and the season."""
    past = ss.filter(F.col("survey_date") < F.lit(f"{season}-01-01").cast("date"))
    history = migration_timing(corrected_catch(past, corrected))
    current = season_progress(ss, season)
    return bind(
        history.select(F.lit("predicted_percent").alias("period"), "yday", "percent"),
        current.select(F.lit("predicted_current").alias("period"), "yday", "percent"),
    )


def timing_fits(ss: DataFrame, season: int, corrected: int) -> DataFrame:
    return logistic_fits(timing_points(ss, season, corrected), "period", "yday", "percent")


def timing_curves(ss: DataFrame, season: int, corrected: int, points: int = 100) -> DataFrame:
    """Both fitted curves on an even grid over the days of the history."""
    curves = curve_points(timing_fits(ss, season, corrected), "period", "predicted_percent", "yday", points, "predicted")
    return curves.select("period", "point", "yday", "predicted")
