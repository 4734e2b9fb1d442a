"""Ocean products: climatology, season means, anomaly curves, envelopes, corridors, optics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.functions.dates import in_season
from brinewave.functions.nulls import complete, strict_mean
from brinewave.operators.grouping import means
from brinewave.operators.joins import members
from brinewave.operators.ordered import with_crossing_midpoints
from brinewave.operators.reshape import bind_same, merge_labels, separate
from brinewave.operators.smoothing import predict_band, predict_for_days

CTD_MEANS = {"mean_temp": "temperature", "mean_do": "dissolved_oxygen_ml_l", "mean_salinity": "salinity"}
TOP_METRES = 30
FIRST_DAY, LAST_DAY = 32, 213  # both excluded

SPAN = 0.65  # smoothing span of the average curve

Spans = float | Mapping[str, float]  # one for all stations, or those of some; the others have SPAN


def span_of(spans: Spans) -> float | Column:
    """The span of each station."""
    if not isinstance(spans, Mapping):
        return spans
    out = F.lit(SPAN)
    for station, span in spans.items():
        out = F.when(F.col("station") == station, span).otherwise(out)
    return out


def with_calendar(ctd: DataFrame) -> DataFrame:
    return ctd.withColumns({"year": F.year("date"), "yday": F.dayofyear("date")})


def merged_stations(ctd: DataFrame) -> DataFrame:
    """The two northern stations read as one."""
    return merge_labels(ctd, "station", ["JS2", "JS12"], "js2_12")


def top_layer(ctd: DataFrame) -> DataFrame:
    return ctd.filter(F.col("depth") <= TOP_METRES)


def in_season_days(ctd: DataFrame) -> DataFrame:
    return ctd.filter((F.col("yday") > FIRST_DAY) & (F.col("yday") < LAST_DAY))


def climatology(ctd: DataFrame, season: int, stations: Sequence[str] | None = None, all_days: bool = False) -> DataFrame:
    """Daily means of the top layer by station over all years but the season."""
    base = top_layer(with_calendar(ctd)).filter(F.col("year") != season)
    if not all_days:
        base = in_season_days(base)
    if stations is not None:
        base = base.filter(F.col("station").isin(*stations))
    return means(base, ["station", "date", "yday"], CTD_MEANS)


def season_means(ctd: DataFrame, season: int, stations: Sequence[str] | None = None) -> DataFrame:
    """Daily means of the top layer by station in the season's sampling window."""
    base = in_season_days(top_layer(with_calendar(ctd.filter(in_season("date", season)))))
    if stations is not None:
        base = base.filter(F.col("station").isin(*stations))
    return means(base, ["station", "yday"], CTD_MEANS)


def anomaly(average: DataFrame, this_year: DataFrame, span: Spans = SPAN, surface: str = "interpolate") -> DataFrame:
    """Season means against the smoothed average curve, with the points where they cross.

    Each season day gets the curve value and the side it lies on; between neighbours on different
    sides a midpoint row is added, whose temperature is set to the curve.
    """
    fitted = predict_for_days(
        average, ["station"], "yday", "mean_temp", span_of(span), this_year, surface, "predicted_mean_temp"
    )
    side = F.when(F.col("mean_temp") > F.col("predicted_mean_temp"), "pos").when(
        F.col("mean_temp") <= F.col("predicted_mean_temp"), "neg"
    )
    observed = complete(fitted.withColumn("diff", side), ["diff"])
    crossed = with_crossing_midpoints(
        observed, ["station"], "yday", "diff", ["predicted_mean_temp"], {"mean_temp": "predicted_mean_temp"}
    )
    return crossed.sortWithinPartitions("station", "yday")


def temperature_anomaly(ctd: DataFrame, season: int, span: Spans = SPAN, surface: str = "interpolate") -> DataFrame:
    merged = merged_stations(ctd)
    return anomaly(climatology(merged, season), season_means(merged, season), span, surface)


def sides(anomaly_rows: DataFrame) -> DataFrame:
    """Rows at or above the curve and rows at or below it; rows on the curve are in both parts."""
    above = anomaly_rows.filter(F.col("mean_temp") >= F.col("predicted_mean_temp")).withColumn("side", F.lit("above"))
    below = anomaly_rows.filter(F.col("mean_temp") <= F.col("predicted_mean_temp")).withColumn("side", F.lit("below"))
    return bind_same(above, below)


def envelope(ctd: DataFrame) -> DataFrame:
    """Lowest and highest yearly daily mean temperature of each day of the year."""
    base = top_layer(with_calendar(ctd))
    yearly = base.groupBy("station", "year", "yday").agg(strict_mean("temperature").alias("mean_temp"))
    return yearly.groupBy("station", "yday").agg(
        F.min("mean_temp").alias("min_temp"), F.max("mean_temp").alias("max_temp")
    )


def climatology_band(average: DataFrame, span: Spans = SPAN, level: float = 0.95) -> DataFrame:
    """Smoothed average with a confidence band."""
    band = predict_band(average, ["station"], "yday", "mean_temp", span_of(span), level)
    reach = F.col("t") * F.col("se")
    return band.withColumns({"lower": F.col("fit") - reach, "upper": F.col("fit") + reach}).drop("x10", "df", "delta1", "t")


def corridor_means(
    ctd: DataFrame, casts: DataFrame, surveys: DataFrame, sites: DataFrame, excluded_sites: Sequence[int]
) -> DataFrame:
    """Top-layer means by survey date and zone; casts are matched to surveys by their composed key.

    Casts are reduced to sums by key before the join, so the raw casts are never shuffled whole.
    """
    key = ["station", "date", "cast_number"]
    parts = []
    for c in ("temperature", "dissolved_oxygen_ml_l", "salinity"):
        parts += [F.sum(c).alias(f"{c}_s"), F.count(c).alias(f"{c}_n")]
    reduced = top_layer(ctd).groupBy(*key).agg(*parts)
    located = casts.join(surveys.select("survey_id", "survey_date", "site_id"), "survey_id", "left")
    located = located.join(sites.select("site_id", "zone"), "site_id", "left")
    joined = complete(reduced.join(located, key, "left"), ["site_id"])
    joined = joined.filter(~F.col("site_id").isin(*excluded_sites))

    def mean(c: str):
        return F.try_divide(F.sum(f"{c}_s"), F.sum(f"{c}_n"))

    return joined.groupBy("survey_date", "zone").agg(
        mean("temperature").alias("mean_temp30"),
        mean("dissolved_oxygen_ml_l").alias("mean_DO30"),
        mean("salinity").alias("mean_salinity_30"),
    )


def region_profile(casts: DataFrame, first_date: str) -> DataFrame:
    """Top-layer temperature (missing skipped) and chlorophyll (strict) by region and date.

    The date is the second part of the file name; later parts stay in the time.
    """
    split = separate(casts, "filename", ["unit_id", "date", "time"], "_")
    split = split.withColumn("date", F.col("date").try_cast("date")).filter(F.col("date") > F.lit(first_date).cast("date"))
    return (
        top_layer(split)
        .groupBy("region", "date")
        .agg(F.avg("temperature").alias("avg_temp"), strict_mean("chlorophyll").alias("chlorophyll"))
    )


def chlorophyll_means(chl: DataFrame, sites: DataFrame, first_date: str) -> DataFrame:
    """Strict daily mean chlorophyll of bulk filters near the surface at the listed sites."""
    base = chl.filter(
        (F.col("filter_type") == "Bulk GF/F")
        & (F.col("line_out_depth") <= TOP_METRES)
        & (F.col("date") > F.lit(first_date).cast("date"))
    )
    return complete(means(members(base, sites, ["site_id"]), ["date", "site_id"], {"chl_a_avg": "chla"}, strict=True))


def surface_temperature(probe: DataFrame) -> DataFrame:
    return means(probe, ["survey", "date"], {"avg_temp": "temp"}, strict=True)


def secchi_since(secchi: DataFrame, year: int) -> DataFrame:
    return secchi.filter(F.col("date") >= F.lit(f"{year + 1}-01-01").cast("date"))


def curve_against_observed(
    observed: DataFrame, curve: DataFrame, keys: Sequence[str], value: str, fitted: str
) -> DataFrame:
    """Attach a curve value by key and label each row lower or higher; days without a curve drop out."""
    joined = complete(observed.join(curve, list(keys), "left"), [fitted])
    side = F.when(F.col(value) < F.col(fitted), "lower").when(F.col(value) >= F.col(fitted), "higher")
    return joined.withColumn("higher_or_lower", side)


def regional_series(ctd: DataFrame) -> DataFrame:
    """All-year daily top-layer means by date and station."""
    return means(top_layer(ctd), ["date", "station"], CTD_MEANS)

