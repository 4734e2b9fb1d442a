"""Fish length products: merged lengths, box statistics by week, frequencies, anomaly by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.functions.labels import SALMON_LABELS, recode, sampling_week_position
from brinewave.functions.nulls import complete, rows
from brinewave.operators.bins import box_outliers, box_statistics, density_histogram, histogram
from brinewave.operators.smoothing import predict_observed
from brinewave.plans.lice import SALMON
from brinewave.plans.ocean import curve_against_observed
from brinewave.plans.survey import counted_by_seine, fish_with_survey

# Weeks the lengths of all years are compared over.
COMPARED_WEEKS = ["May 19", "May 26", "June 2", "June 9", "June 16", "June 23", "June 30", "July 6"]


def field_or_lab(fish: DataFrame, lab: DataFrame) -> DataFrame:
    """Fork length from the field, else from the laboratory."""
    measured = lab.select("ufn", F.col("fork_length").alias("fork_length_lab"))
    joined = fish.join(measured, "ufn", "left")
    return joined.withColumn(
        "fork_length", F.coalesce(F.col("fork_length_field").try_cast("double"), F.col("fork_length_lab"))
    )


def field_lengths(fish: DataFrame) -> DataFrame:
    """Field lengths as numbers; the text NA is no length."""
    known = fish.filter(F.col("fork_length_field") != "NA")
    return known.withColumn("fork_length", F.col("fork_length_field").try_cast("double"))


def length_comparison(
    fish: DataFrame, ss: DataFrame, season: int, weeks: Sequence[str] = tuple(COMPARED_WEEKS), region: str = "DI"
) -> DataFrame:
    """Counts of each length by week and species: the season, and the compared weeks of all earlier years.

    Equal lengths of one seine are counted before the join, so the fish themselves never move.
    """
    salmon = field_lengths(fish).filter(F.col("species").isin(*SALMON))
    counts = counted_by_seine(
        salmon, ss, ["species", "fork_length"], ["region", "sampling_week", "year"], [rows().alias("m")]
    )
    counts = counts.filter((F.col("region") == region) & F.col("fork_length").isNotNull())
    past = (F.col("year") < season) & F.col("sampling_week").isin(*weeks)
    period = F.when(F.col("year") == season, str(season)).when(past, f"to {season - 1}")
    keys = ["sampling_week", "species", "period", "fork_length"]
    return counts.withColumn("period", period).filter("period IS NOT NULL").groupBy(*keys).agg(F.sum("m").alias("m"))


def length_boxes(fish: DataFrame, ss: DataFrame, season: int) -> DataFrame:
    counts = length_comparison(fish, ss, season)
    boxes = box_statistics(counts, ["sampling_week", "species", "period"], "fork_length", counted="m")
    return boxes.withColumn("week_order", sampling_week_position("sampling_week"))


def length_outliers(fish: DataFrame, ss: DataFrame, season: int) -> DataFrame:
    counts = length_comparison(fish, ss, season)
    return box_outliers(counts, ["sampling_week", "species", "period"], "fork_length", counted="m")


def length_frequency(fish: DataFrame) -> DataFrame:
    """Fish by five-millimetre length class and species."""
    salmon = field_lengths(fish).filter(F.col("species").isin(*SALMON))
    named = salmon.withColumn("species", recode("species", SALMON_LABELS))
    return histogram(named, ["species"], "fork_length", 5.0)


def length_density(fish: DataFrame) -> DataFrame:
    return density_histogram(field_lengths(fish), "fork_length", 9.0)


def weight_density(fish: DataFrame) -> DataFrame:
    return density_histogram(fish, "weight", 4.0)


def length_against_curve(
    fish: DataFrame, ss: DataFrame, season: int, species: str = "SO", region: str = "DI", surface: str = "interpolate"
) -> DataFrame:
    """Season lengths against the smoothed all-year length of the day.

    The curve has one row a day of the year, so each fish matches once.
    """
    one = field_lengths(fish).filter(F.col("species") == species)
    placed = fish_with_survey(one, ss, ["region", "year", "yday"]).filter(F.col("region") == region)
    lengths = complete(placed.select("ufn", "species", "year", "yday", "fork_length"), ["fork_length"])
    past = lengths.filter(F.col("year") < season)
    curve = predict_observed(past, ["species"], "yday", "fork_length", 1.0, "loess_annual", surface)
    curve = curve.select("species", F.col("yday").cast("int").alias("yday"), "loess_annual")
    current = lengths.filter(F.col("year") == season).drop("year")
    labelled = curve_against_observed(current, curve, ["species", "yday"], "fork_length", "loess_annual")
    return labelled.drop("species")
