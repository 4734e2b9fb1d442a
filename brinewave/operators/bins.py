"""Histograms, quantiles, box statistics and the two-way binning of wind.

Raw rows are combined on the map side everywhere: into bins, or into counts of ranges of values and then of the values
of the few ranges that matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col, ratio, rows
from brinewave.operators.joins import null_safe_join
from brinewave.operators.ordered import range_blocks

VALUES = 8192  # expected distinct values of a range that quantiles are looked for in

# Sixteen compass points, clockwise from north.
COMPASS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
]


def left_closed_bin(c: Column | str, width: float) -> Column:
    """Start of the bin [k*width, (k+1)*width)."""
    return F.floor(as_col(c) / F.lit(width)) * F.lit(width)


def centred_bin(c: Column | str, width: float) -> Column:
    """Centre of the right-closed bin (k*width - width/2, k*width + width/2]."""
    return F.ceil((as_col(c) - F.lit(width / 2)) / F.lit(width)) * F.lit(width)


def right_closed_bin(c: Column | str, breaks: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Label of the bin (a, b]; null outside all bins."""
    c = as_col(c)
    labels = labels or [f"{a:g} - {b:g}" for a, b in zip(breaks, breaks[1:])]
    out = None
    for low, high, label in zip(breaks, breaks[1:], labels):
        inside = (c > low) & (c <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def histogram(df: DataFrame, keys: Sequence[str], value: str, width: float) -> DataFrame:
    """Counts of left-closed bins that start at multiples of the width."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, left_closed_bin(value, width).alias("bin_start"))
        .agg(rows().alias("n"))
    )


def density_histogram(df: DataFrame, value: str, width: float, scale: float = 5.0) -> DataFrame:
    """Counts and scaled density (scale * count / (total * width) * 100) of centred bins."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(centred_bin(value, width).alias("bin_centre"))
        .agg(rows().alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("frequency", ratio(F.col("n") * scale * 100, total * F.lit(width)))


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], counted: str | None = None, every: int = VALUES
) -> DataFrame:
    """Exact interpolated quantiles (linear between order statistics) by group; missing values are skipped.

    Selection in two passes, both combined before the shuffle: rows are counted by range of values (``range_blocks``, about
    ``every`` distinct values each), which tells the ranges that hold the wanted order statistics; only there are the
    values themselves counted. ``counted`` names a count column where the rows are counts of a value already.
    """
    keys = list(keys)
    present = df.filter(F.col(value).isNotNull()).withColumn("_m", F.col(counted) if counted else F.lit(1).cast("bigint"))
    ranged = range_blocks(present.select(*keys, value, "_m"), keys, [value], every=every)
    counts = ranged.groupBy(*keys, "_block").agg(F.sum("_m").alias("_sum"))
    one_group = Window.partitionBy(*keys)
    before = one_group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {"n": F.sum("_sum").over(one_group), "_before": F.coalesce(F.sum("_sum").over(before), F.lit(0))}
    )
    places = {}
    for name, p in probs.items():
        low = F.floor((F.col("n") - 1) * F.lit(p))
        places[f"_{name}_lo"], places[f"_{name}_hi"] = low, F.least(low + 1, F.col("n") - 1)
    needed = [(p >= F.col("_before")) & (p < F.col("_before") + F.col("_sum")) for p in places.values()]
    needed = counts.filter(reduce(lambda a, b: a | b, needed)).drop("_sum")
    inside = null_safe_join(ranged, needed, [*keys, "_block"], "inner")
    ranked = inside.groupBy(*keys, "_block", "n", "_before", value).agg(F.sum("_m").alias("_m"))
    upto = F.sum("_m").over(Window.partitionBy(*keys, "_block").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("_upto", F.col("_before") + upto)

    holds = {c: (p < F.col("_upto")) & (p >= F.col("_upto") - F.col("_m")) for c, p in places.items()}
    found = ranked.groupBy(*keys, "n").agg(*[F.max(F.when(h, F.col(value))).alias(c) for c, h in holds.items()])
    out = []
    for name, p in probs.items():
        at = (F.col("n") - 1) * F.lit(p)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (at - F.floor(at)) * (hi - lo)).alias(name))
    return found.select(*keys, "n", *out)


def _with_fences(df: DataFrame, keys: list[str], value: str, counted: str | None, every: int) -> DataFrame:
    """The present rows with the quartiles and fences of their group, and their count ``_m``."""
    q = quantiles(df, keys, value, {"lower": 0.25, "middle": 0.5, "upper": 0.75}, counted, every)
    reach = (F.col("upper") - F.col("lower")) * 1.5
    q = q.withColumns({"_low": F.col("lower") - reach, "_high": F.col("upper") + reach})
    present = df.filter(F.col(value).isNotNull()).select(*keys, value, (F.col(counted) if counted else F.lit(1).cast("bigint")).alias("_m"))
    return null_safe_join(present, q, keys)


def box_statistics(
    df: DataFrame, keys: Sequence[str], value: str, counted: str | None = None, every: int = VALUES
) -> DataFrame:
    """Box-plot numbers by group: quartiles, whisker ends within 1.5 IQR, and outlier count.

    ``counted`` names a count column where the rows are counts of a value already.
    """
    keys = list(keys)
    joined = _with_fences(df, keys, value, counted, every)
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    stats = joined.groupBy(*keys, "n", "lower", "middle", "upper").agg(
        F.min(F.when(inside, F.col(value))).alias("_lowest"),
        F.max(F.when(inside, F.col(value))).alias("_highest"),
        F.coalesce(F.sum(F.when(~inside, F.col("_m"))), F.lit(0)).alias("n_outliers"),
    )
    return stats.select(
        *keys,
        "n",
        F.least("lower", "_lowest").alias("ymin"),
        "lower",
        "middle",
        "upper",
        F.greatest("upper", "_highest").alias("ymax"),
        "n_outliers",
    )


def box_outliers(
    df: DataFrame, keys: Sequence[str], value: str, counted: str | None = None, every: int = VALUES
) -> DataFrame:
    """Distinct values beyond the whiskers of their group, with their counts."""
    joined = _with_fences(df, list(keys), value, counted, every)
    beyond = (F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high"))
    return joined.filter(beyond).groupBy(*keys, value).agg(F.sum("_m").alias("n"))


def wind_rose(
    df: DataFrame,
    speed: str,
    direction: str,
    breaks: Sequence[float],
    speed_max: float = 25.0,
    sectors: int = 16,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Share of observations by speed bin and compass sector (and further keys).

    Speed bins are right-closed; if any speed exceeds ``speed_max``, one more bin reaches from the
    last break to the fastest observation. The first sector is centred on north. A row with either
    part missing counts as missing in both.
    """
    step = 360.0 / sectors
    both = F.col(speed).isNotNull() & F.col(direction).isNotNull()
    s, d = F.when(both, F.col(speed)), F.when(both, F.col(direction))
    sector = F.pmod(F.ceil((d - F.lit(step / 2)) / F.lit(step)), F.lit(sectors)).cast("int")

    fastest = df.agg(F.max(s)).scalar()
    over = (fastest > speed_max) & (s > breaks[-1])
    beyond = F.when(over, F.concat(F.lit(f"{speed_max:g} - "), fastest.cast("string")))
    binned = df.select(
        *keys,
        F.coalesce(right_closed_bin(s, breaks), beyond).alias("speed_bin"),
        sector.alias("sector"),
    )
    counts = binned.groupBy(*keys, "speed_bin", "sector").agg(rows().alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    out = counts.withColumn("frequency", ratio("n", total))
    if sectors == len(COMPASS):
        names = F.array(*[F.lit(c) for c in COMPASS])
        out = out.withColumn("compass", F.get(names, F.col("sector")))
    return out
