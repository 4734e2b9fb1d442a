"""Order-dependent operators: running totals, centred means, neighbour comparison.

The plain windows serve series that are already aggregated to calendar days, so a partition holds a
bounded number of rows. For raw rows there are blocked forms, which cut one long series into blocks:
no task ever sorts a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col, ratio
from brinewave.operators.joins import null_safe_join

CHUNK_ROWS = 1_000_000
BLOCK_ROWS = 100_000  # expected rows of a range block

_SEARCH = """IF(coalesce(size(_splitters), 0) = 0, 0,
  aggregate(sequence(1, length(bin(size(_splitters)))), struct(0 AS low, size(_splitters) AS high), (b, step) ->
    IF(b.low >= b.high, b, IF(_splitters[shiftright(b.low + b.high, 1)] <= _row,
      struct(shiftright(b.low + b.high, 1) + 1 AS low, b.high AS high),
      struct(b.low AS low, shiftright(b.low + b.high, 1) AS high)))).low)"""


def running_total(
    value: Column | str, keys: Sequence[str], order: Sequence[str], strict: bool = False
) -> Column:
    """Running sum in order; ``strict`` makes it null from the first missing value on."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(as_col(value)).over(w)
    if not strict:
        return total
    return F.when(F.count(as_col(value)).over(w) == F.count(F.lit(1)).over(w), total)


def cumulative_percent(value: Column | str, keys: Sequence[str], order: Sequence[str]) -> Column:
    total = F.sum(as_col(value)).over(Window.partitionBy(*keys))
    return running_total(ratio(value, total) * 100, keys, order)


def share_of_total(value: Column | str, keys: Sequence[str]) -> Column:
    return ratio(value, F.sum(as_col(value)).over(Window.partitionBy(*keys)))


def centred_mean(value: Column | str, keys: Sequence[str], order: Sequence[str], width: int = 5) -> Column:
    """Mean of ``width`` rows around each row, null near the ends or where a value is missing."""
    half = width // 2
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-half, half)
    v = as_col(value)
    return F.when(F.count(v).over(w) == width, F.avg(v).over(w))


def next_row(column: Column | str, keys: Sequence[str], order: Sequence[str]) -> Column:
    return F.lead(as_col(column)).over(Window.partitionBy(*keys).orderBy(*order))


def range_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_block", every: int = BLOCK_ROWS
) -> DataFrame:
    """Cut each key's rows into ranges of the order columns: ``name`` is a row's range, from 0 on.

    The splitters are one in ``every`` distinct order values, taken by their hash, so they follow the data however the
    values are spread, are the same in every evaluation, and are found by a pre-aggregated pass. A key's splitters are one
    array; a row finds its range in it by bisection. Rows of equal order values share a range.
    """
    if not keys:
        one = range_blocks(df.withColumn("_all", F.lit(0)), ["_all"], order, name, every)
        return one.drop("_all")
    keys = list(keys)
    row = F.struct(*[F.col(c) for c in order])
    picked = df.filter(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).select(*keys, row.alias("_row")).distinct()
    splitters = picked.groupBy(*keys).agg(F.sort_array(F.collect_list("_row")).alias("_splitters"))
    found = null_safe_join(df, splitters, keys).withColumn("_row", row)
    return found.withColumn(name, F.expr(_SEARCH)).drop("_splitters", "_row")


def _block_starts(blocks: DataFrame, keys: list[str], block: list[str], total: str | None) -> DataFrame:
    """Sum before each block, built level by level.

    At each level a window only spans the children of one parent (the days of a season, then the id
    ranges of a day), never all blocks of a key.
    """
    starts = None
    for depth, column in enumerate(block):
        parent = [*keys, *block[:depth]]
        level = blocks.groupBy(*parent, column).agg(F.sum("_sum").alias("_level"))
        siblings = Window.partitionBy(*parent).orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("_level").over(siblings), F.lit(0))
        if starts is None:
            whole = [F.sum("_level").over(Window.partitionBy(*keys)).alias(total)] if total else []
            starts = level.select(*parent, column, offset.alias("_before"), *whole)
        else:
            finer = level.select(*parent, column, offset.alias("_inner"))
            joined = null_safe_join(finer, starts, parent, "inner")
            starts = joined.withColumn("_before", F.col("_before") + F.col("_inner")).drop("_inner")
    return starts


def blocked_running_total(
    df: DataFrame,
    keys: Sequence[str],
    block: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Running total over raw rows; ``total`` names a column for the whole total of the key.

    ``block`` columns, taken in turn, must be a non-decreasing function of ``order`` within a key
    (for instance the date and a range of ids, see ``range_blocks``). Block totals are pre-aggregated and
    accumulated by level; each row then only needs the running total inside its own block.
    """
    keys, block = list(keys), list(block)
    starts = _block_starts(df.groupBy(*keys, *block).agg(F.sum(value).alias("_sum")), keys, block, total)
    inner = Window.partitionBy(*keys, *block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        null_safe_join(df, starts, [*keys, *block], "inner")
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .drop("_before")
    )


def with_position(
    df: DataFrame, keys: Sequence[str], block: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """1-based row position within each key in the given order, by blocks."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return blocked_running_total(ones, keys, block, order, "_one", name).drop("_one")


def blocked_centred_mean(
    df: DataFrame,
    keys: Sequence[str],
    block: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    width: int = 5,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Centred mean over raw rows of any length.

    Rows are numbered, cut into chunks of ``chunk_rows`` and the few rows at a chunk edge are lent to
    the neighbouring chunk, so every window holds at most ``chunk_rows + width - 1`` rows.
    """
    half = width // 2
    numbered = with_position(df, keys, block, order, "_pos")
    home = F.floor((F.col("_pos") - 1) / F.lit(chunk_rows))
    first = F.floor((F.greatest(F.col("_pos") - half, F.lit(1)) - 1) / F.lit(chunk_rows))
    last = F.floor((F.col("_pos") + half - 1) / F.lit(chunk_rows))
    lent = numbered.withColumn("_home", home).withColumn("_chunk", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-half, half)
    mean = F.when(F.count(value).over(w) == width, F.avg(value).over(w))
    return (
        lent.withColumn(name, mean)
        .filter(F.col("_chunk") == F.col("_home"))
        .drop("_pos", "_home", "_chunk")
    )


def with_crossing_midpoints(
    df: DataFrame, keys: Sequence[str], x: str, side: str, averaged: Sequence[str], copied: dict[str, str]
) -> DataFrame:
    """Insert a row half-way between neighbours that lie on different sides.

    The new row has the keys, the middle of ``x`` and of the averaged columns, and for ``copied``
    ({column: source}) the new value of the source; other columns are null. One pass: each row is
    followed by its midpoint row, so the input is not evaluated twice for a union.
    """
    watched = [x, side, *averaged]
    after = [next_row(c, keys, [x]).alias(f"_next_{c}") for c in watched]
    paired = df.select(*df.columns, *after)
    middle = {c: (F.col(c) + F.col(f"_next_{c}")) / 2 for c in [x, *averaged]}
    middle |= {c: F.col(c) for c in keys}
    middle |= {c: middle[source] for c, source in copied.items()}
    types = dict(df.dtypes)
    own = F.struct(*[F.col(c) for c in df.columns])
    new = F.struct(*[middle.get(c, F.lit(None)).cast(types[c]).alias(c) for c in df.columns])
    crosses = F.col(side) != F.col(f"_next_{side}")
    return paired.select(F.inline(F.when(crosses, F.array(own, new)).otherwise(F.array(own))))


def zero_crossings(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Where the line through neighbouring points meets zero, strictly between the two."""
    x1, y1 = F.col(x), F.col(y)
    x2, y2 = F.col("_x2"), F.col("_y2")
    at = x1 - y1 * ratio(x2 - x1, y2 - y1)
    paired = df.select(
        *keys, x, y, next_row(x, keys, [x]).alias("_x2"), next_row(y, keys, [x]).alias("_y2")
    )
    return (
        paired.withColumn("_at", at)
        .filter((x1 < F.col("_at")) & (F.col("_at") < x2))
        .select(*keys, F.col("_at").alias(x), F.lit(0.0).alias(y))
    )
