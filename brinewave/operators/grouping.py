"""Grouped statistics built so that map-side partial aggregation does the heavy part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col, ratio, rows, standard_error, strict_mean, strict_sd
from brinewave.operators.joins import null_safe_join


def means(df: DataFrame, keys: Sequence[str], columns: dict[str, str], strict: bool = False) -> DataFrame:
    """Mean of each source column by group, ``{output name: source column}``."""
    mean = strict_mean if strict else F.avg
    return df.groupBy(*keys).agg(*[mean(src).alias(out) for out, src in columns.items()])


def mean_sd_se(df: DataFrame, keys: Sequence[str], value: str, mean: str = "mean") -> DataFrame:
    """Strict mean, sd, row count and standard error by group."""
    return df.groupBy(*keys).agg(
        strict_mean(value).alias(mean),
        strict_sd(value).alias("sd"),
        rows().alias("n"),
        standard_error(value, strict=True).alias("se"),
    )


def share_within(counts: DataFrame, parent: Sequence[str], count: str, name: str) -> DataFrame:
    """count / total count of the parent group.

    ``counts`` must already be aggregated to one row per category, so a parent group holds as many
    rows as it has categories.
    """
    total = F.sum(count).over(Window.partitionBy(*parent))
    return counts.withColumn(name, ratio(count, total))


def duplicated_groups(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column] = ()) -> DataFrame:
    """One row for each key group of more than one row, with its size and further aggregates."""
    return df.groupBy(*keys).agg(rows().alias("count"), *aggregates).filter("count > 1")


def rows_of_duplicated_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the groups of more than one row (a grouped filter on the group size).

    Sizes are aggregated and joined back: a hot group is never gathered in one window task.
    """
    return null_safe_join(df, duplicated_groups(df, keys).select(*keys), keys, "left_semi")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in the given order, all columns kept.

    A minimum over structs instead of a row number: copies collapse before the shuffle, so a key
    with very many copies stays cheap. Columns outside keys and order break the last ties.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    ranked = [c for c in ranked if c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def ratio_of_sums(df: DataFrame, top: Column | str, bottom: Column | str, name: str = "ratio") -> DataFrame:
    """One row: sum(top) / sum(bottom), missing parts skipped."""
    return df.agg(ratio(F.sum(as_col(top)), F.sum(as_col(bottom))).alias(name))


def with_total_ratio(df: DataFrame, top: Column | str, bottom: Column | str, name: str = "ratio") -> DataFrame:
    """Attach the whole-table ratio of sums as a scalar subquery."""
    return df.withColumn(name, ratio_of_sums(df, top, bottom).scalar())


def with_group_ratio(df: DataFrame, keys: Sequence[str], top: str, bottom: str, name: str = "ratio") -> DataFrame:
    """Attach the ratio of sums of each group; aggregated first, then joined back."""
    per_group = df.groupBy(*keys).agg(ratio(F.sum(top), F.sum(bottom)).alias(name))
    return null_safe_join(df, per_group, keys, "left")


def with_group_values(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Attach group aggregates to every row: aggregated first, then joined back, so that a hot group
    is neither sorted nor held in one window task."""
    per_group = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    return null_safe_join(df.drop(*aggregates), per_group, keys, "left")


def count_of(condition: Column, name: str) -> Column:
    """Number of rows for which the condition holds."""
    return F.count_if(condition).alias(name)


def distinct_hosts(df: DataFrame, keys: Sequence[str], host: Sequence[str], name: str = "n") -> DataFrame:
    """Number of distinct hosts by group: distinct rows first, then a count, each pre-combined."""
    every = list(dict.fromkeys([*keys, *host]))
    return df.select(*every).distinct().groupBy(*keys).agg(rows().alias(name))


def uncounted(df: DataFrame, keys: Sequence[str], times: str, name: str = "n") -> DataFrame:
    """Rows repeated ``times`` times, then counted. The repetition is arithmetic: the count is a sum,
    and groups of no repetition vanish."""
    return df.groupBy(*keys).agg(F.sum(times).alias(name)).filter(F.col(name) > 0)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row repeated ``times`` times, literally; zero and missing drop the row."""
    n = F.coalesce(F.col(times).cast("int"), F.lit(0))
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), n))).drop("_copy")


def moment_parts(columns: dict[str, Column | str]) -> list[Column]:
    """Count, sum and sum of squares of each column, to be added up again after a join.

    Meant for whole numbers: the parts are then exact and so are the statistics built from them.
    """
    out = []
    for name, c in columns.items():
        c = as_col(c)
        out += [
            F.count(c).alias(f"{name}__n"),
            F.sum(c.cast("bigint")).alias(f"{name}__s"),
            F.sum((c * c).cast("bigint")).alias(f"{name}__q"),
        ]
    return out


def merged_parts(names: Sequence[str]) -> list[Column]:
    return [F.sum(f"{c}__{p}").alias(f"{c}__{p}") for c in names for p in ("n", "s", "q")]


def mean_of_parts(name: str) -> Column:
    return ratio(f"{name}__s", f"{name}__n")


def sd_of_parts(name: str) -> Column:
    n, s, q = (F.col(f"{name}__{p}").cast("double") for p in ("n", "s", "q"))
    return F.when(n > 1, F.sqrt(F.greatest(q - s * s / F.when(n > 0, n), F.lit(0.0)) / (n - 1)))
