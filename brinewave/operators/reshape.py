"""Wide-to-long reshaping, unions and column splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def longer(df: DataFrame, columns: Sequence[str], key: str, value: str) -> DataFrame:
    """One row per listed column; missing values are kept."""
    ids = [c for c in df.columns if c not in columns]
    return df.unpivot(ids, list(columns), key, value)


def longer_structs(df: DataFrame, groups: dict[str, dict[str, str]], key: str) -> DataFrame:
    """Several value columns per key at once: ``{key value: {output column: source column}}``.

    Mean and standard error of one aggregate travel together, so no two tables are paired by row
    order.
    """
    used = {src for outs in groups.values() for src in outs.values()}
    ids = [c for c in df.columns if c not in used]
    entries = [
        F.struct(F.lit(k).alias(key), *[F.col(src).alias(out) for out, src in outs.items()])
        for k, outs in groups.items()
    ]
    return df.select(*ids, F.inline(F.array(*entries)))


def bind(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def bind_same(*frames: DataFrame) -> DataFrame:
    """Union by name of tables with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def merge_labels(df: DataFrame, column: str, members: Sequence[str], name: str) -> DataFrame:
    """Give several labels one common name, e.g. two stations read as one."""
    c = F.col(column)
    return df.withColumn(column, F.when(c.isin(*members), F.lit(name)).otherwise(c))


def separate(df: DataFrame, column: str, into: Sequence[str], pattern: str) -> DataFrame:
    """Split one text column into several; the rest of the text stays in the last one."""
    parts = F.split(F.col(column), pattern, len(into))
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(into)}).drop(column)


def split_rows(df: DataFrame, column: str, name: str, pattern: str = ",") -> DataFrame:
    """One row per trimmed part of a separated text column."""
    parts: Column = F.transform(F.split(F.col(column), pattern), lambda x: F.trim(x))
    return df.select(*[c for c in df.columns if c != column], F.explode(parts).alias(name))
