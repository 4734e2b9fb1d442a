"""Joins with the null rules of the reports.

No broadcast hint is given anywhere in this module: whether a side is small enough is decided by
Spark from its measured size (autoBroadcastJoinThreshold at plan time and again by AQE at run time),
and a hot key of a sort-merge join is split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a missing key matches a missing key; key columns appear once.

    A right join takes the keys of the right side, as ``how="left"`` does of the left.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "right":
        joined = joined.withColumns({k: F.col(f"_r_{k}") for k in on})
    return joined.drop(*[f"_r_{k}" for k in on])


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column the two sides share, missing keys matching."""
    shared = [c for c in left.columns if c in right.columns]
    return null_safe_join(left, right, shared, "left")


def lookup_join(fact: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Attach columns of a dimension by its key; unmatched rows are kept with nulls."""
    return fact.join(dimension.select(key, *columns), key, "left")


def members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def non_members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows with a missing key are kept."""
    return df.join(keys.select(*on), list(on), "left_anti")


def zero_filled_join(left: DataFrame, right: DataFrame, on: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Left join, then zero for the missing counts."""
    return null_safe_join(left, right, on, "left").fillna(0, subset=list(counts))
