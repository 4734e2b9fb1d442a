"""Column selection and bulk column changes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names of the contiguous columns from ``first`` to ``last``, in schema order."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def change_at(df: DataFrame, columns: Iterable[str], f: Callable[[Column], Column]) -> DataFrame:
    """Apply one function to the listed columns."""
    return df.withColumns({c: f(F.col(c)) for c in columns})


def change_numeric(df: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    """Apply one function to every numeric column, keys and counts included."""
    numeric = [s.name for s in df.schema.fields if isinstance(s.dataType, NumericType)]
    return change_at(df, numeric, f)


def rename(df: DataFrame, **new_to_old: str) -> DataFrame:
    return df.withColumnsRenamed({old: new for new, old in new_to_old.items()})
