"""Aggregates and predicates with the null rules of the field reports.

"Strict" aggregates return null as soon as one input is null; the plain Spark aggregates skip nulls
and serve where the report removes missing values first.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strict(c: Column | str, aggregate: Column) -> Column:
    return F.when(F.count(as_col(c)) == F.count(F.lit(1)), aggregate)


def strict_mean(c: Column | str) -> Column:
    return _strict(c, F.avg(as_col(c)))


def strict_sum(c: Column | str) -> Column:
    return _strict(c, F.sum(as_col(c)))


def strict_sd(c: Column | str) -> Column:
    return _strict(c, F.stddev_samp(as_col(c)))


def rows() -> Column:
    """Row count of the group, rows with missing values included."""
    return F.count(F.lit(1))


def standard_error(c: Column | str, strict: bool = False) -> Column:
    """sd / sqrt(n) where n counts every row of the group, missing or not."""
    sd = strict_sd(c) if strict else F.stddev_samp(as_col(c))
    return sd / F.sqrt(rows())


def share_true(condition: Column) -> Column:
    """Mean of a logical; null if any row's condition is null."""
    return strict_mean(condition.cast("int"))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Non-membership that keeps null rows."""
    c = as_col(c)
    return c.isNull() | ~c.isin(*values)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null for a zero divisor (ANSI division would raise)."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def row_sum(columns: Iterable[str]) -> Column:
    """Sum over the columns of one row; null if any part is null."""
    total = None
    for name in columns:
        total = F.col(name) if total is None else total + F.col(name)
    return total


def row_sum_present(columns: Iterable[str]) -> Column:
    """Sum over the non-null columns of one row; null only if all parts are null."""
    columns = list(columns)
    filled = None
    for name in columns:
        part = F.coalesce(F.col(name), F.lit(0))
        filled = part if filled is None else filled + part
    return F.when(F.coalesce(*[F.col(c) for c in columns]).isNotNull(), filled)


def complete(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without a missing value in the columns (default: all of them).

    Written as plain not-null tests, one a column, and not as ``dropna``: these reach the parquet
    scan and turn an outer join below into an inner one, which a count of non-null values cannot.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for name in columns if columns is not None else df.columns:
        c = F.col(f"`{name}`")
        out = out.filter(c.isNotNull())
        if isinstance(types[name], DoubleType | FloatType):
            out = out.filter(~F.isnan(c))
    return out


def text_or_na(c: Column | str) -> Column:
    """Text form used when pasting keys: a missing value becomes the text NA."""
    return F.coalesce(as_col(c).cast("string"), F.lit("NA"))
