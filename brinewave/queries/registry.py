"""Registration of a query together with its check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

from brinewave.fixtures import views as open_views
from brinewave.fixtures import with_views
from brinewave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def settled(df: DataFrame, digits: int) -> DataFrame:
    """Common number types, and doubles rounded where two engines add in different orders."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType | FloatType):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, IntegralType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(
    name: str,
    views: Sequence[str],
    sql: str | None = None,
    doubles: Sequence[str] = (),
    integers: Sequence[str] = (),
    extra: Sequence[str] = (),
    digits: int = 9,
    recursive: bool = False,
):
    """Register ``f(*views)``.

    ``sql`` may name the views as tables; ``extra`` are further common table expressions in front of
    it (``recursive`` if one of them is); ``doubles`` and ``integers`` list the result columns to round and to cast in DuckDB.
    """

    def register(f: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return settled(f(*open_views(spark, sf_dir, views)), digits)

        run.__name__ = name
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            changes = [f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in doubles]
            changes += [f"CAST({c} AS BIGINT) AS {c}" for c in integers]
            star = f"* REPLACE ({', '.join(changes)})" if changes else "*"
            ctes = ",\n".join([*with_views(*views), *extra])
            head = f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n" if ctes else ""
            ORACLES[name] = f"{head}SELECT {star} FROM (\n{sql.strip()}\n) AS result"
        return f

    return register
