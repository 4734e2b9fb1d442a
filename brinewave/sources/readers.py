"""Readers of landed field and sensor files."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NA_OPTIONS = {"header": True, "nullValue": "NA", "nanValue": "NaN"}


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headed CSV with an explicit schema, checked against the header; the text NA is missing."""
    return spark.read.schema(schema).options(**NA_OPTIONS, enforceSchema=False).csv(path)


def explore(spark: SparkSession, path: str, sample: float = 1.0) -> DataFrame:
    """Headed CSV with types inferred from a share of the rows, for a first look only."""
    return spark.read.options(**NA_OPTIONS, inferSchema=True, samplingRatio=sample).csv(path)


#: Types a text may be, narrowest first. A column gets the first that all of its sampled values parse as.
GUESSED_TYPES = ("boolean", "bigint", "double", "date", "timestamp", "string")


@dataclass
class Guessed:
    """A table read with guessed types; ``problems`` has the values that its types could not hold."""

    table: DataFrame
    types: dict[str, str]
    problems: DataFrame

    def first_problems(self) -> DataFrame:
        """The first value of each column that breaks the guess: column, file, line, expected, actual."""
        # a number is all that is kept of the many problems of a file, so nothing is sorted for it
        lines = self.problems.groupBy("column", "file").agg(F.min("line").alias("line"))
        first = lines.groupBy("column").agg(F.min(F.struct("file", "line")).alias("x")).select("column", "x.*")
        places = ["column", "file", "line"]
        return self.problems.join(F.broadcast(first), places).select(*places, "expected", "actual")


def numbered_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """``value, file, line``: the lines of text files with their numbers from 1 on.

    With ``parts`` the files are one table in the order of their names, as a sorted table is written: each repeats the
    header, which counts once, and lines are numbered on from file to file.

    Splits are counted where they are read, and a running total over the splits of a file gives their offsets: no line
    is moved or sorted and no file is read by one task.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )  # ids count up within a split
    splits = lines.groupBy("file", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    order = Window.orderBy("file", "start") if parts else Window.partitionBy("file").orderBy("start")
    again = (F.col("start") == 0) & (F.row_number().over(order) > 1)  # opens with the header once more
    splits = splits.withColumn("header", F.when(again, F.col("first")))
    splits = splits.withColumn("n", F.col("n") - F.col("header").isNotNull().cast("int"))
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = before - F.col("first") + F.when(F.col("header").isNull(), 1).otherwise(0)
    splits = F.broadcast(splits.select("file", "start", "header", shift.alias("shift")))  # a row for each split
    body = lines.join(splits, ["file", "start"]).filter(~F.col("id").eqNullSafe(F.col("header")))
    return body.select("value", "file", (F.col("id") + F.col("shift")).alias("line"))


def _parses(text: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.lower(text).isin("true", "false", "t", "f")
    if kind == "bigint":
        return text.rlike(r"^\s*[+-]?\d+\s*$") & text.try_cast("bigint").isNotNull()
    if kind == "double":
        return ~text.rlike("[dDfF]\\s*$") & text.try_cast("double").isNotNull()
    if kind == "date":
        return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()
    if kind == "timestamp":
        return text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}") & text.try_cast("timestamp").isNotNull()
    return F.lit(True)


def read_guessed(spark: SparkSession, path: str, guess_max: int = 1000, parts: bool = False) -> Guessed:
    """Headed CSV files with types guessed from the first ``guess_max`` rows of each file, or of all as ``parts`` of a table.

    One aggregation over these rows: a value's possible types are bits, a column's are the bits that all values share,
    and the narrowest is taken (boolean where all are missing). Later values that do not parse become missing and are
    listed as problems with their line. A record is one line; every file has the same header.
    """
    head = spark.read.text(path).limit(1).collect()
    names = next(csv.reader([head[0]["value"]]), []) if head else []
    if not names:
        raise ValueError("there is no header line")
    texts = ", ".join(f"`{n}` string" for n in names)
    rows = numbered_lines(spark, path, parts).filter((F.col("line") > 1) & (F.length(F.trim("value")) > 0))
    rows = rows.select("file", "line", F.from_csv("value", texts, {"nullValue": "NA"}).alias("row"))

    def value(name: str) -> Column:
        return F.col("row").getField(name)

    def mask(name: str) -> Column:
        bits = [F.when(_parses(value(name), k), 1 << i).otherwise(0) for i, k in enumerate(GUESSED_TYPES)]
        return F.when(value(name).isNotNull(), sum(bits[1:], bits[0]))

    shared = rows.filter(F.col("line") <= guess_max + 1).agg(
        *[F.bit_and(mask(n)).alias(str(i)) for i, n in enumerate(names)]
    ).first()
    types = {
        n: next(k for b, k in enumerate(GUESSED_TYPES) if shared[i] is None or shared[i] >> b & 1) for i, n in enumerate(names)
    }

    def typed(name: str) -> Column:
        kind, text = types[name], value(name)
        if kind == "boolean":
            return F.when(_parses(text, kind), F.lower(text).isin("true", "t"))
        return F.when(_parses(text, kind), text.try_cast(kind))

    table = rows.select(*[typed(n).alias(n) for n in names])
    odd = [
        F.when(value(n).isNotNull() & ~F.coalesce(_parses(value(n), types[n]), F.lit(False)),
               F.struct(F.lit(n).alias("column"), F.lit(types[n]).alias("expected"), value(n).alias("actual")))
        for n in names
    ]
    problems = rows.select("file", "line", F.inline(F.array_compact(F.array(*odd))))
    return Guessed(table, types, problems.select("column", "file", "line", "expected", "actual"))


def read_quoted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV whose quoted fields may hold commas, doubled quotes and line feeds."""
    return (
        spark.read.schema(schema).options(**NA_OPTIONS, multiLine=True, escape='"', enforceSchema=False).csv(path)
    )


def _drop_head(header: int, after: int, names: Sequence[str]):
    """Drop the lines up to the header and ``after`` more; the header line of each file must have the names."""

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            place = batch.groupby("file").cumcount() + batch["file"].map(seen).fillna(0)
            for line in batch.loc[place == header, "value"]:
                found = next(csv.reader([line]), [])
                if found != list(names):
                    raise ValueError(f"the header is {found}, not {list(names)}")
            for file, n in batch.groupby("file").size().items():
                seen[file] = seen.get(file, 0) + int(n)
            yield batch.loc[place > header + after, ["value"]]

    return drop


def _body(spark: SparkSession, path: str, header: int, after: int, names: Sequence[str]) -> DataFrame:
    """The lines of CSV files below their heads, blank ones left out.

    Files stay splittable: only the split at the start of a file passes through Python, which counts its lines as they
    go, so no file is ever held in memory; later splits stay in the JVM.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    first = lines.filter("start = 0").select("value", "file")
    body = first.mapInPandas(_drop_head(header, after, names), "value string")
    return body.unionByName(lines.filter("start > 0").select("value")).filter(F.length(F.trim("value")) > 0)


def read_skipping(spark: SparkSession, path: str, skip: int, schema: str) -> DataFrame:
    """CSV files that open with ``skip`` lines of preamble and a header line, which must name the schema's columns."""
    body = _body(spark, path, skip, 0, StructType.fromDDL(schema).names)
    return body.select(F.from_csv("value", schema, {"nullValue": "NA"}).alias("row")).select("row.*")


def read_with_units_row(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a row of units under the header: that row of each file is dropped, whatever it says, and all
    others are cast to the schema, missing where a value does not parse."""
    wanted = StructType.fromDDL(schema)
    texts = ", ".join(f"`{f.name}` string" for f in wanted.fields)
    rows = _body(spark, path, 0, 1, wanted.names).select(F.from_csv("value", texts, {"nullValue": "NA"}).alias("row"))
    return rows.select(*[F.col(f"row.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_sheets(spark: SparkSession, folder: str, sheets: dict[str, str]) -> dict[str, DataFrame]:
    """One table for each sheet of a workbook landed as one folder a sheet."""
    return {name: read_table(spark, f"{folder}/{name}", schema) for name, schema in sheets.items()}


def read_casts(
    spark: SparkSession,
    path: str,
    stations: Sequence[str],
    after_year: int | None = None,
    days: tuple[int, int] | None = None,
    deepest: float | None = None,
    columns: Sequence[str] = ("station", "year", "date", "depth", "temperature", "salinity", "dissolved_oxygen_ml_l"),
) -> DataFrame:
    """CTD casts stored by station and year. Station and year prune folders, depth and the column
    list reach the parquet scan; the day range excludes both ends."""
    casts = spark.read.parquet(path).filter(F.col("station").isin(*stations))
    if after_year is not None:
        casts = casts.filter(F.col("year") > after_year)
    if deepest is not None:
        casts = casts.filter(F.col("depth") <= deepest)
    if days is not None:
        yday = F.dayofyear("date")
        casts = casts.filter((yday > days[0]) & (yday < days[1]))
    return casts.select(*columns)


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A packaged data set, by its name in the catalog."""
    return spark.table(name)


# the Python helper travels with the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
