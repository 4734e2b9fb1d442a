"""Writers of results: year folders, casts by station and year, plain CSV."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], form: str = "parquet") -> None:
    """Write folders by the partition columns, replacing only the folders present in ``df``.

    Rows are rebalanced by the partition columns first: small folders get one file, and AQE splits
    a folder that holds a large share of the rows over several tasks.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy(*by)
    if form == "csv":
        writer = writer.option("header", True).option("nullValue", "NA")
    writer.format(form).save(path)


def write_season(df: DataFrame, path: str, form: str = "parquet") -> None:
    """One folder a year; rerunning a season leaves the other years alone."""
    write_partitioned(df, path, ["year"], form)


def write_casts(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, ["station", "year"])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, nullValue="NA").csv(path)


def reload(spark: SparkSession, path: str, form: str = "parquet", schema: str | None = None) -> DataFrame:
    """Read a stage output back."""
    reader = spark.read.schema(schema) if schema else spark.read
    if form == "csv":
        reader = reader.options(header=True, nullValue="NA")
    return reader.format(form).load(path)


# ---- seasons that are switched as a whole -------------------------------------------------------
#
# path/data/run=<id>/year=<y>   the rows of a run, never changed afterwards
# path/manifest                 an append-only table: version, year, run
#
# A run's data are written first. Then its years are named in the manifest by one file, which its job's commit makes visible
# as a whole. Readers take each year's last version, so a run that fails before that has written nothing anyone reads.

MANIFEST = "version bigint, year int, run string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``year, version, run`` of the current run of each year."""
    try:
        log = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], MANIFEST)
    return log.groupBy("year").agg(F.max(F.struct("version", "run")).alias("x")).select("year", "x.*")


def commit_seasons(df: DataFrame, path: str) -> str:
    """Write the years of ``df`` (column ``year``) and switch readers to them at the end; the name of the run.

    Other years stay as they are. A year without rows in ``df`` is not touched, so a rerun cannot empty one by mistake.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    data = f"{path}/data/run={run}"
    df.hint("rebalance", "year").write.partitionBy("year").parquet(data)
    years = spark.read.parquet(data).select(F.col("year").cast("int").alias("year")).distinct()
    last = manifest(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    entries = years.select(F.lit(last + 1).cast("bigint").alias("version"), "year", F.lit(run).alias("run"))
    entries.coalesce(1).write.mode("append").parquet(f"{path}/manifest")  # one row a year
    return run


def read_seasons(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """The current rows of all or the given years; only their folders are read."""
    current = manifest(spark, path)
    if years is not None:
        current = current.filter(F.col("year").isin(*years))
    folders = [f"{path}/data/run={r['run']}/year={r['year']}" for r in current.collect()]  # one a year
    if not folders:
        raise ValueError("no season has been committed")
    return spark.read.option("basePath", f"{path}/data").option("mergeSchema", True).parquet(*folders).drop("run")


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """``year, run`` of entries that a later version has replaced; their folders may be deleted once no reader uses them."""
    log = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    return log.join(manifest(spark, path).select("year", "run"), ["year", "run"], "left_anti").select("year", "run")
