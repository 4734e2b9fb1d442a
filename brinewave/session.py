"""Session settings the transforms rely on, and durable staging of intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only: they can be applied to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where an aggregate above would have reused the partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # year folders are replaced one by one, never the whole table
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the cast feed takes conditions over
    "spark.sql.python.filterPushdown.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("brinewave")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a fresh folder of its own; on a cluster there is no
    safe guess, since a machine-local folder is not seen by the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="brinewave-"))
    return _OWN_FOLDER[0]


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder (in folders of the ``by`` columns) and read it back.

    The written table cuts the lineage and survives the loss of executors, so a result that feeds
    several products is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
