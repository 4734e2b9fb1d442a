"""From raw documents to a training mix: each stage works on all that its predecessor kept.

The quality classifier drops what it rejects, SimHash near-dedup keeps one document of each group, decontamination drops documents that
hold a benchmark item, PII masks personal data and the terms that disclose it, and mixing says how often each document
is taken. A stage's result is written as Parquet below the shared folder and read again by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinewave.llm import decontamination, mixing, pii, quality, simhash
from brinewave.llm.base import prepared
from brinewave.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_QUALITY = 0.7


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", of=4, held_out=2)
    return quality.scored(docs, model).filter(F.col("_score") >= LEAST_QUALITY).drop("_score")


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, distance=3)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.sanitised(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("simhash near-dedup", different),
    ("benchmark decontamination", uncontaminated),
    ("pii", anonymous),
    ("mixing", mix),
]

#: A trained classifier and fingerprints take part: no SQL expresses the stages together.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
