"""What the operators share: word rules, durable intermediate results, bounded Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinewave.session import shared_folder

SPACE = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 256


def prepared(spark: SparkSession) -> SparkSession:
    """Arrow batches by rows and bytes, so that a batch of long texts fits a Python worker."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder: lineage is cut, lost executors cost nothing.

    The files go when the frame is no longer referenced, if the session cleans its checkpoints.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots included."""
    return df[f"`{name}`"]


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """The maximal runs of other characters than ASCII white space, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def materialised(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that the optimizer cannot repeat their expressions inside lambdas."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def labelled(documents: DataFrame, labels: DataFrame, label: str, of: int, held_out: int, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out remainder.

    The bound is on what a model is fitted to, never on what it scores: the rows with the smallest hash of doc_id
    are taken, so the choice does not depend on the layout of the tables; the bound also allows their broadcast. Rows
    without id or label are left out.
    """
    mine = labels.select(
        column(labels, "doc_id").cast("bigint").alias("doc_id"), column(labels, label).cast("int").alias("label")
    ).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    train = mine.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of != held_out)
    train = train.groupBy("doc_id").agg(F.max("label").alias("label"))
    train = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.select(column(documents, "doc_id").cast("bigint").alias("doc_id"), text_of(documents).alias("text"))
    return texts.join(F.broadcast(train), "doc_id").select("text", "label")


def boxed(docs: DataFrame, **more: Column) -> DataFrame:
    """The columns of ``docs`` in one struct, beside working columns that cannot clash with them."""
    return docs.select(F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("_box"), *[c.alias(n) for n, c in more.items()])


def unboxed(df: DataFrame, **replaced: Column) -> DataFrame:
    """The boxed columns in their order, some replaced or added."""
    names = df.schema["_box"].dataType.names
    old = [replaced.get(n, F.col("_box").getField(n)).alias(n) for n in names]
    return df.select(*old, *[c.alias(n) for n, c in replaced.items() if n not in names])


def remainder(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTE_BASE = 0x9DDFEA08EB382D69
PIECE = 1 << 21
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse, modulo 2**64; remembered for the largest n so far."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            both.append(np.cumprod(out))
        known = _POWERS[base] = (both[0], both[1])
    return known


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a piece of UTF-8 text and the byte places where they start.

    Words are runs without ASCII white space; a hash is a polynomial of the word's bytes modulo 2**64, mixed.
    """
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~WHITE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    up, down = powers(BYTE_BASE, len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start]), start


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts one after another, and the number of words of each; memory goes by pieces."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    group: list[int] = []
    size = 0

    def flush() -> None:
        h, start = hash_words(b"\n".join(texts[i] for i in group))
        bounds = np.cumsum([0, *(len(texts[i]) + 1 for i in group)])
        counts[group] = np.diff(np.searchsorted(start, bounds))
        hashes.append(h)

    for i, t in enumerate(texts):
        if group and size + len(t) > PIECE:
            flush()
            group, size = [], 0
        if len(t) > PIECE:
            parts = [hash_words(p)[0] for p in pieces(t)]
            hashes += parts
            counts[i] = sum(map(len, parts))
        else:
            group.append(i)
            size += len(t)
    if group:
        flush()
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at white space, or where the text ends."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end


cloudpickle.register_pickle_by_value(sys.modules[__name__])
