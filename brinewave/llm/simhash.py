"""SimHash near-duplicates: fingerprints as segment popcounts, a grid range join, exact verification.

The 64 bits are cut into 32 segments of two bits and a fingerprint becomes the point of its 32 bit counts (0, 1 or 2).
The Manhattan distance of two points is a lower bound of the Hamming distance. The point is kept as one long in which
a segment's count c has its c lowest bits set, so that the Manhattan distance is the bit count of an exclusive or.

Grid: the segments form ``d + 2`` groups of coordinates. Points within Manhattan distance ``d`` differ in at most ``d``
groups, so they agree in two groups at least: one cell for each pair of groups finds every such pair of points. In a
cell, pairs are kept by the Manhattan bound first and verified by the Hamming distance. A cell with many fingerprints
is cut into blocks, and pairs of blocks are compared in separate tasks; a comparison returns a spanning forest of the
verified links, never all pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import boxed, column, held, prepared, text_of, unboxed
from brinewave.llm.components import components

BLOCK = 1024
SEED = 42
CHUNK = 1 << 15
LOW_BITS = 0x5555555555555555


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 of the word shingles, repeats included, as a signed long; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
    counts = np.zeros(64, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    for at in range(0, len(pieces), CHUNK):
        part = pieces[at : at + CHUNK]
        h = np.fromiter(map(digest, part), np.uint64, len(part))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(pieces), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` and the long ``_fp``. Null or wordless text: fingerprint 0."""
    prepared(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn("_fp", of(text_of(docs)))


def point(fp: np.ndarray) -> np.ndarray:
    m = np.uint64(LOW_BITS)
    one = np.uint64(1)
    return ((fp | (fp >> one)) & m) | ((fp & (fp >> one) & m) << one)


def _cell_masks(groups: int) -> list[int]:
    """For each pair of coordinate groups, the bits of their segments as a signed long."""
    segments = np.array_split(np.arange(32), groups)
    masks = [sum(3 << (2 * int(s)) for s in part) for part in segments]
    pairs = [a | b for a, b in combinations(masks, 2)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in pairs]


def _forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one block, or between two blocks."""
    nodes = left if right is None else np.concatenate([left, right])
    rows, cols = left, nodes if right is None else right
    prow, pcol = point(rows), point(cols)
    near = np.bitwise_count(prow[:, None] ^ pcol[None, :]) <= distance
    i, j = np.nonzero(near)
    linked = np.bitwise_count(rows[i] ^ cols[j]) <= distance
    i, j = i[linked], j[linked] + (0 if right is None else len(left))
    label = np.arange(len(nodes))
    while len(i):
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            break
        label = least
    own = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[own].view(np.int64), nodes[label[own]].view(np.int64)


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``(a, b)`` between distinct fingerprints: connects exactly what lies within ``distance`` bits.

    ``prints`` has one row a fingerprint, column ``_fp``.
    """
    spark = prepared(prints.sparkSession)
    m = F.lit(LOW_BITS)
    x = F.col("_fp")
    half = F.shiftrightunsigned(x, 1)
    p = x.bitwiseOR(half).bitwiseAND(m).bitwiseOR(F.shiftleft(x.bitwiseAND(half).bitwiseAND(m), 1))
    cells = F.array(
        *[
            F.struct(F.lit(k).alias("pair"), p.bitwiseAND(F.lit(mask)).alias("cell"))
            for k, mask in enumerate(_cell_masks(distance + 2))
        ]
    )
    dealt = prints.select("_fp", F.inline(cells))
    sizes = dealt.groupBy("pair", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("_fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (
        dealt.join(sizes, ["pair", "cell"])
        .withColumn("blocks", blocks)
        .withColumn("block", mine)
        .select("*", other.alias("other"))
        .groupBy("pair", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .agg(F.collect_list(F.when(F.col("block") == F.least("block", "other"), F.col("_fp"))).alias("left"),
             F.collect_list(F.when(F.col("block") != F.least("block", "other"), F.col("_fp"))).alias("right"))
        .select("left", "right")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for lo, hi in zip(pdf["left"], pdf["right"]):
                a = np.asarray(lo, np.int64).view(np.uint64)
                b = np.asarray(hi, np.int64).view(np.uint64)
                if len(a) and len(b):
                    found.append(_forest(a, b, distance))
                elif len(a) > 1 or len(b) > 1:
                    found.append(_forest(a if len(a) else b, None, distance))
            if found:
                yield pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return rows.mapInPandas(compare, "a long, b long").distinct()


def placed(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, _rid, _fp`` of every row, and ``_fp, least, component``: the group of each distinct fingerprint."""
    ids = docs.select(column(docs, "doc_id").alias("doc_id"), row_hash(docs).alias("_rid"), text_of(docs).alias("text"))
    rows = held(fingerprints(ids, shingle).select("doc_id", "_rid", "_fp"))
    prints = rows.groupBy("_fp").agg(F.min("doc_id").alias("least"))
    found = components(links(prints.select("_fp"), distance))
    joined = prints.join(found.withColumnRenamed("node", "_fp"), "_fp", "left")
    return rows, joined.withColumn("component", F.coalesce("component", "_fp"))


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[column(docs, c) for c in docs.columns])


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``doc_id, _fp, component_id`` of every row.

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest doc_id reachable, the
    row's own included. Exact copies share a fingerprint and are one node. Null text and text without words have
    fingerprint 0 and link like any other; rows without doc_id are returned, linked, and never name a component (null
    where no row of the component has an id). Other columns are ignored. An empty table gives no row.
    """
    rows, groups = placed(docs, shingle, distance)
    named = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.drop("_rid").join(groups.join(named, "component").select("_fp", "component_id"), "_fp")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each near-duplicate group, all columns: the one with the smallest doc_id (rows without id come last,
    ties go by a hash of the row). Of rows equal in all columns one stays."""
    rows, groups = placed(docs, shingle, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid")).alias("first")
    kept = rows.join(groups.select("_fp", "component"), "_fp").groupBy("component").agg(first).select("first._rid", "first.doc_id")
    keyed = boxed(docs, _rid=row_hash(docs), _id=column(docs, "doc_id"))
    chosen = keyed.join(kept.withColumnRenamed("doc_id", "_first"), "_rid").filter(F.col("_id").eqNullSafe(F.col("_first")))
    return unboxed(chosen.dropDuplicates(["_rid", "_id"]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
