"""Vector codes: product quantisation whose nearest entries are found by a GNAT over each part's entries.

A vector is cut into parts of whole numbers; the code of a part is the index of the nearest entry of that part's codebook
(squared Euclidean distance, ties to the lower index). Codebooks are refined by rounds of assignment and componentwise
floored means.

Search: a geometric near-neighbour access tree. A node has a few split points (entries far from each other); the other
entries are dealt to the nearest split point, and for each pair of a split point and a subtree the node keeps the least
and the largest distance from the one to the members of the other. A query's distance to a split point, the radius of its
best entry so far and such a range rule out a whole subtree by the triangle inequality. Roots are rounded outwards and a
subtree goes only where it is strictly farther than the best, so no entry at an equal distance is lost; what is left is
compared in exact integers, then by index.

Spark reads the table once a round. A task assigns its batches and returns sums and counts of each entry, whose number is
bounded by the codebooks (parts x entries x components); only these reach the driver.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col
from brinewave.llm.base import column, held, prepared
from brinewave.operators.joins import null_safe_join

ARITY = 4
OUTWARDS = 1 + 2.0**-48  # far above the rounding of a root, a sum and the conversion of an integer
MOST = 2**28


@dataclass
class Node:
    splits: np.ndarray  # indexes of the split points
    low: np.ndarray  # [split, subtree]: lower bound of the distances to the subtree's members
    high: np.ndarray
    below: list[Node | None]


def squared(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = points - to
    return np.einsum("ij,ij->i", apart, apart)


def build(entries: np.ndarray, index: np.ndarray | None = None) -> Node | None:
    """The tree over the rows of ``entries`` (whole numbers) named by ``index``; None without rows."""
    index = np.arange(len(entries)) if index is None else index
    if not len(index):
        return None
    chosen = [0]
    nearest = squared(entries[index], entries[index[0]])
    while len(chosen) < min(ARITY, len(index)):
        nearest[chosen] = -1
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries[index], entries[index[chosen[-1]]]))
    splits = index[chosen]
    rest = np.delete(index, chosen)
    to = np.stack([squared(entries[rest], entries[s]) for s in splits])
    dealt = to.argmin(0)
    low, high, below = np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2), []
    for j, s in enumerate(splits):
        mine = rest[dealt == j]
        for i, t in enumerate(splits):
            d = np.sqrt(squared(entries[np.append(mine, s)], entries[t]).astype(float))
            low[i, j], high[i, j] = d.min() / OUTWARDS, d.max() * OUTWARDS
        below.append(build(entries, mine))
    return Node(splits, low, high, below)


def nearest_entries(tree: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each query the nearest entry and its squared distance, and the number of distances computed for all."""
    best = np.full(len(queries), len(entries))
    reach = np.full(len(queries), np.iinfo(np.int64).max)
    computed = 0

    def visit(node: Node, rows: np.ndarray) -> None:
        nonlocal computed
        alive = np.ones((len(rows), len(node.splits)), bool)
        seen = np.full(alive.shape, np.nan)

        def strike(i: int, at: np.ndarray) -> None:
            d, r = seen[at, i, None], np.sqrt(reach[rows[at]].astype(float))[:, None] * OUTWARDS
            far = (node.low[i] > (d * OUTWARDS + r) * OUTWARDS) | (d / OUTWARDS > (node.high[i] + r) * OUTWARDS)
            alive[at] &= ~far

        for i, s in enumerate(node.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            mine = rows[at]
            d2 = squared(queries[mine], entries[s])
            computed += len(at)
            closer = (d2 < reach[mine]) | ((d2 == reach[mine]) & (s < best[mine]))
            best[mine[closer]], reach[mine[closer]] = s, d2[closer]
            seen[at, i] = np.sqrt(d2.astype(float))
            strike(i, at)
        for i in range(len(node.splits)):  # once more, with the radius that all split points have left
            strike(i, np.flatnonzero(~np.isnan(seen[:, i])))
        for j, child in enumerate(node.below):
            if child is not None and len(left := rows[alive[:, j]]):
                visit(child, left)

    if len(queries):
        visit(tree, np.arange(len(queries)))
    return best, reach, computed


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    return [(length * p // parts, length * (p + 1) // parts) for p in range(parts)]


def whole_numbers(vector: Column, scale: int, length: int) -> Column:
    """``floor(scale * x)`` of each component, held within what keeps every squared distance a long."""
    most = float(min(MOST, isqrt(2**62 // max(length, 1)) // 2))
    limited = lambda x: F.greatest(F.least(x * scale, F.lit(most)), F.lit(-most))
    return F.transform(vector, lambda x: F.floor(limited(x)).cast("int"))


def kept_vectors(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, v`` of the rows whose vector is complete and finite."""
    v = column(vectors, vector).cast("array<double>")
    out = vectors.select(column(vectors, id).alias("vec_id"), column(vectors, label).alias("label"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return out.filter(F.col("v").isNotNull() & ~odd)


def matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, length)


def first_books(kept: DataFrame, parts: int, entries: int, scale: int) -> tuple[DataFrame, int, list[np.ndarray]]:
    """The vectors as whole numbers, their length, and the codebooks before the first round."""
    order = [as_col("vec_id").asc_nulls_last(), "v"]
    first = kept.orderBy(*order).limit(1).select(F.size("v").alias("n")).first()
    length = first["n"] if first else 0
    numbers = kept.filter(F.size("v") == length).withColumn("v", whole_numbers(F.col("v"), scale, length))
    rows = [r["v"] for r in numbers.orderBy(*order).limit(entries).select("v").collect()]
    books = np.array(rows, np.int64).reshape(len(rows), length)
    return numbers, length, [books[:, lo:hi] for lo, hi in cuts(length, parts)]


def refined(numbers: DataFrame, length: int, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part to its nearest entry, every used entry to the floored mean of its parts."""
    trees, bounds = [build(b) for b in books], cuts(length, len(books))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            m = matrix(batch, length)
            for (lo, hi), tree, book, s in zip(bounds, trees, books, sums):
                codes = nearest_entries(tree, book, m[:, lo:hi])[0]
                order = np.argsort(codes, kind="stable")
                used, at = np.unique(codes[order], return_index=True)
                if len(used):
                    s[used, :-1] += np.add.reduceat(m[order, lo:hi], at, axis=0)
                    s[used, -1] += np.diff([*at, len(codes)])
        for p, s in enumerate(sums):
            e, k = np.nonzero(np.ones(s.shape, bool))
            yield pa.RecordBatch.from_pydict(
                {"part": np.full(len(e), p), "entry": e, "at": k, "total": s.ravel()},
                pa.schema([(c, pa.int64()) for c in ("part", "entry", "at", "total")]),
            )

    sums = numbers.select("v").mapInArrow(gather, "part long, entry long, at long, total long")
    out = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
    for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect():
        out[r["part"]][r["entry"], r["at"]] = r["total"]
    return [np.where(s[:, -1:] > 0, s[:, :-1] // np.maximum(s[:, -1:], 1), b) for s, b in zip(out, books)]


def coded(numbers: DataFrame, length: int, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of every vector under the given codebooks."""
    trees, bounds = [build(b) for b in books], cuts(length, len(books))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch, length)
            found = [nearest_entries(t, b, m[:, lo:hi])[:2] for (lo, hi), t, b in zip(bounds, trees, books)]
            codes = np.stack([c for c, _ in found], axis=1)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            error = np.sum([d for _, d in found], axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = dict(numbers.dtypes)
    return numbers.mapInArrow(assign, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compressed(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
    id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error, label_error`` of every kept vector, and the final codebooks.

    Components become ``floor(scale * x)``; a codebook starts as the parts of the ``entries`` smallest ids (rows without id
    come last, equal ids by vector). Rows whose vector is null or holds a null or non-finite component are dropped, also
    rows of another length than the row of the smallest id. Components beyond 2**28 (less for parts of over 16 components) count
    as that bound. A length that ``parts`` does not divide gives parts that differ by one; vectors without components
    have codes 0. Fewer rows than ``entries`` make smaller codebooks; an empty table has no row and empty codebooks.
    ``label_error`` sums over equal labels, nulls together. Repeated rows are coded each; other columns are ignored.
    """
    prepared(vectors.sparkSession)
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits")
    numbers, length, books = first_books(kept_vectors(vectors, id, vector, label), parts, entries, scale)
    if len(books[0]):
        for _ in range(rounds):
            books = refined(numbers, length, books)
    rows = held(coded(numbers, length, books))
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return null_safe_join(rows, sums, ["label"]), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
