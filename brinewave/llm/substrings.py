"""Substring deduplication on a compacted De Bruijn graph of token k-mers.

A k-mer has half as many words as a window; its hash is an edge. Of every run of k-mers that fill a window the one
with the least hash is an anchor, so each window holds an anchor, and equal windows hold it at the same place. Anchors
are the graph's sampled edges: an occurrence knows its context, the words of all windows that pick it.

Spark groups the occurrences by anchor: repeated ones occur in more than one document; those with one context only lie
inside a nonbranching path that all their documents share. Joined back to the coordinates of the occurrences,
nonbranching anchors decide their windows at once (by the smallest document of the path), however long the path. Windows at branches and at ends of paths are verified by their source
coordinates: each is hashed to 96 bits and looked for among the windows of all documents that hold its anchors.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import column, hash_texts, held, mix, powers, prepared, split_words, text_of

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Rolling:
    """Hashes of any stretch of a word sequence from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, h: np.ndarray, base: int):
        up, self.down = powers(base, len(h) + 1)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + np.asarray(end - start).astype(np.uint64))

    def all(self, k: int) -> np.ndarray:
        """The hashes of every stretch of ``k`` words."""
        sums = self.sums
        return mix((sums[k:] - sums[:-k]) * self.down[: len(sums) - k] + np.uint64(k))


def picks(rolling: Rolling, length: int) -> np.ndarray:
    """For each window of the sequence, the place of its least k-mer; nothing for a sequence shorter than a window."""
    if len(rolling.sums) <= length:
        return np.zeros(0, np.int64)
    k = length // 2
    value = rolling.all(k)
    place = np.arange(len(value))
    span, have = length - k + 1, 1
    while have < span:  # least of ``have`` neighbours, doubled; the left one of equals
        step = min(have, span - have)
        right = value[step:] < value[:-step]
        value, place = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])
        have += step
    return place


def runs(pick: np.ndarray, start: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last index of each run of windows (at ``start``) that pick one place; ``first`` begins a new document."""
    new = np.ones(len(pick), bool)
    new[1:] = (pick[1:] != pick[:-1]) | first[1:] | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    return at, np.concatenate([at[1:], [len(pick)]]) - 1


def contexts(rolling: Rolling, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the words of all windows that pick an anchor, and of where the anchor stands in them."""
    return mix(rolling.of(low, high) + (at - low).astype(np.uint64) * np.uint64(BASES[1]))


def occurrences(texts: DataFrame, length: int) -> DataFrame:
    """``edge, context, doc_id, key, pos`` of every anchor of every text."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = length // 2
        for pdf in batches:
            h, counts = hash_texts([t.encode() for t in pdf["text"]])
            begin = np.cumsum(counts) - counts
            rolling = Rolling(h, BASES[0])
            pick = picks(rolling, length)
            doc = np.repeat(np.arange(len(counts)), counts)[: len(pick)]
            start = np.arange(len(pick))
            whole = start + length <= (begin + counts)[doc]  # windows do not run into the next document
            pick, doc, start = pick[whole], doc[whole], start[whole]
            if not len(pick):
                continue
            lo, hi = runs(pick, start, np.concatenate([[True], doc[1:] != doc[:-1]]))
            at, mine = pick[lo], doc[lo]
            yield pd.DataFrame({
                "edge": rolling.of(at, at + k).view(np.int64),
                "context": contexts(rolling, start[lo], start[hi] + length, at).view(np.int64),
                "doc_id": pdf["doc_id"].to_numpy(np.int64)[mine], "key": pdf["key"].to_numpy()[mine], "pos": at - begin[mine],
            })

    return texts.mapInPandas(emit, "edge long, context long, doc_id long, key int, pos int")


class Marked:
    """The windows of one marked document: decided by a path, or to be verified."""

    def __init__(self, text: bytes, marks: list, length: int):
        self.h, _ = hash_texts([text])
        self.length = length
        self.rolling = Rolling(self.h, BASES[0])
        pick = picks(self.rolling, length)
        start = np.arange(len(pick))
        lo, hi = runs(pick, start, np.zeros(len(pick), bool))
        place = pick[lo]
        repeated, branching, least = np.zeros(len(lo), bool), np.ones(len(lo), bool), np.zeros(len(lo), np.int64)
        for pos, branches, doc in marks:
            i = np.searchsorted(place, pos)
            repeated[i], branching[i], least[i] = True, branches, doc
        # a window belongs to the anchor it picks: wherever the window stands, it picks the same one
        mine = np.repeat(np.arange(len(lo)), hi - lo + 1)
        inside = (repeated & ~branching)[mine]
        self.first = least[mine]
        self.least = np.where(inside, self.first, np.iinfo(np.int64).max)
        self.asked = repeated[mine] & ~inside

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, two hashes, and the least document of the anchor of each window to be verified."""
        s = np.flatnonzero(self.asked)
        second = Rolling(self.h ^ np.uint64(BASES[1]), BASES[1])
        two = (second.of(s, s + self.length) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return s, self.rolling.of(s, s + self.length).view(np.int64), two, self.first[s]

    def kept(self, doc_id: int, found: list[int] | None) -> np.ndarray:
        """Which words stay: those no window with a smaller document covers."""
        gone = self.least < doc_id
        if found is not None and len(found):
            gone[np.asarray(found, np.int64)] = True
        edge = np.zeros(len(self.h) + 1, np.int64)
        starts = np.nonzero(gone)[0]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.length, -1)
        return np.cumsum(edge)[:-1] == 0


def packed(texts: DataFrame) -> DataFrame:
    """``texts`` with compressed texts: they are shuffled and kept once."""

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(text=[zlib.compress(t.encode(), 1) for t in pdf["text"]])

    return texts.mapInPandas(squeeze, "doc_id long, key int, text binary")


def marked(texts: DataFrame, length: int) -> DataFrame:
    """``doc_id, key, text, marks`` of the documents with repeated anchors; a mark is (pos, branching, least doc_id)."""
    nodes = occurrences(texts, length).groupBy("edge").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
        (F.min("context") != F.max("context")).alias("branching"),
    )
    repeated = nodes.filter("least <> most").select("edge", "least", "branching")
    marks = occurrences(texts, length).select("edge", "doc_id", "key", "pos").join(repeated, "edge")
    marks = marks.groupBy("doc_id", "key").agg(F.collect_set(F.struct("pos", "branching", "least")).alias("marks"))
    return held(packed(texts).join(marks, ["doc_id", "key"]))


def removals(texts: DataFrame, length: int) -> DataFrame:
    """``doc_id, key, spans, kept`` of the documents that lose words: word ranges removed, and the words that stay."""
    mine = marked(texts, length)

    def each(pdf: pd.DataFrame) -> Iterator[tuple[int, int, bytes, Marked]]:
        for doc_id, key, packed_text, marks in zip(pdf["doc_id"], pdf["key"], pdf["text"], pdf["marks"]):
            text = zlib.decompress(packed_text)
            yield doc_id, key, text, Marked(text, _tuples(marks), length)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts, ids, keys, counts = [], [], [], []
            for doc_id, key, _, m in each(pdf):
                parts.append(m.windows())
                ids.append(doc_id)
                keys.append(key)
                counts.append(len(parts[-1][0]))
            if parts:
                s, one, two, first = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({
                    "one": one, "two": two, "doc_id": np.repeat(np.asarray(ids, np.int64), counts),
                    "key": np.repeat(keys, counts), "pos": s, "first": first,
                })

    asked = mine.mapInPandas(ask, "one long, two int, doc_id long, key int, pos int, first long")
    least = asked.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = least.filter("least <> most").select("one", "two", "least")
    # the first document with an anchor vouches for its windows and loses none of them
    later = asked.filter("first < doc_id").drop("first")
    found = later.join(least, ["one", "two"]).filter("least < doc_id")
    found = found.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("found"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for (doc_id, key, text, m), at in zip(each(pdf), pdf["found"]):
                keep = m.kept(doc_id, at)
                if not keep.all():
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
                    stay = b" ".join(w for w, k in zip(text.split(), keep) if k)
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                    out.append((doc_id, key, spans, stay.decode()))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "key", "spans", "kept"])

    joined = mine.join(found, ["doc_id", "key"], "left")
    return joined.mapInPandas(cut, "doc_id long, key int, spans array<struct<start:int,end:int>>, kept string")


def _tuples(marks) -> list[tuple[int, bool, int]]:
    return [(m["pos"], m["branching"], m["least"]) for m in marks]


def keyed(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select(column(docs, "doc_id").cast("bigint").alias("doc_id"), F.hash(text).alias("key"), text.alias("text"))


def deduplicated(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept, spans`` of every row.

    Removed is each word covered by a window of ``length`` words that also starts in a document with a smaller doc_id,
    judged on the input. ``kept_sha256`` is of the words that stay, joined by one space. ``kept`` is null where nothing is removed
    (the text stays as it is) and else these words; ``spans`` are the removed word ranges. Null text has no words. A row without doc_id loses
    nothing and takes nothing from others; rows of one doc_id do not take from each other, and repeated rows get the
    same result. An empty table gives no row. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    rows = keyed(docs)
    gone = removals(rows.filter("doc_id IS NOT NULL"), length)
    gone = gone.withColumn("rest", F.sha2(F.col("kept").cast("binary"), 256))
    gone = gone.groupBy("doc_id", "key").agg(*[F.first(c).alias(c) for c in ("spans", "rest", "kept")])  # repeated rows
    base = rows.select("doc_id", "key", split_words(F.col("text")).alias("words")).select(
        "doc_id", "key", F.size("words").cast("bigint").alias("n_words"),
        F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("whole"),
    )
    out = base.join(gone, ["doc_id", "key"], "left")
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    digest = F.coalesce("rest", "whole")
    return out.select(
        "doc_id", "n_words", F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
        digest.alias("kept_sha256"), "kept", "spans",
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
