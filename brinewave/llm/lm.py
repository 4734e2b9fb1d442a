"""Language-model scores by stupid backoff over bigrams of the corpus itself, leaving each document out.

A word scores log(c(vw) / c(v)) if the bigram vw occurs in another document, else log(0.4 * c(w) / N); counts are those of
the whole corpus less the document's own. A word that no other document holds counts as half an occurrence. The scores of a
document's words are summed. Words and bigrams are told apart by 64-bit hashes; no count is cut or merged.

Spark counts the words of all documents. Words with over 1/``COMMON`` of all occurrences, so fewer than ``COMMON`` at any
size, are shared with all tasks; bigrams of two words with over 1/``HOT``, at most ``HOT**2``, are counted before and shared
too. All other n-grams are exploded by document and partitioned by hash: a bigram of two common words under its own
hash, one that holds other words under each of these, beside the occurrences of that word. So c(w) and c(vw) are windows over
the exploded n-grams of one partition, and what they add to a document is summed relationally. To spare disk, n-grams travel
as arrays, one row for each batch of documents and bucket of hashes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from brinewave.llm.base import column, hash_texts, held, mix, prepared, text_of

COMMON = 4_000_000
HOT = 1000
BACKOFF = 0.4
UNSEEN = 0.5
BUCKET_WORDS = 8_000_000
BATCH = 256
PAIR = np.uint64(0x9E3779B97F4A7C15)
GRAMS = (
    "bucket int, batch long, k array<long>, o array<long>, doc array<tinyint>, times array<int>, own array<int>, "
    "gain array<float>, whole array<struct<doc:tinyint,doc_id:long,n:long,base:double>>"
)


def words_of(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts one after another, and the number of words of each; A-Z count as a-z."""
    return hash_texts([t.encode().lower() for t in texts])


def pair_of(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * PAIR + w)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n``: how often each word (by hash) occurs in all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            word, n = np.unique(words_of(pdf["text"])[0], return_counts=True)
            yield pd.DataFrame({"word": word.view(np.int64), "n": n})

    return texts.select("text").mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(texts: DataFrame, common: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (ascending) and counts of repeated words with over 1/``common`` of all occurrences, and the number of these."""
    seen = Observation()
    counts = word_counts(texts).observe(seen, F.sum("n").alias("total"))
    counts = held(counts.filter("n > 1"))  # what stands once is left to the windows
    total = seen.get.get("total") or 0

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"word": [pdf["word"].to_numpy().tobytes()], "n": [pdf["n"].to_numpy().tobytes()]})

    rows = counts.filter(F.col("n") * common > total).mapInPandas(pack, "word binary, n binary").collect()
    word = np.frombuffer(b"".join(r["word"] for r in rows), np.uint64)
    n = np.frombuffer(b"".join(r["n"] for r in rows), np.int64)
    order = np.argsort(word)
    return word[order], n[order], total


def found_in(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and which of them are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def followed(counts: np.ndarray) -> np.ndarray:
    """The places of words that another word of the same text follows."""
    last = np.zeros(int(counts.sum()), bool)
    last[np.cumsum(counts)[counts > 0] - 1] = True
    return np.flatnonzero(~last)


def hot_pairs(texts: DataFrame, hot: np.ndarray) -> np.ndarray:
    """Counts of the bigrams of two hot words, by their places in ``hot``."""
    size = len(hot)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size * size, np.int64)
        for pdf in batches:
            s, counts = words_of(pdf["text"])
            rank, there = found_in(hot, s)
            at = followed(counts)
            at = at[there[at] & there[at + 1]]
            pair, c = np.unique(rank[at] * size + rank[at + 1], return_counts=True)
            n[pair] += c
        pair = np.flatnonzero(n)
        yield pd.DataFrame({"pair": pair, "n": n[pair]})

    out = np.zeros(size * size, np.int64)
    if size:
        table = texts.select("text").mapInPandas(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        for row in table.collect():
            out[row["pair"]] = row["n"]
    return out


class Exploder:
    """The n-grams of a batch of texts that are counted elsewhere, and the scores without what these add."""

    def __init__(self, shared: dict):
        self.words, self.n, self.total = shared["words"], shared["n"], shared["total"]
        self.hot, self.pairs = shared["hot"], shared["pairs"]

    def grams(self, texts: pd.Series) -> tuple[np.ndarray, np.ndarray, tuple, tuple]:
        """Words and score of each text; (k, doc, times, gain) of common bigrams; (k, o, doc, times, own, gain) under rare words.

        ``gain`` is what the text gains, besides the log of its count and of the rare word's, if the bigram is found
        elsewhere; it is NaN where the first word's row adds it. ``o`` is 0 for the word itself.
        """
        s, counts = words_of(texts)
        doc = np.repeat(np.arange(len(counts)), counts)
        word, place = np.unique(s, return_inverse=True)
        of, common = found_in(self.words, word)
        n = np.where(common, self.n[of], 0) if len(self.n) else np.zeros(len(word), np.int64)
        rank, hot = found_in(self.hot, word)
        size = max(len(word), 1)
        here, where, own = np.unique(doc * size + place, return_inverse=True, return_counts=True)
        mine = own[where]
        known = common[place]
        log = np.where(known, np.log(np.maximum(n[place] - mine, UNSEEN)), 0)
        rest = np.log(np.maximum(self.total - counts, 1))
        score = np.bincount(doc, log, minlength=len(counts)) - counts * rest + np.maximum(counts - 1, 0) * np.log(BACKOFF)

        at = followed(counts)
        key = (doc[at] * size + place[at]) * size + place[at + 1]
        _, first, times = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        gain = rest[doc[at]] - np.log(BACKOFF) - log[at] - log[at + 1]
        both = hot[place[at]] & hot[place[at + 1]]
        if both.any():
            b = at[both]
            others = self.pairs[rank[place[b]] * len(self.hot) + rank[place[b + 1]]] - times[both]
            more = np.where(others > 0, np.log(np.maximum(others, 1)) + gain[both], 0)
            score += np.bincount(doc[b], times[both] * more, minlength=len(counts))
        pair = pair_of(s[at], s[at + 1])
        left, right = known[at], known[at + 1]
        c = left & right & ~both
        plain = (pair[c], doc[at][c], times[c], gain[c])

        here, own = here[~common[here % size]], own[~common[here % size]]
        v, w = ~left, ~right
        rare = tuple(np.concatenate(x) for x in (
            (word[here % size], s[at][v], s[at + 1][w]),
            (np.zeros(len(here), np.uint64), pair[v] | np.uint64(1), ~pair[w] | np.uint64(1)),
            (here // size, doc[at][v], doc[at][w]),
            (own, times[v], times[w]),
            (own, mine[at][v], mine[at + 1][w]),
            (np.zeros(len(here)), gain[v], np.where(left[w], gain[w], np.nan)),
        ))
        return counts, score, plain, rare


def by_bucket(batch: int, buckets: int, plain: tuple, rare: tuple) -> Iterator[dict]:
    """One row for each bucket of hashes; n-grams under rare words come first, and only they have ``o`` and ``own``."""

    def dealt(k: np.ndarray, *columns: np.ndarray) -> tuple:
        bucket = ((k >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        return np.searchsorted(bucket[order], np.arange(buckets + 1)), *[c[order] for c in columns]

    o, own = rare[1].view(np.int64), rare[4].astype(np.int32)
    known, o, own = dealt(rare[0], o, own)
    k, doc, times, gain = (np.concatenate([rare[i], plain[j]]) for i, j in ((0, 0), (2, 1), (3, 2), (5, 3)))
    edges, doc, times, gain, k = dealt(k, (doc - 128).astype(np.int8), times.astype(np.int32), gain.astype(np.float32), k.view(np.int64))
    for b in np.flatnonzero(np.diff(edges)):
        at, some = slice(edges[b], edges[b + 1]), slice(known[b], known[b + 1])
        yield {
            "bucket": b, "batch": batch, "k": k[at], "o": o[some], "doc": doc[at], "times": times[at], "own": own[some],
            "gain": gain[at], "whole": [],
        }


def scored(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` of every row; words are lower-cased (A-Z) runs without white space.

    Null text and text without words: score 0, no mean. Rows without doc_id are scored and counted like any other. Copies
    vouch for each other, repeated rows too. Other columns are ignored. An empty table gives no row. ``common`` bounds the
    words that are shared with all tasks; results do not depend on it.
    """
    spark = prepared(docs.sparkSession)
    id_, text = column(docs, "doc_id").cast("bigint"), text_of(docs)
    texts = docs.select(id_.alias("doc_id"), F.xxhash64(id_, text).alias("key"), text.alias("text"))
    words, n, total = common_words(texts, common)
    hot = words[n * HOT > total]
    shared = spark.sparkContext.broadcast({"words": words, "n": n, "total": total, "hot": hot, "pairs": hot_pairs(texts, hot)})
    # enough buckets from the start that a document meets most of its own at any size: the sums grow with the input
    buckets = max(64, total // BUCKET_WORDS)

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exploder = Exploder(shared.value)
        for pdf in batches:
            for begin in range(0, len(pdf), BATCH):
                part = pdf.iloc[begin : begin + BATCH]
                counts, score, plain, rare = exploder.grams(part["text"])
                keys = part["key"].to_numpy(np.int64).view(np.uint64)
                # equal batches share their number, so a task that runs again repeats it
                batch = int(mix(keys + np.arange(len(keys), dtype=np.uint64) * PAIR).sum().view(np.int64))
                ids = [None if pd.isna(i) else int(i) for i in part["doc_id"]]
                whole = [
                    {"doc": d - 128, "doc_id": i, "n": int(m), "base": float(b)} for d, (i, m, b) in enumerate(zip(ids, counts, score))
                ]
                none = dict.fromkeys(["k", "o", "doc", "times", "own", "gain"], [])
                rows = [
                    {"bucket": batch % buckets, "batch": batch, **none, "whole": whole},
                    *by_bucket(batch, buckets, plain, rare),
                ]
                yield pd.DataFrame(rows)

    grams = texts.mapInPandas(explode, GRAMS).repartitionById(buckets, F.col("bucket"))
    grams = grams.select("bucket", "batch", F.inline(F.arrays_zip("k", "o", "doc", "times", "own", "gain", "whole")))
    word, gram = Window.partitionBy("k", "bucket"), Window.partitionBy("k", "bucket", "o")  # sorted by hash first
    counted = grams.withColumn("c_gram", F.sum("times").over(gram)).filter("o = 0 OR c_gram > times OR whole IS NOT NULL")
    counted = counted.withColumn("c_word", F.sum(F.when(F.col("o") == 0, F.col("times"))).over(word))
    rare = F.when(F.col("o").isNotNull(), F.log(F.greatest(F.col("c_word") - F.col("own"), F.lit(UNSEEN))))
    found = F.when(F.isnan("gain"), F.lit(0.0)).otherwise(F.log(F.col("c_gram") - F.col("times")) + F.col("gain"))
    add = F.when(F.col("o") == 0, F.col("times") * rare).when(
        F.col("c_gram") > F.col("times"), F.col("times") * (found - F.coalesce(rare, F.lit(0.0)))
    )
    sums = counted.select(
        "bucket", "batch", F.coalesce("doc", "whole.doc").alias("doc"), add.alias("add"), "whole.doc_id", "whole.n", "whole.base"
    )
    sums = sums.groupBy("bucket", "batch", "doc").agg(
        F.sum("add").alias("add"), F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.sum("base").alias("base"),
        F.count("base").alias("rows"),
    )
    whole = F.when(F.col("rows") > 0, F.struct("doc", "doc_id", "n", "base", "rows"))
    # a document's sums travel as arrays too
    sums = sums.withColumn("add", F.coalesce("add", F.lit(0.0)).cast("float")).groupBy("bucket", "batch").agg(
        F.collect_list("doc").alias("doc"), F.collect_list("add").alias("add"), F.collect_list(whole).alias("whole")
    )
    none = F.lit(None)
    items = F.concat(
        F.transform(F.arrays_zip("doc", "add"), lambda x: F.struct(
            x["doc"].alias("doc"), x["add"].alias("add"), none.cast("long").alias("doc_id"), none.cast("long").alias("n"),
            none.cast("double").alias("base"), none.cast("long").alias("rows"),
        )),
        F.transform("whole", lambda x: F.struct(
            x["doc"].alias("doc"), none.cast("float").alias("add"), x["doc_id"].alias("doc_id"), x["n"].alias("n"),
            x["base"].alias("base"), x["rows"].alias("rows"),
        )),
    )
    each = sums.drop("bucket").repartition("batch").select("batch", F.inline(items)).groupBy("batch", "doc").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.sum("rows").alias("rows"),
        (F.sum(F.col("add").cast("double")) + F.sum("base")).alias("score"),
    )
    # equal batches have added up: each gets its share
    out = each.select(
        "doc_id", (F.col("n") / F.col("rows")).cast("bigint").alias("n_words"), (F.col("score") / F.col("rows")).alias("log_score"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))),
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return out.select("doc_id", "n_words", "log_score", mean.alias("mean_log_score"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
