"""Quality classifier: hashed word n-gram logistic regression trained with follow-the-regularised-leader updates.

A text is cut into runs of letters and digits and runs of other marks; unigrams and bigrams of these tokens are hashed
into ``2**BITS`` slots. Two more slots stand for the share of tokens that repeat one of the two before, and for the
share of distinct tokens, in tenths, since the word at hand tells nothing about repetition. A document is the set of its slots, each with the value 1/sqrt(number of slots), and its score
the logistic function of a sparse dot product. Training cuts the bounded sample of labelled rows into shards, runs proximal FTRL
on each shard in its own task, and averages the shards' weights with Spark; the model is bounded by ``2**BITS`` floats.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import labelled, prepared, text_of

BITS = 18
TRAIN_ROWS = 12_000
SHARD_ROWS = 3_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 60.0, 1.0, 0.01, 0.01
MEMO = 1 << 17


class Slots(dict):
    """Token hashes, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[token] = xxhash.xxh64_intdigest(token.encode())
        return h


def features(text: str | None, tokens: re.Pattern, memo: Slots) -> np.ndarray:
    """The distinct slots of a text, the bias slot 0 first; every token of the text counts."""
    found = tokens.findall(text or "")
    h = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    shift = np.uint64(64 - BITS)
    again = (h[1:] == h[:-1]).sum() + (h[2:] == h[:-2]).sum()
    tenths = [10 * int(again) // max(len(h), 1), 100 + 10 * len(np.unique(h)) // max(len(h), 1)]
    whole = np.asarray(tenths, np.uint64) * np.uint64(0x9FB21C651E98DF25)
    mixed = np.concatenate([h, pairs, whole]) * np.uint64(0xD6E8FEB86659FD93) >> shift
    seen = np.zeros(1 << BITS, bool) if len(mixed) > 4096 else None
    if seen is not None:
        seen[mixed] = True
        seen[0] = False
        return np.concatenate([[0], np.nonzero(seen)[0]])
    slots = np.unique(mixed).astype(np.int64)
    return np.concatenate([[0], slots[slots > 0]])


def tokens() -> re.Pattern:
    return re.compile(r"\w+|[^\w\s]+")


def train_shard(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Weights after ``EPOCHS`` passes of proximal FTRL over the rows in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    pattern, memo = tokens(), Slots()
    rows = [features(t, pattern, memo) for t in texts]
    for _ in range(EPOCHS):
        for s, y in zip(rows, labels):
            zi, ni = z[s], n[s]
            w = weights(zi, ni, s)
            x = np.full(len(s), 1 / np.sqrt(len(s)))
            x[0] = 1
            g = (1 / (1 + np.exp(-(w @ x))) - y) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[s] += g - sigma * w
            n[s] += g * g
    return weights(z, n, np.arange(1 << BITS))


def weights(z: np.ndarray, n: np.ndarray, slots: np.ndarray) -> np.ndarray:
    l1 = np.where(slots == 0, 0.0, L1)
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", of: int = 4, held_out: int = 2,
          rows: int = TRAIN_ROWS) -> np.ndarray:
    """The averaged weights. Without labelled rows they are all zero, and every score is one half."""
    sample = labelled(documents, labels, label, of, held_out, rows)
    parts = max(1, sample.count() // SHARD_ROWS)
    sample = sample.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.assign(h=[xxhash.xxh64_intdigest(t.encode(), 1) for t in pdf["text"]]).sort_values(["h", "label"])
        w = train_shard(list(order["text"]), order["label"].to_numpy(float))
        slot = np.nonzero(w)[0]
        return pd.DataFrame({"slot": slot, "weight": w[slot]})

    found = sample.groupBy("shard").applyInPandas(fit, "slot int, weight double")
    total = found.groupBy("slot").agg((F.sum("weight") / parts).alias("weight")).toPandas()
    model = np.zeros(1 << BITS)
    model[total["slot"].to_numpy(np.int64)] = total["weight"]
    return model


def scored(documents: DataFrame, model: np.ndarray, name: str = "_score") -> DataFrame:
    """All columns and the probability of label 1. Null and empty texts get the model's bias alone."""
    spark = prepared(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model.astype(np.float32))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, pattern, memo = shared.value, tokens(), Slots()
        for texts in batches:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                s = features(t, pattern, memo)
                out[i] = float(w[0]) + float(w[s[1:]].sum(dtype=np.float64)) / np.sqrt(len(s))
            yield pd.Series(1 / (1 + np.exp(-out)))

    return documents.withColumn(name, score(text_of(documents)))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
