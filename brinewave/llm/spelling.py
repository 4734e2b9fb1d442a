"""Spelling variants: words at one edit from each other, found by pivotal bigrams.

The bigrams of a word, with their places, are put in one order for all words (rarest first). A word's prefix is its three
rarest bigrams and all that are as rare as the third; its pivots are two bigrams of the prefix that share no letter, chosen by dynamic
programming so that their total frequency is least. One edit breaks at most one of two disjoint bigrams, so of two
words at one edit the one whose prefix ends earlier has a pivot that stands in the other's prefix, at the same place or
moved by the difference of lengths. The index is an equi-join on (bigram, length, place): a pivot asks for the five
combinations one edit allows. Pairs that differ in too many letter kinds are dropped, the rest is verified.

Texts are counted in Arrow batches, combined in the task before words are shuffled. Bigrams of the alphabet are fewer than
``ALPHABET ** 2``, which bounds the table of ranks that tasks get.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import column, held, pieces, prepared, text_of

LEAST_LENGTH = 5
LEAST_COUNT = 3
PREFIX = 3
PIVOTS = 2
ALPHABET = 26 + 64  # lower-case letters, and U+00C0 to U+00FF
FLUSH = 1 << 18


def counted(docs: DataFrame, typo_every: int | None = None, length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts, A-Z lower-cased, of ``length`` code points or more
    that occur ``least`` times or more. ``n`` counts occurrences.

    With ``typo_every``, a run whose crc32 of ``<doc_id>:<run>`` that number divides loses its code point at crc32 modulo
    its length. A null text has no run, a null doc_id is written as nothing. Texts of any length are read in pieces that
    end at white space. Other columns are ignored; an empty table gives no row.
    """
    prepared(docs.sparkSession)
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{length},}}")
    rows = docs.select(
        F.coalesce(column(docs, "doc_id").cast("string"), F.lit("")).alias("doc_id"), text_of(docs).alias("text")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                start = zlib.crc32(f"{doc_id}:".encode())
                for piece in pieces(text.encode().lower()):  # bytes: only A-Z have a lower case
                    found = runs.findall(piece.decode())
                    if typo_every is None:
                        seen.update(found)
                        continue
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < length:
                                continue
                        seen[word] += n
                    if len(seen) > FLUSH:
                        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                        seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    part = rows.mapInPandas(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Of each bigram its place in the order of all and its frequency; bounded by the square of the alphabet."""
    each = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    found = words.select(each.alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: (k, r["count"]) for k, r in enumerate(sorted(found, key=lambda r: (r["count"], r["gram"])))}


def disjoint(grams: list[tuple[int, int]], most: int) -> list[int]:
    """Places of ``most`` bigrams without a common letter and of the least total weight; ``grams``: (place, weight) by place.

    Row t of the table holds the least weight of t disjoint bigrams among the first i, and how it was reached.
    """
    before, k = [], 0
    for p, _ in grams:
        while grams[k][0] <= p - 2:
            k += 1
        before.append(k)
    table = [[(0, None)] * (len(grams) + 1)]
    for _ in range(most):
        row: list[tuple[float, int | None]] = [(float("inf"), None)]
        for i, (_, weight) in enumerate(grams):
            with_it = table[-1][before[i]][0] + weight
            row.append(min(row[-1], (with_it, i), key=lambda c: c[0]))
        table.append(row)
    out, i = [], len(grams)
    for t in range(most, 0, -1):
        k = table[t][i][1]
        out.append(grams[k][0])
        i = before[k]
    return out[::-1]


def outline(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Prefix and pivots as (rank, place), and the rank where the prefix ends."""
    grams = sorted((order[word[p : p + 2]][0], p) for p in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    rank = {p: r for r, p in prefix}
    chosen = disjoint([(p, order[word[p : p + 2]][1]) for p in sorted(rank)], PIVOTS)
    return prefix, [(rank[p], p) for p in chosen], last


def kinds_of(word: str) -> int:
    """One of 64 bits for each letter kind, as a signed long; one edit changes two bits at most."""
    bits = 0
    for c in set(word):
        bits |= 1 << (ord(c) % 64)
    return bits - (1 << 64) if bits >> 63 else bits


def outlined(words: DataFrame) -> DataFrame:
    order = ranks(words)

    def outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [outline(w, order) for w in pdf["word"]]
            yield pd.DataFrame({
                "word": pdf["word"], "n": pdf["n"], "len": pdf["word"].str.len().astype("int32"),
                "kinds": pd.Series([kinds_of(w) for w in pdf["word"]], dtype="int64"),
                "prefix": [[{"g": g, "p": p} for g, p in x[0]] for x in parts],
                "pivots": [[{"g": g, "p": p} for g, p in x[1]] for x in parts],
                "last": pd.Series([x[2] for x in parts], dtype="int32"),
            })

    gram = "array<struct<g: int, p: int>>"
    return words.mapInPandas(outlines, f"word string, n long, len int, kinds long, prefix {gram}, pivots {gram}, last int")


#: What one edit makes of a pivot that it leaves whole: the other word's length and the place there.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, other, other_n``: both directions of each pair of words that differ by one inserted, deleted or replaced
    code point. ``words(word, n)`` has distinct words of at least ``LEAST_LENGTH`` code points."""
    known = held(outlined(words))
    shifts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SHIFTS])
    asking = known.select("word", "n", "len", "kinds", "last", F.explode("pivots").alias("x"))
    asking = asking.select("*", F.explode(shifts).alias("s")).select(
        F.col("x.g").alias("g"), (F.col("len") + F.col("s.a")).alias("l"), (F.col("x.p") + F.col("s.b")).alias("p"),
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("kinds").alias("a_kinds"), F.col("last").alias("a_last"),
    )
    index = known.select("word", "n", "len", "kinds", "last", F.explode("prefix").alias("x")).select(
        F.col("x.g").alias("g"), F.col("len").alias("l"), F.col("x.p").alias("p"),
        F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("kinds").alias("b_kinds"), F.col("last").alias("b_last"),
    )
    alike = (F.col("a_last") <= F.col("b_last")) & (F.bit_count(F.col("a_kinds").bitwiseXOR(F.col("b_kinds"))) <= 2)
    met = asking.join(index, ["g", "l", "p"]).filter(alike & (F.col("a") != F.col("b")))
    near = met.filter(F.levenshtein("a", "b", 1) == 1)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return near.select(F.inline(both)).dropDuplicates(["word", "other"])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word in ``forms(word, form)``, following forms to the last by pointer doubling."""
    up = held(forms.select("word", F.col("form").alias("root")))
    while True:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = held(up.join(higher, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        up = step.drop("moved")
        if step.filter("moved").isEmpty():
            return up


def grouped(words: DataFrame, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word in ``words(word, n)``.

    A word's form is its near word of the largest n (ties: the smallest in code-point order) if that n is ``times`` the
    word's own or more, else null. As n grows along forms, they have no cycle; ``root`` is the last, the word itself
    without a form. An empty table gives no row.
    """
    words = held(words)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= times * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    out = held(out)
    found = roots(out.filter("form IS NOT NULL").select("word", "form"))
    out = out.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
