"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of Hamming blocks, exact verification.

Windows are as long as an item, in words. Only those that share a five-word shingle with some item of their length are
fingerprinted; any other has similarity 0. Fingerprints are majority bits of the shingle hashes, summed by Spark
in packed counters. They are cut into ``RADIUS + 1`` blocks, one of which is equal in any two fingerprints within ``RADIUS`` bits,
so a join on (length, block, value) guarantees all of them. Candidates are then verified by the weighted Jaccard
similarity of their shingles (numbers of occurrences are the weights).

All of it is DataFrame functions. The benchmark's tables are broadcast only if their counted rows are within
``BROADCAST_ROWS``; beyond it, Spark shuffles both sides. Texts are shuffled once, to meet the places of their hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import boxed, column, held, materialised, split_words, text_of, unboxed

SHINGLE = 5
RADIUS = 20
SIMILARITY = 0.8
BROADCAST_ROWS = 500_000
FIELD = 21
ROW = ["rid", "rid2"]


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def with_shingles(df: DataFrame, text: Column) -> DataFrame:
    """Add ``words`` (lower case) and ``hashes``, the hash of the shingle at each place; none in a shorter text."""
    df = materialised(df, words=split_words(F.lower(text)))
    n = F.size("words")
    zipped = F.arrays_zip(*[F.slice("words", i + 1, F.greatest(n, F.lit(1))).alias(f"w{i}") for i in range(SHINGLE)])
    whole = F.slice(zipped, 1, F.greatest(n - (SHINGLE - 1), F.lit(0)))
    return materialised(df, hashes=F.transform(whole, lambda x: F.xxhash64(*[x[f"w{i}"] for i in range(SHINGLE)])))


def simhashed(df: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    """``keys`` and ``fp``: the bits set in over half of the array of ``hashes``.

    Counters of 21 bits, three to a long, are summed; the rows of one key are combined before the shuffle.
    """
    each = df.select(*keys, F.explode(hashes).alias("h"))
    three = F.lit(1 | 1 << FIELD | 1 << 2 * FIELD)
    h = F.col("h")
    sums = [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(three)).alias(f"s{k}") for k in range(FIELD)]
    sums.append(F.sum(F.shiftrightunsigned(h, 63)).alias(f"s{FIELD}"))
    counted = each.groupBy(*keys).agg(F.count("*").alias("m"), *sums)

    def bit(b: int) -> Column:
        k, field = (FIELD, 0) if b == 63 else (b % FIELD, b // FIELD)
        n = F.shiftrightunsigned(F.col(f"s{k}"), FIELD * field).bitwiseAND(F.lit((1 << FIELD) - 1))
        one = 1 << b if b < 63 else -(1 << 63)
        return F.when(n * 2 > F.col("m"), F.lit(one).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    return counted.select(*keys, reduce(Column.bitwiseOR, [bit(b) for b in range(64)]).alias("fp"))


def blocks(fp: Column, radius: int) -> Column:
    """(block, value) of the ``radius + 1`` blocks of a fingerprint."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*[
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"),
        )
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ])


def strings(words: Column) -> Column:
    """The shingles of an array of words as strings."""
    n = F.size(words)
    zipped = F.arrays_zip(*[F.slice(words, i + 1, F.greatest(n, F.lit(1))).alias(f"w{i}") for i in range(SHINGLE)])
    whole = F.slice(zipped, 1, F.greatest(n - (SHINGLE - 1), F.lit(0)))
    return F.transform(whole, lambda x: F.concat_ws(" ", *[x[f"w{i}"] for i in range(SHINGLE)]))


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, rid, rid2, item_id, start, length, similarity``: for each document and item the most similar window.

    Words are lower-cased runs without white space; ``start`` counts words from 0, the first of equal windows is named.
    Null texts have no words. Items of fewer than five words have no shingle and match nothing; repeated items (equal
    id) count as one each. A row without doc_id is searched like any other; repeated rows are reported once
    (``rid, rid2`` identify a row's id and text). Other columns are ignored. Empty tables give no row.
    """
    items = benchmark.select(column(benchmark, "item_id").alias("item_id"), text_of(benchmark).alias("_t"))
    items = held(with_shingles(items, F.col("_t")).drop("_t").filter(F.size("hashes") > 0).dropDuplicates(["item_id", "words"])
                 .withColumn("length", F.size("words")).withColumn("uid", F.xxhash64("item_id", "words")))
    wanted = items.select(F.explode("hashes").alias("h"), "length").groupBy("h").agg(F.collect_set("length").alias("lengths"))

    text = text_of(docs)
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), text.alias("_t"))
    rows = rows.select("doc_id", "_t", F.xxhash64("doc_id", "_t").alias("rid"), F.hash("_t", "doc_id").alias("rid2"))
    placed = with_shingles(rows, F.col("_t")).select(*ROW, F.size("words").alias("n"), F.posexplode("hashes").alias("at", "h"))
    hits = placed.join(small(wanted), "h").select(*ROW, "n", "at", F.explode("lengths").alias("length"))
    hits = hits.filter("length <= n").groupBy(*ROW, "n", "length").agg(F.collect_set("at").alias("at"))
    around = F.transform("at", lambda p: F.sequence(
        F.greatest(p - F.col("length") + SHINGLE, F.lit(0)), F.least(p, F.col("n") - F.col("length"))
    ))
    starts = F.array_distinct(F.flatten(around))
    hits = hits.select(*ROW, F.struct("length", starts.alias("starts")).alias("ask")).groupBy(*ROW).agg(
        F.collect_list("ask").alias("asks")
    )
    asked = rows.join(hits, ROW).dropDuplicates(ROW)
    asked = held(with_shingles(asked, F.col("_t")).drop("_t"))

    windows = asked.select(*ROW, "hashes", F.explode("asks").alias("ask")).select(
        *ROW, "hashes", F.col("ask.length").alias("length"), F.explode("ask.starts").alias("start")
    )
    shingles = F.slice("hashes", F.col("start") + 1, F.col("length") - (SHINGLE - 1))
    keys = [*ROW, "length", "start"]
    prints = simhashed(windows.select(*keys, shingles.alias("hashes")), keys, "hashes")
    index = simhashed(items, ["uid", "length"], "hashes").withColumnRenamed("fp", "item_fp")
    index = index.select("uid", "length", "item_fp", F.inline(blocks(F.col("item_fp"), radius)))
    near = prints.select(*keys, "fp", F.inline(blocks(F.col("fp"), radius))).join(small(index), ["length", "block", "value"])
    near = near.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*keys, "uid").distinct()

    sides = items.select("uid", F.explode(strings(F.col("words"))).alias("g")).groupBy("uid", "g").agg(F.count("*").alias("weight"))
    window = near.join(asked.select(*ROW, "words"), ROW).select(
        *keys, "uid", F.slice("words", F.col("start") + 1, F.col("length")).alias("words")
    )
    counted = window.select(*keys, "uid", F.explode(strings(F.col("words"))).alias("g")).groupBy(*keys, "uid", "g").agg(
        F.count("*").alias("n")
    )
    common = counted.join(small(sides), ["uid", "g"]).groupBy(*keys, "uid").agg(F.sum(F.least("n", "weight")).alias("common"))
    total = 2 * (F.col("length") - (SHINGLE - 1))
    alike = common.withColumn("similarity", F.col("common") / (total - F.col("common"))).filter(F.col("similarity") >= similarity)
    best = alike.groupBy(*ROW, "uid").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "length")).alias("b")
    )
    named = best.join(small(items.select("uid", "item_id")), "uid").join(asked.select(*ROW, "doc_id"), ROW)
    return named.select(
        "doc_id", *ROW, "item_id", (-F.col("b.back")).alias("start"), F.col("b.length").alias("length"),
        F.col("b.similarity").alias("similarity"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a window of any item, all columns."""
    found = contaminated(docs, benchmark).select(*ROW).distinct()
    text = text_of(docs)
    keyed = boxed(docs, rid=F.xxhash64(column(docs, "doc_id"), text), rid2=F.hash(text, column(docs, "doc_id")))
    return unboxed(keyed.join(found, ROW, "left_anti"))
