from __future__ import annotations

import random

from pyspark.sql import functions as F

from brinewave.llm import mixing


def water_fill(sizes: dict, weights=(1, 2, 3), most=3.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, open_ = sum(sizes.values()), {}, set(order)
    while True:
        level = (total - sum(out.values())) / sum(w[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        open_ -= over


def test_targets_and_words(spark, documents):
    rng = random.Random(3)
    parts, sizes = None, {}
    for source, n in (("b", 300), ("a", 40), (None, 5), ("é", 700), ("z", 1)):
        texts = ["w " * rng.randint(0, 60) for _ in range(n)]
        df = documents(*texts, source=source)
        parts = df if parts is None else parts.unionByName(df)
        sizes[source] = sum(len(t.split()) for t in texts)
    rows = mixing.mixed(parts, payload=("doc_id", "source")).collect()
    want = water_fill(sizes)
    for s in sizes:
        mine = [r for r in rows if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == sizes[s] for r in mine)
        assert all(r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3 for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 30.5
        assert all(r["copies"] in (int(want[s] / sizes[s]), int(want[s] / sizes[s]) + 1) for r in mine if r["size"])
    again = mixing.mixed(parts.repartition(7), payload=("doc_id", "source")).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_each_document_has_the_same_chance(spark, documents):
    docs = documents(*(f"t{i} " + "w " * (5 + i % 7) for i in range(3000)))
    extra = documents(*("w " * 10 for _ in range(3000)), source="t")
    rows = mixing.mixed(docs.unionByName(extra), payload=("doc_id", "source")).filter("source = 's'").collect()
    short = [r["copies"] for r in rows if r["size"] <= 8]
    long = [r["copies"] for r in rows if r["size"] > 8]
    assert abs(sum(short) / len(short) - sum(long) / len(long)) < 0.06


def test_odd_rows(spark, odd):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    out = mixing.taken(odd)
    assert set(odd.columns) <= set(out.columns) and out.filter("copies < 1").count() == 0
    assert mixing.mixed(odd.limit(0)).count() == 0
    assert mixing.mixed(odd.filter(F.col("doc_id") < 3)).filter("target > 0").count() == 0


def test_large_documents_leave_no_gap(spark, documents):
    """One huge document a source, or many large ones: the small ones make up for what they bring or lack."""
    rng = random.Random(21)
    parts, sizes = None, {}
    for k, (huge, large, small) in enumerate([(6000, 0, 900), (3000, 5, 400), (0, 40, 300), (20000, 0, 4000), (0, 0, 500)]):
        for repeat in range(3):
            source = f"s{k}-{repeat}"
            lengths = [huge + repeat] * (huge > 0) + [rng.randint(300, 2500) for _ in range(large)] + [rng.randint(0, 60) for _ in range(small)]
            df = documents(*(f"{source} " * n for n in lengths), source=source)
            parts = df if parts is None else parts.unionByName(df)
            sizes[source] = sum(lengths)
    want = water_fill(sizes)
    got = {r["source"]: r["taken"] for r in mixing.mixed(parts, payload=("source",)).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    for s in sizes:
        assert abs(got[s] - want[s]) <= 16, (s, got[s], want[s])


def test_targets_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixed(docs, payload=("source",)).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    for r in rows.collect():
        assert abs(r["taken"] - r["target"]) <= max(16, 0.01 * r["target"]), r
