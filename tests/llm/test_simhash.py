from __future__ import annotations

import numpy as np
import pytest

from brinewave.llm import components, simhash


def closure(prints: list[int], distance: int) -> dict[int, int]:
    a = np.array(sorted(prints)).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= distance
    label = np.array(sorted(prints))
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        if (new == label).all():
            return dict(zip(sorted(prints), label.tolist()))
        label = new


@pytest.mark.parametrize("block", [1024, 16])
def test_links_connect_what_is_within_the_distance(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 40, dtype=np.int64)
    prints = set(base.tolist())
    for b in base[:20]:
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            prints.add(int((np.uint64(b.view(np.uint64)) ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))).view(np.int64)))
    df = spark.createDataFrame([(p,) for p in prints], "_fp long")
    got = {r["node"]: r["component"] for r in components.components(simhash.links(df, 3)).collect()}
    want = closure(list(prints), 3)
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == dict.fromkeys(range(61), 0)


def test_fingerprint_is_the_majority_of_xxhash64(spark):
    h = spark.sql("SELECT xxhash64('a b c') h").first()["h"]
    assert simhash.fingerprint("A b  c", 3) == h
    assert simhash.fingerprint("a b", 3) == spark.sql("SELECT xxhash64('a b') h").first()["h"]
    assert simhash.fingerprint(None, 3) == 0 == simhash.fingerprint(" \n", 3)


def test_groups_and_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    empty = {r["component_id"] for r in rows if r["_fp"] == 0}
    assert empty == {1}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "6", "None"]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
