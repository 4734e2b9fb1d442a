"""MinHash groups, vector codes and spelling groups against brute force, and on odd tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from brinewave.llm import components, gnat, minhash, spelling

# --- MinHash near-duplicates


def word_set(text: str | None, shingle: int = 2) -> frozenset:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    n = max(len(words) - shingle + 1, min(len(words), 1))
    return frozenset(tuple(words[i : i + shingle]) for i in range(n))


def classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest doc_id reachable over all pairs, by brute force."""
    sets = {i: word_set(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                common = len(sets[i] & sets[j])
                if common and 100 * common >= 80 * len(sets[i] | sets[j]) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def copies(n: int, seed: int, length: int = 60, edits: int = 6) -> list[str]:
    """Texts of a few families whose similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        family = random.Random(k % 7)
        words = [f"w{family.randrange(4000)}" for _ in range(length)]
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block, members", [(512, 1 << 17), (8, 500)])
def test_minhash_groups_equal_brute_force(documents, monkeypatch, block, members):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members)
    texts = copies(150, 1) + ["A b  c", "a B c", "one", "ONE\n", "one two", "", None, " \t", "É x", "é x"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(documents(*texts)).collect()}
    want = classes(list(enumerate(texts)))
    assert got == {i: (len(word_set(t)), want[i]) for i, t in enumerate(texts)}


def test_blocks_find_what_hubs_leave(documents, monkeypatch):
    monkeypatch.setattr(minhash, "following", lambda rows, hubs: rows.withColumn("comp", rows["node"]))
    texts = copies(60, 3)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(*texts)).collect()}
    assert got == classes(list(enumerate(texts)))


def test_copies_of_one_base_that_are_far_from_each_other(documents):
    rng = random.Random(14)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for _ in range(120):
        words = list(base)
        for at in rng.sample(range(1, 99, 2), 5):
            words[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    texts.append(" ".join(base))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(*texts)).collect()}
    assert set(got.values()) == {0} and got == classes(list(enumerate(texts)))


def test_minhash_of_odd_rows(spark, odd):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[4] == {(1, 4)} and by_id[5] == {(2, 5)}
    assert by_id[None] == {(3, None), (0, None)}
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_sketches_of_a_pair_are_compared_once(spark):
    of = np.arange(2 * minhash.TABLES * minhash.DEPTH, dtype=np.uint16).tobytes()
    nodes = spark.createDataFrame([(i, 60, bytearray(of)) for i in (1, 2)], "node long, n long, sketch binary")
    rows = spark.createDataFrame([(7, 1, 2), (7, 2, 2)], "key long, node long, score long")
    met = minhash.to_hubs(rows, nodes)
    assert [tuple(r) for r in met.collect()] == [(1, 2, 2, len(of) // 2)]
    assert met._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_components_stop_at_stars(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(components, "_star", lambda *a, step=components._star: steps.append(a[1]) or step(*a))
    stars = [(5, 1), (6, 1), (1, 7), (8, 3), (3, 8), (9, 9)]
    found = components.components(spark.createDataFrame(stars, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (3, 3), (5, 1), (6, 1), (7, 1), (8, 3)] and not steps
    chain = [(i, i + 1) for i in range(40)] + [(60, 50), (60, 55), (50, 55)]
    found = components.components(spark.createDataFrame(chain, "a long, b long"), 10)
    assert dict(map(tuple, found.collect())) == {i: 0 for i in range(41)} | {50: 50, 55: 50, 60: 50} and steps


def test_minhashes_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(5)
    members = rng.integers(0, 2**63 - 1, 900, dtype=np.uint64)
    a, b = np.sort(members[:800]), np.sort(members[100:])
    runs = [np.mean(minhash.minima(minhash.mix(a * np.uint64(2 * k + 1))) == minhash.minima(minhash.mix(b * np.uint64(2 * k + 1)))) for k in range(60)]
    assert abs(np.mean(runs) - 7 / 9) < 0.03


# --- vector codes


@pytest.mark.parametrize("spread", [3, 4096, 2**28])
def test_gnat_finds_the_nearest_entry_of_least_index(spread):
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 16, 60):
        entries = rng.integers(-spread, spread + 1, (n, 8))
        entries[n // 2 :] = entries[: n - n // 2]  # equal entries: ties go to the lower index
        queries = np.concatenate([rng.integers(-spread, spread + 1, (400, 8)), entries])
        best, reach, computed = gnat.nearest_entries(gnat.build(entries), entries, queries)
        d = np.stack([gnat.squared(queries, e) for e in entries], axis=1)
        assert (best == d.argmin(1)).all() and (reach == d.min(1)).all()
        assert computed <= d.size


def test_gnat_leaves_out_subtrees():
    rng = np.random.default_rng(7)
    centres = rng.integers(-40_000, 40_000, (16, 8))
    entries = np.repeat(centres, 8, axis=0) + rng.integers(-50, 50, (128, 8))
    queries = entries[rng.integers(0, 128, 1000)] + rng.integers(-20, 20, (1000, 8))
    _, _, computed = gnat.nearest_entries(gnat.build(entries), entries, queries)
    assert computed < 0.4 * len(queries) * len(entries)


def quantised(rows: list[tuple], parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[dict, list]:
    rows = sorted(r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]))
    m = np.floor(np.array([r[1] for r in rows], float) * 4096).astype(np.int64)
    cuts = gnat.cuts(m.shape[1], parts)
    books = [m[:entries, lo:hi] for lo, hi in cuts]
    for k in range(rounds + 1):
        d = [((m[:, None, lo:hi] - b[None]) ** 2).sum(2) for (lo, hi), b in zip(cuts, books)]
        codes = [x.argmin(1) for x in d]
        if k < rounds:
            books = [
                np.array([m[c == e, lo:hi].sum(0) // (c == e).sum() if (c == e).any() else b[e] for e in range(len(b))])
                for (lo, hi), c, b in zip(cuts, codes, books)
            ]
    error = sum(x.min(1) for x in d)
    return {r[0]: ("".join(f"{c[i]:02x}" for c in codes), int(error[i])) for i, r in enumerate(rows)}, books


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=20)], i % 3 if i % 5 else None) for i in range(200)]
    rows += [(900, None, 1), (901, [None] * 20, 1), (902, [float("nan")] * 20, 1), (903, [float("inf")] * 20, None), (-1, [0.5] * 20, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    out, books = gnat.compressed(df)
    want, want_books = quantised([r for r in rows])
    got = {r["vec_id"]: r for r in out.collect()}
    assert {i: (r["code"], r["error"]) for i, r in got.items()} == want
    assert gnat.digest(books) == gnat.digest(want_books)
    labels = {r[0]: r[2] for r in rows}
    for i, r in got.items():
        assert r["label_error"] == sum(e for j, (_, e) in want.items() if labels[j] == labels[i])


def test_codes_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label string, v string, code string"
    few = spark.createDataFrame(
        [(3, [1.0, -2.0], "a", "x", "x"), (None, [1.0, 5.0], None, "x", "x"), (3, [1.0, -2.0], "a", "x", "x"), (4, [1.0], "a", "x", "x"),
         (9, [1e30, -1e30], "b", "x", "x")], kind)
    out, books = gnat.compressed(few)
    assert sorted((str(r["vec_id"]), r["error"] >= 0) for r in out.collect()) == [("3", True), ("3", True), ("9", True), ("None", True)]
    assert sum(b.shape[1] for b in books) == 2
    empty, books = gnat.compressed(few.limit(0))
    assert empty.count() == 0 and gnat.digest(books) == gnat.digest([])
    bare, _ = gnat.compressed(spark.createDataFrame([(1, [], "a", "x", "x")], kind))
    assert [(r["code"], r["error"]) for r in bare.collect()] == [("00" * 8, 0)]


# --- spelling groups


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def some_words(n: int, letters: str, seed: int) -> list[str]:
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        base = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        out.add(base)
        i = rng.randrange(len(base))
        out.add(base[:i] + rng.choice(["", rng.choice(letters), base[i] * 2]) + base[i + 1 :])
    return sorted(w for w in out if len(w) >= 5)


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyz"])
def test_near_pairs_equal_brute_force(spark, letters):
    words = some_words(400, letters, 9) + (["a" * 300, "a" * 301, "a" * 303] if letters == "ab" else [])
    df = spark.createDataFrame([(w, 3 + k) for k, w in enumerate(words)], "word string, n long")
    got = {(r["word"], r["other"]) for r in spelling.near_pairs(df).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_disjoint_bigrams_weigh_least():
    rng = random.Random(10)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        grams = [(p, rng.randint(1, 50)) for p in places]
        weight = dict(grams)
        best = min(weight[p] + weight[q] for p in places for q in places if p + 2 <= q)
        chosen = spelling.disjoint(grams, 2)
        assert sum(weight[p] for p in chosen) == best and chosen[0] + 2 <= chosen[1]


def test_forms_and_roots(spark):
    rows = [("waters", 100), ("water", 40), ("watr", 3), ("wates", 15), ("wateq", 7), ("other", 9), ("othen", 9), ("single", 4)]
    rows = [r for r in rows if len(r[0]) >= 5]
    got = {r["word"]: r for r in spelling.grouped(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert (got["water"]["form"], got["water"]["root"], got["water"]["form_n"]) == ("waters", "waters", 100)
    assert (got["wateq"]["form"], got["wateq"]["root"]) == ("water", "waters")
    assert (got["wates"]["form"], got["wates"]["n_near"]) == ("waters", 3)
    assert (got["other"]["form"], got["other"]["root"], got["other"]["n_near"]) == (None, "other", 1)
    assert (got["single"]["form"], got["single"]["n_near"], got["single"]["form_n"]) == (None, 0, None)
    assert got["waters"]["form"] is None and got["waters"]["root"] == "waters"


def test_counted_words(spark, documents, odd):
    texts = ["Hello hello HELLO Élan×÷x word", "hello-hello1hello"] + [None, ""]
    got = {r["word"]: r["n"] for r in spelling.counted(documents(*texts), least=1).collect()}
    assert got == {"hello": 6, "Élan×÷x": 1}
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["spelling", "variants", "grouping"]) for _ in range(30)) for _ in range(300)]
    want: dict[str, int] = {}
    for i, t in enumerate(texts):
        for w in t.split():
            h = zlib.crc32(f"{i}:{w}".encode())
            w = w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]
            want[w] = want.get(w, 0) + 1
    got = {r["word"]: r["n"] for r in spelling.counted(documents(*texts), typo_every=97, least=1).collect()}
    assert got == want and len(got) > 3
    assert spelling.counted(odd, typo_every=97).count() > 0
    assert spelling.grouped(spelling.counted(odd.limit(0))).count() == 0
