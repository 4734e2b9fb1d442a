"""The trained operators on held-out rows, and the automaton against edit distances."""

from __future__ import annotations

import random

import pytest

from brinewave.llm import lm, quality, queries, toxicity
from brinewave.llm.base import hash_texts
from brinewave.llm.toxicity import Automaton, edits_allowed


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return row[-1]


def test_automaton_equals_edit_distances():
    rng = random.Random(2)
    entries = [("idiot", False), ("scum", False), ("disgusting", False), ("lowei", True), ("worthless", True), ("abc", False)]
    automaton = Automaton(entries)
    tokens = {"", "scum", "scam", "loweix", "worthlessness", "worthlesly", "abcd"}
    for word, _ in entries:
        for _ in range(150):
            t = list(word)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(t) + 1)
                t[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "o", "t"])
            tokens.add("".join(t) + rng.choice(["", "", "ly"]))
    for t in tokens:
        want = {}
        for k, (entry, stem) in enumerate(entries):
            ends = range(len(t) + 1) if stem else [len(t)]
            e = min(distance(t[:n], entry) for n in ends)
            if e <= edits_allowed(entry, stem):
                want[k] = e
        assert dict(automaton.hits(t)) == want, t


@pytest.fixture(scope="module")
def abuse(spark):
    rng = random.Random(4)
    calm = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(calm) for _ in range(30)]
        if i % 4 == 0:
            words.insert(rng.randrange(30), rng.choice(["blockhead", "dimwit", "schmuk" + rng.choice("abcdef")]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_catches_misspellings_and_spares_quotations(spark, documents, abuse):
    texts = ["you are a blockhead", "you blokhead", "BLOCKHEAD!", "schmukzz that you are", 'the word "blockhead" was quoted', "calm words", ""]
    got = {r["doc_id"]: r["_score"] for r in toxicity.scored(documents(*texts), abuse).collect()}
    assert [got[i] >= 0.7 for i in range(7)] == [True, True, True, True, False, False, False]


def test_toxicity_on_odd_rows(spark, odd, labels, abuse):
    out = toxicity.scored(odd, abuse)
    assert out.count() == odd.count() and out.filter("_score BETWEEN 0 AND 1").count() == odd.count()
    assert toxicity.train(odd, labels.limit(0))["entries"] == []
    nothing = toxicity.scored(odd, toxicity.train(odd.limit(0), labels))
    assert nothing.count() == odd.count()


@pytest.mark.parametrize("name,label", [("op4_toxicity", "toxic"), ("op5_quality_classifier", "quality")])
def test_held_out_accuracy(spark, name, label):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    held = rows.join(known, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r[label] for r in held) >= 0.9 * len(held)
    assert rows.count() == 1000


def test_quality_on_odd_rows(spark, odd, labels):
    model = quality.train(odd, labels)
    out = quality.scored(odd, model)
    assert out.count() == odd.count() and out.filter("_score BETWEEN 0 AND 1").count() == odd.count()
    flat = quality.scored(odd, quality.train(odd, labels.limit(0)))
    assert flat.filter("_score = 0.5").count() == odd.count()
    assert quality.scored(odd.limit(0), model).count() == 0


def test_lm_scores_equal_brute_force(spark, documents):
    from collections import Counter
    from math import log

    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words[: 2 + i % 39]) for _ in range(rng.randint(0, 50))) for i in range(300)]
    texts += ["same old story"] * 5 + ["lonely"]
    rows = lm.scored(documents(*texts)).collect()
    one, two = Counter(), Counter()
    for t in texts:
        w = t.split()
        one.update(w)
        two.update(zip(w, w[1:]))
    total = sum(one.values())
    for r in rows:
        w = texts[r["doc_id"]].split()
        o, b = Counter(w), Counter(zip(w, w[1:]))
        want = 0.0
        for i, x in enumerate(w):
            alone = log(max(one[x] - o[x], lm.UNSEEN) / (total - len(w)))
            pair = (w[i - 1], x)
            seen = two[pair] - b[pair] if i else 0
            if seen:
                want += log(seen / (one[pair[0]] - o[pair[0]]))
            else:
                want += alone + (log(lm.BACKOFF) if i else 0)
        assert r["n_words"] == len(w) and abs(r["log_score"] - want) < 1e-4 * max(1, abs(want))


def brute_force(texts):
    """The scores of all texts, word by word."""
    from collections import Counter
    from math import log

    split = [t.split() for t in texts]
    one, two = Counter(x for w in split for x in w), Counter(p for w in split for p in zip(w, w[1:]))
    total = sum(one.values())
    out = []
    for w in split:
        o, b = Counter(w), Counter(zip(w, w[1:]))
        score = 0.0
        for i, x in enumerate(w):
            pair = (w[i - 1], x)
            seen = two[pair] - b[pair] if i else 0
            if seen:
                score += log(seen / (one[pair[0]] - o[pair[0]]))
            else:
                score += log(max(one[x] - o[x], lm.UNSEEN) / (total - len(w))) + (log(lm.BACKOFF) if i else 0)
        out.append(score)
    return out


def test_lm_tells_words_apart_whose_hashes_begin_alike(spark, documents):
    import numpy as np

    words = [f"w{i}" for i in range(20_000)]
    h, _ = hash_texts([" ".join(words).encode()])
    order = np.argsort(h)
    alike = np.flatnonzero((h[order][1:] >> np.uint64(43)) == (h[order][:-1] >> np.uint64(43)))[:20]
    pairs = [(words[order[i]], words[order[i + 1]]) for i in alike]
    assert len(pairs) == 20
    texts = [f"{a} then {b}" for a, b in pairs] + [f"{a} then" for a, _ in pairs] + [f"then {b} {b}" for _, b in pairs]
    want = brute_force(texts)
    for r in lm.scored(documents(*texts)).collect():
        assert abs(r["log_score"] - want[r["doc_id"]]) < 1e-4 * abs(want[r["doc_id"]])


@pytest.mark.parametrize("common", [1, 30, 300, lm.COMMON])
def test_lm_scores_do_not_depend_on_the_words_shared(spark, documents, common):
    rng = random.Random(common)
    words = [f"w{i}" for i in range(2500)]
    texts = [" ".join(rng.choice(words[: rng.choice([3, 60, 2500])]) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["rare rare rare end", "rare rare", "same old story", "same old story", "once", "", "w1"]
    want = brute_force(texts)
    rows = lm.scored(documents(*texts).repartition(3), common).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        w = want[r["doc_id"]]
        assert r["n_words"] == len(texts[r["doc_id"]].split()) and abs(r["log_score"] - w) < 1e-4 * max(1, abs(w))


def test_lm_on_odd_rows(spark, odd):
    rows = lm.scored(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["log_score"] == 0 and r["mean_log_score"] is None for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["log_score"] for r in rows if r["doc_id"] == 4}) == 1
    assert lm.scored(odd.limit(0)).count() == 0
