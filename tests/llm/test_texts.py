"""Substrings, benchmark windows and chat trees against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from brinewave.llm import chat, decontamination, substrings


def brute_removal(texts: list[tuple[int, str]], length: int) -> list[tuple]:
    least: dict = {}
    for i, t in texts:
        w = t.split()
        for s in range(len(w) - length + 1):
            g = tuple(w[s : s + length])
            least[g] = min(i, least.get(g, i))
    out = []
    for i, t in texts:
        w = t.split()
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if least[tuple(w[s : s + length])] < i:
                gone[s : s + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,words", [(10, 2000), (12, 3), (50, 400), (7, 20)])
def test_removed_words_equal_brute_force(spark, documents, length, words):
    rng = random.Random(length)
    pool = [[f"w{rng.randrange(words)}" for _ in range(rng.randint(1, 3 * length))] for _ in range(25)]
    texts = [sum((rng.choice(pool) for _ in range(rng.randint(0, 6))), []) for _ in range(120)]
    for t in texts[:60]:  # near copies: single words changed
        if t:
            t = t[:]
            t[rng.randrange(len(t))] = "changed"
            texts.append(t)
    rows = [(i if i % 9 else i + 1, " ".join(t)) for i, t in enumerate(texts)]  # some ids twice
    out = substrings.deduplicated(documents(*(t for _, t in rows), ids=[i for i, _ in rows]), length).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == brute_removal(rows, length)


def test_substrings_on_odd_rows(spark, odd):
    rows = substrings.deduplicated(odd).collect()
    assert len(rows) == odd.count() and all(r["n_removed"] == 0 for r in rows)
    assert substrings.deduplicated(odd.limit(0)).count() == 0


def test_windows_of_benchmark_items(spark, documents):
    rng = random.Random(6)
    item = [f"i{rng.randrange(10_000)}" for _ in range(40)]
    noise = lambda n: [f"n{rng.randrange(10_000)}" for _ in range(n)]
    changed = item[:]
    changed[20] = "other"
    much = [w if k % 6 else "x" for k, w in enumerate(item)]
    texts = [noise(30) + item + noise(30), noise(9) + changed, noise(50), much + noise(20), item[:20], [w.upper() for w in item]]
    bench = spark.createDataFrame([(5, " ".join(item)), (6, "too short"), (7, None), (8, " ".join(noise(20)))], "item_id long, text string")
    docs = documents(*(" ".join(t) for t in texts))
    got = {(r["doc_id"], r["item_id"]): (r["start"], round(r["similarity"], 6)) for r in decontamination.contaminated(docs, bench).collect()}
    a, b = (Counter(zip(*[x[i:] for i in range(5)])) for x in (item, changed))
    assert got == {(0, 5): (30, 1.0), (5, 5): (0, 1.0)} | (
        {(1, 5): (9, round(sum((a & b).values()) / sum((a | b).values()), 6))} if sum((a & b).values()) >= 0.8 * sum((a | b).values()) else {}
    )
    assert {r["doc_id"] for r in decontamination.clean(docs, bench).collect()} == set(range(6)) - {d for d, _ in got}


def test_decontamination_on_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "word other word other word other"), (1, None)], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.contaminated(odd, bench).collect()} == {5}
    assert decontamination.clean(odd, bench).columns == odd.columns
    assert decontamination.clean(odd, bench).count() == odd.count() - 1
    assert decontamination.clean(odd, bench.limit(0)).count() == odd.count()
    assert decontamination.contaminated(odd.limit(0), bench).count() == 0


def test_escape_is_reversible(spark):
    texts = ["<|end|>\n", "\\l\\\\", "[INST]</s>\\", "\\n", "é\U0001f600<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(df["t"]).alias("e")).collect():
        assert chat.unescape(r["e"]) == r["t"] and "<" not in r["e"] and "[" not in r["e"]


@pytest.mark.parametrize("limit", [chat.PACK, 40])
def test_trees_share_turns_and_read_back(spark, limit):
    rng = random.Random(8)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 5)):
            rows.append((c, t, ["user", "assistant"][t % 2], f"t{t} {rng.choice('ab')}<|end|>[INST]"))
    rows += [(None, 0, "assistant", None), (90, None, None, "x"), (90, 1, "a\nb", "y"), (91, 1, "user", "same"), (91, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS path_id")
    got = {r["conv_id"]: r for r in chat.digests(df, limit).collect()}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1]))]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    if limit == chat.PACK:
        paths = chat.formatted(df).groupBy("path_id").agg({"turns": "first"}).withColumnRenamed("first(turns)", "turns").coalesce(1)
        nodes = [n for p in chat.packs(paths).collect() for n in p["nodes"]]
        prefixes = {tuple(t["text"] for t in r["turns"][: k + 1]) for r in paths.collect() for k in range(len(r["turns"]))}
        assert len(nodes) <= len(prefixes) + 40  # one task walks nearly all: each prefix once
    assert chat.digests(df.limit(0)).count() == 0
