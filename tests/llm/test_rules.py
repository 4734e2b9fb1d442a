from __future__ import annotations

import random
from collections import Counter

from brinewave.llm import rules


def brute(text: str) -> tuple:
    words, lines = text.split(), [x for x in text.split("\n") if x.split()]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
    )


def test_counts_equal_brute_force(spark, documents):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "b ", "é ", "\n", "# ", "c ", "\t", "x|y ", "\r\n"]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts.append("a b c " * 20_000)
    rows = rules.judged(documents(*texts)).collect()
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_lines_of_many_documents_of_a_host(spark, documents):
    body = [" ".join(chr(97 + i) + "x" * j for j in range(60)) for i in range(12)]
    frame = "Menu 12 home about"
    docs = documents(*(f"{frame}\n{b}" for b in body), "menu 99  HOME about\nqa qb qc")
    other = documents(f"{frame}\n{body[0]}", source="other", ids=[50])
    both = docs.unionByName(other)
    assert rules.frequent_lines(rules.measured(both), limit=5).count() == 1
    kept = {r["doc_id"]: r["kept"] for r in rules.judged(both, limit=5, least_share=0.5).collect()}
    assert kept == {**dict.fromkeys(range(12), True), 12: False, 50: True}
    clean = {r["doc_id"]: r["text"] for r in rules.cleaned(both, limit=5).collect()}
    assert clean[0] == body[0] and clean[50].startswith(frame)


def test_copies_are_one_document(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = rules.judged(documents(*[text] * 30), limit=5).collect()
    assert all(r["kept"] for r in rows)


def test_odd_rows(spark, odd):
    rows = rules.judged(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows)
    assert rules.cleaned(odd).columns == odd.columns
    assert rules.cleaned(odd).filter("doc_id = 1").first()["text"] is None
    assert rules.judged(odd.limit(0)).count() == 0
