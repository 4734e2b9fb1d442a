from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from brinewave.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text: str) -> str:
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(d) <= 19 and luhn(d),
                "phone": 10 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_the_plain_patterns(spark, documents):
    rng = random.Random(7)
    parts = ["a@b.c", "x.y@zz.", "@", ".", "_", "1.2.3.4", "256.1.1.1", ".5.6.7.8", "007.1.2.3", "4111111111111111",
             "4111 1111 1111 1111", "-", " ", "+1 (555) 010-9999", "+", "+44.20", "é", "\U0001f600", "12", "foo", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    texts += ["1" * 20_000, "a" * 20_000, "1." * 5_000, "a@b.c" * 2_000]
    got = pii.found(documents(*texts)).select("doc_id", pii.written(F.col("base")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in got} == {i: brute(t) for i, t in enumerate(texts)}


def test_a_term_that_stands_only_beside_an_entity_is_found_everywhere(spark, documents):
    filler = [f"word{chr(97 + i)} plain talk about nothing in particular number {chr(97 + i)}" for i in range(20)]
    private = [f"{f} Zorblax mails zor@blax.org {f[::-1]}" for f in filler[:6]]
    docs = documents(*private, *(f"{f} mails" for f in filler), "here Zorblax stands alone")
    rows = {r["doc_id"]: r for r in pii.found(docs).collect()}
    assert [(s["kind"], s["start"]) for s in rows[26]["added"]] == [("removed", 5)]
    assert not rows[10]["added"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert clean[26] == "here [REMOVED] stands alone"
    assert "zor@blax.org" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[10] == f"{filler[4]} mails"


def test_odd_rows(spark, odd):
    rows = pii.found(odd).collect()
    assert len(rows) == odd.count()
    kinds = {r["doc_id"]: [s["kind"] for s in r["base"]] for r in rows}
    assert kinds[6] == ["ip", "email"] and kinds[1] == []
    out = pii.sanitised(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.filter("doc_id = 1").first()["text"] is None
    assert pii.found(odd.limit(0)).count() == 0
