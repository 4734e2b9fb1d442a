"""Toxicity: a Levenshtein automaton intersected with a lexicon trie, and context windows around its hits.

The lexicon is learned from labelled rows: whole words, and stems that many inflected words share, most of whose uses
are in rows of label 1. Uses are counted over different contexts (the words on either side), so that copies of one
text do not vouch for its words. The automaton reads a token character by character; its states are sets of
(trie node, edits so far), determinised lazily, so most tokens end in the dead state after a few characters.

A hit gets the probability its kind (entry, number of edits, quoted or not) has on the labelled rows. The window around
a hit tells quotation (quotation marks on both sides, words of reporting) from abuse; a quoted hit counts as much as
quoted hits do on the labelled rows, and little where these have none. A small logistic regression turns the most
telling hit and the number and density of hits into the score.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import held, labelled, prepared, text_of

TRAIN_ROWS = 12_000
SUPPORT = 5
LIFT = 3
PRECISION, STEM_PRECISION = 0.9, 0.7
RIDGE = 1.0
FEATURES = 7
STEMS = range(3, 13)
MAX_ENTRIES = 20_000
WINDOW = 40
MEMO = 1 << 17
QUOTED_PRIOR, FUZZY_PRIOR, PRIOR_ROWS = 0.3, (0.97, 0.85, 0.72), 4
CUES = ("said", "says", "quote", "quoted", "wrote", "called", "word", "term", "insult", "slur")


def words_of(text: str | None) -> list[str]:
    return re.findall(r"\w+", (text or "").lower())


def edits_allowed(entry: str, stem: bool) -> int:
    if stem:
        return 0 if len(entry) < 7 else 1
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


class Automaton:
    """Finds the lexicon entries within their edit limit of a token: whole entries, or stems at its start."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.limit = [0]
        for k, (entry, stem) in enumerate(entries):
            node, most = 0, edits_allowed(entry, stem)
            self.limit[0] = max(self.limit[0], most)
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], most)
            self.ends[node].append(k)
        self.ids: dict[tuple, int] = {}
        self.sets: list[dict[int, int]] = []
        self.next: list[dict[str, int]] = []
        self.final: list[tuple[tuple[int, int], ...]] = []
        self.stems: list[tuple[tuple[int, int], ...]] = []
        self.start = self._state({0: 0})
        self.memo: dict[str, tuple[tuple[int, int], ...]] = {}

    def _state(self, at: dict[int, int]) -> int:
        """The state of a set of nodes with their least edits, after skipping characters of the entries."""
        todo = list(at)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                e = at[node] + 1
                if e <= self.limit[child] and e < at.get(child, 99):
                    at[child] = e
                    todo.append(child)
        if not at:
            return -1
        key = tuple(sorted(at.items()))
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(at)
            self.next.append({})
            hits = [(k, e) for n, e in at.items() for k in self.ends[n] if e <= edits_allowed(*self.entries[k])]
            self.final.append(tuple(h for h in hits if not self.entries[h[0]][1]))
            self.stems.append(tuple(h for h in hits if self.entries[h[0]][1]))
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        at: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.limit[node] and e < at.get(node, 99):
                at[node] = e

        for node, e in self.sets[state].items():
            put(node, e + 1)
            for d, child in self.children[node].items():
                put(child, e if d == c else e + 1)
        to = self.next[state][c] = self._state(at)
        return to

    def hits(self, token: str) -> tuple[tuple[int, int], ...]:
        """(entry, edits) with the least edits of each entry the token matches."""
        known = self.memo.get(token)
        if known is not None:
            return known
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(self.sets) >= MEMO:  # the lazily built states are a cache as well
            self.ids, self.sets, self.next, self.final, self.stems = {}, [], [], [], []
            self.start = self._state({0: 0})
        state, found = self.start, {}
        for c in token:
            to = self.next[state].get(c)
            state = self._step(state, c) if to is None else to
            if state < 0:
                break
            for k, e in self.stems[state]:
                found[k] = min(e, found.get(k, 99))
        else:
            for k, e in self.final[state]:
                found[k] = min(e, found.get(k, 99))
        out = self.memo[token] = tuple(found.items())
        return out


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around a hit shows quotation: marks on both sides, or a word of reporting before a mark."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    marks = '"“”„«»'
    opened = any(m in before for m in marks)
    closed = any(m in after for m in marks)
    cue = any(re.search(rf"\b{c}\b", before) for c in CUES)
    return (opened and closed) or (cue and (opened or closed))


def found_in(text: str | None, automaton: Automaton) -> Counter:
    """The uses of each kind of hit in a whole text: (entry, edits, quoted)."""
    low = (text or "").lower()
    bad = {w: h for w in set(re.findall(r"\w+", low)) if (h := automaton.hits(w))}
    out: Counter = Counter()
    if bad:
        for m in re.finditer(r"\w+", low):
            if m.group() in bad:
                q = quoted(low, m.start(), m.end())
                out.update((k, e, q) for k, e in bad[m.group()])
    return out


def evidence(text: str | None, hits: Counter, chance: dict) -> list[float]:
    """What the regression sees of a text with hits: log-odds of the three most telling uses, number and density."""
    odds = []
    for h, n in sorted(hits.items(), key=lambda x: -chance[x[0]])[:3]:
        p = min(max(chance[h], 1e-3), 1 - 1e-3)
        odds += [float(np.log(p / (1 - p)))] * min(n, 3)
    first, second, third = (odds + [0.0, 0.0])[:3]
    plain = sum(n for (_, _, q), n in hits.items() if not q)
    rate = 100 * plain / (20 + len((text or "").split()))
    return [first, second, third, np.log1p(plain), np.log1p(rate), float(plain >= 3), 1.0]


def fit_regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the log-odds of the most telling hit alone."""
    start = np.zeros(FEATURES)
    start[0] = 1
    w = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + RIDGE * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(FEATURES)
        w = w - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return w


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Entries (text, is a stem) most of whose uses, over different contexts, are in rows of label 1."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                terms = set()
                for w in set(words_of(text)):
                    terms.add(w + "$")
                    terms.update(w[:n] for n in STEMS if n <= len(w))
                (toxic if label else clean).update(terms)
            if len(toxic) + len(clean) > 1 << 20:
                yield _counts(toxic, clean)
                toxic, clean = Counter(), Counter()
        if toxic or clean:
            yield _counts(toxic, clean)

    counted = sample.mapInPandas(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    rows = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    share = LIFT * rows.get(1, 0) / max(rows.get(0, 0), 1)
    good = counted.filter(f"toxic >= {SUPPORT}").filter(F.col("toxic") >= F.col("clean") * share)
    terms = set(good.orderBy(F.desc("toxic"), "term").limit(MAX_ENTRIES * 10).toPandas()["term"])

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen = set()
            for text, label in zip(pdf["text"], pdf["label"]):
                w = ["", *words_of(text), ""]
                for i in range(1, len(w) - 1):
                    around = f"{w[i - 1]} {w[i + 1]}"
                    for term in (w[i] + "$", *(w[i][:n] for n in STEMS if n <= len(w[i]))):
                        if term in terms:
                            seen.add((term, around, int(label)))
            if seen:
                yield pd.DataFrame(sorted(seen), columns=["term", "around", "label"])

    apart = sample.mapInPandas(contexts, "term string, around string, label int").distinct()
    uses = apart.groupBy("term").agg(F.sum("label").alias("n"), F.count("*").alias("all"))
    least = F.when(F.col("term").endswith("$"), PRECISION).otherwise(STEM_PRECISION)
    told = uses.filter(f"n >= {SUPPORT}").filter(F.col("n") >= least * F.col("all")).toPandas()
    return closed_entries({r.term: (int(r.n), r.n / getattr(r, "all")) for r in told.itertuples()})


def _counts(toxic: Counter, clean: Counter) -> pd.DataFrame:
    terms = list(toxic | clean)
    return pd.DataFrame({"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]})


def closed_entries(uses: dict[str, tuple[int, float]]) -> list[tuple[str, bool]]:
    """The shortest telling stems, lengthened while one continuation holds nearly all of their uses, and the whole
    words that no stem of their precision covers. ``uses``: of a term, its number and the share with label 1."""
    n = {t: u[0] for t, u in uses.items()}
    out = set()
    stems = {t for t in n if not t.endswith("$")}
    following: dict[str, list[str]] = {}
    for t in stems:
        following.setdefault(t[:-1], []).append(t)
    for t in sorted(stems):
        if t[:-1] in stems:
            continue
        while (longer := max(following.get(t, []), key=n.__getitem__, default=None)) and n[longer] >= PRECISION * n[t]:
            t = longer
        out.add((t, n.get(t + "$", 0) < PRECISION * n[t]))
    sure = {t for t, _ in out if uses[t][1] >= PRECISION}
    for t in n:
        if t.endswith("$") and not any(t[:k] in sure for k in range(1, len(t))):
            out.add((t[:-1], False))
    return sorted(out)


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", of: int = 3, held_out: int = 1,
          rows: int = TRAIN_ROWS) -> dict:
    """The lexicon and the probability of each kind of hit, from at most ``rows`` labelled rows."""
    sample = held(labelled(documents, labels, label, of, held_out, rows).repartition(24))
    entries = learn_lexicon(sample)

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, out = Automaton(entries), Counter()
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["label"]):
                hits = found_in(text, automaton)
                least = min(((q, e) for _, e, q in hits), default=None)  # what stands beside a plainer hit tells nothing
                out.update((k, e, q, int(y)) for k, e, q in hits if (q, e) == least)
        if out:
            yield pd.DataFrame([(*k, n) for k, n in out.items()], columns=["entry", "edits", "quoted", "label", "n"])

    seen = sample.mapInPandas(kinds, "entry int, edits int, quoted boolean, label int, n long")
    table = seen.groupBy("entry", "edits", "quoted", "label").agg(F.sum("n").alias("n")).toPandas()
    base = sample.agg(F.avg("label")).first()[0] or 0.0
    n = {tuple(r[:4]): r[4] for r in table.itertuples(index=False)}
    chance = {}
    quoted_rows = [sum(v for (_, _, q, y), v in n.items() if q and y == side) for side in (0, 1)]
    any_quoted = (quoted_rows[1] + QUOTED_PRIOR * 10) / (sum(quoted_rows) + 10)
    for k, (entry, stem) in enumerate(entries):
        for e in range(edits_allowed(entry, stem) + 1):
            for q in (False, True):
                prior = FUZZY_PRIOR[e] * (any_quoted if q else 1)
                pos, neg = n.get((k, e, q, 1), 0), n.get((k, e, q, 0), 0)
                chance[k, e, q] = (pos + PRIOR_ROWS * prior) / (pos + neg + PRIOR_ROWS)

    def regressors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(entries)
        for pdf in batches:
            out = [(evidence(t, h, chance), int(y)) for t, y in zip(pdf["text"], pdf["label"]) if (h := found_in(t, automaton))]
            if out:
                yield pd.DataFrame({"x": [x for x, _ in out], "y": [y for _, y in out]})

    points = sample.mapInPandas(regressors, "x array<double>, y int").toPandas()
    x = np.array(points["x"].tolist(), float).reshape(-1, FEATURES)
    return {
        "entries": entries,
        "chance": chance,
        "base": min(0.1, base) / 4,
        "weights": fit_regression(x, points["y"].to_numpy(float)),
    }


def score_text(text: str | None, automaton: Automaton, model: dict) -> float:
    hits = found_in(text, automaton)
    if not hits:
        return model["base"]
    at = float(np.clip(np.dot(evidence(text, hits, model["chance"]), model["weights"]), -30, 30))
    return max(model["base"], 1 / (1 + float(np.exp(-at))))


def scored(documents: DataFrame, model: dict, name: str = "_score") -> DataFrame:
    """All columns and the probability of label 1; texts without hits, null and empty ones too, get a low base."""
    spark = prepared(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        automaton = Automaton(m["entries"])
        for texts in batches:
            yield pd.Series([score_text(t, automaton, m) for t in texts], dtype=float)

    return documents.withColumn(name, score(text_of(documents)))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
