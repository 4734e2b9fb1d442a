"""MinHash near-duplicates with tensored banding, verified on full sets.

A document is its set of distinct word shingles. Two collections of ``TABLES`` hashes each are computed, a hash being ``DEPTH``
minhashes. A table key pairs one hash of the first collection with one of the second, so ``TABLES ** 2`` tables of
``2 * DEPTH`` minhashes come from ``2 * TABLES * DEPTH`` minhashes, not ``2 * TABLES ** 2 * DEPTH``. With similarity s, a pair meets
in some table unless one collection misses entirely: probability ``1 - (1 - (1 - s ** DEPTH) ** TABLES) ** 2``, with the values
below 4e-4 at s = 0.8, 2e-5 at 0.85 and 3e-7 at 0.9.

Equal sets are one node. A hash that no other node has is dropped before keys are formed, which loses no bucket.

What has to be right is connection, so no pairs are written within a bucket. The nodes that share one hash first meet its hub,
the node with most company; a node follows the hub of most company among those with a similar sketch. Hashes whose nodes
all follow one hub are done, and so is every table key made of them; keys are formed for what is left. In buckets that still hold
followers of different hubs, these meet in blocks, of which a spanning forest of similar sketches comes out. Both together make
families: two nodes of one bucket with similar sketches are always in one (a pair of similarity 0.8 has dissimilar ones with
probability 1e-8). Within a family, links are confirmed by the exact intersection of full sets: of each node with the hub it
follows and the one it agrees most with, then in blocks between nodes that do not follow one confirmed hub; again a forest of
links comes out. Blocks of the largest following meet those of the others only, so a large group around one text costs no more
than its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import column, hash_texts, held, mix, prepared, text_of
from brinewave.llm.components import components

SHINGLE = 2
SIMILARITY = 80  # percent
TABLES = 12
DEPTH = 3
BLOCK = 512  # nodes, where sketches meet
BLOCK_MEMBERS = 1 << 17  # shingles, where sets meet
#: Of 72 minhashes, 36 or more agree but for a chance of 1e-8 at similarity 0.8; chance agreements only add pairs.
AGREE_LEAST = 36
LINKS_OF_TASK = 100_000
SPAN = 1 << 13
MULTIPLIERS = np.random.default_rng(11).integers(1 << 62, (1 << 63) - 1, 2 * TABLES * DEPTH, dtype=np.uint64) * 2 + 1
OFFSETS = np.random.default_rng(13).integers(0, (1 << 63) - 1, 2 * TABLES * DEPTH, dtype=np.uint64)


def shingle_set(words: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text given by its word hashes; one for a shorter text, none without words."""
    n = max(len(words) - shingle + 1, min(len(words), 1))
    out = np.zeros(n, np.uint64)
    for k in range(min(shingle, len(words))):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n] + np.uint64(1))
    return np.unique(out)


def minima(members: np.ndarray) -> np.ndarray:
    """The minhashes of a set that has members."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), SPAN):
        part = members[at : at + SPAN]
        np.minimum(least, (MULTIPLIERS[:, None] * part + OFFSETS[:, None]).min(1), out=least)
    return least


def sets_of(texts: pd.Series, shingle: int) -> Iterator[np.ndarray]:
    hashes, counts = hash_texts([t.encode().lower() for t in texts])  # bytes: only A-Z have a lower case
    at = 0
    for n in counts.tolist():
        yield shingle_set(hashes[at : at + n], shingle)
        at += n


def sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, rid, rid2, n, digest, hashes, sketch``: size and digest of the set, the hashes of both collections one after
    the other, and 16 bits of each minhash. ``rid, rid2`` name a row's id and text. Digest and hashes are null without words."""
    text, doc_id = text_of(docs), column(docs, "doc_id")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("rid"), F.hash(text, doc_id).alias("rid2"), text.alias("text"))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: dict[str, list] = {"n": [], "digest": [], "hashes": [], "sketch": []}
            for s in sets_of(pdf["text"], shingle):
                out["n"].append(len(s))
                if not len(s):
                    for c in ("digest", "hashes", "sketch"):
                        out[c].append(None)
                    continue
                least = minima(s)
                hashes = np.zeros(2 * TABLES, np.uint64)
                for k in range(DEPTH):
                    hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + least[k::DEPTH])
                out["digest"].append(xxhash.xxh3_128_digest(s.tobytes()))
                out["hashes"].append(hashes.view(np.int64))
                out["sketch"].append((least >> np.uint64(40)).astype(np.uint16).tobytes())
            yield pdf[["doc_id", "rid", "rid2"]].assign(**out)

    kind = dict(rows.dtypes)["doc_id"]
    if kind not in ("string", "int", "bigint"):
        raise TypeError("doc_id is an integer or a string")
    # ids pass as strings: a batch with nulls would make floats of integers
    passed = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        sketch, "doc_id string, rid long, rid2 int, n long, digest binary, hashes array<long>, sketch binary"
    )
    return passed.withColumn("doc_id", F.col("doc_id").cast(kind))


def mixed(rows: DataFrame) -> DataFrame:
    """The rows of ``rows(key, comp, ...)`` whose key has different values of ``comp``."""
    apart = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    return rows.join(apart, "key", "left_semi")


def shared_hashes(nodes: DataFrame) -> DataFrame:
    """``key, node, at, h, score``: the hashes that nodes share with others. The score is a node's company in all hashes."""
    each = nodes.select("node", F.posexplode("hashes").alias("at", "h")).withColumn("key", F.xxhash64("at", "h"))
    company = each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # at most 2 * TABLES entries of one node
    sides = each.join(company, "key").groupBy("node").agg(
        F.collect_list(F.struct("key", "at", "h")).alias("hashes"), F.sum("n").alias("score")
    )
    return sides.select("node", "score", F.inline("hashes"))


def buckets(rows: DataFrame) -> DataFrame:
    """``key, node, comp`` of the table keys that nodes of different comps share.

    ``rows(key, node, comp, at, h)`` are the hashes that nodes of different comps share: the nodes of a bucket share both of its
    hashes, so a key of any other hash has one comp.
    """
    pair = F.struct("at", "h")
    sides = rows.groupBy("node", "comp").agg(
        F.collect_list(F.when(F.col("at") < TABLES, pair)).alias("first"),
        F.collect_list(F.when(F.col("at") >= TABLES, pair)).alias("second"),
    )
    keys = sides.select("node", "comp", F.explode("first").alias("x"), "second").select("node", "comp", "x", F.explode("second").alias("y"))
    return mixed(keys.select(F.xxhash64("x.at", "x.h", "y.at", "y.h").alias("key"), "node", "comp"))


def sizes_allow(a: str, b: str):
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def to_hubs(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, score, agree``: every node with the hubs of its hashes whose sizes and sketches allow the similarity."""
    hubs = rows.groupBy("key").agg(F.max(F.struct("score", "node")).alias("hub"))
    pairs = rows.join(hubs, "key").select(F.col("node").alias("a"), F.col("hub.node").alias("b"), "hub.score").filter("a <> b").distinct()
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("of_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("of_b"))

    # deterministic, it would be evaluated once for the filter and once for the column, by two Python workers a task
    @F.pandas_udf("int")
    def agreements(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((table(x) == table(y)).sum(1), dtype="int32")

    agreements = agreements.asNondeterministic()
    met = pairs.join(a, "a").join(b, "b").filter(sizes_allow("n_a", "n_b"))
    return met.select("a", "b", "score", agreements("of_a", "of_b").alias("agree")).filter(F.col("agree") >= AGREE_LEAST)


def table(sketches) -> np.ndarray:
    """Sketches in binary form, one a row."""
    return np.frombuffer(b"".join(sketches), np.uint16).reshape(len(sketches), 2 * TABLES * DEPTH)


def met_in_blocks(rows: DataFrame, weight, limit: int, *carried: str) -> DataFrame:
    """``left, right`` of ``rows(key, node, comp, ...)``: pairs of blocks of one key that nodes of different ``comp`` can meet in.

    The nodes of a key's largest comp are in blocks of their own, which meet the blocks of the others only; the others' blocks
    meet each other, and a block itself (``right`` empty). A block has about ``limit`` of the weight, whatever the key has.
    """
    parts = rows.groupBy("key", "comp").agg(F.sum(weight).alias("w")).groupBy("key").agg(
        F.max(F.struct("w", "comp")).alias("most"), F.sum("w").alias("w")
    )
    blocks = lambda w: F.ceil(w / limit).cast("int")
    parts = parts.select("key", F.col("most.comp").alias("main"), blocks(F.col("most.w")).alias("own"), blocks(F.col("w") - F.col("most.w")).alias("others"))
    dealt = rows.join(parts, "key")
    h, is_main = F.xxhash64("node"), F.col("comp") == F.col("main")
    block = F.when(is_main, F.pmod(h, F.col("own"))).otherwise(F.col("own") + F.pmod(h, F.col("others"))).cast("int")
    first = F.when(is_main, F.col("own")).otherwise(0)
    met = dealt.withColumn("block", block).withColumn("with", F.explode(F.sequence(first, F.col("own") + F.col("others") - 1)))
    one, low = F.struct("node", "comp", *carried), F.least("block", "with")
    return met.groupBy("key", low.alias("i"), F.greatest("block", "with").alias("j")).agg(
        F.collect_list(F.when(F.col("block") == low, one)).alias("left"), F.collect_list(F.when(F.col("block") != low, one)).alias("right")
    ).select("left", "right")


class Forest:
    """Classes of a few numbered things, joined by links; keeps the links that joined two classes."""

    def __init__(self, classes: np.ndarray) -> None:
        self.of = np.unique(classes, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def join(self, a: int, b: int) -> None:
        if self.of[a] != self.of[b]:
            self.links.append((a, b))
            self.of[self.of == self.of[b]] = self.of[a]


def forest(left, right, linked) -> list[tuple[int, int]]:
    """Links between the nodes of two blocks (of one, if ``right`` is empty) that join their classes.

    ``linked(i, js)`` tells which of the rows ``js`` of both together are linked to row ``i``. Rows of one class do not meet.
    """
    both = [*left, *right]
    node = np.array([r["node"] for r in both], np.int64)
    found = Forest(np.array([r["comp"] for r in both], np.int64))
    for i in range(len(left) if len(right) else len(both)):
        js = np.flatnonzero(found.of[: len(both)] != found.of[i])
        js = js[js >= max(i + 1, len(left) if len(right) else 0)]
        for j in linked(i, js) if len(js) else ():
            found.join(i, int(j))
    return [(int(node[i]), int(node[j])) for i, j in found.links]


def similar(rows, sizes: np.ndarray):
    """For ``forest``: the rows whose sizes and sketches allow the similarity."""
    sketch = table([r["sketch"] for r in rows])

    def of(i: int, js: np.ndarray) -> np.ndarray:
        js = js[100 * np.minimum(sizes[js], sizes[i]) >= SIMILARITY * np.maximum(sizes[js], sizes[i])]
        return js[(sketch[js] == sketch[i]).sum(1) >= AGREE_LEAST]

    return of


def sketch_links(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b``: a forest over the nodes of different comps in one bucket whose sizes and sketches allow the similarity."""
    met = met_in_blocks(rows.join(nodes.select("node", "n", "sketch"), "node"), F.lit(1), BLOCK, "n", "sketch")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = set()
            for left, right in zip(pdf["left"], pdf["right"]):
                both = [*left, *right]
                found.update(forest(left, right, similar(both, np.array([r["n"] for r in both]))))
            yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return met.mapInPandas(compare, "a long, b long").distinct()


def set_links(rows: DataFrame) -> DataFrame:
    """``a, b``: a forest of the confirmed links between nodes of different comps in one family.

    ``rows(key, node, comp, n, sketch, members)`` of a family have one key.
    """
    met = met_in_blocks(rows, F.col("n") + 64, BLOCK_MEMBERS, "n", "sketch", "members")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = set()
            for left, right in zip(pdf["left"], pdf["right"]):
                both = [*left, *right]
                sizes = np.array([len(r["members"]) for r in both])
                ends = np.cumsum([0, *sizes])
                names, place = np.unique(np.concatenate([r["members"] for r in both]), return_inverse=True)
                mark, near = np.zeros(len(names), bool), similar(both, sizes)

                def linked(i: int, js: np.ndarray) -> np.ndarray:
                    js = near(i, js)
                    if not len(js):
                        return js
                    mark[place[ends[i] : ends[i + 1]]] = True
                    common = np.array([np.count_nonzero(mark[place[ends[j] : ends[j + 1]]]) for j in js])
                    mark[place[ends[i] : ends[i + 1]]] = False
                    return js[100 * common >= SIMILARITY * (sizes[i] + sizes[js] - common)]

                found.update(forest(left, right, linked))
            yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return met.mapInPandas(compare, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    total = F.size("of_a") + F.size("of_b") - common
    return pairs.join(a, "a").join(b, "b").filter(100 * common >= SIMILARITY * total).select("a", "b")


def following(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """``rows`` with the hub of each node in ``comp``; a node without one is its own, as a hub's own name is."""
    return rows.join(hubs.select(F.col("a").alias("node"), F.col("b").alias("comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Words are runs without ASCII white space, A-Z lower-cased; a text with fewer words than a shingle is one shingle. Texts
    link at ``SIMILARITY`` percent or more of common shingles; ``component_id`` is the smallest doc_id reachable, the row's own
    included. Texts without words, null ones too, link with nothing and are components of their own. Rows without
    doc_id are returned and linked but never name a component (null where no row of it has an id). Repeated rows are
    returned each. Other columns are ignored; an empty table gives no row.
    """
    prepared(docs.sparkSession)
    rows = held(sketched(docs, shingle))
    first = F.min(F.struct("rid", "rid2")).alias("row")
    same = F.min(F.struct("n", "hashes", "sketch")).alias("x")  # equal in all rows of a digest
    # ids are given out before the write, so they are fixed
    nodes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"), first, same)
    nodes = held(nodes.select("digest", "least", "row", "x.*").withColumn("node", F.monotonically_increasing_id()))

    hashes = held(shared_hashes(nodes))
    near_hubs = held(to_hubs(hashes, nodes))
    # a hub that is followed has more company than its followers
    chosen = near_hubs.groupBy("a").agg(F.max(F.struct("score", "b")).alias("x"), F.max(F.struct("agree", "b")).alias("y"))
    chosen = held(chosen.select("a", F.col("x.b").alias("b"), F.col("y.b").alias("closest")))
    beside = sketch_links(buckets(mixed(following(hashes, chosen))), nodes)
    families = held(components(near_hubs.select("a", "b").union(beside), LINKS_OF_TASK))
    wanted = families.join(nodes.select("node", "row.*"), "node")
    text, doc_id = text_of(docs), column(docs, "doc_id")
    texts = docs.select(F.xxhash64(doc_id, text).alias("rid"), F.hash(text, doc_id).alias("rid2"), text.alias("text"))

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "members": [s.view(np.int64) for s in sets_of(pdf["text"], shingle)]})

    read = texts.join(wanted, ["rid", "rid2"]).select("node", "text").dropDuplicates(["node"])
    sets = held(read.mapInPandas(members, "node long, members array<long>"))

    asked = chosen.select("a", "b").union(chosen.select("a", F.col("closest").alias("b"))).distinct()
    confirmed = held(verified(asked, sets))
    leads = confirmed.join(near_hubs.select("a", "b", "score"), ["a", "b"]).groupBy("a").agg(F.max(F.struct("score", "b")).alias("x"))
    inside = mixed(following(families.withColumnRenamed("component", "key"), leads.select("a", F.col("x.b").alias("b"))))
    inside = inside.join(nodes.select("node", "n", "sketch"), "node").join(sets, "node")
    found = components(confirmed.union(set_links(inside)), LINKS_OF_TASK)
    found = found.withColumnRenamed("component", "comp")
    groups = nodes.select("node", "digest", "least").join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = groups.groupBy("comp").agg(F.min("least").alias("component_id"))
    groups = groups.join(named, "comp").select("digest", "component_id")
    linked = rows.filter("digest IS NOT NULL").join(groups, "digest")
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*out).unionByName(rows.filter("digest IS NULL").withColumn("component_id", F.col("doc_id")).select(*out))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
