"""Mixing sources to target weights by pivotal dependent rounding.

Sources get weights in code point order; their targets share the words of all documents by weight, stop at ``most``
times the source's size, and the excess goes to the others by weight until none is above. A document of a source is
copied ``target / size`` times in expectation: its whole part surely, its fraction by pivotal rounding. Two fractional
documents meet, and words of mass go over from one to the other at random until one is integral; the other meets the
next. Where a large document meets a small one, the small one closes, so what is left open in the end is large.
Documents are therefore rounded by classes of size, the largest first: what the last document of a class brings more or less
than its mass is made up by the fraction of all smaller documents of the source, in proportion to their sizes. Only the last
document of a source's smallest class misses the target, by half its words at most (more only where the smaller documents
together cannot make up for a large one).

Rounding is a reduction tree: level 0 deals the documents of a source and class to blocks by hash and rounds each block by
itself. Every block leaves one document at most that is still fractional; those meet in the blocks of the next level,
until one is left, which is drawn by its mass, or rounded to the nearer side in the source's smallest class. A source with a third of all rows
is many blocks. Draws are hashes of the documents' contents, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinewave.llm.base import SPACE, boxed, column, held, text_of, unboxed

BLOCK = 64
NEAR = 1e-9
CLASSES = (2048, 256, 32, 0)  # a document belongs to the first class whose size it has at least


def words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACE), lambda w: w != "")).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in code point order, null last: within ranges of sources, then offset by the ranges before."""
    ordered = sources.repartitionByRange(F.col("_source").asc_nulls_last())
    ordered = held(ordered.withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy("_part").orderBy(F.col("_source").asc_nulls_last())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    counts = ordered.groupBy("_part").agg(F.count("*").alias("n"))
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(within) - 1 + F.col("_offset")
    return ordered.join(offsets, "_part").withColumn("rank", rank).drop("_part", "_offset")


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The columns of ``sizes`` (``_source, source_size`` and more) and ``target``: capped shares, the excess dealt anew.

    The driver only sees the two sums of each round; a round caps sources or ends.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    each = ranked(sizes).withColumn("_w", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    each = held(each.withColumn("_cap", F.col("source_size") * F.lit(most)))
    total = each.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("_w") * F.lit(level) > F.col("_cap")
        taken, left, n = each.agg(
            F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_w"))), F.count(F.when(full, 1))
        ).first()
        if n == capped or left is None:
            break
        capped, level = n, (total - (taken or 0.0)) / left
    target = F.col("_cap") if level is None else F.least(F.col("_w") * F.lit(level), F.col("_cap"))
    return each.select(*sizes.columns, target.alias("target"))


def _draw(*parts: Column) -> Column:
    """A uniform number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def _rounded(block: DataFrame, level: int) -> DataFrame:
    """Pivotal rounding along each block: ``_fold`` has the decided places with 0 or 1 copy, and the open place with
    its mass.

    Two documents with masses a of size s and b of size t meet: either min(a, t - b) words go over from the first to
    the second or min(b, s - a) from the second to the first, with the odds that keep both expectations. The sum of
    words stays, and one of the two is then empty or full.
    """
    decided = "array<struct<at:int,up:double>>"
    start = F.struct(
        F.lit(-1).alias("at"), F.lit(0.0).alias("m"), F.lit(0.0).alias("s"), F.array().cast(decided).alias("done")
    )

    def state(at: Column, m: Column, s: Column, done: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), m.alias("m"), s.alias("s"), done.alias("done"))

    def put(done: Column, at: Column, m: Column, s: Column) -> Column:
        up = F.when(m * 2 > s, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.concat(done, F.array(F.struct(at.cast("int").alias("at"), up.alias("up"))))

    def meet(acc: Column, x: Column) -> Column:
        there, back = F.least(acc["m"], x["s"] - x["m"]), F.least(x["m"], acc["s"] - acc["m"])
        move = F.when(x["u"] * (there + back) < back, there).otherwise(-back)
        a, b = acc["m"] - move, x["m"] + move
        closed = settled(a, acc["s"])
        met = F.when(closed, state(x["at"], b, x["s"], put(acc["done"], acc["at"], a, acc["s"]))).otherwise(
            state(acc["at"], a, acc["s"], put(acc["done"], x["at"], b, x["s"]))
        )
        first = state(x["at"], x["m"], x["s"], acc["done"])
        passed = state(x["at"], x["m"], x["s"], put(acc["done"], acc["at"], acc["m"], acc["s"]))
        return F.when(acc["at"] < 0, first).when(settled(acc["m"], acc["s"]), passed).otherwise(met)

    entries = F.transform("_rows", lambda x, i: F.struct(
        i.alias("at"), x["m"].alias("m"), x["size"].cast("double").alias("s"), _draw(x["key"], F.lit(level)).alias("u")
    ))
    return block.withColumn("_fold", F.aggregate(entries, start, meet))


def _decided(each: DataFrame, most_rows: int) -> list[DataFrame]:
    """``each`` with ``up``, 0 or 1, in every row, in parts: the rows whose ``up`` is given, and those of each level of the tree.

    A source has ``most_rows`` rows at most.
    """
    done = [each.filter("up IS NOT NULL").drop("_last", "n")]
    open_ = each.filter("up IS NULL")
    sources_of = ["_source", "source_size", "target", "n", "_last"]
    level = 0
    while True:
        blocks = F.ceil(F.col("n") / F.lit(float(BLOCK) ** (level + 1)))
        block = F.pmod(F.xxhash64("key", F.lit(level)), F.greatest(blocks, F.lit(1)))
        entry = F.struct("size", "key", "m", "_row", "_whole")
        grouped = open_.groupBy(*sources_of, block.alias("_block")).agg(
            F.sort_array(F.collect_list(entry), asc=False).alias("_rows")
        )
        top = most_rows <= BLOCK ** (level + 1)
        fold = _rounded(grouped, level)
        flat = fold.select(*sources_of, "_fold.at", "_fold.m", F.sort_array("_fold.done").alias("_done"), "_rows")
        # every place but the open one is decided: in order of place, those are the rows without it
        others = F.filter("_rows", lambda x, i: i != F.col("at"))
        pairs = F.zip_with(others, "_done", lambda r, d: F.struct(r.alias("r"), F.lit(0.0).alias("m"), d["up"].alias("up")))
        left = F.element_at("_rows", F.col("at") + 1)
        size = left["size"].cast("double")
        nearer = F.when(F.col("m") * 2 >= size, F.lit(1.0)).otherwise(F.lit(0.0))
        up = F.when(settled(F.col("m"), size), nearer)
        if top:
            drawn = F.when(_draw(left["key"], F.lit(-1)) * size < F.col("m"), F.lit(1.0)).otherwise(F.lit(0.0))
            up = F.coalesce(up, F.when(F.col("_last"), nearer).otherwise(drawn))
        rest = F.struct(left.alias("r"), F.col("m").alias("m"), up.alias("up"))
        every = flat.select(*sources_of, F.explode(F.concat(pairs, F.array(rest))).alias("x"))
        level_rows = held(every.select(*sources_of, "x.r.size", "x.r.key", "x.m", "x.r._row", "x.r._whole", "x.up"))
        done.append(level_rows.filter("up IS NOT NULL").drop("_last", "n"))
        if top:
            return done
        open_ = level_rows.filter("up IS NULL")
        level += 1


def settled(m: Column, s: Column) -> Column:
    return (m < NEAR) | (s - m < NEAR)


def mixed(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0, source: str = "source",
          payload: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``payload`` columns of every row with ``key, size, source_size, target, copies, taken``.

    ``taken`` is size times copies, ``key`` a hash of id and text. Null text has size 0; the null source comes last; a source without words has target
    0 and gives no copies. Repeated rows are rounded one by one. An empty table gives no row. Other columns are ignored.
    """
    rows = docs.select(
        F.struct(*[column(docs, c).alias(c) for c in payload]).alias("_row"),
        column(docs, source).cast("string").alias("_source"),
        text_of(docs).alias("_text"),
        (column(docs, "doc_id") if "doc_id" in docs.columns else F.lit(None)).cast("string").alias("_id"),
    )
    rows = held(rows.select("_row", "_source", words(F.col("_text")).alias("size"), F.xxhash64("_id", "_text").alias("key")))
    rank = F.lit(len(CLASSES) - 1)
    for k, least in reversed(list(enumerate(CLASSES[:-1]))):
        rank = F.when(F.col("size") >= least, F.lit(k)).otherwise(rank)
    rows = rows.withColumn("_class", rank)
    per_class = [F.sum(F.when(F.col("_class") == k, F.col("size"))).alias(f"_s{k}") for k in range(len(CLASSES))]
    counts = [F.count(F.when(F.col("_class") == k, F.lit(1))).alias(f"_n{k}") for k in range(len(CLASSES))]
    totals = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), *per_class, *counts).fillna(0)
    sources = targets(totals, weights, most).withColumnRenamed("_source", "_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + NEAR)
    sources = sources.withColumns({"_whole": whole.cast("int"), "_open": F.col("target") - whole * F.col("source_size")})
    sources = held(sources)
    most_rows = sources.agg(*[F.max(f"_n{k}") for k in range(len(CLASSES))]).first()
    done: list[DataFrame] = []
    for k in range(len(CLASSES)):
        smaller = [F.col(f"_s{j}") for j in range(k + 1, len(CLASSES))]
        rest = reduce(Column.__add__, [F.col(f"_s{k}"), *smaller])
        fraction = F.when(rest > 0, F.greatest(F.least(F.col("_open") / rest, F.lit(1.0)), F.lit(0.0))).otherwise(F.lit(0.0))
        is_last = reduce(Column.__add__, smaller) == 0 if smaller else F.lit(True)
        here = sources.select("_s", "source_size", "target", F.col(f"_n{k}").alias("n"), "_whole", fraction.alias("_f"), is_last.alias("_last"))
        each = rows.filter(F.col("_class") == k).join(here, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s", "_class")
        mass = F.when(F.col("_f") < NEAR, F.lit(0.0)).when(F.col("_f") > 1 - NEAR, F.col("size").cast("double")).otherwise(F.col("_f") * F.col("size"))
        each = each.withColumn("m", mass).drop("_f")
        up = F.when(F.col("m") == 0, F.lit(0.0)).when(F.col("m") == F.col("size"), F.lit(1.0))
        parts = _decided(each.withColumn("up", up), most_rows[k] or 0)
        done += parts
        if smaller:
            sums = [p.groupBy("_source").agg(F.sum(F.col("up") * F.col("size")).alias("_got")) for p in parts]
            got = reduce(DataFrame.unionByName, sums).groupBy(F.col("_source").alias("_g")).agg(F.sum("_got").alias("_got"))
            joined = sources.join(got, F.col("_s").eqNullSafe(F.col("_g")), "left").drop("_g")
            sources = held(joined.withColumn("_open", F.col("_open") - F.coalesce("_got", F.lit(0.0))).drop("_got"))
    out = None
    for part in done:
        copies = (F.col("_whole") + F.col("up").cast("int")).cast("bigint")
        part = part.select(
            "_row.*", "key", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
        )
        out = part if out is None else out.unionByName(part)
    return out


def taken(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The rows of ``docs`` in the mix, all columns, with ``copies`` and ``taken`` words; rows with equal id and text are
    one row with the copies of all."""
    plan = mixed(docs, weights, most).filter("copies > 0")
    plan = plan.groupBy(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).agg(
        F.sum("copies").alias("copies"), F.sum("taken").alias("taken")
    )
    keyed = boxed(docs, _key=F.xxhash64(column(docs, "doc_id").cast("string"), text_of(docs)), _own=column(docs, "doc_id"))
    found = keyed.join(plan, "_key").filter(F.col("_own").eqNullSafe(F.col("_id"))).dropDuplicates(["_key", "_own"])
    return unboxed(found, copies=F.col("copies"), taken=F.col("taken"))
