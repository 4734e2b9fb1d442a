"""Personal data: patterns for the entities, and terms of the corpus that disclose them.

Entities are found by patterns with checks. Corpus co-occurrence tells how strongly a term reveals an entity: with
``N`` word positions in the corpus, ``n_e`` different contexts of an entity, ``n_t`` uses of a term and ``n_et`` contexts
of the entity that hold the term, the pointwise mutual information log(N n_et / (n_e n_t)) is compared with the
information of the entity, log(N / n_e). A term that only occurs beside an entity has the ratio 1: it discloses the entity
fully. From ``REMOVE`` on, a term is removed wherever it stands; from ``GENERALISE`` on, it is replaced by a general word. Terms need
``SUPPORT`` different contexts with the entity; copies of a text are one context.

All of it is DataFrame functions. Words meet the terms in question in a join whose small side is broadcast only if
its counted rows are within ``BROADCAST_ROWS``; counts are combined before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import boxed, column, held, materialised, text_of, unboxed

KINDS = ["email", "ip", "card", "phone", "removed", "generalised"]
# Each pattern finds what its plain form finds from left to right: a run of characters is read once and not given
# back (++), and a match starts where a run starts or where the match before ended (\G). A gate is a cheap test that
# holds in every text with a match that passes the checks.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATES = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
MASKS = {
    "email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": "[REMOVED]", "generalised": "[TERM]",
}
AROUND, REACH = 8, 100
SUPPORT = 3
REMOVE, GENERALISE = 0.95, 0.8
BROADCAST_ROWS = 500_000
ROW = ["rid", "rid2"]
SPAN = "array<struct<start:int,no:int,end:int,kind:string>>"
NOT_LETTERS = r"[^\p{L}]+"


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    back = F.reverse(digits(match))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, 1).cast("int")  # type: ignore[arg-type]
        return total + F.when(i % 2 == 1, d).when(d < 5, d * 2).otherwise(d * 2 - 9)

    return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(part, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(digits(match)).between(14, 19) & luhn(match)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def placed(text: Column, pattern: Column, no: Column, kind: Column, check) -> Column:
    """The matches of a pattern that pass, with code point places: the pieces between the matches give them."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), no.alias("no"), end.alias("end"), kind.alias("kind"))
        ok = F.coalesce(check(x["match"]), F.lit(False))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, start, step)["out"]


def base_spans(text: Column) -> Column:
    """Spans of all base kinds, by start and then kind. Matches that fail their check are dropped."""
    found = []
    for no, kind in enumerate(PATTERNS):
        spans = placed(text, F.lit(PATTERNS[kind]), F.lit(no), F.lit(kind), lambda m, k=kind: m.isNotNull() & passes(k, m))
        found.append(F.when(text.rlike(GATES[kind]), spans).otherwise(F.array().cast(SPAN)))
    return F.array_sort(F.concat(*found))


def letters(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_LETTERS), lambda w: F.length(w) > 2)


def with_row(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select(
        column(docs, "doc_id").alias("doc_id"), text.alias("_t"),
        F.xxhash64(column(docs, "doc_id"), text).alias("rid"), F.hash(text, column(docs, "doc_id")).alias("rid2"),
    )


def contexts(rows: DataFrame, base: DataFrame) -> DataFrame:
    """``rid, rid2, entity, context, terms``: the words around each use of an entity."""
    private = base.filter(F.size("spans") > 0).select(*ROW, "spans").dropDuplicates(ROW)
    each = rows.join(small(private), ROW).select(*ROW, "_t", F.explode("spans").alias("s"))
    start, end = F.col("s.start"), F.col("s.end")
    low = F.greatest(start - REACH, F.lit(0))
    before = letters(F.col("_t").substr(low + 1, start - low))
    after = letters(F.col("_t").substr(end + 1, F.lit(REACH)))
    n = F.size(before)
    near = F.concat(
        F.slice(before, F.greatest(n - (AROUND - 1), F.lit(1)), F.lit(AROUND)), F.slice(after, 1, AROUND)
    )
    value = F.lower(F.col("_t").substr(start + 1, end - start))
    found = each.select(*ROW, F.concat_ws(":", F.col("s.kind"), value).alias("entity"), F.array_distinct(near).alias("terms"))
    return found.withColumn("context", F.xxhash64("terms"))


def ratio(total: int, n_e: Column, n_t: Column, n_et: Column) -> Column:
    """Mutual information of term and entity by the information of the entity. A context counts copies once, so the
    uses beside an entity never exceed all uses."""
    n = F.lit(float(max(total, 2)))
    information = F.log(n / n_e)
    return F.when(information > 0, F.log(n * n_et / (n_e * F.greatest(n_t, n_et))) / information)


def disclosing(rows: DataFrame, base: DataFrame) -> DataFrame:
    """``term, ratio`` of the terms that disclose some entity, by their strongest entity; every word of ``_t`` counts.

    The documents whose contexts hold a term bound its uses from below, and with that its ratio from above: terms
    that cannot reach ``GENERALISE``, all common words among them, are dropped before their counts are joined.
    """
    uses = held(contexts(rows, base))
    found = uses.dropDuplicates(["entity", "context"])
    entities = found.groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= SUPPORT)
    pairs = found.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    least = uses.select(*ROW, F.explode("terms").alias("term")).distinct().groupBy("term").agg(F.count("*").alias("least"))
    pairs = pairs.filter(F.col("n_et") >= SUPPORT).join(entities, "entity").join(least, "term")
    total = rows.select(F.sum(F.size(letters(F.col("_t"))).cast("bigint"))).first()[0] or 0
    most = ratio(total, F.col("n_e"), F.col("least"), F.col("n_et"))
    pairs = held(pairs.filter(most >= GENERALISE).drop("least"))
    words = rows.select(F.explode(letters(F.col("_t"))).alias("term"))
    # all words are counted before they meet the terms, so that the join makes a row a term and not a row a use
    used = words.groupBy("term").agg(F.count("*").alias("n_t")).join(small(pairs.select("term").distinct()), "term")
    told = pairs.join(used, "term").withColumn("ratio", ratio(total, F.col("n_e"), F.col("n_t"), F.col("n_et")))
    return told.groupBy("term").agg(F.max("ratio").alias("ratio")).filter(F.col("ratio") >= GENERALISE)


def found(docs: DataFrame) -> DataFrame:
    """``doc_id, rid, rid2, base, added``: base spans and the spans of disclosing terms outside them.

    Null text is empty and has no spans. Repeated rows (equal id and text) are found once each. Rows without doc_id are
    searched and counted like any other. Other columns are ignored. An empty table gives no row.
    """
    rows = with_row(docs)
    rows = materialised(rows, spans=base_spans(F.col("_t")))
    base = held(rows.select("doc_id", *ROW, "spans"))
    terms = held(disclosing(with_row(docs), base))
    words = with_row(docs).select(*ROW, F.explode(F.array_distinct(letters(F.col("_t")))).alias("term"))
    hits = words.join(small(terms), "term").groupBy(*ROW).agg(
        F.collect_set(F.when(F.col("ratio") >= REMOVE, F.col("term"))).alias("remove"),
        F.collect_set(F.when(F.col("ratio") < REMOVE, F.col("term"))).alias("generalise"),
    )
    texts = with_row(docs).join(hits, ROW).dropDuplicates(ROW)

    def located(terms: str, no: int) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}])(?:"), F.array_join(terms, "|"), F.lit(r")(?![\p{L}])"))
        spans = placed(F.col("_t"), pattern, F.lit(no), F.lit(KINDS[no]), lambda m: m.isNotNull())
        return F.when(F.size(terms) > 0, spans).otherwise(F.array().cast(SPAN))

    added = texts.select(*ROW, F.concat(located("remove", 4), located("generalise", 5)).alias("terms"))
    out = base.join(added, ROW, "left")
    apart = F.filter(
        F.coalesce("terms", F.array().cast(SPAN)),
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return out.select("doc_id", *ROW, F.col("spans").alias("base"), apart.alias("added"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans() -> Column:
    return F.array_sort(F.concat("base", "added"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by the mask of its kind (overlapping ones by the first one's), all columns.

    Texts without spans, null ones too, stay as they are.
    """
    spans = found(docs).select(*ROW, all_spans().alias("_spans")).filter(F.size("_spans") > 0).dropDuplicates(ROW)
    text = text_of(docs)
    keyed = boxed(docs, _t=text, rid=F.xxhash64(column(docs, "doc_id"), text), rid2=F.hash(text, column(docs, "doc_id")))
    joined = keyed.join(spans, ROW, "left")
    masks = F.create_map(*[F.lit(x) for pair in MASKS.items() for x in pair])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.col("_t").substr(acc["at"] + 1, s["start"] - acc["at"])
        more = F.concat(acc["out"], between, masks[s["kind"]])
        new = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(s["end"], acc["at"]).alias("at"), F.when(new, more).otherwise(acc["out"]).alias("out")
        )

    folded = F.aggregate("_spans", start, step)
    masked = F.concat(folded["out"], F.col("_t").substr(folded["at"] + 1, F.length("_t")))
    return unboxed(joined, text=F.when(F.col("_spans").isNull(), F.col("_box.text")).otherwise(masked))
