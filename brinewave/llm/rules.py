"""Quality rules: counts on each text, and lines that too many documents of one host share.

Lines are normalised (ASCII white space squeezed, lower case, digits to 0) and hashed. For each host the distinct documents
that hold a line are counted; exact copies are one document. Lines in more than ``limit`` documents of their host are
removed, and a document that keeps less than ``least_share`` of its words is depleted and rejected.

Everything is DataFrame functions. A line is counted once a document before the shuffle and combined on the map side,
so a line of a third of all documents is a few rows; verdicts depend on (host, text) alone and return by that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import SPACE, boxed, column, held, materialised, split_words, text_of, unboxed

SYMBOLS = "#*$%&|<>"
LIMIT = 100
LEAST_SHARE = 0.2
LEAST_WORDS = 50
REPEATED_PERCENT = 50


def normalised(line: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(line, SPACE, " "))
    return F.regexp_replace(F.lower(squeezed), "[0-9]", "0")


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def with_counts(df: DataFrame, text: str = "_text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the non-null column ``text``.

    ``n_repeat_words`` counts the words inside three-word windows found twice or more: windows are hashed, sorted by
    hash and position, and equal neighbours give the positions whose union is measured.
    """
    t = F.col(text)
    lines = F.filter(F.split(t, "\n"), has_word)
    df = materialised(df, _words=split_words(t), _lines=lines)
    w = F.col("_words")
    n = F.size(w)
    zipped = F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(n, F.lit(1))).alias("b"),
                          F.slice(w, 3, F.greatest(n, F.lit(1))).alias("c"))
    windows = F.transform(
        F.slice(zipped, 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("p")),
    )
    df = materialised(
        df,
        _sorted=F.sort_array(windows),
        n_words=n.cast("bigint"),
        word_chars=F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("bigint"),
        n_symbols=(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    ).drop("_words")
    s = F.col("_sorted")
    m = F.size(s)
    same = F.zip_with(s, F.slice(s, 2, F.greatest(m, F.lit(1))), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    df = materialised(df, _next=same, _at=F.transform(s, lambda x: x["p"])).drop("_sorted")
    before = F.concat(F.array(F.lit(False)), F.slice("_next", 1, F.greatest(F.size("_next") - 1, F.lit(0))))
    repeated = F.filter(
        F.arrays_zip(F.col("_at").alias("p"), F.col("_next").alias("n"), before.alias("b")), lambda x: x["n"] | x["b"]
    )
    covered = F.aggregate(
        F.sort_array(F.transform(repeated, lambda x: x["p"])),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, p: F.struct((p + 3).alias("end"), (acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n")),
    )["n"]
    return df.withColumn("n_repeat_words", covered.cast("bigint")).drop("_next", "_at")


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row a document: ``doc_id``, the counts, the key ``_host, _hash`` and its lines, computed once."""
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, host).alias("_source"), text_of(docs).alias("_text"))
    rows = with_counts(rows)
    lines = F.transform("_lines", lambda x: F.struct(line_hash(x).alias("line"), F.size(split_words(x)).alias("words")))
    return held(rows.select(
        "doc_id", F.xxhash64("_source").alias("_host"), F.xxhash64("_text").alias("_hash"), lines.alias("_lines"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    ))


def _texts(rows: DataFrame) -> DataFrame:
    """Each line of each distinct (host, text), with how often and at how many words it stands there."""
    texts = rows.groupBy("_host", "_hash").agg(F.min("_lines").alias("_lines"))
    each = texts.select("_host", "_hash", F.explode("_lines").alias("x"))
    return each.select("_host", "_hash", F.col("x.line").alias("line"), F.col("x.words").alias("words"))


def frequent_lines(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``_host, line`` of the lines in more than ``limit`` distinct documents of a host."""
    lines = F.array_distinct(F.transform("_lines", lambda x: x["line"]))
    texts = rows.groupBy("_host", "_hash").agg(F.min("_lines").alias("_lines"))
    counted = texts.select("_host", F.explode(lines).alias("line")).groupBy("_host", "line").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") > limit).select("_host", "line")


def depleted(rows: DataFrame, frequent: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``_host, _hash`` of the texts that keep less than ``least_share`` of their words without frequent lines."""
    lost = _texts(rows).join(frequent, ["_host", "line"]).groupBy("_host", "_hash").agg(F.sum("words").alias("lost"))
    sizes = rows.groupBy("_host", "_hash").agg(F.max("n_words").alias("n"))
    left = F.col("n") - F.col("lost")
    return lost.join(sizes, ["_host", "_hash"]).filter(left < F.lit(least_share) * F.col("n")).select("_host", "_hash")


def judged(docs: DataFrame, host: str = "source", limit: int = LIMIT, least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed`` and ``kept`` of every row.

    Null text counts as empty: no words, so it fails. A null host is a host of its own. Repeated rows give repeated
    results; copies of one text in a host get one verdict. Rows without doc_id are judged like any other. Columns
    other than the id, the text and the host are ignored. An empty table gives no row.
    """
    rows = measured(docs, host)
    out = depleted(rows, frequent_lines(rows, limit), least_share).withColumn("_out", F.lit(True))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.drop("_lines").join(out, ["_host", "_hash"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("_out").isNull()).alias("kept"),
    )


def cleaned(docs: DataFrame, host: str = "source", limit: int = LIMIT) -> DataFrame:
    """``docs`` with the frequent lines of its host removed from every text; other texts and columns stay as they are."""
    rows = measured(docs, host)
    bad = _texts(rows).join(frequent_lines(rows, limit), ["_host", "line"])
    bad = bad.groupBy("_host", "_hash").agg(F.collect_set("line").alias("_bad"))
    keyed = boxed(docs, _host=F.xxhash64(column(docs, host)), _hash=F.xxhash64(text_of(docs)))
    kept = F.filter(F.split(F.col("_box.text"), "\n"), lambda x: ~F.array_contains("_bad", line_hash(x)))
    text = F.when(F.col("_bad").isNull(), F.col("_box.text")).otherwise(F.array_join(kept, "\n"))
    return unboxed(keyed.join(bad, ["_host", "_hash"], "left"), text=text)
