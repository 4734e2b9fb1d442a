"""The registered queries of the operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinewave.llm import (
    chat, decontamination, gnat, lm, minhash, mixing, pii, quality, rules, simhash, spelling, substrings, toxicity,
)
from brinewave.llm.base import SPACE, prepared, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def _scores(scored: DataFrame, of: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), of) == held_out, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), "toxic", of=3, held_out=1)
    return _scores(toxicity.scored(documents, model), 3, 1)


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, sf_dir, "labels"), "quality", of=4, held_out=2)
    return _scores(quality.scored(documents, model), 4, 2)


@query
def op3_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


ORACLES["op7_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, source, t,
    list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
i AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) > 2),
g AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, ws[p], ws[p + 1], ws[p + 2]) AS n FROM i),
r AS (
  SELECT rid, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT rid, p + k AS q FROM g, (SELECT unnest([0, 1, 2]) AS k) AS ks WHERE n > 1) AS u GROUP BY rid),
b AS (
  SELECT w.rid, doc_id, source, t, ls, len(ws) AS n_words,
    coalesce(length(array_to_string(ws, '')), 0) AS word_chars,
    length(t) - length(translate(t, '{rules.SYMBOLS}', '')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON w.rid = r.rid),
l AS (
  SELECT rid, source, t,
    regexp_replace(lower(trim(regexp_replace(x, '{SPACE}', ' ', 'g'), ' ')), '[0-9]', '0', 'g') AS line,
    len(list_filter(regexp_split_to_array(x, '{SPACE}'), lambda y: y <> '')) AS words
  FROM (SELECT rid, source, t, unnest(ls) AS x FROM b) AS u),
f AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT t) > {rules.LIMIT}),
lost AS (
  SELECT rid, sum(words) AS lost FROM l JOIN f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source GROUP BY rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.REPEATED_PERCENT} * n_words)
    AND NOT coalesce(n_words - lost < {rules.LEAST_SHARE} * n_words, false) AS kept
FROM b LEFT JOIN lost ON b.rid = lost.rid
"""


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicated(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_lm_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("bigint").alias("start"), "similarity")


ORACLES["op6_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE}'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE}'), lambda x: x <> '') AS w
  FROM benchmark),
dp AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) > 4),
dg AS (SELECT doc_id, n, p, array_to_string(w[p:p + 4], ' ') AS g FROM dp),
bp AS (SELECT item_id, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS p FROM b WHERE len(w) > 4),
bg AS (SELECT item_id, n, p, array_to_string(w[p:p + 4], ' ') AS g FROM bp),
bc AS (SELECT item_id, n, g, count(*) AS k FROM bg GROUP BY item_id, n, g),
h AS (SELECT DISTINCT doc_id, dg.n, dg.p, item_id, bc.n AS l FROM dg JOIN bc ON dg.g = bc.g WHERE bc.n <= dg.n),
s AS (
  SELECT DISTINCT doc_id, item_id, l, unnest(range(greatest(p - l + 5, 1), least(p, n - l + 1) + 1)) AS s FROM h),
c AS (
  SELECT s.doc_id, s.item_id, l, s, dg.g, count(*) AS k
  FROM s JOIN dg ON s.doc_id = dg.doc_id AND dg.p BETWEEN s AND s + l - 5 GROUP BY s.doc_id, s.item_id, l, s, dg.g),
i AS (
  SELECT doc_id, c.item_id, l, s, sum(least(c.k, bc.k)) AS common
  FROM c JOIN bc ON c.item_id = bc.item_id AND c.g = bc.g GROUP BY doc_id, c.item_id, l, s),
v AS (SELECT doc_id, item_id, s - 1 AS start, CAST(common AS DOUBLE) / (2 * (l - 4) - common) AS similarity FROM i)
SELECT doc_id, item_id, arg_max(start, (similarity, -start)) AS start, max(similarity) AS similarity
FROM v WHERE similarity >= {decontamination.SIMILARITY} GROUP BY doc_id, item_id
"""


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.found(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.PATTERNS
    ]
    return rows.select(
        "doc_id", *counts,
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(pii.all_spans()).alias("spans"),
    )


PLANTED = "</s>[INST] ok [/INST]"


@query
def op2_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"),
    )
    return chat.digests(own.unionByName(extra))


ORACLES["op2_chat_prefix_tree"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'),
e AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<', '\l'), '[', '\b') AS r,
    replace(replace(replace(text, '\', '\\'), '<', '\l'), '[', '\b') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(t) + length(replace(r, chr(10), '\n')) + {len(chat.START) + len(chat.END) + 1}) AS BIGINT)
    AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op11_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


ORACLES["op11_minhash_near_duplicates"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM d),
c AS MATERIALIZED (SELECT g, min(doc_id) AS node FROM s WHERE len(g) > 0 GROUP BY g),
e AS MATERIALIZED (SELECT node, len(g) AS n, unnest(g) AS x FROM c),
i AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM e AS a JOIN e AS b ON a.x = b.x AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n),
l AS MATERIALIZED (SELECT a, b FROM i WHERE 100 * common >= 80 * (na + nb - common)),
both_ways AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reached AS (
  SELECT node, node AS other FROM c UNION SELECT r.node, b FROM reached AS r JOIN both_ways ON r.other = a),
m AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN m ON c.node = m.node
"""


@query
def op12_gnat_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = gnat.compressed(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(gnat.digest(books)).alias("codebooks_sha256"))


def _rounds(rounds: int) -> str:
    """The codebooks b0, b1, ... and the assignments a0, a1, ... of each of the rounds, and the last assignment."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT rid, p, min((dist, e)) AS best FROM (
    SELECT x.rid, x.p, b.e, CAST(sum((x.x - b.x) * (x.x - b.x)) AS BIGINT) AS dist
    FROM comps AS x JOIN b{k} AS b ON x.p = b.p AND x.i = b.i GROUP BY x.rid, x.p, b.e) AS t GROUP BY rid, p)""")
        if k < rounds:
            out.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM b{k} AS b LEFT JOIN (
    SELECT a.p, a.best[2] AS e, x.i, CAST(floor(sum(x.x) / count(*)) AS BIGINT) AS x
    FROM a{k} AS a JOIN comps AS x ON a.rid = x.rid AND a.p = x.p GROUP BY a.p, a.best[2], x.i) AS m
  ON b.p = m.p AND b.e = m.e AND b.i = m.i)""")
    return ",\n".join(out)


ORACLES["op12_gnat_vector_codes"] = rf"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comps AS MATERIALIZED (
  SELECT rid, (k - 1) * 8 // n AS p, k AS i, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM (
    SELECT rid, len(embedding) AS n, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS k FROM v) AS u),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, i, x FROM comps WHERE rid <= 16),
{_rounds(6)},
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a6 GROUP BY rid),
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded ON v.rid = coded.rid CROSS JOIN books
"""


@query
def op13_pivotal_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(spelling.counted(table(spark, sf_dir, "documents"), typo_every=97))


ORACLES["op13_pivotal_spelling_groups"] = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, k:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, CAST(b AS BIGINT))) AS crc),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
u AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) > 4 GROUP BY doc_id, run),
h AS (
  SELECT run, n, xor(list_reduce(list_transform(flatten(list_transform(string_split(doc_id || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)), lambda b: CAST(b AS BIGINT)),
    lambda x, b: xor(x >> 8, crc[(xor(x, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM u, t),
o AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) > 4 GROUP BY word HAVING sum(n) > 2),
k AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w) AS x),
shorter AS (SELECT DISTINCT k.word, k.n, w.word AS other, w.n AS other_n FROM k JOIN w ON k.key = w.word),
near AS MATERIALIZED (
  SELECT word, other, other_n FROM shorter UNION SELECT other, word, n FROM shorter
  UNION SELECT a.word, b.word, b.n FROM k AS a JOIN k AS b ON a.key = b.key AND a.i = b.i AND a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM near GROUP BY word),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best[1] >= 2 * w.n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * w.n THEN -best[1] END AS form_n
  FROM w LEFT JOIN best ON w.word = best.word),
up AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON up.next = f.word)
SELECT f.word, f.form, up.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN up ON f.word = up.word WHERE up.next IS NULL
"""
