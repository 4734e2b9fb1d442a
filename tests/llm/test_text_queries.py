"""Every registered query of the operators against its check SQL."""

from __future__ import annotations

import pytest
from compare import differences, duck

import corpus_pipeline
from brinewave.llm import queries

WITHOUT_SQL = {
    "op1_pii", "op3_pivotal_mixing", "op4_toxicity", "op5_quality_classifier", "op8_lm_stupid_backoff",
    "op9_simhash_near_duplicates", "op10_substring_dedup",
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir) == []


def test_queries_without_sql():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_registered(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    bench = {r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() <= n
        n = docs.count()
        if k < 4:
            assert docs.columns == columns
        if name == "benchmark decontamination":
            assert not [r for r in docs.collect() if any(b in r["text"] for b in bench)]
        if name == "simhash near-dedup":
            assert docs.count() == docs.select("doc_id").distinct().count()
    assert docs.filter("copies < 1").count() == 0
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))
