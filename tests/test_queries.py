"""Every registered query against its check SQL, and the shape of the driver contract."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from brinewave.queries import load

QUERIES, ORACLES = load()
NAMES = list(QUERIES)

@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, connection, sf_dir, name):
    found = differences(spark, connection, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert [d for d in found if d != "no rows"] == []


def test_every_query_is_checked():
    assert set(NAMES) == set(ORACLES)
    assert set(NAMES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert {"station", "yday", "predicted_mean_temp", "mean_temp", "diff"} <= set(df.columns)
