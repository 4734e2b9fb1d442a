from __future__ import annotations

import pytest

HEAD = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    def make(*texts, source="s", ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, HEAD)

    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows and extra columns with the operators' own names."""
    long = "word other " * 30_000
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", "b", 3),
        (4, "one", "en", "b", 3), (None, "one two three four", "en", "b", 18), (None, None, None, None, None),
        (5, long, "en", "b", len(long)), (6, "naïve ẞtraße 10.0.0.1 x@y.zz \U0001f600", "de", None, 30),
    ]
    more = ["score", "words", "key", "spans", "component", "size", "label", "_fp", "rid", "hashes", "n", "_t"]
    df = spark.createDataFrame(rows, HEAD)
    for c in more:
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1 if i % 2 else 0, 1 if i % 2 else 0) for i in range(200)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
