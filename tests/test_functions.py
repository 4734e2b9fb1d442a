from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinewave.functions import dates, labels, nulls, numeric


def values(df):
    return [tuple(r) for r in df.collect()]


def test_strict_aggregates_and_standard_error(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None), ("c", 5.0)], "k string, v double"
    )
    out = df.groupBy("k").agg(
        nulls.strict_mean("v"),
        nulls.strict_sum("v"),
        nulls.strict_sd("v"),
        nulls.standard_error("v"),
        nulls.share_true(F.col("v") > 2),
    )
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got["a"] == (2.0, 4.0, pytest.approx(2**0.5), pytest.approx(1.0), 0.5)
    assert got["b"] == (None, None, None, None, None)
    assert got["c"] == (5.0, 5.0, None, None, 1.0)


def test_standard_error_counts_missing_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "v double")
    assert df.agg(nulls.standard_error("v")).first()[0] == pytest.approx(2**0.5 / 2)


def test_not_in_keeps_missing_and_ratio_survives_zero(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert [r.v for r in df.filter(nulls.not_in("v", [1])).collect()] == [2, None]
    assert df.select(nulls.ratio("v", F.lit(0))).first()[0] is None


def test_row_sums(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None)], "a int, b int")
    assert values(df.select(nulls.row_sum(["a", "b"]), nulls.row_sum_present(["a", "b"]))) == [
        (3, 3),
        (None, 2),
        (None, None),
    ]


@pytest.mark.parametrize(
    "day, week, label",
    [
        ("2023-05-02", 18, "May 5"),
        ("2023-05-03", 18, "May 5"),
        ("2023-04-28", 17, None),
        ("2023-07-16", 28, "July 13"),
        ("2023-07-17", 28, "July 13"),
        ("2023-07-18", 29, None),
    ],
)
def test_sampling_week(spark, day, week, label):
    df = spark.sql(f"SELECT DATE '{day}' AS d")
    n = dates.sampling_week("d")
    assert values(df.select(n, labels.sampling_week_label(n))) == [(week, label)]


def test_week_of_year_is_not_iso(spark):
    df = spark.sql("SELECT DATE '2023-01-01' AS d UNION ALL SELECT DATE '2023-01-08'")
    assert sorted(values(df.select(dates.week_of_year("d"), dates.iso_week("d")))) == [(1, 52), (2, 1)]


def test_survey_week_takes_the_later_range(spark):
    days = ["2017-05-02", "2017-05-23", "2017-05-29", "2017-05-30", "2017-06-29", "2017-07-18"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    assert [r[0] for r in df.select(dates.survey_week("d")).collect()] == [None, 4, 4, 5, 9, 11]


def test_in_year_has_no_29_february(spark):
    df = spark.sql("SELECT DATE '2020-02-29' AS d UNION ALL SELECT DATE '2020-03-01' UNION ALL SELECT NULL")
    assert [r[0] for r in df.select(dates.in_year("d", 2022)).collect()] == [None, dt.date(2022, 3, 1), None]


def test_recode_keeps_and_lookup_drops_the_unknown(spark):
    df = spark.createDataFrame([("SO",), ("XX",), (None,)], "s string")
    got = values(df.select(labels.recode("s", labels.SALMON_LABELS), labels.lookup("s", labels.SALMON_LABELS)))
    assert got == [("Sockeye", "Sockeye"), ("XX", None), (None, None)]


def test_half_even_and_error_bar(spark):
    df = spark.createDataFrame([(0.25, 0.5), (0.35, 0.1), (0.45, None)], "m double, s double")
    got = values(df.select(numeric.half_even("m", 1), numeric.lower_bar("m", "s")))
    assert got[0] == (0.2, 0.0) and got[1][1] == pytest.approx(0.25) and got[2][1] is None


@pytest.mark.parametrize("df, t", [(1, 12.7062047362), (2, 4.3026527297), (10, 2.2281388520), (100, 1.9839715185)])
def test_t_quantile(df, t):
    assert numeric.t_quantile(0.975, df) == pytest.approx(t, abs=1e-9)


def test_t_quantile_joins_expansion_smoothly(spark):
    df = spark.createDataFrame([(0,), (1,), (200,), (201,), (10**6,), (None,)], "d bigint")
    got = dict(values(numeric.with_t_quantile(df, 0.975, F.col("d"), "t").select("d", "t")))
    assert got[0] is None and got[None] is None
    assert got[201] == pytest.approx(numeric.t_quantile(0.975, 201), abs=1e-9)
    assert got[200] > got[201] > got[10**6] > 1.9599


def test_t_quantiles_at_any_degrees(spark):
    from brinewave.functions.numeric import t_quantile, t_quantile_at

    degrees = [0.3, 0.5, 1.0, 1.5, 2.0, 2.75, 7.0, 17.25, 40.0, 150.5, 999.0, 1001.0, 5e4]
    df = spark.createDataFrame([(d,) for d in degrees] + [(0.0,), (-1.0,), (None,)], "df double")
    for p in (0.6, 0.9, 0.975, 0.9995):
        got = {r.df: r.t for r in df.withColumn("t", t_quantile_at(p, F.col("df"))).collect()}
        assert got[0.0] is None and got[-1.0] is None and got[None] is None
        for d in degrees:
            if d == int(d) and d < 1000:
                assert got[d] == pytest.approx(t_quantile(p, int(d)), rel=1e-9)
            elif d < 300:  # the area by quadrature over s, t = sinh(s)
                s = np.linspace(0, math.asinh(got[d]), 200_001)
                x = np.sinh(s)
                log_density = math.lgamma((d + 1) / 2) - math.lgamma(d / 2) - 0.5 * math.log(d * math.pi) - (d + 1) / 2 * np.log1p(x * x / d)
                assert 0.5 + np.trapezoid(np.exp(log_density) * np.cosh(s), s) == pytest.approx(p, abs=1e-9)
        assert got[5e4] < got[1001.0] < got[999.0]
    assert [round(r.t, 3) for r in df.filter("df = 1").withColumn("t", t_quantile_at(0.975, F.col("df"))).collect()] == [12.706]
