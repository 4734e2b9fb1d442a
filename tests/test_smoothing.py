from __future__ import annotations

import csv
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinewave.operators import smoothing
from brinewave.plans import ocean

GOLDENS = Path(__file__).parent / "data" / "smoothing_goldens.csv"


def golden(season: int, kind: str):
    with GOLDENS.open() as f:
        return [
            (float(r["yday"]), int(r["n"]), float(r["value"]))
            for r in csv.DictReader(f)
            if int(r["season"]) == season and r["kind"] == kind
        ]


def frames(spark, season):
    average = [("S", int(d), v) for d, n, v in golden(season, "history") for _ in range(n)]
    this_year = [("S", int(d), v) for d, _, v in golden(season, "season")]
    schema = "station string, yday int, mean_temp double"
    return spark.createDataFrame(average, schema), spark.createDataFrame(this_year, schema)


def brute(x, y, x0, span):
    """Weighted least squares at x0 over single points; value, slope and operator row."""
    n = len(x)
    q = min(int(n * span + 1e-5), n)
    d = np.abs(x - x0)
    h = np.sort(d)[q - 1] * max(span, 1.0)
    w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0.0)
    design = np.column_stack([np.ones(n), x - x0, (x - x0) ** 2])
    operator = np.linalg.solve(design.T @ (w[:, None] * design), design.T * w)
    return operator @ y, operator[0]


@pytest.mark.parametrize("season, largest", [(2022, 0.08), (2023, 0.08)])
def test_direct_curve_is_near_the_stored_one(spark, season, largest):
    average, days = frames(spark, season)
    got = {r.yday: r.predicted_mean_temp for r in ocean.anomaly(average, days, surface="direct").collect()}
    errors = [abs(got[d] - v) for d, _, v in golden(season, "curve")]
    assert np.median(errors) < 0.012 and max(errors) < largest


@pytest.mark.parametrize("season", [2022, 2023])
def test_interpolated_curve_matches_the_stored_one(spark, season):
    average, days = frames(spark, season)
    got = {r.yday: r.predicted_mean_temp for r in ocean.anomaly(average, days).collect()}
    errors = [abs(got[d] - v) for d, _, v in golden(season, "curve")]
    assert np.median(errors) < 0.001 and max(errors) < 0.015


@pytest.mark.parametrize("surface", ["direct", "interpolate"])
@pytest.mark.parametrize("season", [2022, 2023])
def test_crossings_are_the_stored_ones(spark, season, surface):
    average, days = frames(spark, season)
    rows = ocean.anomaly(average, days, surface=surface).collect()
    crossings = sorted(r.yday for r in rows if r["diff"] is None)
    assert crossings == sorted(d for d, _, _ in golden(season, "crossing"))
    assert all(r.mean_temp == r.predicted_mean_temp for r in rows if r["diff"] is None)


def test_fits_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.sort(rng.integers(30, 60, 45)).astype(float)
    y = np.sin(x / 9) + rng.normal(0, 0.1, 45)
    df = spark.createDataFrame([("k", float(a), float(b)) for a, b in zip(x, y)], "s string, x double, y double")
    for span in (0.4, 0.75, 1.0):
        got = smoothing.predict_grid(df, ["s"], "x", "y", span, "direct").filter("x10 % 20 = 5").collect()
        assert len(got) > 10
        for r in got:
            assert r.predicted == pytest.approx(brute(x, y, r.x, span)[0][0], abs=1e-9)


def test_band_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.sort(rng.integers(1, 25, 40)).astype(float)
    y = x**0.5 + rng.normal(0, 0.2, 40)
    df = spark.createDataFrame([("k", float(a), float(b)) for a, b in zip(x, y)], "s string, x double, y double")
    operator = np.array([brute(x, y, a, 0.65)[1] for a in x])
    residual = y - operator @ y
    m = (np.eye(40) - operator) @ (np.eye(40) - operator).T
    delta1, delta2 = np.trace(m), np.trace(m @ m)
    sigma2 = residual @ residual / delta1
    for r in smoothing.predict_band(df, ["s"], "x", "y", 0.65).filter("x10 % 30 = 0").collect():
        beta, row = brute(x, y, r.x, 0.65)
        assert (r.delta1, r.df) == pytest.approx((delta1, delta1**2 / delta2))
        assert t_area(r.t, r.df) == pytest.approx(0.975, abs=1e-9)
        assert (r.fit, r.se) == pytest.approx((beta[0], (sigma2 * (row @ row)) ** 0.5))


def test_series_stay_apart_and_short_ones_give_null(spark):
    data = [("a", float(i), float(i * i)) for i in range(12)] + [("b", 1.0, 2.0), ("b", 2.0, 3.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "s string, x double, y double")
    got = smoothing.predict_observed(df, ["s"], "x", "y", 0.8, "fit", "direct").collect()
    square = {r.x: r.fit for r in got if r.s == "a"}
    assert all(v == pytest.approx(x * x, abs=1e-7) for x, v in square.items()) and len(square) == 12
    assert all(r.fit is None for r in got if r.s == "b")


def t_area(t, df):
    """P(T <= t) by a fine trapezoid sum over the density."""
    x = np.linspace(0, t, 400_001)
    density = np.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi) - (df + 1) / 2 * np.log1p(x * x / df))
    return 0.5 + np.trapezoid(density, x)


def cell_ends(xs, ns, span):
    """Vertices by a stack of cells; a cell is cut between the two x nearest its median point."""
    largest = int(sum(ns) * span * 0.2)
    margin = 0.005 * max(xs[-1] - xs[0], 1e-3 * max(abs(xs[0]), abs(xs[-1])) + 1e-30)
    ends, todo = [xs[0] - margin, xs[-1] + margin], [(0, len(xs))]
    while todo:
        low, high = todo.pop()
        size = sum(ns[low:high])
        if size <= largest or high - low < 2:
            continue
        seen = np.cumsum(ns[low : high - 1])
        cut = min((abs(c - (size + 1) // 2), -c, low + i + 1) for i, c in enumerate(seen))[2]
        ends.append((xs[cut - 1] + xs[cut]) / 2)
        todo += [(low, cut), (cut, high)]
    return sorted(ends)


@pytest.mark.parametrize("span", [0.05, 0.35, 0.65, 1.0])
def test_cells_equal_those_of_a_stack(spark, span):
    rng = np.random.default_rng(8)
    series = {}
    for k in range(12):
        xs = np.sort(rng.choice(366, rng.integers(1, 120), replace=False))
        series[k] = (xs.astype(float).tolist(), np.maximum(1, rng.geometric(0.2, len(xs)) ** rng.integers(1, 3)).tolist())
    data = [(k, x, 1.0) for k, (xs, ns) in series.items() for x, n in zip(xs, ns) for _ in range(n)]
    df = spark.createDataFrame(data, "s int, x double, y double")
    table = smoothing.series_buckets(df, ["s"], "x", "y", span)
    for r in smoothing._vertices(table, ["s"]).collect():
        assert sorted(r.ends) == pytest.approx(cell_ends(*series[r.s], span), abs=1e-12)


def test_span_by_series(spark):
    rng = np.random.default_rng(9)
    data = [(s, float(x), float(rng.normal())) for s in "ab" for x in range(60)]
    df = spark.createDataFrame(data, "s string, x double, y double")
    mixed = smoothing.predict_grid(df, ["s"], "x", "y", F.when(F.col("s") == "a", 0.35).otherwise(0.8)).collect()
    for name, span in (("a", 0.35), ("b", 0.8)):
        one = smoothing.predict_grid(df.filter(F.col("s") == name), ["s"], "x", "y", span).collect()
        assert {r.x10: r.predicted for r in mixed if r.s == name} == pytest.approx({r.x10: r.predicted for r in one})


def test_no_python_in_the_curves(spark):
    df = spark.range(40).select(F.lit("k").alias("s"), F.col("id").alias("x"), F.sqrt("id").alias("y"))
    for surface in ("direct", "interpolate"):
        plan = smoothing.predict_grid(df, ["s"], "x", "y", 0.65, surface)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
