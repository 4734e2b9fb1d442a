from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brinewave.operators import bins, columns, grouping, growth, joins, ordered, reshape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_safe_joins(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, x string")
    b = spark.createDataFrame([(1, "p"), (None, "q"), (4, "r")], "k int, y string")
    assert rows(joins.natural_left_join(a, b)) == rows_of([(1, "a", "p"), (None, "b", "q"), (3, "c", None)])
    right = joins.null_safe_join(a, b, ["k"], "right").select("k", "x", "y")
    assert rows(right) == rows_of([(1, "a", "p"), (None, "b", "q"), (4, None, "r")])
    assert rows(joins.members(a, b, ["k"])) == [(1, "a")]
    assert rows(joins.non_members(a, b, ["k"])) == rows_of([(None, "b"), (3, "c")])


def rows_of(tuples):
    return sorted(tuples, key=repr)


def test_zero_filled_join(spark):
    a = spark.createDataFrame([("x", 3), ("y", 4)], "k string, n int")
    b = spark.createDataFrame([("x", 1)], "k string, m int")
    assert rows(joins.zero_filled_join(a, b, ["k"], ["m"])) == [("x", 3, 1), ("y", 4, 0)]


def test_first_per_key_and_duplicated_groups(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 7, "z"), (None, 2, "c"), (None, 1, "d"), (2, 9, "e")], "k int, o int, v string"
    )
    assert rows(grouping.first_per_key(df, ["k"], ["o"])) == rows_of([(1, 5, "a"), (None, 1, "d"), (2, 9, "e")])
    assert len(rows(grouping.rows_of_duplicated_groups(df, ["k"]))) == 5


def test_partial_key_join_multiplies_rows(spark):
    """The many-to-many join on the stage alone, against the full key the library uses."""
    a = spark.createDataFrame([("w1", "mot", 1.0), ("w2", "mot", 2.0)], "week string, stage string, mean double")
    b = spark.createDataFrame([("w1", "mot", 0.1), ("w2", "mot", 0.2)], "week string, stage string, sd double")
    assert a.join(b.drop("week"), "stage").count() == 4
    assert rows(a.join(b, ["week", "stage"])) == [("w1", "mot", 1.0, 0.1), ("w2", "mot", 2.0, 0.2)]


def test_uncounted_equals_literal_repetition(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 0), ("c", None), ("d", 1)], "k string, n int")
    fast = grouping.uncounted(df, ["k"], "n")
    slow = grouping.repeat_rows(df, "n").groupBy("k").count()
    assert rows(fast) == rows(slow) == [("a", 5), ("d", 1)]


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 2)], "p string, c string, n int")
    shares = grouping.share_within(df, ["p"], "n", "s")
    assert {r[0]: r[1] for r in shares.groupBy("p").agg(F.sum("s")).collect()} == {"a": 1.0, "b": 1.0}


def test_ratio_of_sums(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", None, 2), ("b", 3, 0)], "k string, t int, b int")
    assert {r.ratio for r in grouping.with_total_ratio(df, "t", "b").collect()} == {1.0}
    got = {r.k: r.ratio for r in grouping.with_group_ratio(df, ["k"], "t", "b").collect()}
    assert got == {"a": 0.25, "b": None}


def test_moment_parts_add_up(spark):
    data = [(i % 3, random.Random(i).choice([None, 0, 1, 2, 7])) for i in range(60)]
    df = spark.createDataFrame(data, "k int, v int")
    parts = df.groupBy("k", (F.rand(3) * 5).cast("int").alias("p")).agg(*grouping.moment_parts({"v": "v"}))
    merged = parts.groupBy("k").agg(*grouping.merged_parts(["v"]))
    got = merged.select("k", grouping.mean_of_parts("v"), grouping.sd_of_parts("v")).collect()
    want = {r[0]: r for r in df.groupBy("k").agg(F.avg("v"), F.stddev_samp("v")).collect()}
    for k, mean, sd in got:
        assert mean == pytest.approx(want[k][1]) and sd == pytest.approx(want[k][2])


def test_reshape(spark):
    df = spark.createDataFrame([(1, 2, None, "u_d_t_x")], "id int, a int, b int, f string")
    assert rows(reshape.longer(df.drop("f"), ["a", "b"], "k", "v")) == rows_of([(1, "a", 2), (1, "b", None)])
    parts = reshape.separate(df.select("f"), "f", ["unit", "date", "time"], "_")
    assert rows(parts) == [("u", "d", "t_x")]
    crew = spark.createDataFrame([("Ann B,  Cy ",)], "crew string")
    assert rows(reshape.split_rows(crew, "crew", "name")) == [("Ann B",), ("Cy",)]
    pairs = spark.createDataFrame([("w", 1.0, 0.1, 2.0, 0.2)], "k string, am double, ae double, bm double, be double")
    long = reshape.longer_structs(pairs, {"a": {"m": "am", "e": "ae"}, "b": {"m": "bm", "e": "be"}}, "g")
    assert rows(long) == [("w", "a", 1.0, 0.1), ("w", "b", 2.0, 0.2)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.25, "t")], "a int, b double, c string")
    assert columns.columns_between(df, "b", "c") == ["b", "c"]
    assert rows(columns.change_numeric(df, lambda c: F.bround(c, 1))) == [(1, 2.2, "t")]


def series(spark, n, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice("pq"), rng.randrange(6), i, rng.choice([None, 1, 2, 3, 10])) for i in range(n)]
    return data, spark.createDataFrame(data, "g string, day int, id int, v int")


def test_blocked_running_total_equals_one_window(spark):
    data, df = series(spark, 120)
    blocked = df.withColumn("blk", F.floor(F.col("id") / 7))
    got = ordered.blocked_running_total(blocked, ["g"], ["day", "blk"], ["id"], "v", "upto", total="all")
    for g in "pq":
        mine = sorted((r for r in data if r[0] == g), key=lambda r: (r[1], r[2]))
        want = list(itertools.accumulate(r[3] or 0 for r in mine))
        found = {r.id: (r.upto, r["all"]) for r in got.filter(F.col("g") == g).collect()}
        assert [found[r[2]] for r in mine] == [(w, want[-1]) for w in want]


@pytest.mark.parametrize("days", [1, 3])
def test_running_total_over_sparse_ids_is_cut_evenly(spark, days):
    rng = random.Random(17)
    data = [(rng.randrange(days), rng.choice([None, rng.randrange(-(2**63), 2**63)]) if i % 50 == 0 else rng.randrange(-(2**63), 2**63), i % 7)
            for i in range(20_000)]
    data = list({(d, i): (d, i, v) for d, i, v in data}.values())
    df = spark.createDataFrame(data, "day int, id long, v int")
    blocked = ordered.range_blocks(df, ["day"], ["id"], every=100)
    sizes = [r["count"] for r in blocked.groupBy("day", "_block").count().collect()]
    assert len(sizes) > 100 and max(sizes) < 2000
    got = ordered.blocked_running_total(blocked, [], ["day", "_block"], ["id"], "v", "upto", total="all")
    want, total = {}, 0
    for d, i, v in sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        total += v
        want[d, i] = total
    assert {(r.day, r.id): r.upto for r in got.collect()} == want


def test_quantiles_count_values_inside_their_range_only(spark):
    rng = np.random.default_rng(18)
    v = {"a": rng.lognormal(0, 3, 6000), "b": rng.normal(size=9), "c": np.repeat([1.5, 2.5], 500), "d": np.array([7.0])}
    df = spark.createDataFrame([(k, float(x)) for k, xs in v.items() for x in xs] + [("a", None), ("e", None)], "k string, x double")
    probs = {"p0": 0.0, "p1": 0.013, "p50": 0.5, "p99": 0.987, "p100": 1.0}
    for every in (1, 50, 10**6):
        got = {r.k: r for r in bins.quantiles(df, ["k"], "x", probs, every=every).collect()}
        assert set(got) == set(v)
        for k, xs in v.items():
            assert got[k].n == len(xs)
            assert [got[k][c] for c in probs] == pytest.approx(np.quantile(xs, list(probs.values())).tolist(), rel=1e-12)


@pytest.mark.parametrize("chunk", [1, 2, 3, 1000])
def test_blocked_centred_mean_equals_one_window(spark, chunk):
    data, df = series(spark, 60, seed=chunk)
    blocked = df.withColumn("blk", F.floor(F.col("id") / 5))
    got = ordered.blocked_centred_mean(blocked, ["g"], ["day", "blk"], ["id"], "v", "m", chunk_rows=chunk)
    found = {r.id: r.m for r in got.collect()}
    assert len(found) == len(data)
    for g in "pq":
        mine = sorted((r for r in data if r[0] == g), key=lambda r: (r[1], r[2]))
        v = [r[3] for r in mine]
        for i, r in enumerate(mine):
            window = v[i - 2 : i + 3] if i >= 2 else []
            want = sum(window) / 5 if len(window) == 5 and None not in window else None
            assert found[r[2]] == (pytest.approx(want) if want is not None else None)


def test_crossings(spark):
    df = spark.createDataFrame(
        [("s", 1.0, 5.0, 4.0, "pos"), ("s", 3.0, 6.0, 8.0, "neg"), ("s", 4.0, 7.0, 9.0, "neg")],
        "k string, x double, t double, p double, side string",
    )
    got = ordered.with_crossing_midpoints(df, ["k"], "x", "side", ["p"], {"t": "p"}).orderBy("x")
    assert [tuple(r) for r in got.collect()][1] == ("s", 2.0, 6.0, 6.0, None)
    assert got.count() == 4
    pts = spark.createDataFrame([("a", x, y) for x, y in enumerate([-1, 2, 1, 2, -1, 1], 1)], "k string, x int, y int")
    zero = ordered.zero_crossings(pts, ["k"], "x", "y").orderBy("x")
    assert [r.x for r in zero.collect()] == pytest.approx([4 / 3, 4 + 2 / 3, 5.5])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-40, 40)), min_size=1, max_size=40))
def test_box_statistics_against_numpy(spark, data):
    df = spark.createDataFrame([(k, v / 2) for k, v in data], "k string, v double")
    got = {r.k: r for r in bins.box_statistics(df, ["k"], "v", every=3).collect()}
    for k in {k for k, _ in data}:
        v = np.array([x / 2 for g, x in data if g == k])
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        r = got[k]
        assert (r.n, r.n_outliers) == (len(v), len(v) - len(inside))
        assert [r.lower, r.middle, r.upper] == pytest.approx([q1, q2, q3])
        assert [r.ymin, r.ymax] == [min(q1, inside.min()), max(q3, inside.max())]


def test_histograms(spark):
    df = spark.createDataFrame([(4.5,), (4.6,), (13.5,), (None,)], "v double")
    assert rows(bins.histogram(df, [], "v", 5.0)) == [(0.0, 2), (10.0, 1)]
    got = {r.bin_centre: (r.n, r.frequency) for r in bins.density_histogram(df, "v", 9.0).collect()}
    assert got == {0.0: (1, pytest.approx(500 / 27)), 9.0: (2, pytest.approx(1000 / 27))}


def test_wind_rose(spark):
    data = [(0.0, 0.0), (3.0, 11.25), (3.1, 11.3), (9.5, 348.75), (9.5, 360.0), (None, 90.0), (2.0, None)]
    df = spark.createDataFrame(data, "s double, d double")
    plain = {(r.speed_bin, r.compass): r.n for r in bins.wind_rose(df, "s", "d", [0.0, 3.0, 6.0, 9.0]).collect()}
    assert plain == {
        (None, "N"): 2, ("0 - 3", "N"): 1, ("3 - 6", "NNE"): 1, (None, "NNW"): 1, (None, None): 2,
    }
    over = bins.wind_rose(df, "s", "d", [0.0, 3.0, 6.0, 9.0], speed_max=9.0)
    assert {r.speed_bin for r in over.collect()} == {None, "0 - 3", "3 - 6", "9 - 9.5"}
    assert over.agg(F.sum("frequency")).first()[0] == pytest.approx(1.0)


def test_logistic_fit_recovers_curve(spark):
    data = []
    for name, asym, mid, scale in (("past", 100.0, 150.0, 6.0), ("now", 97.0, 160.5, 3.5)):
        for day in range(120, 200):
            y = asym / (1 + math.exp((mid - day) / scale))
            data += [(name, day, y + 0.2), (name, day, y - 0.2)]
    fits = {r.g: r for r in growth.logistic_fits(spark.createDataFrame(data, "g string, x int, y double"), "g", "x", "y").collect()}
    for name, want in (("past", (100.0, 150.0, 6.0)), ("now", (97.0, 160.5, 3.5))):
        r = fits[name]
        assert r.converged and r.n == 160
        assert (r.asym, r.mid, r.scale) == pytest.approx(want, rel=1e-4)


def test_logistic_fit_reports_failure(spark):
    flat = spark.createDataFrame([("g", 100, 1.0), ("g", 100, 1.0)], "g string, x int, y double")
    assert not growth.logistic_fits(flat, "g", "x", "y").first().converged


def gauss_newton(x, n, mean, noise, top):
    """One group step by step, with a QR solve."""
    at = np.repeat(x, n.astype(int))
    beta, factor, root = np.array([top, np.median(at), 1.0]), 1.0, np.sqrt(n)

    def parts(b):
        f = 1 / (1 + np.exp((b[1] - x) / b[2]))
        slope = b[0] * f * (1 - f) / b[2]
        return root * (mean - b[0] * f), root[:, None] * np.column_stack([f, -slope, slope * (b[1] - x) / b[2]])

    for _ in range(growth.MAX_STEPS):
        r, g = parts(beta)
        q, t = np.linalg.qr(g)
        along = q.T @ r
        if along @ along <= 1e-10 * (r @ r + noise - along @ along):
            return *beta, True
        step = np.linalg.solve(t, along)
        while (new := parts(beta + factor * step)[0]) @ new > r @ r:
            factor /= 2
            if factor < 1 / 1024:
                return *beta, False
        beta, factor = beta + factor * step, min(2 * factor, 1.0)
    return *beta, False


def test_thousands_of_logistic_fits_in_one_plan(spark):
    rng = np.random.default_rng(12)
    data, want = [], {}
    for k in range(2000):
        x = np.sort(rng.choice(np.arange(110, 210), 20, replace=False)).astype(float)
        asym, mid, scale = rng.uniform(80, 110), rng.uniform(140, 180), rng.uniform(3, 12)
        low = asym / (1 + np.exp((mid - x) / scale)) + rng.normal(0, 1.5, 20)
        high = low + rng.uniform(0, 2, 20)
        if k < 60:
            mean, noise = (low + high) / 2, ((high - low) ** 2 / 2).sum()
            want[str(k)] = gauss_newton(x, np.full(20, 2.0), mean, noise, max(low.max(), high.max()))
        data += [(str(k), float(a), float(b)) for a, b in zip([*x, *x], [*low, *high])]
    fits = growth.logistic_fits(spark.createDataFrame(data, "g string, x double, y double"), "g", "x", "y")
    assert "Python" not in fits._jdf.queryExecution().executedPlan().toString()
    got = {r.g: r for r in fits.collect()}
    assert len(got) == 2000 and sum(r.converged for r in got.values()) > 1900
    for k, w in want.items():
        r = got[k]
        assert r.converged == w[3]
        if r.converged:
            assert (r.asym, r.mid, r.scale) == pytest.approx(w[:3], rel=1e-6)


def test_linear_trend(spark):
    df = spark.createDataFrame([("a", x, 2.0 * x + 1) for x in range(5)], "k string, x int, y double")
    r = growth.linear_trend(df, ["k"], "x", "y").first()
    assert (r.slope, r.intercept, r.n) == (pytest.approx(2.0), pytest.approx(1.0), 5)
