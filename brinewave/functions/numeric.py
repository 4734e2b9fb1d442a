"""Scalar numeric helpers."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col

# Fixed value: knots per metre per second.
KNOTS_PER_MS = 1.9438444924574

T_TABLE_MAX = 200


def knots(speed: Column | str) -> Column:
    return as_col(speed) * F.lit(KNOTS_PER_MS)


def lower_bar(mean: Column | str, se: Column | str) -> Column:
    """Lower end of an error bar, floored at zero; null where either part is null."""
    low = as_col(mean) - as_col(se)
    return F.when(low < 0, F.lit(0.0)).otherwise(low)


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


def _t_central_area(t: float, df: int) -> float:
    """P(|T| <= t) for integer df: the finite trigonometric sums (Abramowitz & Stegun 26.7.3-4)."""
    theta = math.atan2(t, math.sqrt(df))
    c2 = math.cos(theta) ** 2
    if df % 2:
        term, total = math.cos(theta), 0.0
        for k in range(1, (df - 1) // 2 + 1):
            total += term
            term *= c2 * 2 * k / (2 * k + 1)
        return 2 / math.pi * (theta + math.sin(theta) * total)
    term, total = 1.0, 0.0
    for k in range(1, df // 2 + 1):
        total += term
        term *= c2 * (2 * k - 1) / (2 * k)
    return math.sin(theta) * total


@lru_cache(maxsize=None)
def t_quantile(p: float, df: int) -> float:
    """Student-t quantile for p > 0.5 and integer df, by bisection on the exact area."""
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        if _t_central_area(mid, df) < 2 * p - 1:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def t_quantile_large(p: float, df: Column) -> Column:
    """Expansion around the normal quantile (Abramowitz & Stegun 26.7.5), for large df."""
    z = NormalDist().inv_cdf(p)
    g1 = (z**3 + z) / 4
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160
    n = df.cast("double")
    return F.lit(z) + F.lit(g1) / n + F.lit(g2) / n**2 + F.lit(g3) / n**3 + F.lit(g4) / n**4


LARGE_DF = 1000.0  # beyond it the expansion is exact to twelve digits
CF_TERMS = 120
NEWTON_STEPS = 40
TINY = 1e-300


def _log_gamma(x: Column) -> Column:
    """Stirling's series for x > 0, moved up by eight first."""
    z = x + F.lit(8.0)
    moved = F.log(x)
    for i in range(1, 8):
        moved = moved + F.log(x + F.lit(float(i)))
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - moved


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta integral (Abramowitz & Stegun 26.5.8), evaluated from the front
    as a product of ratios; converges fast for x < (a + 1) / (a + b + 2)."""

    def away(v: Column) -> Column:
        return F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    def step(s: Column, coefficient: Column) -> Column:
        d = 1 / away(1 + coefficient * s["d"])
        c = away(1 + coefficient / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def both(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        once = F.transform(F.array(s), lambda t: step(t, even))  # a lambda's argument is evaluated once
        return F.transform(once, lambda t: step(t, odd))[0]

    d0 = 1 / away(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    terms = F.transform(F.sequence(F.lit(1), F.lit(CF_TERMS)), lambda m: m.cast("double"))
    return F.aggregate(terms, start, both)["h"]


def t_upper_tail(t: Column, df: Column, log_beta: Column) -> Column:
    """P(T > t) for t > 0 and any df > 0: half the incomplete beta ratio at df / (df + t²) with parameters df / 2 and 1/2."""
    a, b = df / 2, F.lit(0.5)
    x, y = df / (df + t * t), t * t / (df + t * t)
    front = F.exp(a * F.log(x) + 0.5 * F.log(y) - log_beta)
    near = F.lit(0.5) * front * _beta_fraction(x, a, b) / a
    far = F.lit(0.5) - front * _beta_fraction(y, b, a)  # by symmetry; 0.5 * front / 0.5
    return F.when(x < (a + 1) / (a + 2.5), near).otherwise(far)


def t_quantile_at(p: float, df: Column) -> Column:
    """Student-t quantile for p > 0.5 and any degrees of freedom, fractional ones too; null for df <= 0 or null.

    Newton steps for log t on the logarithm of the upper tail, which is concave and falls almost in a line: from the
    normal quantile the first step goes past the root, the others come back without crossing it.
    """
    if not 0.5 < p < 1:
        raise ValueError("p lies between 0.5 and 1")
    n = df.cast("double")
    goal, z = math.log(1 - p), NormalDist().inv_cdf(p)

    def solved(v: Column) -> Column:
        nu, log_beta = v["n"], v["b"]

        def newton(s: Column, _: Column) -> Column:
            u = s["u"]
            t = F.exp(u)
            log_density = -(nu + 1) / 2 * F.log(1 + t * t / nu) - 0.5 * F.log(nu) - log_beta
            tail = F.array(t_upper_tail(t, nu, log_beta))
            moved = F.transform(tail, lambda q: u + (F.log(q) - goal) * q / (F.exp(log_density) * t))
            next_one = F.transform(moved, lambda m: F.struct(m.alias("u"), (F.abs(m - u) < 1e-14).alias("done")))[0]
            return F.when(s["done"], s).otherwise(next_one)

        start = F.struct(F.lit(math.log(z)).alias("u"), F.lit(False).alias("done"))
        return F.exp(F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, newton)["u"])

    log_beta = _log_gamma(n / 2) + F.lit(math.lgamma(0.5)) - _log_gamma(n / 2 + 0.5)
    given = F.array(F.struct(n.alias("n"), log_beta.alias("b")))
    exact = F.transform(given, solved)[0]
    return F.when(n > LARGE_DF, t_quantile_large(p, n)).when(n > 0, exact)


def t_table(spark: SparkSession, p: float) -> DataFrame:
    rows = [(df, t_quantile(p, df)) for df in range(1, T_TABLE_MAX + 1)]
    return spark.createDataFrame(rows, "_t_df bigint, _t_value double")


def with_t_quantile(df: DataFrame, p: float, degrees: Column, name: str) -> DataFrame:
    """Add the t quantile of ``degrees``: 200 fixed values, then the expansion; null below 1."""
    table = F.broadcast(t_table(df.sparkSession, p))  # always 200 rows
    d = degrees.cast("bigint")
    out = df.withColumn("_d", d).join(table, F.col("_d") == F.col("_t_df"), "left")
    large = F.when(F.col("_d") > T_TABLE_MAX, t_quantile_large(p, F.col("_d")))
    return out.withColumn(name, F.coalesce(F.col("_t_value"), large)).drop("_d", "_t_df", "_t_value")
