"""Local quadratic smoothing (loess) of day-of-year series in column expressions.

A series is first reduced to one bucket per distinct x (a day of the year: at most 366 a series),
holding the number of points, the sum and the sum of squares. Every fit reads only these buckets, as
one array column per series, so the cost does not depend on the number of observations. A fit at x0
uses the nearest ``q = floor(n * span)`` points, tricube weights and a weighted quadratic centred on
x0; its constant is the fitted value and its linear term the slope.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.functions.nulls import ratio
from brinewave.functions.numeric import t_quantile_at
from brinewave.operators.joins import null_safe_join

STEPS_PER_UNIT = 10  # grid of tenths of a day
KD_CELL = 0.2  # share of the span a cell of the interpolating surface may hold
KD_MARGIN = 0.005  # the outer vertices lie this share of the range outside the data


def evaluated(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns by way of a one-row generator.

    A filter above a projection is pushed down with the expression copied into it; above a generator
    it can only refer to the value. The fits are long expressions, so they are made values at once.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


Span = float | Column  # a number, or a column over the keys where series differ


def series_buckets(df: DataFrame, keys: Sequence[str], x: str, y: str, span: Span) -> DataFrame:
    """One row per series: its bucket array, size, range, span and nearest-neighbour windows.

    ``windows`` holds, for each bucket as left end, the nearest right end such that the closed
    interval has at least q points; the bandwidth at x0 is then the least, over windows, of the
    larger distance to the two ends.
    """
    daily = (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys, F.col(x).cast("double").alias("_x"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("_n"),
            F.sum(y).cast("double").alias("_s"),
            F.sum(F.col(y) * F.col(y)).cast("double").alias("_ss"),
        )
    )
    bucket = F.struct(*[F.col(f"_{c}").alias(c) for c in ("x", "n", "s", "ss")])
    one = daily.groupBy(*keys).agg(
        F.sort_array(F.collect_list(bucket)).alias("buckets"),
        F.sum("_n").alias("size"),
        F.min("_x").alias("x_min"),
        F.max("_x").alias("x_max"),
    )
    one = evaluated(one, span=span.cast("double") if isinstance(span, Column) else F.lit(float(span)))
    # floor(n * span) with the usual guard against representation error, never more than n
    q = F.least(F.floor(F.col("size") * F.col("span") + 1e-5).cast("double"), F.col("size"))
    one = evaluated(one, q=q, widen=F.greatest(F.col("span"), F.lit(1.0)))
    one = evaluated(one, _upto=F.expr(
        "transform(buckets, b -> struct(b.x AS x, b.n AS n,"
        " aggregate(filter(buckets, o -> o.x <= b.x), 0D, (acc, o) -> acc + o.n) AS c))"
    ))
    one = evaluated(one, _windows=F.expr(
        "transform(_upto, b -> struct(b.x AS left,"
        " array_min(transform(filter(_upto, o -> o.c - (b.c - b.n) >= q), o -> o.x)) AS right))"
    ))
    return evaluated(one, windows=F.expr("filter(_windows, w -> w.right IS NOT NULL)")).drop("_upto", "_windows")


def grid(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tenth-of-a-day grid over the range of each series, as an exact integer key ``x10``."""
    low = F.round(F.col("x_min") * STEPS_PER_UNIT).cast("int")
    high = F.round(F.col("x_max") * STEPS_PER_UNIT).cast("int")
    return series.select(*keys, F.explode(F.sequence(low, high)).alias("x10"))


BANDWIDTH = "array_min(transform(windows, w -> greatest(_x0 - w.left, w.right - _x0))) * widen"

# buckets inside the bandwidth: offset d, weighted count c, weighted value s, count by squared weight v
NEAR = """
    transform(
      transform(
        filter(buckets, b -> abs(b.x - _x0) < h),
        b -> struct(b.x - _x0 AS d, power(1 - power(abs(b.x - _x0) / h, 3), 3) AS w, b.n AS n, b.s AS s, b.x AS x)),
      p -> struct(p.d AS d, p.w * p.n AS c, p.w * p.s AS s, p.w * p.w * p.n AS v, p.x AS x, p.n AS n))"""


def _moments(squares: bool) -> dict[str, Column]:
    """Moments of the weighted buckets: m0..m4 of the counts, t0..t2 of the values, v0..v4 of the
    squared weights. One scalar sum each: a struct accumulator would be copied at every element."""

    def moment(part: str, k: int) -> Column:
        term = " * ".join([f"p.{part}", *["p.d"] * k])
        return F.expr(f"aggregate(near, 0D, (acc, p) -> acc + {term})")

    out = {f"m{k}": moment("c", k) for k in range(5)} | {f"t{k}": moment("s", k) for k in range(3)}
    return out | ({f"v{k}": moment("v", k) for k in range(5)} if squares else {})


def local_fit(
    points: DataFrame, series: DataFrame, keys: Sequence[str], x0: Column, errors: bool = False, weights: bool = False
) -> DataFrame:
    """Fit at ``x0`` of every row of ``points``; adds ``fit`` and ``slope``.

    With ``errors`` also ``norm2`` (squared length of the operator row, for standard errors) and
    ``own`` (weight the fit gives to one point at x0 itself, for the trace). With ``weights`` also
    ``operator``, the row itself: (x, n, r) of each bucket that one of its n points enters with weight r.
    Singular systems give null.
    """
    wide = series.select(*keys, "buckets", "windows", "widen")
    joined = null_safe_join(points.withColumn("_x0", x0), wide, keys, "inner")
    near = evaluated(evaluated(joined, h=F.expr(BANDWIDTH)), near=F.expr(NEAR))
    sums = _moments(errors)
    fitted = evaluated(near, **sums)
    m = [F.col(f"m{i}") for i in range(5)]
    t = [F.col(f"t{i}") for i in range(3)]
    # adjugate of the symmetric normal matrix [[m0 m1 m2], [m1 m2 m3], [m2 m3 m4]]
    a00 = m[2] * m[4] - m[3] * m[3]
    a01 = m[2] * m[3] - m[1] * m[4]
    a02 = m[1] * m[3] - m[2] * m[2]
    a11 = m[0] * m[4] - m[2] * m[2]
    a12 = m[1] * m[2] - m[0] * m[3]
    det = m[0] * a00 + m[1] * a01 + m[2] * a02
    found = {
        "fit": ratio(a00 * t[0] + a01 * t[1] + a02 * t[2], det),
        "slope": ratio(a01 * t[0] + a11 * t[1] + a12 * t[2], det),
    }
    if errors:
        v = [F.col(f"v{i}") for i in range(5)]
        row = [a00, a01, a02]
        quad = reduce(lambda a, b: a + b, [row[i] * row[j] * v[i + j] for i in range(3) for j in range(3)])
        found |= {"norm2": ratio(quad, det * det), "own": ratio(a00, det)}
    out = evaluated(fitted, **found)
    if weights:
        rows = evaluated(out, _a0=a00, _a1=a01, _a2=a02, _det=F.nullif(det, F.lit(0.0)))
        row = F.expr("transform(near, p -> struct(p.x AS x, p.n AS n, p.c / p.n * (_a0 + _a1 * p.d + _a2 * p.d * p.d) / _det AS r))")
        out = evaluated(rows, operator=row).drop("_a0", "_a1", "_a2", "_det")
    return out.drop(*sums, "_x0", "h", "near", "buckets", "windows", "widen")


def spread_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distribute a small generated table so the fits run on all cores, not in the task that made it.

    The number is given because AQE would otherwise coalesce so few bytes into one task again.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def predict_at(
    points: DataFrame, series: DataFrame, keys: Sequence[str], at: Column, surface: str, name: str
) -> DataFrame:
    """Fitted value at each point: ``surface`` is "interpolate" for the k-d blend, or "direct"."""
    if surface == "direct":
        return local_fit(points, series, keys, at).withColumnRenamed("fit", name).drop("slope")
    if surface != "interpolate":
        raise ValueError('surface is "interpolate" or "direct"')
    return _interpolated(points, series, keys, at, name)


def predict_grid(
    df: DataFrame, keys: Sequence[str], x: str, y: str, span: Span, surface: str = "interpolate", name: str = "predicted"
) -> DataFrame:
    """Smoothed curve on the tenth-of-a-day grid: keys, x10, x and the fitted value."""
    series = series_buckets(df, keys, x, y, span)
    points = spread_rows(grid(series, keys), [*keys, "x10"])
    at = F.col("x10") / F.lit(float(STEPS_PER_UNIT))
    return predict_at(points, series, keys, at, surface, name).select(*keys, "x10", at.alias(x), name)


def predict_for_days(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    y: str,
    span: Span,
    days: DataFrame,
    surface: str = "interpolate",
    name: str = "predicted",
) -> DataFrame:
    """Rows of ``days`` that meet the grid of their series, with the curve value.

    Same result as joining the whole predicted grid to the days on the exact tenth-of-a-day key, but
    the curve is fitted only where a day needs it.
    """
    series = series_buckets(df, keys, x, y, span)
    keyed = days.withColumn("x10", F.round(F.col(x) * STEPS_PER_UNIT).cast("int"))
    points = spread_rows(null_safe_join(grid(series, keys), keyed, [*keys, "x10"], "inner"), [*keys, "x10"])
    at = F.col("x10") / F.lit(float(STEPS_PER_UNIT))
    return predict_at(points, series, keys, at, surface, name).withColumn(x, at).drop("x10")


def predict_observed(
    df: DataFrame, keys: Sequence[str], x: str, y: str, span: Span, name: str, surface: str = "interpolate"
) -> DataFrame:
    """Fitted value at each distinct observed x, one row per series and x."""
    series = series_buckets(df, keys, x, y, span)
    points = series.select(*keys, F.explode("buckets").alias("_b")).select(*keys, F.col("_b.x").alias(x))
    return predict_at(spread_rows(points, [*keys, x]), series, keys, F.col(x), surface, name).select(*keys, x, name)


def residual_traces(own: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per series: ``rss``, the residual sum of squares, and ``delta1`` and ``delta2``, the traces of M and M², with
    M = (I - L)(I - L)' and L the operator of the fits at the observations.

    ``own`` has one row a bucket, with ``b``, ``fit`` and ``operator``. Points of one x have equal operator rows and
    columns, so M is the identity plus a matrix G of one value a pair of buckets: G(a, b) = sum over c of n_c r(a, c) r(b, c),
    less r(a, b) and r(b, a). The sums are a sparse product: the entries of a column c (at most one a bucket) meet in
    one row, and their pairs are added up by (a, b) in the task that made them, then by Spark.
    """
    b = {c: F.col(f"b.{c}") for c in ("x", "n", "s", "ss")}
    squares = b["ss"] - 2 * F.col("fit") * b["s"] + b["n"] * F.col("fit") * F.col("fit")
    entry = own.select(*keys, b["x"].alias("a"), b["n"].alias("n_a"), squares.alias("rss"), F.inline("operator"))
    diagonal = F.col("a") == F.col("x")
    column = entry.groupBy(*keys, "x", "n").agg(
        F.collect_list(F.struct("a", "n_a", "r")).alias("rows"), F.max(F.when(diagonal, F.col("rss"))).alias("rss")
    )
    pairs = column.select("*", F.explode("rows").alias("p")).select("*", F.explode("rows").alias("q")).filter("p.a <= q.a")
    g = F.expr("n * p.r * q.r - IF(q.a = x, p.r, 0D) - IF(p.a = x, q.r, 0D)")
    here = F.expr("p.a = x AND q.a = x")  # once a column
    summed = pairs.groupBy(*keys, F.expr("p.a AS a"), F.expr("q.a AS b"), F.expr("p.n_a AS n_a"), F.expr("q.n_a AS n_b")).agg(
        F.sum(g).alias("g"), F.sum(F.when(here, F.col("rss"))).alias("rss"), F.sum(F.when(here, F.col("n"))).alias("n")
    )
    same = F.col("a") == F.col("b")
    points = F.col("n_a") * F.col("n_b") * F.col("g") * F.col("g")
    twice = 2 * F.col("n_a") * F.col("g")
    return summed.groupBy(*keys).agg(
        F.sum("rss").alias("rss"),
        (F.sum("n") + F.sum(F.when(same, F.col("n_a") * F.col("g")))).alias("delta1"),
        (F.sum("n") + F.sum(F.when(same, points + twice).otherwise(2 * points))).alias("delta2"),
    )


def predict_band(df: DataFrame, keys: Sequence[str], x: str, y: str, span: Span, level: float = 0.95) -> DataFrame:
    """Curve with its standard error on the grid, and the t quantile ``t`` of a confidence band of the level.

    The residual variance is the residual sum of squares over ``delta1`` of ``residual_traces``; ``df``, the degrees of freedom
    for the t quantile, is delta1² / delta2. Both come from the buckets alone.
    """
    series = series_buckets(df, keys, x, y, span)
    own = series.select(*keys, F.explode("buckets").alias("b"))
    own = local_fit(spread_rows(own, [*keys, "b"]), series, keys, F.col("b.x"), weights=True)
    residual = residual_traces(own, keys)
    residual = evaluated(residual, degrees=ratio(F.col("delta1") * F.col("delta1"), "delta2"))
    residual = evaluated(residual, t=t_quantile_at(0.5 + level / 2, F.col("degrees"))).withColumnRenamed("degrees", "df")
    points = spread_rows(grid(series, keys), [*keys, "x10"])
    at = F.col("x10") / F.lit(float(STEPS_PER_UNIT))
    curve = null_safe_join(local_fit(points, series, keys, at, errors=True), residual, keys)
    se = F.sqrt(ratio("rss", "delta1") * F.col("norm2"))
    return curve.select(*keys, "x10", at.alias(x), "fit", se.alias("se"), "delta1", "df", "t")


#: One level of the k-d partition over the bucket array: ``ends`` are the numbers of buckets left of each cell's
#: ends. A cell of more than ``_largest`` points and two buckets or more gets a cut: between the two buckets nearest its
#: median point, the later gap of two equally near.
KD_LEVEL = """
  flatten(transform(sequence(1, size(cells.ends) - 1), k ->
    transform(array(struct(cells.ends[k - 1] AS lo, cells.ends[k] AS hi,
                           (_upto[cells.ends[k]] - _upto[cells.ends[k - 1]] + 1) div 2 AS half)),
      c -> IF(c.hi - c.lo < 2 OR _upto[c.hi] - _upto[c.lo] <= _largest, array(c.hi),
        array(array_min(transform(sequence(c.lo + 1, c.hi - 1), i -> struct(
                abs(_upto[i] - _upto[c.lo] - c.half) AS off, _upto[c.lo] - _upto[i] AS later, i AS i))).i, c.hi)))[0]))"""


def _vertices(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Vertices of the one-dimensional k-d partition of each series: the outer ones, and the middle of each cut's gap.

    An array fold, level by level until no cell is cut any more; at most one level a bucket.
    """
    counted = evaluated(
        series,
        _upto=F.expr("transform(sequence(0, size(buckets)), i -> CAST(aggregate(slice(buckets, 1, i), 0D, (s, b) -> s + b.n) AS BIGINT))"),
        _largest=F.floor(F.col("size") * F.col("span") * KD_CELL),
        _margin=KD_MARGIN * F.greatest(
            F.col("x_max") - F.col("x_min"), 1e-3 * F.greatest(F.abs("x_min"), F.abs("x_max")) + 1e-30
        ),
    )
    folded = evaluated(counted, _cells=F.expr(f"""
      aggregate(sequence(1, size(buckets)), struct(array(0, size(buckets)) AS ends, true AS open),
        (cells, level) -> IF(NOT cells.open, cells,
          transform(array(concat(array(0), {KD_LEVEL})),
            next -> struct(next AS ends, size(next) > size(cells.ends) AS open))[0]))"""))
    inner = "transform(slice(_cells.ends, 2, size(_cells.ends) - 2), i -> (buckets[i - 1].x + buckets[i].x) / 2)"
    ends = F.concat(F.array(F.col("x_min") - F.col("_margin")), F.expr(inner), F.array(F.col("x_max") + F.col("_margin")))
    return folded.select(*keys, ends.alias("ends"))


def _interpolated(
    points: DataFrame, series: DataFrame, keys: Sequence[str], at: Column, name: str
) -> DataFrame:
    """Cubic Hermite blend of value and slope at the k-d vertices (about a dozen fits a series)."""
    vertices = _vertices(series, keys)
    v = vertices.select(*keys, F.explode("ends").alias("vx"))
    v = local_fit(v, series, keys, F.col("vx"))
    table = v.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("vx", "fit", "slope"))).alias("_v"))
    joined = null_safe_join(points.withColumn("_at", at), table, keys, "inner")
    left, right = F.expr("array_max(filter(_v, e -> e.vx < _at))"), F.expr("array_min(filter(_v, e -> e.vx >= _at))")
    out = evaluated(joined, _l=left, _r=right)
    width = F.col("_r.vx") - F.col("_l.vx")
    u = (F.col("_at") - F.col("_l.vx")) / width
    value = (
        F.col("_l.fit") * (1 - u) * (1 - u) * (1 + 2 * u)
        + F.col("_r.fit") * u * u * (3 - 2 * u)
        + width * (F.col("_l.slope") * u * (1 - u) * (1 - u) - F.col("_r.slope") * u * u * (1 - u))
    )
    return evaluated(out, **{name: value}).drop("_at", "_v", "_l", "_r")
