"""Three-parameter logistic growth curves, y = asym / (1 + exp((mid - x) / scale)).

The residual sum of a fit depends on the points of one x only through their number, mean and squares, so the
points are first reduced to one row per distinct x (a whole number of a bounded range, as a day of the year: at most
366 a group). A group is then one row that carries these as an array, and the whole iteration is a fold over it in column
expressions: no Python, no collecting on the driver, one plan for any number of groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinewave.functions.nulls import rows
from brinewave.operators.joins import null_safe_join
from brinewave.operators.smoothing import evaluated

MAX_STEPS = 50
HALVINGS = 10
TOLERANCE = 1e-5
SMALLEST_STEP = 1e-12  # relative; an exact fit leaves no residual to compare
SINGULAR = 1e-18  # determinant over the product of the diagonal

_PARAMETERS = ("asym", "mid", "scale")


def _curve(b: str) -> str:
    """The curve over asym at ``p.x``, for the parameters in struct ``b``."""
    return f"(1 / (1 + exp(({b}.mid - p.x) / {b}.scale)))"


def _residual(b: str) -> str:
    """Residual sum of squares around the means of each x."""
    return f"aggregate(points, 0D, (sum, p) -> sum + p.n * power(p.mean - {b}.asym * {_curve(b)}, 2))"


# weighted gradient entries of each point: f, and the derivatives by mid and scale
_GRADIENT = f"""
  transform(transform(points, p -> struct(p.x AS x, p.n AS n, p.mean AS mean, {_curve("s")} AS f)),
    p -> struct(p.n AS n, p.mean - s.asym * p.f AS r, p.f AS j0, -s.asym * p.f * (1 - p.f) / s.scale AS j1,
                s.asym * p.f * (1 - p.f) / s.scale * (s.mid - p.x) / s.scale AS j2))"""


def _sum(term: str) -> str:
    return f"aggregate(g.each, 0D, (sum, p) -> sum + p.n * {term})"


_NORMAL = ", ".join(
    [f"{_sum(f'p.j{i} * p.j{j}')} AS a{i}{j}" for i in range(3) for j in range(i, 3)]
    + [f"{_sum(f'p.j{i} * p.r')} AS r{i}" for i in range(3)]
    + [f"{_sum('p.r * p.r')} AS rss"]
)

# the step by the adjugate of the symmetric normal matrix, and the share of the residual it explains
_ADJUGATE = """
  struct(m.*, m.a11 * m.a22 - m.a12 * m.a12 AS c00, m.a02 * m.a12 - m.a01 * m.a22 AS c01, m.a01 * m.a12 - m.a02 * m.a11 AS c02,
         m.a00 * m.a22 - m.a02 * m.a02 AS c11, m.a01 * m.a02 - m.a00 * m.a12 AS c12, m.a00 * m.a11 - m.a01 * m.a01 AS c22)"""


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _fields(of: str, names: Sequence[str]) -> str:
    return ", ".join(f"{of}.{n} AS {n}" for n in names)


def _step() -> str:
    """One Gauss-Newton step from state ``s`` (parameters, factor, converged, open).

    All halvings of the step are tried at once and the largest accepted one is taken, from the last factor doubled.
    """
    normal = [*(f"a{i}{j}" for i in range(3) for j in range(i, 3)), "r0", "r1", "r2", "rss"]
    adjugate = _ADJUGATE.replace("m.*", _fields("m", normal))
    solved = """struct(
      c.rss AS rss, c.a00 * c.c00 + c.a01 * c.c01 + c.a02 * c.c02 AS det, c.a00 * c.a11 * c.a22 AS scaled,
      c.c00 * c.r0 + c.c01 * c.r1 + c.c02 * c.r2 AS u0, c.c01 * c.r0 + c.c11 * c.r1 + c.c12 * c.r2 AS u1,
      c.c02 * c.r0 + c.c12 * c.r1 + c.c22 * c.r2 AS u2, c.r0 AS r0, c.r1 AS r1, c.r2 AS r2)"""
    moved = f"""struct(t.rss AS rss, t.det > {SINGULAR} * t.scaled AS regular, t.u0 / nullif(t.det, 0D) AS d0,
      t.u1 / nullif(t.det, 0D) AS d1, t.u2 / nullif(t.det, 0D) AS d2,
      (t.u0 * t.r0 + t.u1 * t.r1 + t.u2 * t.r2) / nullif(t.det, 0D) AS explained)"""
    trial = "struct(s.asym + k * d.d0 AS asym, s.mid + k * d.d1 AS mid, s.scale + k * d.d2 AS scale, k AS factor)"
    trials = f"""filter(
      transform(transform(filter(factors, k -> k <= s.factor), k -> {trial}),
                b -> struct(b.asym AS asym, b.mid AS mid, b.scale AS scale, b.factor AS factor, {_residual("b")} AS rss)),
      b -> b.rss <= d.rss)"""  # a NaN is larger than any number
    stay = "struct(s.asym AS asym, s.mid AS mid, s.scale AS scale, s.factor AS factor, {} AS converged, false AS open)"
    go = "struct(b.asym AS asym, b.mid AS mid, b.scale AS scale, least(2 * b.factor, 1D) AS factor, false AS converged, true AS open)"
    done = f"""d.explained <= {TOLERANCE**2!r}D * greatest(d.rss + noise - d.explained, 1e-300D)
      OR greatest(abs(d.d0), abs(d.d1), abs(d.d2)) <= {SMALLEST_STEP!r}D * greatest(abs(s.asym), abs(s.mid), abs(s.scale))"""
    taken = _let("all_trials", trials, f"IF(size(all_trials) = 0, {stay.format('false')}, {_let('b', 'all_trials[0]', go)})")
    chosen = f"CASE WHEN NOT coalesce(d.regular, false) THEN {stay.format('false')} WHEN {done} THEN {stay.format('true')} ELSE {taken} END"
    body = _let("d", _let("t", _let("c", _let("m", _let("g", f"struct({_GRADIENT} AS each)", f"struct({_NORMAL})"), adjugate), solved), moved), chosen)
    return f"IF(NOT s.open, s, {body})"


def logistic_fits(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """One row per group: asym, mid, scale, whether the fit converged, points and x range.

    Gauss-Newton with step halving from (largest y, median x, 1); converged once the step explains a share of the
    residual below the tolerance. A group with fewer than three distinct x, a singular step or no accepted halving has not
    converged and keeps its last parameters.
    """
    reduced = (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(group).cast("string").alias(group), F.col(x).cast("double").alias("x"))
        .agg(rows().alias("n"), F.avg(y).alias("mean"), F.max(y).cast("double").alias("top"),
             (F.var_pop(y) * rows()).alias("noise"))
    )
    point = F.struct("x", F.col("n").cast("double").alias("n"), F.col("mean").cast("double").alias("mean"))
    one = reduced.groupBy(group).agg(
        F.sort_array(F.collect_list(point)).alias("points"), F.max("top").alias("asym"), F.sum("noise").alias("noise"),
        F.sum("n").alias("n"), F.min("x").alias("x_min"), F.max("x").alias("x_max"),
    )
    # the median of x by counts: the middle point, or the mean of both
    upto = "transform(points, p -> struct(p.x AS x, aggregate(filter(points, o -> o.x <= p.x), 0D, (sum, o) -> sum + o.n) AS c))"
    one = evaluated(one, _upto=F.expr(upto))
    middle = "array_min(transform(filter(_upto, p -> p.c > {}), p -> p.x))"
    median = F.expr(f"({middle.format('(n - 1) div 2')} + {middle.format('n div 2')}) / 2")
    start = F.struct(
        F.col("asym"), median.alias("mid"), F.lit(1.0).alias("scale"), F.lit(1.0).alias("factor"),
        F.lit(False).alias("converged"), (F.size("points") >= 3).alias("open"),
    )
    factors = F.array(*[F.lit(2.0**-k) for k in range(HALVINGS + 1)])
    one = evaluated(one, _start=start, factors=factors)
    fitted = evaluated(one, _fit=F.expr(f"aggregate(sequence(1, {MAX_STEPS}), _start, (s, turn) -> {_step()})"))
    return fitted.select(group, *[F.col(f"_fit.{c}").alias(c) for c in _PARAMETERS], F.col("_fit.converged").alias("converged"),
                         "n", "x_min", "x_max")


def curve_points(fits: DataFrame, group: str, base: str, x: str, points: int, name: str) -> DataFrame:
    """Fitted curves on one even grid over the x range of the ``base`` group.

    ``fits`` has one row a group, so the window that carries the base range to all groups is tiny.
    """
    everyone = Window.partitionBy(F.lit(0))
    is_base = F.col(group) == base
    low = F.max(F.when(is_base, F.col("x_min"))).over(everyone)
    high = F.max(F.when(is_base, F.col("x_max"))).over(everyone)
    ranged = fits.withColumns({"_low": low, "_step": (high - low) / F.lit(float(points - 1))})
    grid = ranged.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn(x, F.col("_low") + F.col("point") * F.col("_step"))
    curve = F.col("asym") / (1 + F.exp((F.col("mid") - F.col(x)) / F.col("scale")))
    return grid.withColumn(name, curve).drop("_low", "_step")


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Slope and intercept of the simple regression of y on x by group."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n")
    )


def with_trend(df: DataFrame, keys: Sequence[str], x: str, y: str, name: str = "trend") -> DataFrame:
    """Attach the fitted value of the group's regression line to each row."""
    line = linear_trend(df, keys, x, y).drop("n")
    fitted = null_safe_join(df, line, keys)
    return fitted.withColumn(name, F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")
