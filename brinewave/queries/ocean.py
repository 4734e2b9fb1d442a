"""Ocean and wind queries."""

from brinewave.fixtures import SEASON
from brinewave.operators.smoothing import predict_grid
from brinewave.plans import ocean, wind
from brinewave.queries.registry import query

CTD_AGG = "avg(temperature) AS mean_temp, avg(dissolved_oxygen_ml_l) AS mean_do, avg(salinity) AS mean_salinity"
CTD_DOUBLES = ["mean_temp", "mean_do", "mean_salinity"]
MERGED = """merged AS (
  SELECT * REPLACE (CASE WHEN station IN ('JS2', 'JS12') THEN 'js2_12' ELSE station END AS station),
         year(date) AS year, dayofyear(date) AS yday FROM ctd WHERE depth <= 30)"""
AVERAGE = f"""average AS (
  SELECT station, date, yday, {CTD_AGG} FROM merged
  WHERE year <> {SEASON} AND yday > 32 AND yday < 213 GROUP BY station, date, yday)"""
THIS_YEAR = f"""this_year AS (
  SELECT station, yday, {CTD_AGG} FROM merged
  WHERE year = {SEASON} AND yday > 32 AND yday < 213 GROUP BY station, yday)"""


def fit_ctes(points: str, prefix: str = "") -> list[str]:
    """The local quadratic fit at the (station, x0) rows of ``points``, over the CTE ``buckets``."""
    p = prefix
    return [
        f"""{p}near AS (
  SELECT p.station, p.x0, b.x, b.n, b.s, abs(b.x - p.x0) AS d,
         sum(b.n) OVER (PARTITION BY p.station, p.x0 ORDER BY abs(b.x - p.x0)
                        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM {points} p JOIN buckets b USING (station))""",
        f"""{p}width AS (
  SELECT station, x0, min(d) AS h FROM {p}near JOIN sizes USING (station) WHERE upto >= q GROUP BY station, x0)""",
        f"""{p}moments AS (
  SELECT station, x0, sum(w * n) AS m0, sum(w * n * e) AS m1, sum(w * n * e ** 2) AS m2, sum(w * n * e ** 3) AS m3,
         sum(w * n * e ** 4) AS m4, sum(w * s) AS t0, sum(w * s * e) AS t1, sum(w * s * e ** 2) AS t2,
         sum(w * w * n) AS v0, sum(w * w * n * e) AS v1, sum(w * w * n * e ** 2) AS v2,
         sum(w * w * n * e ** 3) AS v3, sum(w * w * n * e ** 4) AS v4
  FROM (SELECT *, x - x0 AS e, (1 - (d / h) ** 3) ** 3 AS w FROM {p}near JOIN {p}width USING (station, x0)
        WHERE d < h) k GROUP BY station, x0)""",
        f"""{p}solved AS (
  SELECT *, m2 * m4 - m3 * m3 AS a0, m2 * m3 - m1 * m4 AS a1, m1 * m3 - m2 * m2 AS a2,
         m0 * (m2 * m4 - m3 * m3) + m1 * (m2 * m3 - m1 * m4) + m2 * (m1 * m3 - m2 * m2) AS det FROM {p}moments)""",
        f"""{p}fitted AS (
  SELECT station, x0, (a0 * t0 + a1 * t1 + a2 * t2) / nullif(det, 0) AS fit,
         (a1 * t0 + (m0 * m4 - m2 * m2) * t1 + (m1 * m2 - m0 * m3) * t2) / nullif(det, 0) AS slope,
         (a0 * a0 * v0 + 2 * a0 * a1 * v1 + (2 * a0 * a2 + a1 * a1) * v2 + 2 * a1 * a2 * v3 + a2 * a2 * v4)
           / nullif(det * det, 0) AS norm2 FROM {p}solved)""",
    ]


SPAN = "CAST(0.65 AS DOUBLE)"
STATION_SPANS = {"QU39": 0.35, "QU29": 0.5}
STATION_SPAN = "CAST(CASE station WHEN 'QU39' THEN 0.35 WHEN 'QU29' THEN 0.5 ELSE 0.65 END AS DOUBLE)"
SERIES = [
    """buckets AS (
  SELECT station, CAST(yday AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n, sum(mean_temp) AS s,
         sum(mean_temp * mean_temp) AS ss
  FROM average WHERE mean_temp IS NOT NULL GROUP BY station, yday)""",
    """sizes AS (
  SELECT station, least(floor(sum(n) * span + 1e-5), sum(n)) AS q, sum(n) AS n, min(x) AS x_min, max(x) AS x_max, span
  FROM (SELECT *, {span} AS span FROM buckets) b GROUP BY station, span)""",
    """grid AS (
  SELECT station, x10, x10 / CAST(10 AS DOUBLE) AS x0 FROM (
    SELECT station, unnest(generate_series(CAST(x_min * 10 AS BIGINT), CAST(x_max * 10 AS BIGINT))) AS x10
    FROM sizes) g)""",
]


def spans(ctes: list[str], span: str) -> list[str]:
    return [c.replace("{span}", span) for c in ctes]


CURVE = spans([MERGED, AVERAGE, *SERIES, *fit_ctes("grid")], SPAN)

#: The k-d partition of the days of a station, by recursion over cells (buckets low + 1 to high), and the blend.
VERTICES = [
    """ranked AS MATERIALIZED (
  SELECT station, x, row_number() OVER w AS i, CAST(sum(n) OVER w AS BIGINT) AS upto, lead(x) OVER w AS next_x,
         count(*) OVER (PARTITION BY station) AS m
  FROM buckets WINDOW w AS (PARTITION BY station ORDER BY x ROWS UNBOUNDED PRECEDING))""",
    """cells AS (
  SELECT DISTINCT station, CAST(0 AS BIGINT) AS low, m AS high, max(upto) OVER (PARTITION BY station) AS size,
         CAST(0 AS BIGINT) AS below FROM ranked
  UNION ALL
  SELECT station, unnest([low, cut]), unnest([cut, high]), unnest([seen, size - seen]), unnest([below, below + seen])
  FROM (SELECT station, low, high, size, below, best[3] AS cut, -best[2] AS seen
        FROM (SELECT c.station, c.low, c.high, c.size, c.below,
                     min((abs(r.upto - c.below - (c.size + 1) // 2), c.below - r.upto, r.i)) AS best
              FROM cells c JOIN ranked r ON r.station = c.station AND r.i > c.low AND r.i < c.high
                JOIN sizes s ON s.station = c.station
              WHERE c.size > floor(s.n * s.span * 0.2) GROUP BY ALL) b) p)""",
    """vertices AS (
  SELECT DISTINCT r.station, (x + next_x) / 2 AS x0 FROM cells c JOIN ranked r ON r.station = c.station AND r.i = c.high
  WHERE next_x IS NOT NULL
  UNION ALL
  SELECT station, unnest([x_min - margin, x_max + margin]) FROM (
    SELECT *, 0.005::DOUBLE * greatest(x_max - x_min, 1e-3 * greatest(abs(x_min), abs(x_max)) + 1e-30) AS margin FROM sizes) s)""",
]
BLEND = """blended AS (
  SELECT * EXCLUDE (l_fit, l_slope, r_fit, r_slope, width, u),
         l_fit * (1 - u) ** 2 * (1 + 2 * u) + r_fit * u ** 2 * (3 - 2 * u)
           + width * (l_slope * u * (1 - u) ** 2 - r_slope * u ** 2 * (1 - u)) AS fit
  FROM (SELECT g.*, f.fit AS l_fit, f.slope AS l_slope, f.r_fit, f.r_slope, f.r_x - f.x0 AS width,
               (g.x0 - f.x0) / (f.r_x - f.x0) AS u
        FROM {points} g JOIN (
          SELECT station, x0, fit, slope, lead(x0) OVER w AS r_x, lead(fit) OVER w AS r_fit, lead(slope) OVER w AS r_slope
          FROM v_fitted WINDOW w AS (PARTITION BY station ORDER BY x0)) f
        ON f.station = g.station AND g.x0 > f.x0 AND g.x0 <= f.r_x) g)"""


def interpolated(span: str) -> list[str]:
    return spans([MERGED, AVERAGE, *SERIES, *VERTICES, *fit_ctes("vertices", "v_"), BLEND.replace("{points}", "grid")], span)



@query(
    "q01_ctd_climatology",
    ["ctd"],
    f"""SELECT station, date, dayofyear(date) AS yday, {CTD_AGG} FROM ctd
        WHERE station = 'QU39' AND depth <= 30 AND year(date) <> {SEASON}
          AND dayofyear(date) > 32 AND dayofyear(date) < 213 GROUP BY station, date""",
    doubles=CTD_DOUBLES,
)
def ctd_climatology(ctd):
    return ocean.climatology(ctd, SEASON, stations=["QU39"])


query(
    "q01_ctd_all_year_series",
    ["ctd"],
    f"""SELECT date, station, {CTD_AGG} FROM ctd WHERE depth <= 30 GROUP BY date, station""",
    doubles=CTD_DOUBLES,
)(ocean.regional_series)

query(
    "q02_season_daily_means",
    ["ctd"],
    "SELECT * FROM this_year",
    extra=(MERGED, THIS_YEAR),
    doubles=CTD_DOUBLES,
)(lambda ctd: ocean.season_means(ocean.merged_stations(ctd), SEASON))

query(
    "m01_loess_grid",
    ["ctd"],
    "SELECT station, x10, x0 AS yday, fit AS predicted FROM grid JOIN fitted USING (station, x0)",
    extra=CURVE,
    doubles=["predicted"],
    digits=6,
)(lambda ctd: predict_grid(
    ocean.climatology(ocean.merged_stations(ctd), SEASON), ["station"], "yday", "mean_temp", 0.65, "direct"
))

query(
    "m01_loess_grid_interpolated",
    ["ctd"],
    "SELECT station, x10, x0 AS yday, fit AS predicted FROM blended",
    extra=interpolated(SPAN),
    doubles=["predicted"],
    digits=6,
    recursive=True,
)(lambda ctd: predict_grid(ocean.climatology(ocean.merged_stations(ctd), SEASON), ["station"], "yday", "mean_temp", 0.65))

OBSERVED = [
    THIS_YEAR,
    """observed AS (
  SELECT t.station, x0 AS yday, fit AS predicted_mean_temp, mean_temp, mean_do, mean_salinity,
         CASE WHEN mean_temp > fit THEN 'pos' ELSE 'neg' END AS diff
  FROM {curve} g JOIN this_year t ON t.station = g.station AND t.yday * 10 = g.x10
  WHERE mean_temp IS NOT NULL AND fit IS NOT NULL)""",
    """paired AS (
  SELECT *, lead(yday) OVER w AS yday2, lead(predicted_mean_temp) OVER w AS p2, lead(diff) OVER w AS diff2
  FROM observed WINDOW w AS (PARTITION BY station ORDER BY yday))""",
    """anomaly AS (
  SELECT * FROM observed
  UNION ALL BY NAME
  SELECT station, (yday + yday2) / 2 AS yday, (predicted_mean_temp + p2) / 2 AS predicted_mean_temp,
         (predicted_mean_temp + p2) / 2 AS mean_temp FROM paired WHERE diff <> diff2)""",
]
ANOMALY = [*CURVE, *(c.replace("{curve}", "(SELECT * FROM grid JOIN fitted USING (station, x0))") for c in OBSERVED)]


def interpolated_anomaly(span: str) -> list[str]:
    return [*interpolated(span), *(c.replace("{curve}", "blended") for c in OBSERVED)]


ANOMALY_DOUBLES = ["yday", "predicted_mean_temp", *CTD_DOUBLES]
query(
    "q03_temperature_anomaly",
    ["ctd"],
    "SELECT * FROM anomaly",
    extra=ANOMALY,
    doubles=ANOMALY_DOUBLES,
    digits=6,
)(lambda ctd: ocean.temperature_anomaly(ctd, SEASON, surface="direct"))

query(
    "q03_temperature_anomaly_interpolated",
    ["ctd"],
    "SELECT * FROM anomaly",
    extra=interpolated_anomaly(SPAN),
    doubles=ANOMALY_DOUBLES,
    digits=6,
    recursive=True,
)(lambda ctd: ocean.temperature_anomaly(ctd, SEASON))

query(
    "q03_temperature_anomaly_station_spans",
    ["ctd"],
    "SELECT * FROM anomaly",
    extra=interpolated_anomaly(STATION_SPAN),
    doubles=ANOMALY_DOUBLES,
    digits=6,
    recursive=True,
)(lambda ctd: ocean.temperature_anomaly(ctd, SEASON, span=STATION_SPANS))

query(
    "f11_anomaly_sides",
    ["ctd"],
    """SELECT *, 'above' AS side FROM anomaly WHERE mean_temp >= predicted_mean_temp
       UNION ALL SELECT *, 'below' FROM anomaly WHERE mean_temp <= predicted_mean_temp""",
    extra=ANOMALY,
    doubles=ANOMALY_DOUBLES,
    digits=6,
)(lambda ctd: ocean.sides(ocean.temperature_anomaly(ctd, SEASON, surface="direct")))

query(
    "q04_day_of_year_envelope",
    ["ctd"],
    """SELECT station, yday, min(mean_temp) AS min_temp, max(mean_temp) AS max_temp FROM (
         SELECT station, year, yday, CASE WHEN count(temperature) = count(*) THEN avg(temperature) END AS mean_temp
         FROM merged GROUP BY station, year, yday) y GROUP BY station, yday""",
    extra=(MERGED,),
    doubles=["min_temp", "max_temp"],
)(lambda ctd: ocean.envelope(ocean.merged_stations(ctd)))

#: The t quantile by bisection on the area under the density from 0 (Simpson's rule on 400 intervals).
T95 = """list_reduce(range(60), lambda s, k: CASE WHEN 0.5 + s[2] / 1200 * list_sum(list_transform(range(401), lambda i:
      CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * s[3] * (1 + (i * s[2] / 400) ** 2 / s[4]) ** (-(s[4] + 1) / 2)))
    < 0.975 THEN [s[2], s[2] + (s[5] - s[2]) / 2, s[3], s[4], s[5]] ELSE [s[1], s[1] + (s[2] - s[1]) / 2, s[3], s[4], s[2]] END,
    [0.0, 25.0, exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()), df, 50.0])[2]"""
query(
    "q05_climatology_band",
    ["ctd"],
    """SELECT station, x0 AS yday, fit, se, fit - t * se AS lower, fit + t * se AS upper FROM (
          SELECT station, x0, fit, sqrt(rss / delta1 * norm2) AS se, t FROM fitted JOIN quantiles USING (station)) b""",
    extra=(
        *CURVE,
        "own_days AS (SELECT station, x AS x0 FROM buckets)",
        *fit_ctes("own_days", "own_"),
        """entries AS MATERIALIZED (
  SELECT station, k.x0 AS a, k.x AS c, k.n AS n_c, w * (a0 + a1 * e + a2 * e * e) / det AS r
  FROM (SELECT *, x - x0 AS e, (1 - (d / h) ** 3) ** 3 AS w FROM own_near JOIN own_width USING (station, x0) WHERE d < h) k
    JOIN own_solved USING (station, x0))""",
        """products AS (
  SELECT l.station, l.a, r.a AS b, sum(l.n_c * l.r * r.r) AS g
  FROM entries l JOIN entries r ON l.station = r.station AND l.c = r.c GROUP BY l.station, l.a, r.a),
  identity_less_operator AS (
  SELECT station, a, b, CASE WHEN a = b THEN 1.0 ELSE 0.0 END + sum(g) AS whole, sum(g) AS g FROM (
    SELECT * FROM products UNION ALL SELECT station, a, c, -r FROM entries UNION ALL SELECT station, c, a, -r FROM entries) u
  GROUP BY station, a, b)""",
        """traces AS (
  SELECT m.station, sum(CASE WHEN a = b THEN p.n * whole END) AS delta1,
         sum(p.n * q.n * m.g ** 2) + sum(CASE WHEN a = b THEN p.n * (1 + 2 * m.g) END) AS delta2
  FROM identity_less_operator m JOIN buckets p ON p.station = m.station AND p.x = a
    JOIN buckets q ON q.station = m.station AND q.x = b GROUP BY m.station)""",
        """residual AS (
  SELECT station, sum(ss - 2 * fit * s + n * fit * fit) AS rss
  FROM buckets b JOIN own_fitted f USING (station) WHERE b.x = f.x0 GROUP BY station)""",
        f"quantiles AS MATERIALIZED (SELECT *, {T95} AS t FROM (SELECT *, delta1 ** 2 / delta2 AS df FROM traces JOIN residual USING (station)) d)",
    ),
    doubles=["fit", "se", "lower", "upper"],
    digits=6,
)(lambda ctd: ocean.climatology_band(ocean.climatology(ocean.merged_stations(ctd), SEASON)))

query(
    "q06_corridor_means",
    ["ctd", "casts", "surveys", "sites"],
    """SELECT survey_date, zone, avg(temperature) AS mean_temp30, avg(dissolved_oxygen_ml_l) AS "mean_DO30",
              avg(salinity) AS mean_salinity_30
       FROM ctd LEFT JOIN casts USING (station, date, cast_number) LEFT JOIN surveys USING (survey_id)
       LEFT JOIN sites USING (site_id)
       WHERE depth <= 30 AND site_id IS NOT NULL AND site_id NOT IN (7, 8) GROUP BY survey_date, zone""",
    doubles=["mean_temp30", '"mean_DO30"', "mean_salinity_30"],
)(lambda ctd, casts, surveys, sites: ocean.corridor_means(ctd, casts, surveys, sites, [7, 8]))

query(
    "q07_region_temperature_fluorometry",
    ["ctd_2017"],
    """SELECT region, date, avg(temperature) AS avg_temp,
              CASE WHEN count(chlorophyll) = count(*) THEN avg(chlorophyll) END AS chlorophyll
       FROM (SELECT *, CAST(split_part(filename, '_', 2) AS DATE) AS date FROM ctd_2017) c
       WHERE depth <= 30 AND date > DATE '1996-03-01' GROUP BY region, date""",
    doubles=["avg_temp", "chlorophyll"],
)(lambda casts: ocean.region_profile(casts, "1996-03-01"))

query(
    "q08_chlorophyll_daily_means",
    ["chl", "chl_sites"],
    """SELECT date, site_id, avg(chla) AS chl_a_avg FROM chl
       WHERE filter_type = 'Bulk GF/F' AND line_out_depth <= 30 AND date > DATE '1997-03-15'
         AND site_id IN (SELECT site_id FROM chl_sites)
       GROUP BY date, site_id HAVING count(chla) = count(*)""",
    doubles=["chl_a_avg"],
)(lambda chl, chl_sites: ocean.chlorophyll_means(chl, chl_sites, "1997-03-15"))

query(
    "q09_surface_temperature",
    ["sst"],
    """SELECT survey, date, CASE WHEN count(temp) = count(*) THEN avg(temp) END AS avg_temp
       FROM sst GROUP BY survey, date""",
    doubles=["avg_temp"],
)(ocean.surface_temperature)

query("q10_secchi_series", ["secchi"], "SELECT * FROM secchi WHERE year(date) > 1999", doubles=["line_out_depth"])(
    lambda secchi: ocean.secchi_since(secchi, 1999)
)

query(
    "q11_wind_table",
    ["wind_direction", "wind_speed"],
    f"""SELECT split_part(stamp, ' ', 1) AS date, substr(stamp, strpos(stamp, ' ') + 1) AS time, d.year, d.month,
               wind_dir, wind_spd, wind_spd * 1.9438444924574::DOUBLE AS knots
        FROM wind_direction d JOIN wind_speed s USING (stamp)
        WHERE wind_dir IS NOT NULL AND wind_spd IS NOT NULL AND d.year = {SEASON}""",
    doubles=["wind_dir", "wind_spd", "knots"],
)(lambda direction, speed: wind.wind_table(direction, speed, SEASON))

ROSE = """SELECT month, speed_bin, sector, compass, n, n / CAST(sum(n) OVER () AS DOUBLE) AS frequency FROM (
  SELECT month, speed_bin, sector,
         (['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'])[sector + 1] AS compass,
         count(*) AS n
  FROM (SELECT month, CASE WHEN wind_spd > 0 AND wind_spd <= 3 THEN '0 - 3'
                           WHEN wind_spd > 3 AND wind_spd <= 6 THEN '3 - 6'
                           WHEN wind_spd > 6 AND wind_spd <= 9 THEN '6 - 9' {over} END AS speed_bin,
               CAST(ceil((wind_dir - 11.25::DOUBLE) / 22.5::DOUBLE) AS BIGINT) % 16 AS sector
        FROM wind WHERE wind_spd IS NOT NULL AND wind_dir IS NOT NULL) b GROUP BY ALL) c"""
query("q11_wind_rose", ["wind"], ROSE.format(over=""), doubles=["frequency"])(wind.monthly_rose)
query(
    "a22_wind_rose_overflow",
    ["wind"],
    ROSE.format(
        over="WHEN wind_spd > 9 THEN '9 - ' || (SELECT CAST(max(wind_spd) AS VARCHAR) FROM wind WHERE wind_dir IS NOT NULL)"
    ),
    doubles=["frequency"],
)(lambda w: wind.monthly_rose(w, speed_max=9.0))

