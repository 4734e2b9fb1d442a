"""Fish length queries."""

from brinewave.fixtures import SEASON
from brinewave.functions.labels import SALMON_LABELS, SAMPLING_WEEK_LABELS
from brinewave.plans import lengths
from brinewave.plans.survey import survey_seines
from brinewave.queries.catch import SS, SURVEY
from brinewave.queries.ocean import fit_ctes
from brinewave.queries.registry import query

FISH = ("fish", *SURVEY)
WEEKS = ", ".join(f"'{w}'" for w in lengths.COMPARED_WEEKS)
COMPARED = f"""compared AS (
  SELECT sampling_week, species, CASE WHEN year = {SEASON} THEN '{SEASON}' ELSE 'to {SEASON - 1}' END AS period,
         CAST(fork_length_field AS DOUBLE) AS fork_length
  FROM fish JOIN ss ON fish.seine_id = ss.seine_id
  WHERE fork_length_field <> 'NA' AND species IN ('SO', 'PI', 'CU') AND region = 'DI'
    AND (year = {SEASON} OR (year < {SEASON} AND sampling_week IN ({WEEKS}))))"""
BOXES = """boxes AS (
  SELECT sampling_week, species, period, count(*) AS n, quantile_cont(fork_length, 0.25) AS lower,
         quantile_cont(fork_length, 0.5) AS middle, quantile_cont(fork_length, 0.75) AS upper
  FROM compared GROUP BY ALL)"""
JOINED = """compared c JOIN boxes b ON c.sampling_week IS NOT DISTINCT FROM b.sampling_week
       AND c.species = b.species AND c.period = b.period"""
OUTSIDE = "(fork_length < lower - 1.5 * (upper - lower) OR fork_length > upper + 1.5 * (upper - lower))"
WEEK_ORDER = " ".join(f"WHEN '{w}' THEN {i + 1}" for i, w in enumerate(SAMPLING_WEEK_LABELS.values()))

query(
    "q23_length_boxes",
    FISH,
    f"""SELECT b.sampling_week, b.species, b.period, n, lower, middle, upper,
               least(lower, min(fork_length) FILTER (NOT {OUTSIDE})) AS ymin,
               greatest(upper, max(fork_length) FILTER (NOT {OUTSIDE})) AS ymax,
               count(*) FILTER {"(" + OUTSIDE + ")"} AS n_outliers,
               CASE b.sampling_week {WEEK_ORDER} END AS week_order
        FROM {JOINED}
        GROUP BY b.sampling_week, b.species, b.period, n, lower, middle, upper""",
    extra=(SS, COMPARED, BOXES),
    doubles=["lower", "middle", "upper", "ymin", "ymax"],
    integers=["week_order"],
)(lambda fish, *s: lengths.length_boxes(fish, survey_seines(*s), SEASON))

query(
    "a19_length_outliers",
    FISH,
    f"""SELECT b.sampling_week, b.species, b.period, fork_length, count(*) AS n
        FROM {JOINED} WHERE {OUTSIDE} GROUP BY ALL""",
    extra=(SS, COMPARED, BOXES),
    doubles=["fork_length"],
)(lambda fish, *s: lengths.length_outliers(fish, survey_seines(*s), SEASON))

query(
    "q24_field_or_lab_length",
    ["fish", "fish_lab"],
    """SELECT ufn, seine_id, species, coalesce(TRY_CAST(fork_length_field AS DOUBLE), l.fork_length) AS fork_length
       FROM fish LEFT JOIN fish_lab l USING (ufn)""",
    doubles=["fork_length"],
)(lambda fish, lab: lengths.field_or_lab(fish, lab).select("ufn", "seine_id", "species", "fork_length"))

SHOWN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SALMON_LABELS.items())
query(
    "q25_length_frequency",
    ["fish"],
    f"""SELECT CASE species {SHOWN} END AS species, floor(CAST(fork_length_field AS DOUBLE) / 5) * 5 AS bin_start,
               count(*) AS n
        FROM fish WHERE fork_length_field <> 'NA' AND species IN ('SO', 'PI', 'CU') GROUP BY ALL""",
    doubles=["bin_start"],
)(lengths.length_frequency)


def density_sql(value, width, where):
    return f"""SELECT bin_centre, n, 500 * n / (CAST(sum(n) OVER () AS DOUBLE) * {width}) AS frequency FROM (
        SELECT ceil(({value} - CAST({width / 2} AS DOUBLE)) / CAST({width} AS DOUBLE)) * {width} AS bin_centre,
               count(*) AS n FROM fish WHERE {where} GROUP BY ALL) b"""


query(
    "q25_length_density",
    ["fish"],
    density_sql("CAST(fork_length_field AS DOUBLE)", 9, "fork_length_field <> 'NA'"),
    doubles=["bin_centre", "frequency"],
)(lengths.length_density)
query(
    "q25_weight_density",
    ["fish"],
    density_sql("weight", 4, "weight IS NOT NULL"),
    doubles=["bin_centre", "frequency"],
)(lengths.weight_density)

query(
    "q43_length_against_curve",
    FISH,
    """SELECT ufn, CAST(yday AS BIGINT) AS yday, fork_length, fit AS loess_annual,
              CASE WHEN fork_length < fit THEN 'lower' ELSE 'higher' END AS higher_or_lower
       FROM placed JOIN fitted ON placed.yday = fitted.x0 WHERE year = 2001 AND fit IS NOT NULL""",
    extra=(
        SS,
        """placed AS (
  SELECT ufn, year, yday, CAST(fork_length_field AS DOUBLE) AS fork_length
  FROM fish JOIN ss ON fish.seine_id = ss.seine_id
  WHERE fork_length_field <> 'NA' AND species = 'SO' AND region = 'DI')""",
        """buckets AS (
  SELECT 'SO' AS station, CAST(yday AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n, sum(fork_length) AS s
  FROM placed WHERE year < 2001 GROUP BY yday)""",
        "sizes AS (SELECT station, least(floor(sum(n) + 1e-5), sum(n)) AS q FROM buckets GROUP BY station)",
        "days AS (SELECT station, x AS x0 FROM buckets)",
        *fit_ctes("days"),
    ),
    doubles=["fork_length", "loess_annual"],
    digits=6,
)(lambda fish, *s: lengths.length_against_curve(fish, survey_seines(*s), SEASON, surface="direct"))
