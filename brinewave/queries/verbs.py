"""Single-operator queries: projections, filters, joins, grouping, ordering, reshaping, scalars."""

from pyspark.sql import functions as F

from brinewave.fixtures import SEASON
from brinewave.functions import dates, labels, nulls, numeric
from brinewave.operators import bins, columns, grouping, growth, joins, ordered, reshape
from brinewave.plans import lice
from brinewave.plans.catch import filled
from brinewave.plans.survey import star
from brinewave.queries.catch import T_VALUES, WEEK_CASE, on_ss, ss_query, strict
from brinewave.queries.registry import query

TOTALS = ["so_total", "pi_total", "cu_total", "co_total", "he_total", "ck_total"]
COUNTS = ", ".join(TOTALS)

# ---- projections ----

query(
    "p01_select_rename_drop",
    ["seines"],
    """SELECT seine_id AS "Seine ID", so_total AS "Sockeye", pi_total AS pink FROM seines""",
)(
    lambda seines: columns.rename(
        seines.select("seine_id", "so_total", "pi_total", "he_total").drop("he_total"),
        **{"Seine ID": "seine_id", "Sockeye": "so_total", "pink": "pi_total"},
    )
)
query("p04_positional_range", ["seines"], "SELECT seine_id, pi_total, cu_total, co_total FROM seines")(
    lambda seines: seines.select("seine_id", *columns.columns_between(seines, "pi_total", "co_total"))
)
query(
    "p05_dependent_columns",
    ["seines"],
    """SELECT seine_id, so_total + pi_total AS salmon, (so_total + pi_total) * 2 AS doubled FROM seines""",
)(
    lambda seines: seines.withColumn("salmon", nulls.row_sum(["so_total", "pi_total"]))
    .withColumn("doubled", F.col("salmon") * 2)
    .select("seine_id", "salmon", "doubled")
)
query(
    "p06_transmute",
    ["fish"],
    "SELECT ufn, weight / 1000 AS kilograms FROM fish",
    doubles=["kilograms"],
)(lambda fish: fish.select("ufn", (F.col("weight") / 1000).alias("kilograms")))
query(
    "p07_change_listed_columns",
    ["seines"],
    "SELECT seine_id, " + ", ".join(f"sqrt({c}) AS {c}" for c in TOTALS) + " FROM seines",
    doubles=TOTALS,
)(lambda seines: columns.change_at(seines.drop("survey_id"), TOTALS, F.sqrt))
query(
    "p08_round_numeric_columns",
    ["seines"],
    """SELECT survey_id % 40 AS grp, round_even(avg(pi_total), 1) AS mean_pink, round_even(avg(he_total), 1) AS mean_herring,
       count(*) AS n FROM seines GROUP BY 1""",
    doubles=["mean_pink", "mean_herring"],
)(
    lambda seines: columns.change_numeric(
        seines.groupBy((F.col("survey_id") % 40).alias("grp")).agg(
            F.avg("pi_total").alias("mean_pink"), F.avg("he_total").alias("mean_herring"), nulls.rows().alias("n")
        ),
        lambda c: numeric.half_even(c, 1),
    )
)
query(
    "p09_conditional",
    ["seines"],
    """SELECT seine_id, CASE WHEN so_total > 0 THEN 'caught' WHEN so_total <= 0 THEN 'empty' END AS outcome FROM seines""",
)(
    lambda seines: seines.select(
        "seine_id", F.when(F.col("so_total") > 0, "caught").when(F.col("so_total") <= 0, "empty").alias("outcome")
    )
)
query(
    "p10_recode",
    ["fish"],
    """SELECT ufn, CASE species WHEN 'SO' THEN 'Sockeye' WHEN 'PI' THEN 'Pink' WHEN 'CU' THEN 'Chum' ELSE species END
       AS species FROM fish""",
)(lambda fish: fish.select("ufn", labels.recode("species", labels.SALMON_LABELS).alias("species")))
query(
    "p11_recode_factor",
    ["surveys"],
    f"""SELECT survey_id, CASE (dayofyear(survey_date) + 4) // 7 {WEEK_CASE} END AS sampling_week,
        CASE WHEN (dayofyear(survey_date) + 4) // 7 BETWEEN 18 AND 28
             THEN (dayofyear(survey_date) + 4) // 7 - 17 END AS week_order FROM surveys""",
    integers=["week_order"],
)(
    lambda surveys: surveys.select(
        "survey_id", labels.sampling_week_label(dates.sampling_week("survey_date")).alias("sampling_week")
    ).withColumn("week_order", labels.sampling_week_position("sampling_week"))
)
query(
    "p12_factor_relevel",
    ["sites"],
    """SELECT site_id, zone, CASE zone WHEN 'W' THEN 1 WHEN 'C' THEN 2 WHEN 'E' THEN 3 END AS zone_order FROM sites""",
    integers=["site_id", "zone_order"],
)(lambda sites: sites.select("site_id", "zone", labels.position("zone", ["W", "C", "E"]).alias("zone_order")))
query("p13_constant_tag", ["fish_lab"], "SELECT *, 'lab' AS origin FROM fish_lab", doubles=["fork_length"])(
    lambda lab: lab.withColumn("origin", F.lit("lab"))
)

# ---- filters ----

ss_query("f01_comparison", "SELECT seine_id, yday FROM ss WHERE so_total > 0 AND yday > 32 AND yday < 213")(
    on_ss(lambda ss: ss.filter("so_total > 0 AND yday > 32 AND yday < 213").select("seine_id", "yday"))
)
query("f02_membership", ["fish"], "SELECT ufn, species FROM fish WHERE species IN ('SO', 'PI', 'CU')")(
    lambda fish: fish.filter(F.col("species").isin(*lice.SALMON)).select("ufn", "species")
)
query(
    "f03_non_membership_keeps_missing",
    ["surveys"],
    "SELECT survey_id, site_id FROM surveys WHERE site_id IS NULL OR site_id NOT IN (3, 5, 8)",
)(lambda surveys: surveys.filter(nulls.not_in("site_id", [3, 5, 8])).select("survey_id", "site_id"))
query("f04_drop_missing_in_columns", ["seines"], "SELECT * FROM seines WHERE so_total IS NOT NULL")(
    lambda seines: nulls.complete(seines, ["so_total"])
)
query("f05_drop_any_missing", ["seines"], "SELECT * FROM seines WHERE so_total IS NOT NULL AND cu_total IS NOT NULL")(
    lambda seines: nulls.complete(seines)
)
query("f06_text_sentinel", ["fish"], "SELECT ufn FROM fish WHERE fork_length_field <> 'NA'")(
    lambda fish: fish.filter(F.col("fork_length_field") != "NA").select("ufn")
)
query(
    "f07_open_date_range",
    ["surveys"],
    "SELECT survey_id FROM surveys WHERE survey_date > DATE '2000-01-01' AND survey_date < DATE '2000-12-31'",
)(
    lambda surveys: surveys.filter(dates.between_open("survey_date", "2000-01-01", "2000-12-31")).select("survey_id")
)
query("f08_column_predicate", ["lice_series"], "SELECT ufn, year FROM lice_series WHERE year = year(survey_date)")(
    lambda series: series.filter(F.col("year") == F.year("survey_date")).select("ufn", "year")
)
query(
    "f09_duplicated_groups",
    ["surveys"],
    """SELECT * FROM surveys QUALIFY count(*) OVER (PARTITION BY site_id, survey_date) > 1""",
)(lambda surveys: grouping.rows_of_duplicated_groups(surveys, ["site_id", "survey_date"]))
query(
    "f10_filter_after_aggregation",
    ["fish"],
    "SELECT seine_id, species, count(*) AS n FROM fish GROUP BY seine_id, species HAVING count(*) >= 3",
)(
    lambda fish: fish.groupBy("seine_id", "species").agg(nulls.rows().alias("n")).filter("n >= 3")
)
ss_query(
    "f12_week_membership",
    "SELECT seine_id, sampling_week FROM ss WHERE sampling_week IN ('May 19', 'May 26', 'June 2')",
)(
    on_ss(
        lambda ss: ss.filter(F.col("sampling_week").isin("May 19", "May 26", "June 2")).select(
            "seine_id", "sampling_week"
        )
    )
)

# ---- joins ----

query(
    "j01_left_join",
    ["surveys", "seines"],
    "SELECT survey_id, survey_date, seine_id FROM surveys LEFT JOIN seines USING (survey_id)",
)(
    lambda surveys, seines: surveys.join(seines, "survey_id", "left").select("survey_id", "survey_date", "seine_id")
)
SITE_COUNTS = "SELECT site_id, count(*) AS visits FROM surveys GROUP BY site_id"
query(
    "j02_natural_join_missing_keys_match",
    ["surveys"],
    f"""SELECT s.survey_id, s.site_id, visits FROM surveys s LEFT JOIN ({SITE_COUNTS}) v
        ON s.site_id IS NOT DISTINCT FROM v.site_id""",
)(
    lambda surveys: joins.natural_left_join(
        surveys.select("survey_id", "site_id"), surveys.groupBy("site_id").agg(nulls.rows().alias("visits"))
    )
)
query(
    "j03_multi_key_join",
    ["ctd", "casts"],
    """SELECT station, date, cast_number, survey_id, depth FROM ctd LEFT JOIN casts USING (station, date, cast_number)""",
    doubles=["depth"],
    integers=["cast_number"],
)(
    lambda ctd, casts: ctd.join(casts, ["station", "date", "cast_number"], "left").select(
        "station", "date", "cast_number", "survey_id", "depth"
    )
)
query(
    "j04_right_join",
    ["lice", "fish"],
    """SELECT f.ufn, f.seine_id, f.species, l.lam FROM lice l RIGHT JOIN fish f
       ON l.ufn = f.ufn AND l.seine_id = f.seine_id""",
)(
    lambda counts, fish: joins.null_safe_join(
        counts.select("ufn", "seine_id", "lam"), fish.select("ufn", "seine_id", "species"), ["ufn", "seine_id"], "right"
    )
)
STAGE_ROWS = """stages AS (
  SELECT * FROM (SELECT l.seine_id % 7 AS grp, avg(lam) AS lam, avg(laf) AS laf, stddev_samp(lam) AS lam_sd,
                        stddev_samp(laf) AS laf_sd FROM lice l GROUP BY 1) w)"""


@query(
    "j05_inner_join_full_key",
    ["lice"],
    """SELECT grp, 'lam' AS stage, lam AS mean, lam_sd AS sd FROM stages
       UNION ALL SELECT grp, 'laf', laf, laf_sd FROM stages""",
    extra=(STAGE_ROWS,),
    doubles=["mean", "sd"],
)
def stage_means_with_sd(counts):
    keyed = counts.withColumn("grp", F.col("seine_id") % 7)
    means = keyed.groupBy("grp").agg(F.avg("lam").alias("lam"), F.avg("laf").alias("laf"))
    sds = keyed.groupBy("grp").agg(F.stddev_samp("lam").alias("lam"), F.stddev_samp("laf").alias("laf"))
    long_means = reshape.longer(means, ["lam", "laf"], "stage", "mean")
    return long_means.join(reshape.longer(sds, ["lam", "laf"], "stage", "sd"), ["grp", "stage"])


query(
    "j06_semi_join",
    ["surveys", "consistent_sites"],
    "SELECT survey_id, site_id FROM surveys WHERE site_id IN (SELECT site_id FROM consistent_sites)",
)(
    lambda surveys, alike: joins.members(surveys.select("survey_id", "site_id"), alike, ["site_id"])
)
query(
    "j07_anti_join",
    ["surveys", "consistent_sites"],
    """SELECT survey_id, site_id FROM surveys
       WHERE site_id IS NULL OR site_id NOT IN (SELECT site_id FROM consistent_sites)""",
)(
    lambda surveys, alike: joins.non_members(surveys.select("survey_id", "site_id"), alike, ["site_id"]).select(
        "survey_id", "site_id"
    )
)
query(
    "j08_dimension_lookup",
    ["surveys", "sites"],
    "SELECT survey_id, s.site_id, region, zone FROM surveys s LEFT JOIN sites t ON s.site_id = t.site_id",
)(
    lambda surveys, sites: joins.lookup_join(
        surveys.select("survey_id", "site_id"), sites, "site_id", ["region", "zone"]
    )
)
query(
    "j09_star_chain",
    ["surveys", "seines", "fish", "lice"],
    """SELECT l.ufn, l.seine_id, f.species, e.survey_id, s.survey_date, s.site_id, l.lam
       FROM lice l LEFT JOIN fish f ON l.ufn = f.ufn AND l.seine_id = f.seine_id
       LEFT JOIN seines e ON f.seine_id = e.seine_id LEFT JOIN surveys s ON e.survey_id = s.survey_id""",
)(
    lambda surveys, seines, fish, counts: star(surveys, seines, fish, counts).select(
        "ufn", "seine_id", "species", "survey_id", "survey_date", "site_id", "lam"
    )
)
query(
    "j11_grid_to_observation",
    ["ctd"],
    """SELECT s.station, s.year, g.x10, o.mean_temp FROM (SELECT DISTINCT station, year(date) AS year FROM ctd) s
       CROSS JOIN (SELECT unnest(generate_series(330, 2120)) AS x10) g
       LEFT JOIN (SELECT station, year(date) AS year, dayofyear(date) * 10 AS x10, avg(temperature) AS mean_temp FROM ctd
                  GROUP BY 1, 2, 3) o ON g.x10 = o.x10 AND s.station = o.station AND s.year = o.year""",
    doubles=["mean_temp"],
)(
    lambda ctd: ctd.select("station", F.year("date").alias("year"))
    .distinct()
    .select("*", F.explode(F.sequence(F.lit(330), F.lit(2120)).cast("array<bigint>")).alias("x10"))
    .join(
        ctd.groupBy("station", F.year("date").alias("year"), (F.dayofyear("date") * 10).cast("bigint").alias("x10"))
        .agg(F.avg("temperature").alias("mean_temp")),
        ["station", "year", "x10"],
        "left",
    )
)
query(
    "j13_zero_filled_join",
    ["sites", "surveys"],
    f"""SELECT t.site_id, coalesce(visits, 0) AS visits FROM sites t
        LEFT JOIN (SELECT * FROM ({SITE_COUNTS}) v WHERE visits % 2 = 0) v ON t.site_id = v.site_id""",
    integers=["site_id"],
)(
    lambda sites, surveys: joins.zero_filled_join(
        sites.select("site_id"),
        surveys.groupBy("site_id").agg(nulls.rows().alias("visits")).filter("visits % 2 = 0"),
        ["site_id"],
        ["visits"],
    )
)

# ---- aggregates ----

query(
    "a01_mean",
    ["ctd"],
    "SELECT station, avg(dissolved_oxygen_ml_l) AS mean_do FROM ctd GROUP BY station",
    doubles=["mean_do"],
)(lambda ctd: grouping.means(ctd, ["station"], {"mean_do": "dissolved_oxygen_ml_l"}))
query(
    "a02_strict_mean",
    ["ctd"],
    f"""SELECT station, date, {strict("avg", "dissolved_oxygen_ml_l")} AS mean_do FROM ctd GROUP BY station, date""",
    doubles=["mean_do"],
)(lambda ctd: grouping.means(ctd, ["station", "date"], {"mean_do": "dissolved_oxygen_ml_l"}, strict=True))
query(
    "a03_mean_sd_se",
    ["fish"],
    """SELECT species, avg(weight) AS mean, stddev_samp(weight) AS sd, count(*) AS n,
       stddev_samp(weight) / sqrt(count(*)) AS se FROM fish GROUP BY species""",
    doubles=["mean", "sd", "se"],
    digits=8,
)(lambda fish: grouping.mean_sd_se(fish, ["species"], "weight"))
query(
    "a04_sum_count",
    ["seines"],
    """SELECT survey_id % 10 AS grp, CAST(sum(pi_total) AS BIGINT) AS pinks, count(*) AS n FROM seines GROUP BY 1""",
)(
    lambda seines: seines.groupBy((F.col("survey_id") % 10).alias("grp")).agg(
        F.sum("pi_total").alias("pinks"), nulls.rows().alias("n")
    )
)
query(
    "a06_distinct_hosts",
    ["lice_series"],
    """SELECT species, year, count(DISTINCT ufn) AS n FROM lice_series GROUP BY species, year""",
)(lambda series: grouping.distinct_hosts(series, ["species", "year"], ["ufn", "species"]))
ss_query(
    "a08_two_level_mean",
    """SELECT year, region, avg(daily) AS mean FROM (
         SELECT year, region, survey_date, avg(pi_total) AS daily FROM ss GROUP BY ALL) d GROUP BY year, region""",
    doubles=["mean"],
)(
    on_ss(
        lambda ss: grouping.means(
            grouping.means(ss, ["year", "region", "survey_date"], {"daily": "pi_total"}),
            ["year", "region"],
            {"mean": "daily"},
        )
    )
)
query(
    "a12_group_ratio_on_rows",
    ["lice", "fish"],
    """SELECT ufn, species, sum(lam) OVER w / nullif(CAST(sum(cam) OVER w AS DOUBLE), 0) AS ratio
       FROM lice JOIN fish USING (ufn) WINDOW w AS (PARTITION BY species)""",
    doubles=["ratio"],
)(
    lambda counts, fish: grouping.with_group_ratio(
        counts.select("ufn", "lam", "cam").join(fish.select("ufn", "species"), "ufn"), ["species"], "lam", "cam"
    ).select("ufn", "species", "ratio")
)
UNCOUNT = """SELECT year, CAST(sum(ck_total) AS BIGINT) AS n FROM ss WHERE seine_id IS NOT NULL
             GROUP BY year HAVING sum(ck_total) > 0"""
ss_query("a15_uncounted", UNCOUNT)(on_ss(lambda ss: grouping.uncounted(ss, ["year"], "ck_total")))
ss_query("r05_repeated_rows", UNCOUNT)(
    on_ss(
        lambda ss: grouping.repeat_rows(ss.select("year", "ck_total"), "ck_total")
        .groupBy("year")
        .agg(nulls.rows().alias("n"))
    )
)
ss_query(
    "a17_scalar_summaries",
    """SELECT year, max(so_total) AS top, min(so_total) AS bottom, median(yday) AS middle FROM ss
       WHERE so_total > 0 GROUP BY year""",
    doubles=["middle"],
)(
    on_ss(
        lambda ss: bins.quantiles(ss.filter("so_total > 0"), ["year"], "yday", {"middle": 0.5})
        .drop("n")
        .join(
            ss.filter("so_total > 0").groupBy("year").agg(F.max("so_total").alias("top"), F.min("so_total").alias("bottom")),
            "year",
        )
    )
)
query(
    "a17_continuous_quantiles",
    ["ctd"],
    """SELECT station, count(temperature) AS n, quantile_cont(temperature, 0.025) AS low, quantile_cont(temperature, 0.5) AS middle,
              quantile_cont(temperature, 0.975) AS high
       FROM (SELECT station, temperature + salinity / 7 + depth / 1000 AS temperature FROM ctd) c GROUP BY station""",
    doubles=["low", "middle", "high"],
)(
    lambda ctd: bins.quantiles(
        ctd.select("station", (F.col("temperature") + F.col("salinity") / 7 + F.col("depth") / 1000).alias("temperature")),
        ["station"], "temperature", {"low": 0.025, "middle": 0.5, "high": 0.975}, every=64,
    )
)
query("a18_distinct_rows", ["fish"], "SELECT DISTINCT species, lice_presence FROM fish")(
    lambda fish: fish.select("species", "lice_presence").distinct()
)

# ---- ordered ----

DAILY = """daily AS (
  SELECT station, date, year(date) AS year, round(avg(temperature), 9) AS mean_temp FROM ctd GROUP BY station, date)"""


def daily_temperature(ctd):
    daily = grouping.means(ctd, ["station", "date"], {"mean_temp": "temperature"})
    return daily.withColumns({"year": F.year("date"), "mean_temp": F.round("mean_temp", 9)})


query(
    "w02_running_total",
    ["ctd"],
    """SELECT date, CAST(sum(n) OVER (PARTITION BY year(date) ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS readings
       FROM (SELECT date, count(*) AS n FROM ctd GROUP BY date) d""",
)(
    lambda ctd: ctd.groupBy("date")
    .agg(nulls.rows().alias("n"))
    .withColumn("year", F.year("date"))
    .select("date", ordered.running_total("n", ["year"], ["date"]).alias("readings"))
)
query(
    "w06_next_row_change",
    ["ctd"],
    """SELECT station, date, lead(mean_temp) OVER (PARTITION BY station, year ORDER BY date) > mean_temp AS warming
       FROM daily""",
    extra=(DAILY,),
)(
    lambda ctd: daily_temperature(ctd)
    .select(
        "station",
        "date",
        (ordered.next_row("mean_temp", ["station", "year"], ["date"]) > F.col("mean_temp")).alias("warming"),
    )
)
ZERO = """anoms AS (
  SELECT station, year(date) AS year, dayofyear(date) + CAST(0 AS DOUBLE) AS x, avg(temperature) - 11 AS y FROM ctd
  GROUP BY ALL)"""
query(
    "w08_zero_crossings",
    ["ctd"],
    """SELECT station, year, hit AS x, CAST(0 AS DOUBLE) AS y FROM (
         SELECT station, year, x, x2, x - y * (x2 - x) / nullif(y2 - y, 0) AS hit FROM (
           SELECT *, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM anoms
           WINDOW w AS (PARTITION BY station, year ORDER BY x)) p) q WHERE x < hit AND hit < x2""",
    extra=(ZERO,),
    doubles=["x", "y"],
    digits=6,
)(
    lambda ctd: ordered.zero_crossings(
        ctd.groupBy("station", F.year("date").alias("year"), F.dayofyear("date").cast("double").alias("x"))
        .agg((F.avg("temperature") - 11).alias("y")),
        ["station", "year"],
        "x",
        "y",
    )
)
query(
    "w09_group_mean_on_rows",
    ["surveys", "seines"],
    """SELECT seine_id, site_id, round_even(avg(he_total) OVER (PARTITION BY site_id), 0) AS he_total,
              count(*) OVER (PARTITION BY site_id) AS size
       FROM seines JOIN surveys USING (survey_id)""",
    doubles=["he_total"],
)(
    lambda surveys, seines: grouping.with_group_values(
        seines.join(surveys, "survey_id").select("seine_id", "site_id", "he_total"),
        ["site_id"],
        he_total=numeric.half_even(F.avg("he_total")),
        size=nulls.rows(),
    )
)
query(
    "w11_first_row_per_key",
    ["fish"],
    """SELECT seine_id, species, ufn, weight FROM fish
       QUALIFY row_number() OVER (PARTITION BY seine_id, species ORDER BY weight, ufn) = 1""",
    doubles=["weight"],
)(
    lambda fish: grouping.first_per_key(
        fish.select("seine_id", "species", "ufn", "weight"), ["seine_id", "species"], ["weight", "ufn"]
    )
)
ss_query(
    "w01_blocked_running_total",
    f"""SELECT seine_id, CAST(sum(he_total) OVER (PARTITION BY year ORDER BY survey_date, seine_id
                                                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS herring
        FROM ss WHERE seine_id IS NOT NULL AND year <= {SEASON}""",
)(
    on_ss(
        lambda ss: ordered.blocked_running_total(
            ss.filter("seine_id IS NOT NULL")
            .select("year", "survey_date", "seine_id", "he_total")
            .withColumn("_block", F.floor(F.col("seine_id") / F.lit(10_000))),
            ["year"],
            ["survey_date", "_block"],
            ["seine_id"],
            "he_total",
            "herring",
        ).select("seine_id", "herring")
    )
)

# ---- order ----

query("o01_arrange", ["sst"], "SELECT * FROM sst ORDER BY date, survey", doubles=["temp"])(
    lambda sst: sst.orderBy("date", "survey")
)
query(
    "o02_descending_frequency",
    ["fish"],
    "SELECT species, count(*) AS n FROM fish GROUP BY species ORDER BY n DESC",
)(lambda fish: fish.groupBy("species").agg(nulls.rows().alias("n")).orderBy(F.desc("n"), "species"))
ss_query(
    "o03_order_by_level",
    "SELECT sampling_week, count(*) AS n FROM ss GROUP BY sampling_week",
)(
    on_ss(
        lambda ss: ss.groupBy("sampling_week")
        .agg(nulls.rows().alias("n"))
        .orderBy(labels.sampling_week_position("sampling_week"))
    )
)

# ---- unions and reshaping ----

query(
    "u01_bind_missing_columns",
    ["fish", "fish_lab"],
    """SELECT ufn, species, NULL::DOUBLE AS fork_length FROM fish UNION ALL SELECT ufn, NULL, fork_length FROM fish_lab""",
    doubles=["fork_length"],
)(lambda fish, lab: reshape.bind(fish.select("ufn", "species"), lab))
query(
    "u02_bind_same_columns",
    ["surveys", "seines"],
    "SELECT survey_id FROM surveys UNION ALL SELECT survey_id FROM seines",
)(lambda surveys, seines: reshape.bind_same(surveys.select("survey_id"), seines.select("survey_id")))
query(
    "u03_literal_rows",
    ["ctd"],
    """SELECT station, count(*) AS n FROM ctd GROUP BY station
       UNION ALL SELECT 'QU40', 0 UNION ALL SELECT 'QU41', NULL""",
)(
    lambda ctd: reshape.bind(
        ctd.groupBy("station").agg(nulls.rows().alias("n")),
        ctd.sparkSession.createDataFrame([("QU40", 0), ("QU41", None)], "station string, n bigint"),
    )
)
query(
    "u04_station_merge",
    ["ctd"],
    """SELECT CASE WHEN station IN ('JS2', 'JS12') THEN 'js2_12' ELSE station END AS station, count(*) AS n
       FROM ctd GROUP BY 1""",
)(
    lambda ctd: reshape.merge_labels(ctd, "station", ["JS2", "JS12"], "js2_12")
    .groupBy("station")
    .agg(nulls.rows().alias("n"))
)
query(
    "r01_longer_keeps_missing",
    ["seines"],
    f"SELECT seine_id, survey_id, species, n FROM seines UNPIVOT INCLUDE NULLS (n FOR species IN ({COUNTS}))",
)(lambda seines: reshape.longer(seines, TOTALS, "species", "n"))
LONG_LICE = "SELECT ufn, seine_id, part, n FROM lice UNPIVOT (n FOR part IN (lep_cope, lam, laf, lgf))"
query("r02_longer_range", ["lice"], LONG_LICE)(
    lambda counts: reshape.longer(
        counts.select("ufn", "seine_id", *columns.columns_between(counts, "lep_cope", "lgf")),
        ["lep_cope", "lam", "laf", "lgf"],
        "part",
        "n",
    ).dropna(subset=["n"])
)
query(
    "r03_longer_prefix",
    ["lice_lab"],
    "SELECT ufn, part, n FROM lice_lab UNPIVOT INCLUDE NULLS (n FOR part IN (cal_cop, cal_chal_a_1, cal_chal_b_3, cal_mot_unid))",
)(
    lambda lab: reshape.longer(
        lab.select("ufn", *columns.columns_starting(lab, "cal_")), columns.columns_starting(lab, "cal_"), "part", "n"
    )
)
query(
    "r04_separate_merge_rest",
    ["ctd_2017"],
    """SELECT split_part(filename, '_', 1) AS unit, split_part(filename, '_', 2) AS date,
              split_part(filename, '_', 3) || '_' || split_part(filename, '_', 4) AS time FROM ctd_2017""",
)(lambda casts: reshape.separate(casts.select("filename"), "filename", ["unit", "date", "time"], "_"))
query(
    "r06_split_to_rows",
    ["surveys"],
    "SELECT survey_id, trim(unnest(string_split(crew, ','))) AS name FROM surveys",
)(lambda surveys: reshape.split_rows(surveys.select("survey_id", "crew"), "crew", "name"))

# ---- scalars ----

query(
    "d01_calendar_parts",
    ["surveys"],
    """SELECT survey_id, year(survey_date) AS year, month(survey_date) AS month, day(survey_date) AS day,
       dayofyear(survey_date) AS yday, (dayofyear(survey_date) - 1) // 7 + 1 AS week, week(survey_date) AS isoweek,
       (dayofyear(survey_date) + 4) // 7 AS sampling_week FROM surveys""",
    integers=["week", "sampling_week"],
)(
    lambda surveys: surveys.select(
        "survey_id",
        F.year("survey_date").alias("year"),
        F.month("survey_date").alias("month"),
        F.dayofmonth("survey_date").alias("day"),
        dates.yday("survey_date").alias("yday"),
        dates.week_of_year("survey_date").alias("week"),
        dates.iso_week("survey_date").alias("isoweek"),
        dates.sampling_week("survey_date").alias("sampling_week"),
    )
)
query(
    "d05_text_to_date",
    ["ctd_2017"],
    "SELECT filename, TRY_CAST(split_part(filename, '_', 2) AS DATE) AS date FROM ctd_2017",
)(
    lambda casts: reshape.separate(
        casts.select("filename", F.col("filename").alias("f")), "f", ["unit", "date", "time"], "_"
    ).select("filename", F.to_date("date").alias("date"))
)
WEEKS_2001 = [(w, first.replace("2017", "2001"), last.replace("2017", "2001")) for w, first, last in dates.SURVEY_WEEKS_2017]
query(
    "d07_survey_week_ranges",
    ["surveys"],
    f"""SELECT survey_id, survey_date, (SELECT max(w) FROM (VALUES
        {", ".join(f"({w}, DATE '{a}', DATE '{b}')" for w, a, b in WEEKS_2001)}) t(w, a, b)
        WHERE survey_date BETWEEN a AND b) AS week FROM surveys""",
    integers=["week"],
)(
    lambda surveys: surveys.select(
        "survey_id", "survey_date", dates.survey_week("survey_date", WEEKS_2001).alias("week")
    )
)
query(
    "d08_reference_year",
    ["surveys"],
    """SELECT survey_id, TRY_CAST(concat('2001-', month(survey_date), '-', day(survey_date)) AS DATE) AS moved
       FROM surveys""",
)(lambda surveys: surveys.select("survey_id", dates.in_year("survey_date", 2001).alias("moved")))
query("d10_seasons_observed", ["surveys"], "SELECT max(year(survey_date)) - 1995 + 1 AS n_seasons FROM surveys")(
    lambda surveys: dates.seasons_observed(surveys, "survey_date", 1995)
)
query(
    "t01_paste_keys",
    ["surveys"],
    """SELECT survey_id, concat(coalesce(CAST(site_id AS VARCHAR), 'NA'), '-', week(survey_date)) AS site_week
       FROM surveys""",
)(
    lambda surveys: surveys.select(
        "survey_id",
        F.concat_ws("-", nulls.text_or_na("site_id"), dates.iso_week("survey_date").cast("string")).alias("site_week"),
    )
)
query(
    "t03_coercion",
    ["fish"],
    "SELECT ufn, TRY_CAST(fork_length_field AS DOUBLE) AS mm, CAST(seine_id AS VARCHAR) AS seine FROM fish",
    doubles=["mm"],
)(
    lambda fish: fish.select(
        "ufn", F.col("fork_length_field").try_cast("double").alias("mm"), F.col("seine_id").cast("string").alias("seine")
    )
)
query(
    "t04_label_lookup",
    ["fish"],
    """SELECT ufn, CASE species WHEN 'SO' THEN 'Sockeye' WHEN 'PI' THEN 'Pink' WHEN 'CU' THEN 'Chum'
       WHEN 'HE' THEN 'Herring' END AS label FROM fish""",
)(lambda fish: fish.select("ufn", labels.lookup("species", labels.SPECIES_LABELS).alias("label")))
query(
    "n01_math",
    ["fish"],
    """SELECT ufn, sqrt(weight) AS root, exp(-weight / 10) AS decay, round_even(weight / 8, 0) AS eighths,
       seine_id // 7 AS sevenths FROM fish""",
    doubles=["root", "decay", "eighths"],
)(
    lambda fish: fish.select(
        "ufn",
        F.sqrt("weight").alias("root"),
        F.exp(-F.col("weight") / 10).alias("decay"),
        numeric.half_even(F.col("weight") / 8).alias("eighths"),
        F.expr("seine_id div 7").alias("sevenths"),
    )
)
query(
    "n02_t_quantile",
    ["fish"],
    """SELECT seine_id, n, t.v AS t_value FROM (SELECT seine_id, count(*) AS n FROM fish GROUP BY seine_id) g
       LEFT JOIN t ON t.df = n - 1""",
    extra=(f"t(df, v) AS (VALUES {T_VALUES})",),
    doubles=["t_value"],
)(
    lambda fish: numeric.with_t_quantile(
        fish.groupBy("seine_id").agg(nulls.rows().alias("n")), 0.975, F.col("n") - 1, "t_value"
    )
)
query(
    "n04_fill_missing",
    ["seines"],
    """SELECT seine_id, coalesce(so_total, 0) AS so_total, coalesce(cu_total, 0) AS cu_total FROM seines""",
)(lambda seines: filled(seines.select("seine_id", "so_total", "cu_total")))
query(
    "n05_floored_error_bar",
    ["seines"],
    """SELECT grp, CASE WHEN m - s < 0 THEN 0 ELSE m - s END AS lower FROM (
         SELECT survey_id % 50 AS grp, avg(ck_total) AS m, stddev_samp(ck_total) * 1.2 AS s FROM seines GROUP BY 1) g""",
    doubles=["lower"],
)(
    lambda seines: seines.groupBy((F.col("survey_id") % 50).alias("grp"))
    .agg(F.avg("ck_total").alias("m"), (F.stddev_samp("ck_total") * 1.2).alias("s"))
    .select("grp", numeric.lower_bar("m", "s").alias("lower"))
)
query(
    "n06_sequence_grid",
    ["ctd"],
    """SELECT station, unnest(generate_series(lo * 10, hi * 10)) / CAST(10 AS DOUBLE) AS yday FROM (
         SELECT station, min(dayofyear(date)) AS lo, max(dayofyear(date)) AS hi FROM ctd GROUP BY station) s""",
    doubles=["yday"],
)(
    lambda ctd: ctd.groupBy("station")
    .agg(F.min(F.dayofyear("date")).alias("lo"), F.max(F.dayofyear("date")).alias("hi"))
    .select("station", F.explode(F.sequence(F.col("lo") * 10, F.col("hi") * 10)).alias("x10"))
    .select("station", (F.col("x10") / 10).alias("yday"))
)
query(
    "n07_right_closed_bins",
    ["fish"],
    """SELECT ufn, CASE WHEN weight > 0 AND weight <= 10 THEN 'small' WHEN weight > 10 AND weight <= 30 THEN 'middle'
       WHEN weight > 30 AND weight <= 45 THEN 'large' END AS size FROM fish""",
)(
    lambda fish: fish.select(
        "ufn", bins.right_closed_bin("weight", [0, 10, 30, 45], ["small", "middle", "large"]).alias("size")
    )
)
query(
    "m09_linear_trend",
    ["ctd"],
    """SELECT station, date, regr_intercept(temperature, depth) OVER w + regr_slope(temperature, depth) OVER w * depth
       AS trend FROM ctd WINDOW w AS (PARTITION BY station)""",
    doubles=["trend"],
    digits=6,
)(lambda ctd: growth.with_trend(ctd, ["station"], "depth", "temperature").select("station", "date", "trend"))
