"""Source and sink queries: tables derived from the data are landed in the shared folder in the
shape of a field file, then read back by the reader under test."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.fixtures import SEASON
from brinewave.queries.registry import query
from brinewave.session import shared_folder
from brinewave.sources import feed, readers, sinks


def landing(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession).rstrip('/')}/landing-{uuid.uuid4().hex}"


def as_text_file(df: DataFrame, *head: str) -> str:
    """Land rows as headed CSV text files, each file starting with the given lines."""
    path = landing(df)
    line = F.to_csv(F.struct(*df.columns), {"nullValue": "NA"}).alias("value")
    first = "\n".join(head)
    # one preamble a file: it is put in front of the first line of each write task
    numbered = df.select(line, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))
    body = F.when(F.col("i") == 0, F.concat(F.lit(first + "\n"), F.col("value"))).otherwise(F.col("value"))
    numbered.select(body.alias("value")).write.text(path)
    return path


SEINE_COLUMNS = "seine_id bigint, survey_id bigint, so_total bigint, pi_total bigint, cu_total bigint"
SEINE_SQL = "SELECT seine_id, survey_id, so_total, pi_total, cu_total FROM seines"
PICKED = ["seine_id", "survey_id", "so_total", "pi_total", "cu_total"]


@query("s01_read_table", ["seines"], SEINE_SQL)
def read_table(seines):
    path = landing(seines)
    sinks.write_csv(seines.select(*PICKED), path)
    return readers.read_table(seines.sparkSession, path, SEINE_COLUMNS)


@query("s02_explore_types", ["seines"], SEINE_SQL)
def explore(seines):
    path = landing(seines)
    sinks.write_csv(seines.select(*PICKED), path)
    return readers.explore(seines.sparkSession, path)


def late_types(seines: DataFrame) -> tuple[str, DataFrame]:
    """One table in id order, in parts that tasks sort and write side by side, whose columns change type
    late: whole numbers first, then fractions, then words."""
    late = F.col("seine_id") > F.lit(20_000)
    rows = seines.select(
        "seine_id", "survey_id",
        F.when(late & (F.col("seine_id") % 70 == 0), F.lit("many")).otherwise(F.col("so_total").cast("string")).alias("so_total"),
        F.when(late, F.concat(F.col("pi_total"), F.lit(".5"))).otherwise(F.col("pi_total").cast("string")).alias("pi_total"),
    )
    path = landing(seines)
    sinks.write_csv(rows.orderBy("seine_id"), path)
    return path, rows


NUMBERED = """numbered AS (
  SELECT *, row_number() OVER (ORDER BY seine_id) + 1 AS line FROM (
    SELECT seine_id, survey_id, CASE WHEN seine_id > 20000 AND seine_id % 70 = 0 THEN 'many' ELSE CAST(so_total AS VARCHAR) END AS so_total,
           CASE WHEN seine_id > 20000 THEN pi_total || '.5' ELSE CAST(pi_total AS VARCHAR) END AS pi_total FROM seines) s)"""


@query(
    "s02_guessed_types",
    ["seines"],
    "SELECT seine_id, survey_id, TRY_CAST(so_total AS BIGINT) AS so_total, CASE WHEN pi_total NOT LIKE '%.5' THEN CAST(pi_total AS BIGINT) END AS pi_total FROM numbered",
    extra=(NUMBERED,),
)
def guessed(seines):
    path, _ = late_types(seines)
    return readers.read_guessed(seines.sparkSession, path, guess_max=100, parts=True).table


@query(
    "s02_values_that_break_the_guess",
    ["seines"],
    """SELECT "column", min(line) AS line, 'bigint' AS expected, arg_min(actual, line) AS actual FROM (
         SELECT 'so_total' AS "column", line, so_total AS actual FROM numbered WHERE so_total = 'many'
         UNION ALL SELECT 'pi_total', line, pi_total FROM numbered WHERE pi_total LIKE '%.5') p GROUP BY 1""",
    extra=(NUMBERED,),
)
def guess_problems(seines):
    path, _ = late_types(seines)
    return readers.read_guessed(seines.sparkSession, path, guess_max=100, parts=True).first_problems().drop("file")


@query(
    "s03_read_skipping_preamble",
    ["wind_speed"],
    "SELECT stamp, year, month, wind_spd FROM wind_speed",
    doubles=["wind_spd"],
)
def read_skipping(speed):
    path = as_text_file(speed, "Logger 7", "Station: field", "", "stamp,year,month,wind_spd")
    return readers.read_skipping(speed.sparkSession, path, 3, "stamp string, year int, month int, wind_spd double")


@query("s04_units_row", ["sst"], "SELECT survey, date, temp FROM sst", doubles=["temp"])
def units_row(sst):
    path = as_text_file(sst, "survey,date,temp", "text,yyyy-mm-dd,degrees")
    return readers.read_with_units_row(sst.sparkSession, path, "survey string, date date, temp double")


@query(
    "s05_workbook_sheets",
    ["surveys", "seines"],
    """SELECT survey_id, survey_date, site_id, seine_id, so_total FROM surveys LEFT JOIN seines USING (survey_id)""",
)
def sheets(surveys, seines):
    folder = landing(surveys)
    sinks.write_csv(surveys.select("survey_id", "survey_date", "site_id"), f"{folder}/survey_data")
    sinks.write_csv(seines.select(*PICKED), f"{folder}/seine_data")
    schemas = {"survey_data": "survey_id bigint, survey_date date, site_id bigint", "seine_data": SEINE_COLUMNS}
    book = readers.read_sheets(surveys.sparkSession, folder, schemas)
    return book["survey_data"].join(book["seine_data"].drop("pi_total", "cu_total"), "survey_id", "left")


@query(
    "s06_cast_feed",
    ["ctd"],
    """SELECT station, year(date) AS year, date, depth, temperature, salinity, dissolved_oxygen_ml_l FROM ctd
       WHERE station IN ('QU39', 'QU29') AND year(date) > 1996 AND depth <= 30
         AND dayofyear(date) > 32 AND dayofyear(date) < 213""",
    doubles=["depth", "temperature", "salinity", "dissolved_oxygen_ml_l"],
)
def cast_feed(ctd):
    path = landing(ctd)
    sinks.write_casts(ctd.withColumn("year", F.year("date")), path)
    return readers.read_casts(ctd.sparkSession, path, ["QU39", "QU29"], 1996, (32, 213), 30)


@query(
    "s06_cast_feed_pages",
    ["ctd"],
    """SELECT station, date, depth, temperature FROM ctd
       WHERE station IN ('QU39', 'QU29') AND year(date) > 1996 AND depth <= 30
         AND dayofyear(date) > 32 AND dayofyear(date) < 213""",
    doubles=["depth", "temperature"],
)
def cast_feed_pages(ctd):
    path = landing(ctd)
    feed.land_feed(ctd, path)
    wanted = ["station", "date", "depth", "temperature"]
    return feed.read_feed(ctd.sparkSession, path, ["QU39", "QU29"], 1996, (32, 213), 30, wanted)


@query("s07_named_table", ["fish"], "SELECT ufn, species FROM fish WHERE species = 'SO'")
def named_table(fish):
    name = f"survey_seines_fish_{uuid.uuid4().hex}"
    fish.createOrReplaceTempView(name)
    return readers.named_table(fish.sparkSession, name).filter("species = 'SO'").select("ufn", "species")


@query(
    "s08_quoted_line_feeds",
    ["surveys"],
    """SELECT survey_id, concat('1: crew "', crew, '", all well.', chr(10), chr(10), 'Depth ', site_id, ' m') AS comments
       FROM surveys WHERE site_id IS NOT NULL""",
)
def quoted(surveys):
    note = F.concat(
        F.lit('1: crew "'), F.col("crew"), F.lit('", all well.\n\nDepth '), F.col("site_id").cast("string"), F.lit(" m")
    )
    path = landing(surveys)
    noted = surveys.filter("site_id IS NOT NULL").select("survey_id", note.alias("comments"))
    noted.write.options(header=True, escape='"', quoteAll=True).csv(path)
    return readers.read_quoted(surveys.sparkSession, path, "survey_id bigint, comments string")


@query(
    "s09_year_folders",
    ["surveys"],
    f"""SELECT survey_id, survey_date, CASE WHEN year(survey_date) = {SEASON} THEN 'rerun' ELSE 'first' END AS run,
               year(survey_date) AS year FROM surveys""",
)
def year_folders(surveys):
    path = landing(surveys)
    rows = surveys.select("survey_id", "survey_date", F.lit("first").alias("run"), F.year("survey_date").alias("year"))
    sinks.write_season(rows, path)
    sinks.write_season(rows.filter(F.col("year") == SEASON).withColumn("run", F.lit("rerun")), path)
    return sinks.reload(surveys.sparkSession, path)


@query(
    "s09_committed_seasons",
    ["surveys"],
    f"""SELECT survey_id, survey_date, CASE WHEN year(survey_date) >= {SEASON - 1} THEN 'rerun' ELSE 'first' END AS run_name,
               year(survey_date) AS year FROM surveys WHERE year(survey_date) >= {SEASON - 3}""",
)
def committed_seasons(surveys):
    path = landing(surveys)
    rows = surveys.select("survey_id", "survey_date", F.lit("first").alias("run_name"), F.year("survey_date").alias("year"))
    sinks.commit_seasons(rows, path)
    for season in (SEASON - 1, SEASON):
        sinks.commit_seasons(rows.filter(F.col("year") == season).withColumn("run_name", F.lit("rerun")), path)
    return sinks.read_seasons(surveys.sparkSession, path, range(SEASON - 3, SEASON + 1))


@query(
    "s10_reload_stage_csv",
    ["seines"],
    "SELECT survey_id, count(*) AS n, CAST(sum(pi_total) AS BIGINT) AS pinks FROM seines GROUP BY survey_id",
)
def reload_stage(seines):
    path = landing(seines)
    sinks.write_csv(seines.select(*PICKED), path)
    stage = sinks.reload(seines.sparkSession, path, "csv", SEINE_COLUMNS)
    return stage.groupBy("survey_id").agg(F.count(F.lit(1)).alias("n"), F.sum("pi_total").alias("pinks"))
