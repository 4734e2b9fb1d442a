from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brinewave import schemas
from brinewave.queries import files
from brinewave.sources import feed, readers, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_na_text_is_missing_and_header_is_checked(spark, tmp_path):
    path = write(tmp_path / "a.csv", "survey,date,temp\nDI,2017-05-01,NA\nNA,2017-05-02,NaN\n")
    rows = readers.read_table(spark, path, schemas.PROBE).collect()
    assert rows[0].temp is None and rows[1].survey is None and rows[1].temp != rows[1].temp
    wrong = write(tmp_path / "b.csv", "date,survey,temp\n2017-05-01,DI,1\n")
    with pytest.raises(Exception, match="header"):
        readers.read_table(spark, wrong, schemas.PROBE).collect()


def test_explore_sees_late_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "v\n" + "1\n" * 3000 + "2.5\n")
    assert readers.explore(spark, path).dtypes == [("v", "double")]


@pytest.mark.parametrize("split", ["128MB", "64b"])
def test_skip_preamble_of_every_file(spark, tmp_path, split):
    for name in ("one", "two"):
        body = "".join(f"2018-01-0{d} 00:00,{d}.5\n" for d in range(1, 8))
        write(tmp_path / "logs" / f"{name}.csv", f"x\n\ny,z\nstamp,speed\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = readers.read_skipping(spark, str(tmp_path / "logs"), 3, "stamp string, speed double").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.speed for r in rows) == sorted([d + 0.5 for d in range(1, 8)] * 2)


def test_units_row(spark, tmp_path):
    path = write(tmp_path / "a.csv", "survey,date,temp\n-,yyyy-mm-dd,C\nDI,2017-05-01,9.5\nJS,2017-05-02,oops\nJS,NA,3\n")
    rows = readers.read_with_units_row(spark, path, schemas.PROBE).collect()
    assert [tuple(r) for r in rows] == [
        ("DI", dt.date(2017, 5, 1), 9.5), ("JS", dt.date(2017, 5, 2), None), ("JS", None, 3.0)
    ]


def test_swapped_header_is_refused(spark, tmp_path):
    log = write(tmp_path / "log.csv", "x\nspeed,stamp\n3.5,2018-01-01 00:00\n")
    with pytest.raises(Exception, match="the header is"):
        readers.read_skipping(spark, log, 1, "stamp string, speed double").collect()
    units = write(tmp_path / "units.csv", "date,survey,temp\nd,-,C\n2017-05-01,DI,1\n")
    with pytest.raises(Exception, match="the header is"):
        readers.read_with_units_row(spark, units, schemas.PROBE).collect()


def test_quoted_line_feeds(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,comments\n1,"said ""deep"",\n\n265 m"\n2,NA\n')
    rows = readers.read_quoted(spark, path, "id int, comments string").collect()
    assert [tuple(r) for r in rows] == [(1, 'said "deep",\n\n265 m'), (2, None)]


def test_sheets(spark, tmp_path):
    write(tmp_path / "survey_data" / "p.csv", "survey_id,survey_date,site_id,crew\nDE1,2019-05-01,D07,\"A, B\"\n")
    write(tmp_path / "seine_data" / "p.csv", "seine_id,survey_id,so_total,pi_total,cu_total,co_total,he_total,ck_total\nDE1N1,DE1,3,NA,0,0,0,0\n")
    wanted = {k: schemas.SHEETS[k] for k in ("survey_data", "seine_data")}
    book = readers.read_sheets(spark, str(tmp_path), wanted)
    row = book["survey_data"].join(book["seine_data"], "survey_id").first()
    assert (row.crew, row.so_total, row.pi_total) == ("A, B", 3, None)


def test_season_rerun_replaces_one_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_season(spark.createDataFrame([(1, 2018), (2, 2019), (3, 2019)], "id int, year int"), path)
    sinks.write_season(spark.createDataFrame([(9, 2019)], "id int, year int"), path)
    assert sorted(tuple(r) for r in sinks.reload(spark, path).collect()) == [(1, 2018), (9, 2019)]
    sinks.write_season(spark.createDataFrame([(None, 2020)], "id int, year int"), str(tmp_path / "csv"), "csv")
    assert sinks.reload(spark, str(tmp_path / "csv"), "csv").first().id is None


def test_cast_feed_prunes_folders_and_pushes_depth(spark, tmp_path):
    rows = [("QU39", 2018, dt.date(2018, 3, d), float(10 * d), 8.0, 29.0, 6.0) for d in range(1, 6)]
    rows += [("JS2", 2018, dt.date(2018, 3, 1), 1.0, 8.0, 29.0, 6.0), ("QU39", 2010, dt.date(2010, 3, 1), 1.0, 8.0, 29.0, 6.0)]
    schema = "station string, year int, date date, depth double, temperature double, salinity double, dissolved_oxygen_ml_l double"
    path = str(tmp_path / "casts")
    sinks.write_casts(spark.createDataFrame(rows, schema), path)
    got = readers.read_casts(spark, path, ["QU39"], 2014, (32, 213), 30, columns=["date", "temperature"])
    assert sorted(r.date.day for r in got.collect()) == [1, 2, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "station" in pruned and "year" in pruned and "LessThanOrEqual(depth,30.0)" in plan
    assert "salinity" not in plan[plan.index("ReadSchema") :]


@pytest.mark.parametrize("split", ["128MB", "64b"])
def test_types_are_guessed_from_the_first_rows(spark, tmp_path, split):
    lines = ["n,x,flag,day,at,note,none"]
    lines += [f"{i},{i}.5,{'TF'[i % 2]},2019-05-0{1 + i % 9},2019-05-01T10:0{i % 10}:00,a{i},NA" for i in range(40)]
    lines += ["", "3000000000,7,T,2019-05-01,2019-05-01 10:00,\"b, c\",NA", "4.25,many,maybe,May 1,noon,d,late", "x,1e3,F,NA,NA,NA,NA"]
    path = write(tmp_path / "late.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = readers.read_guessed(spark, path, guess_max=30)
        assert list(got.types.values()) == ["bigint", "double", "boolean", "date", "timestamp", "string", "boolean"]
        first = {r["column"]: (r.line, r.expected, r.actual) for r in got.first_problems().collect()}
        rows = {r.note: r for r in got.table.collect()}
        problems = sorted((r["column"], r.line) for r in got.problems.collect())
        whole = readers.read_guessed(spark, path, guess_max=1000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == {
        "n": (44, "bigint", "4.25"), "x": (44, "double", "many"), "flag": (44, "boolean", "maybe"), "day": (44, "date", "May 1"),
        "at": (44, "timestamp", "noon"), "none": (44, "boolean", "late"),
    }
    assert problems == [("at", 44), ("day", 44), ("flag", 44), ("n", 44), ("n", 45), ("none", 44), ("x", 44)]
    assert len(rows) == 43 and rows["b, c"].n == 3_000_000_000 and rows["d"].n is None and rows[None].x == 1000.0
    assert rows["a3"].flag is False and rows["a2"].day == dt.date(2019, 5, 3)
    assert list(whole.types.values()) == ["string", "string", "string", "string", "string", "string", "string"]
    assert whole.problems.count() == 0


def test_guess_of_files_without_rows_or_header(spark, tmp_path):
    path = write(tmp_path / "empty.csv", "a,b\n")
    got = readers.read_guessed(spark, path)
    assert got.types == {"a": "boolean", "b": "boolean"} and got.table.count() == 0
    with pytest.raises(ValueError, match="header"):
        readers.read_guessed(spark, write(tmp_path / "none.csv", ""))


@pytest.mark.parametrize("split", ["128MB", "8b"])
def test_parts_of_a_table_are_numbered_on(spark, tmp_path, split):
    parts = ["n,x\n", "n,x\n1,1\n2,2\n", "n,x\n", "n,x\n3,many\n4,2.5\n5,5\n", "n,x\n6,7\n"]
    for i, text in enumerate(parts):
        write(tmp_path / "table" / f"part-0000{i}.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = sorted((r.line, r.value) for r in readers.numbered_lines(spark, str(tmp_path / "table"), parts=True).collect())
        got = readers.read_guessed(spark, str(tmp_path / "table"), guess_max=2, parts=True)
        rows, problems = sorted(map(tuple, got.table.collect())), [tuple(r) for r in got.problems.drop("file").orderBy("line").collect()]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (got.table, got.first_problems())]
        first = [tuple(r) for r in got.first_problems().drop("file").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert lines == [(1, "n,x"), (2, "1,1"), (3, "2,2"), (4, "3,many"), (5, "4,2.5"), (6, "5,5"), (7, "6,7")]
    assert got.types == {"n": "bigint", "x": "bigint"} and first == [("x", 4, "bigint", "many")]
    assert "SortMergeJoin" not in "".join(plans) and plans[1].count("SortAggregate") <= 2  # those see a row a column and file
    assert rows == [(1, 1), (2, 2), (3, None), (4, None), (5, 5), (6, 7)]
    assert problems == [("x", 4, "bigint", "many"), ("x", 5, "bigint", "2.5")]


def test_late_types_are_written_by_many_tasks(spark):
    """In parts that follow one another, none of which holds the whole table."""
    seines = spark.range(0, 60_000, 3, 4).selectExpr("59999 - id AS seine_id", "id AS survey_id", "id % 7 AS so_total", "id % 5 AS pi_total")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path, rows = files.late_types(seines)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ids = [[int(line.split(",")[0]) for line in p.read_text().splitlines()[1:]] for p in sorted(Path(path).glob("part-*"))]
    assert len(ids) > 1 and sum(ids, []) == sorted(r.seine_id for r in rows.collect())


def test_a_failed_rerun_leaves_the_season_readable(spark, tmp_path):
    path = str(tmp_path / "seasons")
    with pytest.raises(ValueError, match="no season"):
        sinks.read_seasons(spark, path)
    rows = spark.createDataFrame([(i, 2018 + i % 3, "old") for i in range(300)], "id int, year int, run_name string")
    first = sinks.commit_seasons(rows, path)
    broken = rows.filter("year = 2019").withColumn("run_name", F.when(F.col("id") == 298, F.raise_error(F.lit("lost"))).otherwise("new"))
    with pytest.raises(Exception, match="lost"):
        sinks.commit_seasons(broken, path)
    assert sinks.read_seasons(spark, path).filter("run_name = 'old'").count() == 300
    second = sinks.commit_seasons(rows.filter("year = 2019").withColumn("run_name", F.lit("new")), path)
    got = {(r.year, r.run_name): r["count"] for r in sinks.read_seasons(spark, path).groupBy("year", "run_name").count().collect()}
    assert got == {(2018, "old"): 100, (2019, "new"): 100, (2020, "old"): 100}
    one = sinks.read_seasons(spark, path, [2019])
    assert all(second in f for f in one.inputFiles()) and one.count() == 100
    assert [tuple(r) for r in sinks.superseded(spark, path).collect()] == [(2019, first)]


def test_feed_takes_conditions_and_fields_over(spark, tmp_path):
    schema = "station string, date date, cast_number bigint, depth double, temperature double, salinity double, dissolved_oxygen_ml_l double"
    rows = [(s, dt.date(y, m, 5), n, float(d), None if d == 7 else 8.0 + n, 29.0, None)
            for s in ("QU39", "QU29", "JS2") for y in (2014, 2015, 2018) for m in (1, 3, 9) for n in (1, 2) for d in (0.5, 7, 30, 31)]
    path = str(tmp_path / "feed")
    feed.land_feed(spark.createDataFrame(rows, schema), path)
    got = feed.read_feed(spark, path, ["QU39", "QU29"], 2014, (32, 213), 30, ["station", "date", "depth", "temperature"])
    want = [(s, d, z, t) for s, d, _, z, t, _, _ in rows if s != "JS2" and d.year > 2014 and d.month == 3 and z <= 30]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan cast_feed" in plan and "Filter (" not in plan and "salinity" not in plan  # nothing is left for Spark
    reader = feed.FeedReader(path, ["station", "depth", "yday"])
    left = list(reader.pushFilters([feed.In(("station",), ("QU39",)), feed.EqualTo(("year",), 2018), feed.LessThanOrEqual(("depth",), 7.0),
                                    feed.IsNotNull(("depth",)), feed.GreaterThan(("temperature",), 1.0)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"]
    pages = reader.partitions()
    assert {(p.station, p.year) for p in pages} == {("QU39", 2018)}
    tables = [b for p in pages for b in reader.read(p)]
    assert {c for b in tables for c in b.schema.names} == {"station", "depth", "yday"}
    assert sorted(x for b in tables for x in b.column("depth").to_pylist()) == sorted([0.5, 7.0] * 6)
    none = feed.read_feed(spark, path, ["XX"])
    assert none.count() == 0
    with pytest.raises(Exception, match="no field"):
        feed.read_feed(spark, path, ["QU39"], columns=["ph"]).collect()
