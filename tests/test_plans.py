"""Physical plans and report properties."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brinewave import session
from brinewave.fixtures import views
from brinewave.plans import catch, lice, ocean, timing
from brinewave.plans.survey import survey_seines
from brinewave.queries import lice as lice_queries

PYTHON_ALLOWED = {"s03_read_skipping_preamble"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in entry.queries() if n[0] in "mq"])
def test_plan_shape(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "Pandas" in plan) == (name in PYTHON_ALLOWED)


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = plan_of(entry.queries()["q01_ctd_climatology"](spark, sf_dir))
    scan = plan[plan.index("FileScan") :]
    assert "PushedFilters" in scan and "LessThanOrEqual(l_quantity,30.0)" in scan
    assert "l_comment" not in scan and "l_extendedprice" not in scan


def season(spark, sf_dir):
    return survey_seines(*views(spark, sf_dir, ["surveys", "seines", "sites"]))


def test_cumulative_percent_ends_at_100_and_shares_sum_to_1(spark, sf_dir):
    t = timing.migration_timing(timing.corrected_catch(season(spark, sf_dir), 2001))
    for r in t.groupBy("year").agg(F.max("percent").alias("p"), F.sum("non_cumul_prop").alias("s")).collect():
        assert (r.p, r.s) == (pytest.approx(100), pytest.approx(1))


def test_prevalence_bounds_and_abundance_identity(spark, sf_dir):
    counts, *s = views(spark, sf_dir, ["lice_2018", "surveys", "seines", "sites"])
    totals, ss = lice.stage_totals(counts), survey_seines(*s)
    prevalence = lice.weekly_prevalence(totals, ss)
    assert prevalence.filter("n_infected > n_examined OR prevalence < 0 OR prevalence > 1").count() == 0
    complete = totals.dropna(subset=["motile_caligus", "motile_lep"])
    a = lice.motile_abundance(complete, ss).withColumnRenamed("lice_species", "lice_spp")
    i = lice.infection_intensity(complete, ss)
    p = lice.weekly_prevalence(complete, ss, least=1).withColumn(
        "lice_spp", F.when(F.col("lice_spp") == "n_lep_infected", "lep").otherwise("cal")
    )
    keys = ["region", "species", "sampling_week", "lice_spp"]
    joined = a.dropna(subset=keys).join(i, keys).join(p, keys)
    assert joined.count() > 10
    assert joined.filter(F.abs(F.col("abundance") - F.col("prevalence") * F.col("intensity")) > 1e-9).count() == 0


def survey_rows(spark, data):
    full = [
        (sid, sid * 10, dt.date.fromisoformat(d), site, so, 1, 1, 1, 1, 1, "DI")
        for sid, d, site, so in data
    ]
    schema = (
        "survey_id bigint, seine_id bigint, survey_date date, site_id int, so_total int, pi_total int, cu_total int, "
        "co_total int, he_total int, ck_total int, region string"
    )
    df = spark.createDataFrame(full, schema)
    return df.withColumns({"year": F.year("survey_date"), "yday": F.dayofyear("survey_date")})


def test_double_effort_is_averaged_once(spark):
    ss = survey_rows(
        spark,
        [
            (1, "2019-05-06", 7, 10), (2, "2019-05-08", 7, 21), (3, "2019-05-14", 7, 5),
            (4, "2019-05-06", None, 3), (5, "2019-05-07", None, 6), (6, "2018-05-07", 7, 8), (7, "2018-05-08", 7, 9),
        ],
    )
    double = {r.survey_id: r.so_total for r in timing.double_effort(ss, 2019).collect()}
    assert double == {1: 16.0, 2: 16.0, 4: 4.0, 5: 4.0}
    got = sorted((str(r.survey_date), r.so_total, r.year) for r in timing.corrected_catch(ss, 2019).collect())
    assert got == [
        ("2018-05-07", 8.0, 2018), ("2018-05-08", 9.0, 2018), ("2019-05-06", 4.0, 2019),
        ("2019-05-06", 16.0, 2019), ("2019-05-14", 5.0, 2019),
    ]


def test_strict_cumulative_abundance_stays_missing(spark):
    ss = survey_rows(spark, [(1, "2019-05-06", 1, 2), (2, "2019-05-07", 1, None), (3, "2019-05-08", 1, 4)])
    def run(missing):
        out = catch.cumulative_abundance(ss, totals=["so_total"], missing=missing).orderBy("survey_date")
        return [r.cum_abund for r in out.collect()]

    assert run("keep") == [2, None, None]
    assert run("zero") == [2, 2, 6]
    assert run("drop") == [2, 6]


def test_text_ids_are_placed_too(spark):
    data = [(i, f"2019-05-{6 + i % 3:02d}", 1, 1 + i % 4) for i in range(30)]
    ss = survey_rows(spark, data)
    texts = ss.withColumns({c: F.concat(F.lit("DE"), F.col(c)) for c in ("survey_id", "seine_id")})
    for frame in (ss, texts):
        rows = timing.season_progress(frame, 2019).collect()
        by_day = [max(r.percent for r in rows if r.survey_date.day == d) for d in (6, 7, 8)]
        assert by_day == sorted(by_day) and by_day[-1] == pytest.approx(100)
        assert len({round(r.percent, 9) for r in rows}) == 30
        current = catch.rolling_catch(frame, 2019).filter("`group` = '2019'")
        assert current.count() == 30 and current.filter("seven_avg IS NULL").count() == 4


def test_inference_modes(spark):
    base = dict.fromkeys(lice.CURRENT_COUNTS, 0)
    rows = [
        ("U1", 10, *{**base, "lam": 3, "cam": 2, "chal_a_b": 4}.values()),
        ("U2", 10, *{**base, "lep_cope": 1}.values()),
    ]
    counts = spark.createDataFrame(rows, "ufn string, seine_id bigint, " + ", ".join(f"{c} int" for c in lice.CURRENT_COUNTS))
    fish = spark.createDataFrame([("U1", 10, "SO"), ("U2", 10, "SO"), ("U3", 10, "SO")], "ufn string, seine_id bigint, species string")
    ss = survey_rows(spark, [(1, "2019-05-06", 1, 2)])

    def attached(mode):
        out = lice.current_lice(counts, fish, ss, 2019, ratio_mode=mode)
        assert out.count() == 8  # two loused fish, four cells each
        return {r.louse_species[0]: r["count"] for r in out.filter("ufn = 'U1' AND life_stage = 'attached'").collect()}

    assert attached("odds") == {"L": 8.0, "C": -4.0}  # leps/cal = 2
    assert attached("share") == {"L": pytest.approx(8 / 3), "C": pytest.approx(4 / 3)}


def test_lower_surface_and_sides(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.5, 1.0)], "mean_temp double, predicted_mean_temp double")
    got = sorted((r.mean_temp, r.side) for r in ocean.sides(rows).collect())
    assert got == [(0.5, "below"), (1.0, "above"), (1.0, "below"), (2.0, "above")]


def test_stage_writes_below_the_named_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    out = session.stage(spark.range(5).withColumn("k", F.col("id") % 2), "part", ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0)]
    assert [p.name.startswith("part-") for p in tmp_path.iterdir()] == [True]


class Session:
    """Stands for a session with a given setting and master."""

    def __init__(self, named, master):
        self.conf = self
        self.sparkContext = self
        self.named, self.master = named, master

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default


def test_shared_folder_reads_the_setting():
    assert session.shared_folder(Session("s3a://team/shared", "yarn")) == "s3a://team/shared"
    assert session.shared_folder(Session(None, "local[2]")) == session.shared_folder(Session(None, "local[2]"))
    with pytest.raises(ValueError, match="share"):
        session.shared_folder(Session(None, "yarn"))


def test_four_lice_sources_in_one_pass(spark, sf_dir):
    """No job while planning, one reading of the sheets and one more for the ratios; duplicates and first records move nothing."""
    folder = Path(session.shared_folder(spark))
    before = set(folder.iterdir())
    plans = {n: plan_of(entry.queries()[n](spark, sf_dir)) for n in ("q38_hosts_examined", "q39_yearly_abundance", "q40_yearly_prevalence")}
    assert set(folder.iterdir()) == before  # nothing is written while planning
    for name, plan in plans.items():
        assert plan.count("FileScan parquet") <= 18, (name, plan.count("FileScan parquet"))
        assert plan.count("Window") <= 4 and "parquet/lice" not in plan


def test_hosts_count_by_their_first_record(spark):
    ss = survey_rows(spark, [(1, "2019-05-06", 1, 3), (2, "2020-05-06", 1, 3)])
    fish = spark.createDataFrame([("A", 10, "SO"), ("A", 20, "SO"), ("B", 20, "PI")], "ufn string, seine_id bigint, species string")
    series = spark.createDataFrame(
        [("A", dt.date(2019, 5, 6), 2019, "DI", "SO", "motile_lep", 2), ("A", dt.date(2019, 5, 6), 2019, "DI", "SO", "motile_caligus", None),
         ("Z", dt.date(2020, 5, 6), 2020, "DI", "SO", "motile_lep", 1), ("Z", dt.date(2020, 5, 6), 2019, "DI", "SO", "motile_lep", 1)],
        "ufn string, survey_date date, year int, region string, species string, louse_species string, n_lice int",
    )
    rows = lice.lice_by_fish([lice.series_sheet(series)], lice.catch_data(fish, ss))
    got = {(r.species, r.year, r.life_stage): r.n_hosts for r in lice.hosts_examined(rows).collect()}
    assert got == {("SO", 2019, "attached"): 0, ("SO", 2019, "motile"): 1, ("SO", 2020, "attached"): 0, ("SO", 2020, "motile"): 1}
    assert lice.long_lice(rows).count() == 5  # the fish with two seines stands for two rows of each louse


@pytest.mark.parametrize("report", [lice.hosts_examined, lice.yearly_abundance, lice.yearly_prevalence])
def test_lice_meet_their_fish_once(spark, sf_dir, report):
    """The fish are moved once, also for the sums behind the ratios, which come back without moving the rows that they split."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(report(lice_queries.by_fish(*views(spark, sf_dir, lice_queries.ALL_VIEWS))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.splitlines() if " Exchange hashpartitioning(" in line and "Reused" not in line]
    assert sum("hashpartitioning(ufn" in line for line in moves) == 3 and "ReusedExchange [ufn" in plan
    assert not any("coalesce(origin" in line for line in moves)
