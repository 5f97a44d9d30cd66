"""Landing by increments, content checks, footers, rejects and marks."""

import datetime
import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daystrata import plans
from daystrata.operators import reconcile_content
from daystrata.plans import increments
from daystrata.sinks import write_clean, write_raw
from daystrata.sources import (
    day_counts,
    file_date_counts,
    layer_max,
    layer_max_per_day,
    read_clean,
    read_raw,
    read_rejects,
)
from daystrata.sources.footers import cell_aggregates

HEADER = "ForecastSiteCode,ObservationTime,ObservationDate,ScreenTemperature,Pressure,Region\n"
FEB, MAR = datetime.date(2016, 2, 1), datetime.date(2016, 3, 1)


@pytest.fixture
def store(tmp_path):
    class Store:
        landing, raw, clean, record = (str(tmp_path / x) for x in ("landing", "raw", "clean", "record"))

        def land(self, name, *rows):
            path = tmp_path / "landing" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(HEADER + "".join(f"{row}\n" for row in rows))

        def take(self, spark, **options):
            return plans.land_increments(spark, self.landing, self.raw, self.clean, self.record, **options)

    return Store()


def temperatures(spark, store):
    return sorted(r[0] for r in read_clean(spark, store.clean).select("ScreenTemperature").collect())


def test_each_file_is_taken_once(spark, store):
    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,990,A", "1,1,2016-02-02,3.5,990,A")
    (first,) = store.take(spark)
    assert first.file_dates == (FEB,) and first.raw["written_rows"] == first.clean["written_rows"] == 2
    before = {path: os.stat(path).st_mtime_ns for path in glob.glob(f"{store.raw}/**/*.parquet", recursive=True)}
    assert store.take(spark) == []
    store.land("odd {na,me}/weather.20160301.csv", "2,0,2016-02-02,4.5,990,B")
    (second,) = store.take(spark)
    assert second.file_dates == (MAR,) and second.clean["seen_rows"] == 1 and len(second.files) == 1
    assert temperatures(spark, store) == [2.5, 3.5, 4.5]
    # What was taken before has not been touched.
    assert before.items() <= {
        path: os.stat(path).st_mtime_ns for path in glob.glob(f"{store.raw}/**/*.parquet", recursive=True)
    }.items()


def test_a_later_file_of_a_date_joins_the_earlier(spark, store):
    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,990,A")
    store.land("weather.csv", "1,0,2016-02-05,0.5,990,A")
    store.take(spark)
    store.land("late/weather.20160201.csv", "1,0,2016-02-01,7.5,990,A")
    store.land("late/other.csv", "1,0,2016-02-06,1.5,990,A")
    (late,) = store.take(spark)
    assert late.file_dates == (FEB, None) and late.raw["written_rows"] == 4
    assert temperatures(spark, store) == [0.5, 1.5, 2.5, 7.5]
    store.land("later/weather.20160201.csv", "1,0,2016-02-01,9.5,990,A")
    store.take(spark, on_duplicate_date="latest")
    assert temperatures(spark, store) == [0.5, 1.5, 9.5]


def test_small_batches_equal_a_whole_run(spark, store, tmp_path):
    for day in range(1, 6):
        store.land(f"weather.2016020{day}.csv", f"{day},0,2016-02-0{day},{day}.5,990,A", f"{day},0,2016-02-09,1,n/a,A")
    assert len(store.take(spark, files_per_batch=2)) == 3
    raw, cleaned = str(tmp_path / "r2"), str(tmp_path / "c2")
    plans.run(spark, raw, cleaned, landing=store.landing)
    assertDataFrameEqual(read_clean(spark, store.clean), read_clean(spark, cleaned))
    assertDataFrameEqual(read_raw(spark, store.raw), read_raw(spark, raw))


def test_a_batch_that_failed_halfway_is_taken_again(spark, store, monkeypatch):
    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,990,A")

    def fails(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(increments, "raw_to_clean", fails)
        with pytest.raises(Exception, match="lost"):
            store.take(spark)
    assert read_raw(spark, store.raw).count() == 1
    store.land("weather.20160301.csv", "1,0,2016-03-01,3.5,990,A")
    store.take(spark)
    assert temperatures(spark, store) == [2.5, 3.5] and read_raw(spark, store.raw).count() == 2


def test_names_must_be_of_files(spark, store):
    with pytest.raises(ValueError, match="member"):
        store.take(spark, name="member")


def test_contents(spark):
    rows = [(FEB, "a", 1), (FEB, "b", 2), (FEB, "b", 2), (MAR, "a", None), (None, None, 3)]
    source = spark.createDataFrame(rows, "file_date date, x string, y int")
    same = reconcile_content(source, source.select("y", "file_date", "x").repartition(5))
    plan = same._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning") == 1
    assert {r["file_date"]: r["same"] for r in same.collect()} == {FEB: True, MAR: True, None: True}

    def differing(changed, schema="file_date date, x string, y int"):
        target = spark.createDataFrame(changed, schema)
        return {r["file_date"] for r in reconcile_content(source, target).collect() if not r["same"]}

    swapped = [(FEB, "a", 2), (FEB, "b", 1), (FEB, "b", 2), *rows[3:]]
    assert differing(swapped) == {FEB}
    assert differing([rows[0], rows[0], rows[1], *rows[3:]]) == {FEB}
    assert differing([*rows[:3], (MAR, "a", 0), rows[4]]) == {MAR}
    assert differing(rows[:4]) == {None}
    assert differing([*rows, (datetime.date(2016, 4, 1), "z", 0)]) == {datetime.date(2016, 4, 1)}
    # Texts that read alike when put together.
    one = spark.createDataFrame([(FEB, "1:a", "b")], "file_date date, x string, y string")
    two = spark.createDataFrame([(FEB, "1:", "ab")], "file_date date, x string, y string")
    assert not reconcile_content(one, two).first()["same"]
    lost = reconcile_content(source, source.drop("y"))
    assert {r["file_date"] for r in lost.collect() if r["same"]} == {MAR}
    assert reconcile_content(source.where("false"), source.where("false")).count() == 0


def test_footers_answer(spark, tmp_path):
    root = str(tmp_path / "clean")
    rows = spark.range(60).select(
        "id", (F.col("id") % 7).cast("double").alias("v"), F.lit(FEB).alias("of"),
        F.when(F.col("id") % 5 > 0, F.date_add(F.lit(FEB), (F.col("id") % 3).cast("int"))).alias("d"),
        F.col("id").cast("string").alias("text"),
    )
    write_clean(rows, root, "d", file_date="of")
    plan = cell_aggregates(spark, root, "v")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(v)]" in plan
    found = read_clean(spark, root)
    assert layer_max(spark, root, "v").first() == (6.0,)
    assertDataFrameEqual(layer_max_per_day(spark, root, "v", "d"), found.groupBy("d").agg(F.max("v").alias("max_v")))
    assert sum(r["RowCount"] for r in day_counts(spark, root).collect()) == 48
    assert [tuple(r) for r in file_date_counts(spark, root).collect()] == [(FEB, 48)]
    # Text has no such statistics, nor have NaN and nulls alone.
    assert layer_max(spark, root, "text").first() == ("9",)
    odd = str(tmp_path / "odd")
    write_raw(rows.select("d", F.when(F.col("id") == 8, float("nan")).otherwise(F.col("v")).alias("v")), odd, "d")
    assert str(layer_max(spark, odd, "v").first()[0]) == "nan"
    none = str(tmp_path / "none")
    write_raw(rows.select("d", F.lit(None).cast("int").alias("v")), none, "d")
    assert layer_max(spark, none, "v").first() == (None,)
    assert "PushedAggregation" not in spark.read.parquet(root).agg(F.max("v"))._jdf.queryExecution().executedPlan().toString()


def test_rejected_rows_stay_with_the_layer(spark, store):
    store.land("weather.20160201.csv", "1,0,no day,2.5,990,A", "1,1,2016-02-02,3.5,n/a,A", "1,1,0000-01-01,4.5,1,A")
    done = plans.run(spark, store.raw, store.clean, landing=store.landing)
    assert done.clean.get == {"seen_rows": 3, "null_days": 1, "written_rows": 2}
    (row,) = read_rejects(spark, store.clean).collect()
    assert row["from_file_date"] == FEB
    assert json.loads(row["rejected_row"]) == {
        "ForecastSiteCode": "1", "ObservationTime": "0", "ObservationDate": "no day", "ScreenTemperature": "2.5",
        "Pressure": "990", "Region": "A", "file_date": "2016-02-01",
    }
    assert temperatures(spark, store) == [3.5, 4.5]
    assert read_clean(spark, store.clean, end="2016-12-31").count() == 2
    assert read_clean(spark, store.clean, file_dates=[FEB]).count() == 2
    assert "rejected_row" not in read_clean(spark, store.clean).columns
    assert {r["column"]: r["failures"] for r in done.failures.collect() if r["failures"]} == {
        "ObservationDate": 1, "Pressure": 1,
    }
    assert [tuple(r) for r in done.reconciled.collect()] == [(FEB, 3, 3, 0)]
    assert all(r["same"] for r in done.contents.collect())
    # A file date that gives no row with a day is settled all the same, and its rejects go with it.
    store.land("weather.20160201.csv", "1,0,never,2.5,990,A")
    plans.run(spark, store.raw, store.clean, landing=store.landing)
    store.land("weather.20160301.csv", "1,0,2016-03-01,1.5,990,A")
    os.remove(f"{store.landing}/weather.20160201.csv")
    again = plans.run(spark, store.raw, store.clean, landing=store.landing)
    assert again.cleaned_dates == (MAR,) and again.clean.get["seen_rows"] == 1
    assert read_rejects(spark, store.clean).count() == 1 and again.rejects.count() == 0
    assert temperatures(spark, store) == [1.5]


def test_many_cells_are_emptied_by_a_few_jobs(spark, tmp_path):
    """As many jobs for 300 withdrawn days as for 3."""
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for n in (3, 300):
        root = str(tmp_path / f"t{n}")
        rows = spark.range(n).select("id", F.date_add(F.lit(FEB), F.col("id").cast("int")).alias("d"), F.lit(FEB).alias("of"))
        write_clean(rows, root, "d", file_date="of", file_dates=[FEB])
        assert len(glob.glob(f"{root}/*/*/*/*/*.parquet")) == n
        spark.sparkContext.setJobGroup(f"empty{n}", "")
        write_clean(rows.where("id = 1"), root, "d", file_date="of", file_dates=[FEB])
        jobs[n] = len(tracker.getJobIdsForGroup(f"empty{n}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [r["id"] for r in read_clean(spark, root).collect()] == [1]
    assert jobs[300] <= jobs[3] + 2


_RUN = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {repo!r})
from daystrata import plans
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.dir", "file://{log}")
    .config("spark.checkpoint.dir", "{shared}").config("spark.sql.shuffle.partitions", "2").getOrCreate())
done = plans.run(spark, "{raw}", "{clean}", landing="{landing}", raise_if_empty=True)
spark.sparkContext.setJobGroup("checks", "")
assert done.failures.count() and done.reconciled.count() == 1 and done.report.count() == 2
spark.stop()
"""


def test_a_run_reads_each_raw_row_once(spark, store, tmp_path):
    n = 5000
    store.land("weather.20160201.csv", *(f"{i},0,2016-02-{1 + i % 20:02},{i % 30}.5,n/a,A" for i in range(n)))
    for name in ("log", "shared"):
        (tmp_path / name).mkdir()
    script = _RUN.format(
        repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), log=tmp_path / "log",
        shared=tmp_path / "shared", raw=store.raw, clean=store.clean, landing=store.landing,
    )
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300, capture_output=True)
    read = []
    (log,) = glob.glob(f"{tmp_path}/log/*")
    for line in open(log):
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            read.append(event["Task Metrics"]["Input Metrics"]["Records Read"])
    # Landing once, once more to count its files' rows for the report; raw once. The answer's two scans are not run.
    assert n <= sum(read) - 2 * n < n + 500
