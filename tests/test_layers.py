import datetime
import glob
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daystrata import plans
from daystrata.operators import clean, file_row_counts, hottest_record, reconcile_counts
from daystrata.sinks import drop_view, register_view, write_by_day, write_clean, write_raw
from daystrata.sources import read_clean, read_landing_csv, read_raw, with_file_date

COLUMNS = (
    "ForecastSiteCode,ObservationTime,ObservationDate,WindDirection,WindSpeed,WindGust,Visibility,"
    "ScreenTemperature,Pressure,SignificantWeatherCode,SiteName,Latitude,Longitude,Region,Country"
).split(",")
FEB = """\
3002,0,2016-02-01T00:00:00,12,8,,30000,2.1,997,8,BALTASOUND,60.749,-0.854,Orkney,SCOTLAND
3002,9,2016-02-01T00:00:00,12,9,20,,15.8,n/a,8,"BALTA, SOUND",60.749,-0.854,Orkney,SCOTLAND
3005,23,2016-02-02T00:00:00,10,7,,1000,,998,7,LERWICK,60.139,-1.183,,
3005,5,,10,7,,1000,3.0,998,7,LERWICK,60.139,-1.183,Orkney,SCOTLAND
"""
MAR = """\
3008,12,2016-03-01T00:00:00,6,5,,25000,15.8,1001,1,FAIR ISLE,59.53,-1.63,Highland,SCOTLAND
3008,13,2016-02-02T00:00:00,6,5,,25000,4.4,1001,1,FAIR ISLE,59.53,-1.63,Highland,SCOTLAND
"""
HOTTEST = [
    (datetime.date(2016, 2, 1), "Orkney", 15.8),
    (datetime.date(2016, 3, 1), "Highland", 15.8),
]


@pytest.fixture
def store(tmp_path):
    header = ",".join(COLUMNS) + "\n"
    landing = tmp_path / "landing" / "2016"
    landing.mkdir(parents=True)
    (landing / "weather.20160201.csv").write_text(header + FEB)
    (landing.parent / "weather.20160301.csv").write_text(header + MAR)
    with zipfile.ZipFile(tmp_path / "drop.zip", "w") as archive:
        archive.writestr("weather.20160201.csv", header + FEB)
        archive.writestr("weather.20160301.csv", header + MAR)
        archive.writestr("readme.csv", "no,data\n")
    return tmp_path


def directories(root):
    """Those of days; rows put aside lie in a cell that is none."""
    paths = glob.glob(f"{root}/year=[12]*/**/*.parquet", recursive=True)
    return sorted({p.removeprefix(f"{root}/").split("/from_file_date")[0].split("/part-")[0]
                   for p in paths})


@pytest.mark.parametrize("way", ["landing", "archives"])
def test_run(spark, store, way):
    raw, cleaned = str(store / "raw"), str(store / "clean")
    source = {"landing": str(store / "landing")} if way == "landing" else {
        "archives": str(store / "*.zip"), "columns": COLUMNS
    }
    done = plans.run(spark, raw, cleaned, **source)
    assert done.raw.get == {"seen_rows": 6, "null_days": 0, "written_rows": 6}
    assert done.clean.get == {"seen_rows": 6, "null_days": 1, "written_rows": 5}
    assert sorted(map(tuple, done.answer.collect())) == HOTTEST
    assert directories(raw) == ["year=2016/month=2/day=1", "year=2016/month=3/day=1"]
    assert directories(cleaned) == [
        "year=2016/month=2/day=1", "year=2016/month=2/day=2", "year=2016/month=3/day=1",
    ]
    # One file for each file's share of these small days.
    assert len(glob.glob(f"{cleaned}/year=2016/*/*/*/*.parquet")) == 4
    assert [json.loads(r["rejected_row"])["ScreenTemperature"] for r in done.rejects.collect()] == ["3.0"]
    assert set(dict(read_raw(spark, raw).drop("file_date").dtypes).values()) == {"string"}
    typed = dict(read_clean(spark, cleaned).dtypes)
    assert typed["ObservationDate"] == "date" and typed["Visibility"] == "bigint"
    assert list(typed) == COLUMNS


def test_running_twice_changes_nothing(spark, store):
    raw, cleaned = str(store / "raw"), str(store / "clean")
    plans.run(spark, raw, cleaned, landing=str(store / "landing"))
    kept = str(store / "kept")
    read_clean(spark, cleaned).write.parquet(kept)
    plans.run(spark, raw, cleaned, landing=str(store / "landing"))
    assert read_raw(spark, raw).count() == 6
    assertDataFrameEqual(read_clean(spark, cleaned), spark.read.parquet(kept))


def test_both_answers_agree(spark, store):
    cleaned = str(store / "clean")
    plans.run(spark, str(store / "raw"), cleaned, landing=str(store / "landing"))
    register_view(read_clean(spark, cleaned), "Weather")
    answer = spark.sql(
        "SELECT ObservationDate, Region, ScreenTemperature FROM Weather "
        "WHERE ScreenTemperature = (SELECT MAX(ScreenTemperature) FROM Weather)"
    )
    assertDataFrameEqual(hottest_record(read_clean(spark, cleaned)), answer)
    assert drop_view(spark, "Weather") and not drop_view(spark, "Weather")


def test_counts_between_layers(spark, store):
    landing, raw = str(store / "landing"), str(store / "raw")
    plans.land_to_raw(spark, raw, landing)
    by_file = file_row_counts(spark, landing, ".csv", "csv", True)
    assert sorted(map(tuple, by_file.collect())) == [
        ("weather.20160201.csv", 4), ("weather.20160301.csv", 2),
    ]
    by_day = file_row_counts(spark, raw, ".parquet", "parquet", name="day")
    assert sorted(map(tuple, by_day.collect())) == [
        ("year=2016/month=2/day=1", 4), ("year=2016/month=3/day=1", 2),
    ]
    dated = with_file_date(read_landing_csv(spark, landing))
    assert {r["delta"] for r in reconcile_counts(dated, read_raw(spark, raw)).collect()} == {0}


def test_many_small_files_of_a_date_can_be_gathered(spark, tmp_path):
    for number in range(40):
        (tmp_path / f"part{number}").mkdir()
        (tmp_path / f"part{number}" / "weather.20160201.csv").write_text(f"a\n{number}\n")
    raw = str(tmp_path / "raw")
    counts = plans.land_to_raw(spark, raw, str(tmp_path / "part*"), gather_days=True)
    assert counts.get["written_rows"] == 40
    assert len(glob.glob(f"{raw}/*/*/*/*.parquet")) == 1
    assert {r["a"] for r in read_raw(spark, raw).collect()} == {str(n) for n in range(40)}


def test_one_source_is_needed(spark, store):
    for source in ({}, {"landing": "a", "archives": "b"}, {"archives": "b"}):
        with pytest.raises(ValueError):
            plans.land_to_raw(spark, str(store / "raw"), **source)


def days(spark, n_days, rows_per_day, first="2016-02-01"):
    return spark.range(n_days * rows_per_day).select(
        F.col("id"),
        F.date_add(F.lit(first).cast("date"), (F.col("id") % n_days).cast("int")).alias("d"),
    )


def test_overwrite_replaces_only_the_days_written(spark, tmp_path):
    root = str(tmp_path / "t")
    write_raw(days(spark, 5, 10), root, "d")
    write_raw(days(spark, 1, 3, "2016-02-03").withColumn("id", F.col("id") + 1000), root, "d")
    stored = read_raw(spark, root)
    assert stored.count() == 43
    third = stored.where("d = date'2016-02-03'")
    assert sorted(r["id"] for r in third.collect()) == [1000, 1001, 1002]


def test_bounds_prune_directories(spark, tmp_path):
    root = str(tmp_path / "t")
    write_raw(days(spark, 40, 2), root, "d")
    part = read_raw(spark, root, datetime.date(2016, 2, 10), "2016-02-12")
    assert sorted({str(r["d"]) for r in part.collect()}) == [
        "2016-02-10", "2016-02-11", "2016-02-12",
    ]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "make_date(year" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert read_raw(spark, root, end="2016-02-02").count() == 4
    assert read_raw(spark, root, start="2016-03-01").columns == ["id", "d"]


def test_rows_without_a_day(spark, tmp_path):
    some = days(spark, 2, 5).unionAll(spark.sql("select 99L id, cast(null as date) d"))
    counts = write_clean(some, str(tmp_path / "clean"), "d")
    assert counts.get == {"seen_rows": 11, "null_days": 1, "written_rows": 10}
    assert read_clean(spark, str(tmp_path / "clean")).count() == 10
    counts = write_raw(some, str(tmp_path / "raw"), "d")
    assert counts.get == {"seen_rows": 11, "null_days": 1, "written_rows": 11}
    assert read_raw(spark, str(tmp_path / "raw")).where("d is null").count() == 1


def test_only_the_months_asked_for_are_listed(spark, tmp_path):
    root = str(tmp_path / "t")
    write_raw(days(spark, 400, 1), root, "d")
    assert len(read_raw(spark, root).inputFiles()) == 400
    across = read_raw(spark, root, "2016-12-30", "2017-01-02")
    listed = spark.read.option("basePath", root).parquet(
        f"{root}/year=2016/month=12", f"{root}/year=2017/month=1"
    )
    assert sorted(across.inputFiles()) == sorted(listed.inputFiles())
    assert sorted(str(r["d"]) for r in across.collect()) == [
        "2016-12-30", "2016-12-31", "2017-01-01", "2017-01-02",
    ]
    assert across.columns == read_raw(spark, root).columns
    # Bounds outside the layer, half inside, reversed, and too long to list by month.
    assert read_raw(spark, root, "1999-01-01", "1999-02-01").collect() == []
    assert read_raw(spark, root, "2015-01-01", "2016-02-03").count() == 3
    assert read_raw(spark, root, "2016-05-01", "2016-03-01").count() == 0
    assert read_raw(spark, root, "1990-01-01", "2030-01-01").count() == 400
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, root + "x", "2016-05-01", "2016-06-01")


@pytest.mark.parametrize("gather", [True, False])
def test_nothing_to_write(spark, tmp_path, gather):
    root = str(tmp_path / "t")
    write_raw(days(spark, 2, 2), root, "d")
    none = days(spark, 2, 2).where("id < 0")
    counts = write_by_day(none, root, "d", drop_null_day=True, gather_days=gather)
    assert counts.get == {"seen_rows": 0, "null_days": 0, "written_rows": 0}
    assert read_raw(spark, root).count() == 4


def test_a_hot_day_is_split_and_small_days_are_not(spark, tmp_path):
    root = str(tmp_path / "t")
    hot = spark.range(400_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000).alias("k"),
    ).withColumn("d", F.when(F.col("k") < 1900, F.lit("2016-02-01"))
                 .otherwise(F.concat(F.lit("2016-03-"), F.lpad(F.col("k") % 25 + 1, 2, "0")))
                 .cast("date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_by_day(hot, root, "d", drop_null_day=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{root}/year=2016/month=2/day=1/*.parquet")) > 4
    assert read_clean(spark, root).count() == 400_000


def test_raw_is_written_without_a_shuffle(spark, store):
    """The last executed write stage reads the landing files directly."""
    rows = with_file_date(read_landing_csv(spark, str(store / "landing")))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    write_raw(rows, str(store / "raw"))
    # Each small landing file stays one raw file.
    assert len(glob.glob(f"{store}/raw/*/*/*/*.parquet")) == 2


def test_partition_columns_may_not_be_taken(spark, tmp_path):
    with pytest.raises(ValueError, match="month"):
        write_raw(days(spark, 1, 1).withColumn("Month", F.lit(1)), str(tmp_path / "t"), "d")


def test_clean_keeps_unlisted_columns(spark, store):
    cleaned = clean(read_landing_csv(spark, str(store / "landing")))
    assert cleaned.columns == COLUMNS
    assert cleaned.where("SiteName = 'BALTA, SOUND' and Pressure = 0").count() == 1


def test_late_rows_leave_a_days_other_rows(spark, store):
    """A second batch brings one more row for a day of the first."""
    raw, cleaned = str(store / "raw"), str(store / "clean")
    first = store / "first"
    first.mkdir()
    (store / "landing" / "2016" / "weather.20160201.csv").rename(first / "weather.20160201.csv")
    plans.run(spark, raw, cleaned, landing=str(first))
    done = plans.run(spark, raw, cleaned, landing=str(store / "landing"), answer="run")
    assert done.file_dates == (datetime.date(2016, 3, 1),)
    assert done.clean.get["seen_rows"] == 2
    day = read_clean(spark, cleaned, "2016-02-02", "2016-02-02")
    assert sorted(r["ScreenTemperature"] for r in day.collect()) == [0.0, 4.4]
    assert [tuple(r) for r in done.answer.collect()] == HOTTEST[1:]
    assert sorted(tuple(r) for r in hottest_record(read_clean(spark, cleaned)).collect()) == HOTTEST


def test_withdrawn_rows_go(spark, store):
    raw, cleaned = str(store / "raw"), str(store / "clean")
    plans.run(spark, raw, cleaned, landing=str(store / "landing"))
    header = ",".join(COLUMNS) + "\n"
    february = store / "landing" / "2016" / "weather.20160201.csv"
    february.write_text(header + FEB.splitlines(keepends=True)[0])
    plans.run(spark, raw, cleaned, landing=str(store / "landing"))
    assert read_raw(spark, raw).count() == 3
    rows = read_clean(spark, cleaned).select("ObservationDate", "ScreenTemperature").collect()
    assert sorted((r[0].day, r[1]) for r in rows) == [(1, 2.1), (1, 15.8), (2, 4.4)]
    february.write_text(header)
    plans.run(spark, raw, cleaned, landing=str(store / "landing"))
    assert read_raw(spark, raw).count() == read_clean(spark, cleaned).count() == 2


@pytest.mark.parametrize("dated", [True, False])
def test_files_without_a_date_are_cleaned(spark, store, dated):
    raw, cleaned, landing = str(store / "raw"), str(store / "clean"), store / "landing"
    undated = landing / "weather.csv"
    if dated:
        (landing / "2016" / "weather.20160201.csv").rename(undated)
    else:
        (landing / "weather.20160301.csv").rename(landing / "march.csv")
        (landing / "2016" / "weather.20160201.csv").rename(undated)
    done = plans.run(spark, raw, cleaned, landing=str(landing), answer="run")
    assert done.file_dates == ((datetime.date(2016, 3, 1), None) if dated else (None,))
    assert done.clean.get == {"seen_rows": 6, "null_days": 1, "written_rows": 5}
    landed = clean(read_landing_csv(spark, str(landing)).select(*COLUMNS))
    landed = landed.where("ObservationDate is not null")
    assertDataFrameEqual(read_clean(spark, cleaned).select(*COLUMNS), landed.select(*COLUMNS))
    assert sorted(map(tuple, done.answer.collect())) == HOTTEST
    assert sum(r["source_rows"] for r in done.reconciled.collect()) == 6
    # A corrected file replaces what the undated files gave before, and nothing else.
    undated.write_text(",".join(COLUMNS) + "\n" + FEB.splitlines(keepends=True)[0])
    plans.run(spark, raw, cleaned, landing=str(landing))
    assert read_clean(spark, cleaned).count() == 3 and read_raw(spark, raw).count() == 3


def test_dates_left_between_the_layers_are_cleaned(spark, store):
    raw, cleaned, landing = str(store / "raw"), str(store / "clean"), str(store / "landing")
    first = store / "first"
    first.mkdir()
    (store / "landing" / "2016" / "weather.20160201.csv").rename(first / "weather.20160201.csv")
    plans.land_to_raw(spark, raw, str(first))
    done = plans.run(spark, raw, cleaned, landing=landing)
    assert done.file_dates == (datetime.date(2016, 3, 1),) and done.clean.get["seen_rows"] == 6
    assert sorted(map(tuple, done.answer.collect())) == HOTTEST
    plans.land_to_raw(spark, raw, str(first))
    assert plans.run(spark, raw, cleaned, landing=landing).clean.get["seen_rows"] == 6
    assert plans.run(spark, raw, cleaned, landing=landing).clean.get["seen_rows"] == 2


def test_new_column_is_there_whatever_the_bounds(spark, tmp_path):
    old = spark.sql("select 'a' as x, date'2016-03-01' as file_date")
    new = spark.sql("select 'b' as x, 'p' as y, date'2016-04-01' as file_date")
    root = str(tmp_path / "raw")
    write_raw(old, root)
    write_raw(new, root)
    for bounds in ((None, None), ("2016-03-01", "2016-03-31"), ("2016-01-01", "2036-01-01")):
        assert read_raw(spark, root, *bounds).columns == ["x", "file_date", "y"]
    with pytest.raises(ValueError, match="column x"):
        write_raw(spark.sql("select 1 as x, date'2016-04-01' as file_date"), root)


def test_checks_of_a_run(spark, store):
    done = plans.run(
        spark, str(store / "raw"), str(store / "clean"), landing=str(store / "landing"),
        fill={"numeric_default": None}, raise_if_empty=True,
    )
    report = sorted(tuple(r) for r in done.report.collect())
    assert report[0] == ("SourceFile", "weather.20160201.csv", 4) and len(report) == 4
    assert all(r["delta"] == 0 for r in done.reconciled.collect())
    failures = {r["column"]: r["failures"] for r in done.failures.collect()}
    assert failures["Pressure"] == 1
    assert read_clean(spark, str(store / "clean")).where("Pressure is null").count() == 1
    with pytest.raises(ValueError, match="no rows"):
        empty = store / "empty"
        empty.mkdir()
        (empty / "weather.20170101.csv").write_text(",".join(COLUMNS) + "\n")
        plans.run(spark, str(store / "r2"), str(store / "c2"), landing=str(empty), raise_if_empty=True)
