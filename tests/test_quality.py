import datetime

import pytest

from daystrata import WEATHER
from daystrata.operators import (
    cast_failures,
    check_not_empty,
    drop_null_key,
    file_row_counts,
    hour_out_of_range,
    non_empty,
    reconcile_counts,
    row_count_report,
)

DAY = datetime.date(2016, 2, 1)


def test_not_empty(spark):
    some, none = spark.range(3), spark.range(0)
    assert check_not_empty(some) and not check_not_empty(none)
    assert non_empty(some).first() == (True,) and non_empty(none).first() == (False,)
    with pytest.raises(ValueError):
        check_not_empty(none, raise_if_empty=True)


def test_hour_out_of_range(spark):
    hours = ["0", "23", "24", "24.0", "99", "00:00:00", "", None]
    df = spark.createDataFrame([(h,) for h in hours], "ObservationTime string")
    assert {r[0] for r in hour_out_of_range(df, "ObservationTime").collect()} == {"24", "24.0", "99"}
    typed = spark.createDataFrame([(1,), (24,)], "ObservationTime int")
    assert hour_out_of_range(typed, "ObservationTime").count() == 1


def test_cast_failures(spark):
    df = spark.createDataFrame(
        [("1", "n/a", "x"), (None, "3.5", "2016-02-01"), ("calm", "", None)],
        "WindSpeed string, ScreenTemperature string, ObservationDate string",
    )
    rows = {r["column"]: r["failures"] for r in cast_failures(df, WEATHER.types).collect()}
    assert rows == {"WindSpeed": 1, "ScreenTemperature": 2, "ObservationDate": 1}
    with pytest.raises(ValueError):
        cast_failures(df.select("WindSpeed"), {"int": ["Pressure"]})


def test_drop_null_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert [r["v"] for r in drop_null_key(df, "k").collect()] == ["a"]


def test_file_row_counts(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "weather.20160201.csv").write_text("a,b\n1,2\n3,4\n\n")
    (tmp_path / "weather.20160301.csv").write_text("a,b\n")
    (tmp_path / "sub dir" / "weather.20160201.csv").write_text("a,b\n1,2\n")
    (tmp_path / "sub dir" / "a+b 100%.csv").write_text("a,b\n1,2\n")
    (tmp_path / "notes.txt").write_text("a,b\n1,2\n")
    counts = file_row_counts(spark, str(tmp_path), ".csv", "csv", True)
    assert counts.columns == ["filename", "RowCount"]
    assert sorted(map(tuple, counts.collect())) == [
        ("a+b 100%.csv", 1),
        ("weather.20160201.csv", 1),
        ("weather.20160201.csv", 2),
        ("weather.20160301.csv", 0),
    ]


def test_file_row_counts_of_several_paths(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.csv").write_text("a\n1\n")
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    rows = file_row_counts(spark, paths, ".csv", "csv", True).collect()
    assert sorted(map(tuple, rows)) == [("one.csv", 1), ("two.csv", 1)]


def test_row_count_report(spark):
    source = spark.createDataFrame([("a.csv", 1)], "filename string, RowCount bigint")
    target = spark.createDataFrame([("day=1", 2)], "filename string, RowCount bigint")
    report = row_count_report("SourceFile", "TargetFile", source, target)
    assert report.columns == ["Type", "filename", "RowCount"]
    assert sorted(map(tuple, report.collect())) == [
        ("SourceFile", "a.csv", 1),
        ("TargetFile", "day=1", 2),
    ]


def test_reconcile_counts(spark):
    other = datetime.date(2016, 2, 2)
    source = spark.createDataFrame([(DAY,), (DAY,), (None,)], "file_date date")
    target = spark.createDataFrame([(DAY,), (other,)], "file_date date")
    counted = reconcile_counts(source, target)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert {tuple(r) for r in counted.collect()} == {
        (DAY, 2, 1, -1),
        (other, 0, 1, 1),
        (None, 1, 0, -1),
    }
