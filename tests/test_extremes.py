import datetime

import pytest

from daystrata.operators import (
    first_max_record,
    global_max,
    head_n,
    hottest_record,
    max_per_day,
    where_all,
    where_max,
)

D1, D2 = datetime.date(2016, 2, 1), datetime.date(2016, 3, 1)
SCHEMA = "ObservationDate date, Region string, ScreenTemperature double, site int"


@pytest.fixture(scope="module")
def tied(spark):
    return spark.createDataFrame(
        [
            (D1, "B", 10.0, 1),
            (D2, "A", 15.8, 2),
            (D1, "C", 15.8, 3),
            (D1, "B", 15.8, 4),
            (D1, "B", 15.8, 5),
            (None, "A", 15.8, 6),
            (D2, "A", None, 7),
        ],
        SCHEMA,
    )


def sites(df):
    return sorted(row["site"] for row in df.collect())


def test_all_ties(tied):
    assert sites(where_max(tied, "ScreenTemperature")) == [2, 3, 4, 5, 6]
    assert global_max(tied, "ScreenTemperature").first() == (15.8,)


def test_first_record_is_earliest_day_then_least_region(tied):
    order = ["ObservationDate", "Region"]
    assert sites(first_max_record(tied, "ScreenTemperature", order)) == [4, 5]


def test_first_record_leaves_out_rows_without_keys(spark):
    rows = [(None, "A", 20.0, 1), (D1, None, 19.0, 2), (D2, "A", 5.0, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sites(first_max_record(df, "ScreenTemperature", ["ObservationDate", "Region"])) == [3]


def test_max_per_day(tied):
    rows = max_per_day(tied, "ScreenTemperature", "ObservationDate").collect()
    assert {row[0]: row[1] for row in rows} == {D1: 15.8, D2: 15.8, None: 15.8}


def test_no_rows_or_only_nulls_give_no_record(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(D1, "A", None, 1)], SCHEMA)
    for df in (empty, nulls):
        assert hottest_record(df).collect() == []
        assert first_max_record(df, "ScreenTemperature", ["Region"]).collect() == []


def test_where_all_and_head(tied):
    assert sites(where_all(tied, {"Region": "B", "ObservationDate": D1})) == [1, 4, 5]
    assert sites(head_n(tied, 2, ["site"])) == [1, 2]


def test_maximum_reaches_the_parquet_reader(spark, tied, tmp_path):
    tied.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = hottest_record(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ScreenTemperature,ScalarSubquery" in plan
    assert "ReadSchema: struct<ScreenTemperature:double>" in plan
    assert "site" not in plan
    assert "Join" not in plan and "Window" not in plan
    assert plan.count("FileScan") == 3  # outer, and the one subquery shown twice
    assert sites(where_max(stored, "ScreenTemperature")) == [2, 3, 4, 5, 6]


def test_subqueries_run_once(spark, tied, tmp_path):
    tied.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = first_max_record(stored, "ScreenTemperature", ["ObservationDate", "Region"])
    assert sites(found) == [4, 5]
    found.collect()
    assert "ReusedSubquery" in found._jdf.queryExecution().executedPlan().toString()
