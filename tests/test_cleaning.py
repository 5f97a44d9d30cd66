import datetime

from pyspark.sql import functions as F

from daystrata import WEATHER
from daystrata.operators import (
    cast_by_lists,
    clean,
    columns_of_type,
    drop_and_rename,
    fill_by_type,
    hottest_record,
    label,
    reorder_last_first,
    stack_by_name,
)

RAW = "ForecastSiteCode string, ObservationTime string, ObservationDate string, " \
    "WindSpeed string, ScreenTemperature string, Region string, Extra string"
DAY = datetime.date(2016, 2, 1)


def raw(spark):
    return spark.createDataFrame(
        [
            ("3002", "9", "2016-02-01T00:00:00", "12.7", "2.5", "Orkney", "x"),
            (None, None, "n/a", "calm", "NaN", None, None),
        ],
        RAW,
    )


def test_clean_types_fills_and_passes_through(spark):
    cleaned = clean(raw(spark))
    assert dict(cleaned.dtypes) == {
        "ForecastSiteCode": "bigint",
        "ObservationTime": "string",
        "ObservationDate": "date",
        "WindSpeed": "int",
        "ScreenTemperature": "double",
        "Region": "string",
        "Extra": "string",
    }
    assert cleaned.collect() == [
        (3002, "09:00:00", DAY, 12, 2.5, "Orkney", "x"),
        (0, "00:00:00", None, 0, 0.0, "Unknown", "Unknown"),
    ]


def test_clean_is_one_stage_of_generated_code(spark):
    plan = clean(raw(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_fill_can_follow_the_narrower_rule(spark):
    """Only int and double filled, and no default of its own for the hour."""
    typed = cast_by_lists(raw(spark), WEATHER.types)
    numbers = columns_of_type(typed, "int") + columns_of_type(typed, "double")
    filled = fill_by_type(typed, numeric_columns=numbers, overrides={})
    assert filled.collect()[1] == (None, "Unknown", None, 0, 0.0, "Unknown", "Unknown")


def test_fill_may_leave_nulls(spark):
    typed = cast_by_lists(raw(spark).where("Region is null"), WEATHER.types)
    kept = fill_by_type(typed, string_default=None, numeric_default=None)
    assert kept.drop("ScreenTemperature").first() == (None,) * 6


def test_filled_zero_can_be_the_maximum(spark):
    cold = spark.createDataFrame(
        [("1", "2016-02-01", "-5", "A"), ("2", "2016-02-02", None, "B")],
        "ObservationTime string, ObservationDate string, ScreenTemperature string, Region string",
    )
    assert [r["Region"] for r in hottest_record(clean(cold)).collect()] == ["B"]
    kept = hottest_record(clean(cold, numeric_default=None)).collect()
    assert [r["Region"] for r in kept] == ["A"]


def test_columns_with_dots_and_spaces(spark):
    odd = spark.createDataFrame([("1", "2")], "`a.b` string, `c d` string")
    assert cast_by_lists(odd, {"int": ["a.b"]}).first() == (1, "2")
    assert reorder_last_first(odd).columns == ["c d", "a.b"]


def test_shaping(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert columns_of_type(df, "numeric") == ["a", "c"]
    assert columns_of_type(df, "string") == ["b"]
    assert reorder_last_first(df).columns == ["c", "a", "b"]
    assert label(df, "100%").first()["Type"] == "100%"
    renamed = drop_and_rename(df, "a", "c")
    assert renamed.columns == ["b", "a"] and renamed.first() == ("x", 2.0)


def test_stack_by_name_keeps_duplicates_and_missing_columns(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([("x", 1), ("y", 2)], "b string, a int")
    three = spark.createDataFrame([(3,)], "a int")
    rows = stack_by_name(one, two, three).select("a", "b").orderBy("a", F.col("b")).collect()
    assert rows == [(1, "x"), (1, "x"), (2, "y"), (3, None)]
