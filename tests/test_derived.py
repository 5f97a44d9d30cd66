"""Tables that follow the clean layer, and point lookups in it."""

import datetime
import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daystrata import plans
from daystrata.operators import (
    cell_extremes,
    first_max_record,
    first_of_extremes,
    hottest_record,
    latest_rows,
    max_per_day,
    merge_extremes,
    where_all,
)
from daystrata.sinks import write_clean, write_raw
from daystrata.sources import read_clean, read_days

A, B = datetime.date(2016, 2, 1), datetime.date(2016, 3, 1)
HEADER = "ForecastSiteCode,ObservationTime,ObservationDate,ScreenTemperature,Region\n"
ORDER = ["Region"]


def observations(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([A, B, None]), A + datetime.timedelta(days=rng.randrange(4)) if rng.random() < 0.95 else None,
            float(rng.randrange(6)) if rng.random() < 0.95 else None, rng.choice(["x", "y", "z", None]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "of date, d date, v double, Region string")


def test_extremes_merge_in_any_order(spark):
    df = observations(spark, 1).unionAll(spark.createDataFrame([(A, A, float("nan"), "y")], "of date, d date, v double, Region string"))
    parts = df.randomSplit([1.0, 2.0, 1.0], 5)
    one, two, three = (cell_extremes(part, "v", "d", "of", ORDER) for part in parts)
    whole = merge_extremes(cell_extremes(df, "v", "d", "of", ORDER), "v", "d", ORDER)
    left = merge_extremes(merge_extremes(one.unionAll(two), "v", "d", ORDER).unionByName(three.drop("of")), "v", "d", ORDER)
    right = merge_extremes(merge_extremes(three.unionAll(two), "v", "d", ORDER).unionByName(one.drop("of")), "v", "d", ORDER)
    assertDataFrameEqual(left, whole)
    assertDataFrameEqual(right, whole)
    known = df.where("d is not null and v is not null and Region is not null")
    assertDataFrameEqual(whole.select("d", F.col("v").alias("max_v")), max_per_day(known, "v", "d"))
    finite = df.where("not isnan(v)")
    first = first_of_extremes(cell_extremes(finite, "v", "d", "of", ORDER), "v", "d", ORDER)
    want = first_max_record(finite, "v", ["d", "Region"]).select("d", "v", "Region").distinct()
    assertDataFrameEqual(first, want)
    assert first_of_extremes(cell_extremes(df.where("false"), "v", "d", "of", ORDER), "v", "d", ORDER).count() == 0
    plan = cell_extremes(df, "v", "d", "of", ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1 and "Window" not in plan


@pytest.fixture
def store(tmp_path):
    class Store:
        landing, raw, clean, extremes, settled = (
            str(tmp_path / x) for x in ("landing", "raw", "clean", "extremes", "settled")
        )

        def land(self, name, *rows):
            (tmp_path / "landing").mkdir(exist_ok=True)
            (tmp_path / "landing" / name).write_text(HEADER + "".join(f"{row}\n" for row in rows))

        def run(self, spark):
            return plans.run(spark, self.raw, self.clean, landing=self.landing).cleaned_dates

    return Store()


def test_extremes_follow_the_layer(spark, store):
    def agrees():
        layer = read_clean(spark, store.clean)
        assertDataFrameEqual(plans.hottest_kept(spark, store.extremes, store.clean), hottest_record(layer))
        assertDataFrameEqual(
            plans.max_per_day_kept(spark, store.extremes),
            max_per_day(layer, "ScreenTemperature", "ObservationDate"),
        )

    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,b", "2,0,2016-02-01,9.5,b", "3,0,2016-02-02,9.5,a")
    store.land("weather.csv", "1,0,2016-02-07,9.5,c")
    plans.keep_extremes(spark, store.clean, store.extremes, store.run(spark))
    agrees()
    assert plans.first_max_kept(spark, store.extremes).first() == (A, "b", 9.5)
    # The table alone answers: the layer may be away.
    plan = plans.first_max_kept(spark, store.extremes)._jdf.queryExecution().executedPlan().toString()
    assert store.clean not in plan
    # The maximum goes with a corrected file, and another comes.
    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,b")
    plans.keep_extremes(spark, store.clean, store.extremes, store.run(spark))
    agrees()
    store.land("weather.20160301.csv", "1,0,2016-02-01,11.5,d", "1,0,2016-03-01,11.5,e")
    plans.keep_extremes(spark, store.clean, store.extremes, store.run(spark))
    agrees()
    assert len(glob.glob(f"{store.extremes}/year=*/**/*.parquet", recursive=True)) == 3
    plans.keep_extremes(spark, store.clean, store.extremes)
    agrees()


def test_latest_rows(spark):
    rows = [("k", 1, "a", A), ("k", 1, "b", B), ("k", 2, "c", None), ("k", 2, "d", A), (None, 1, "e", A), (None, 1, "f", A)]
    df = spark.createDataFrame(rows, "name string, n int, v string, of date")
    found = latest_rows(df, ["name", "n"], ["of"])
    assert found.columns == df.columns
    assert sorted((r["v"] for r in found.collect())) == ["b", "d", "f"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert latest_rows(df.where("false"), ["n"], ["of"]).count() == 0


def test_settled_days(spark, store):
    store.land("weather.20160201.csv", "1,0,2016-02-01,2.5,b", "2,0,2016-02-01,3.5,b", "1,0,2016-02-02,4.5,b")
    plans.settle_days(spark, store.clean, store.settled, ["ForecastSiteCode"], store.run(spark))
    untouched = glob.glob(f"{store.settled}/year=2016/month=2/day=2/*.parquet")
    store.land("weather.20160301.csv", "1,0,2016-02-01,7.5,late", "3,0,2016-02-01,8.5,late")
    plans.settle_days(spark, store.clean, store.settled, ["ForecastSiteCode"], [B] if store.run(spark) else [])
    rows = read_clean(spark, store.settled).select("ObservationDate", "ForecastSiteCode", "ScreenTemperature", "Region")
    assert sorted((r[0].day, *r[1:]) for r in rows.collect()) == [
        (1, 1, 7.5, "late"), (1, 2, 3.5, "b"), (1, 3, 8.5, "late"), (2, 1, 4.5, "b"),
    ]
    assert glob.glob(f"{store.settled}/year=2016/month=2/day=2/*.parquet") == untouched
    assert read_clean(spark, store.clean).count() == 5


def rows_read(df):
    """Rows that the scan hands on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_lookup_passes_over_row_groups(spark, tmp_path):
    n, root = 200_000, str(tmp_path / "t")
    rows = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("site"), (F.col("id") * 2).cast("string")).alias("site"), F.col("id").alias("v"),
        F.rand(3).alias("noise"), F.lit(A).alias("d"),
    )
    small = {"parquet.block.size": 64 << 10, "parquet.page.size": 8 << 10, "parquet.block.size.row.check.min": 100}
    write_clean(rows, root, "d", lookup=["site"], writer_options=small)
    found = where_all(read_clean(spark, root), {"site": "site1000"})
    assert [r["v"] for r in found.collect()] == [500]
    assert 0 < rows_read(found) < n / 20
    # Between two that are there, so that only the Bloom filter can tell.
    assert rows_read(where_all(read_clean(spark, root), {"site": "site1001"})) == 0
    assert read_clean(spark, root).count() == n


def test_file_dates_of_a_layer(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = observations(spark, 3)
    write_clean(rows, root, "d", file_date="of")
    mine = read_days(spark, root, file_dates=[A, None], with_file_date=True)
    assert {r[0] for r in mine.select("from_file_date").distinct().collect()} == {A, None}
    assert mine.count() == rows.where("d is not null and (of is null or of = date'2016-02-01')").count()
    assert all("from_file_date=2016-03-01" not in path for path in mine.inputFiles())
    assert read_days(spark, root, file_dates=[datetime.date(2020, 1, 1)]).count() == 0
    assert read_days(spark, root, "2016-02-02", "2016-02-02", file_dates=[B]).count() == rows.where(
        "d = date'2016-02-02' and of = date'2016-03-01'"
    ).count()
