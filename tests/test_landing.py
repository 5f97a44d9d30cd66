import datetime
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from daystrata.queries import inputs
from daystrata.sources import list_files, read_any, read_landing_csv, with_file_date
from daystrata.sources import files as files_module
from daystrata.sources import landing as landing_module

FEB, MAR = datetime.date(2016, 2, 1), datetime.date(2016, 3, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "weather.20160201.csv").write_text('a,b\n1,x\n2,"y, z"\n')
    (tmp_path / "sub" / "weather.20160301.csv").write_text("a,b\n3,\n")
    (tmp_path / "weather.20160401.csv").write_text("a,b\n")
    (tmp_path / "undated.csv").write_text("a,b\n4,w\n")
    (tmp_path / "weather.20160501.txt").write_text("a,b\n5,no\n")
    return tmp_path


def test_scan_and_date(spark, tree):
    df = with_file_date(read_landing_csv(spark, str(tree), ["a", "b"]))
    assert df.dtypes == [("a", "string"), ("b", "string"), ("file_date", "date")]
    assert rows(df) == [
        ("1", "x", FEB),
        ("2", "y, z", FEB),
        ("3", None, MAR),
        ("4", "w", None),
    ]


def test_columns_default_to_a_header(spark, tree):
    assert read_landing_csv(spark, str(tree)).columns == ["a", "b"]


@pytest.mark.parametrize("header", ["b,a", "a,c"])
def test_another_header_fails(spark, tree, header):
    (tree / "weather.20160601.csv").write_text(f"{header}\n6,x\n")
    with pytest.raises(Exception, match="CSV header"):
        read_landing_csv(spark, str(tree), ["a", "b"]).collect()


def test_unknown_mode(spark, tree):
    with pytest.raises(ValueError):
        read_landing_csv(spark, str(tree), on_header_mismatch="ignore")


@pytest.fixture
def mixed(tree):
    (tree / "weather.20160601.csv").write_text("\n  \nB,A\nx6,6\n")
    (tree / "weather.20160701.csv").write_text('a,c,"b,d"\n7,c7,bd7\n8\n9,c9,bd9,more\n')
    return tree


MIXED = [
    ("1", "x", None, None, FEB),
    ("2", "y, z", None, None, FEB),
    ("3", None, None, None, MAR),
    ("4", "w", None, None, None),
    ("6", "x6", None, None, datetime.date(2016, 6, 1)),
    ("7", None, "c7", "bd7", datetime.date(2016, 7, 1)),
    ("8", None, None, None, datetime.date(2016, 7, 1)),
    ("9", None, "c9", "bd9", datetime.date(2016, 7, 1)),
]


def test_by_name(spark, mixed):
    df = read_landing_csv(spark, str(mixed), on_header_mismatch="by_name")
    assert {name.lower() for name in df.columns} == {"a", "b", "c", "b,d"}
    ordered = with_file_date(df).select("a", "b", "c", "`b,d`", "file_date")
    assert rows(ordered) == MIXED


def test_by_name_with_wanted_columns(spark, mixed):
    df = read_landing_csv(spark, str(mixed), ["c", "a", "none"], on_header_mismatch="by_name")
    assert df.columns == ["c", "a", "none"]
    assert {tuple(r) for r in df.collect()} == {
        (c, a, None) for a, _, c, _, _ in MIXED
    }


def test_by_name_beyond_the_broadcast_bound(spark, mixed, monkeypatch):
    """With more files than may be broadcast the headers are joined by shuffle."""
    monkeypatch.setattr(landing_module, "fits_broadcast", lambda *_: False)
    df = read_landing_csv(spark, str(mixed), on_header_mismatch="by_name")
    ordered = with_file_date(df).select("a", "b", "c", "`b,d`", "file_date")
    assert rows(ordered) == MIXED


def test_by_name_with_one_header_is_a_plain_scan(spark, tree):
    df = read_landing_csv(spark, str(tree), ["b", "none", "a"], on_header_mismatch="by_name")
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in df.collect()} == {
        ("x", None, "1"), ("y, z", None, "2"), (None, None, "3"), ("w", None, "4"),
    }


def test_by_name_when_files_are_split(spark, tmp_path):
    """A file's header holds for all its splits."""
    (tmp_path / "weather.20160201.csv").write_text(
        "a,b\n" + "".join(f"{i},b{i}\n" for i in range(3000))
    )
    (tmp_path / "weather.20160301.csv").write_text(
        "b,a\n" + "".join(f"b{i},{i}\n" for i in range(3000, 6000))
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        df = read_landing_csv(spark, str(tmp_path), on_header_mismatch="by_name")
        assert df.rdd.getNumPartitions() > 8
        assert df.count() == 6000
        assert df.where("b = concat('b', a)").select("a").distinct().count() == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


@pytest.fixture
def twice(tree):
    again = tree / "sub" / "weather.20160201.csv"
    again.write_text("a,b\n1,again\n")
    os.utime(tree / "weather.20160201.csv", (1_000_000, 1_000_000))
    os.utime(again, (2_000_000, 2_000_000))
    return tree


def test_same_date_keeps_all_rows(spark, twice):
    df = with_file_date(read_landing_csv(spark, str(twice), ["a", "b"]))
    assert df.where(F.col("file_date") == F.lit(FEB)).count() == 3


def latest(spark, root):
    return with_file_date(
        read_landing_csv(spark, str(root), ["a", "b"]),
        on_duplicate_date="latest",
        listing=list_files(spark, str(root), "*.csv"),
    )


def test_same_date_latest_file(spark, twice):
    assert rows(latest(spark, twice)) == [
        ("1", "again", FEB),
        ("3", None, MAR),
        ("4", "w", None),
    ]


def test_same_date_latest_file_beyond_the_broadcast_bound(spark, twice, monkeypatch):
    expected = rows(latest(spark, twice))
    monkeypatch.setattr(landing_module, "fits_broadcast", lambda *_: False)
    assert rows(latest(spark, twice)) == expected


def test_broadcast_bounds(spark, monkeypatch):
    paths = spark.range(20).select(F.repeat(F.lit("p"), 10).alias("path"))
    assert files_module.fits_broadcast(paths, "path")
    assert files_module.fits_broadcast(paths.limit(0), "path")
    monkeypatch.setattr(files_module, "BROADCAST_ROWS", 19)
    assert not files_module.fits_broadcast(paths, "path")
    monkeypatch.setattr(files_module, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(files_module, "BROADCAST_BYTES", 199)
    assert not files_module.fits_broadcast(paths, "path")


def test_latest_without_duplicates_adds_no_join(spark, tree):
    df = latest(spark, tree)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 4


def test_latest_needs_a_listing(spark, tree):
    with pytest.raises(ValueError):
        with_file_date(read_landing_csv(spark, str(tree)), on_duplicate_date="latest")
    with pytest.raises(ValueError):
        with_file_date(
            read_landing_csv(spark, str(tree)),
            on_duplicate_date="latest",
            listing=list_files(spark, str(tree)),
            name="a",
        )


def test_listing_reads_no_content(spark, tree):
    listing = list_files(spark, str(tree), "*.csv")
    assert "ReadSchema: struct<>" in listing._jdf.queryExecution().executedPlan().toString()
    assert listing.count() == 4


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_read_any(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    spark.createDataFrame([("1", "x")], "a string, b string").write.format(fmt).option(
        "header", True
    ).save(path)
    assert rows(read_any(spark, path, fmt, header=True)) == [("1", "x")]


def test_uncommon_headers_are_looked_up_without_a_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,y\n3,4\n")
    (tmp_path / "c.csv").write_text("\n \ny,z\n5,6\n")
    df = read_landing_csv(spark, str(tmp_path), on_header_mismatch="by_name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for operator in ("Exchange hashpartitioning", "Sort", "Cartesian"):
        assert operator not in plan
    rows = sorted((r["x"] or "", r["y"], r["z"] or "") for r in df.collect())
    assert rows == [("", "5", "6"), ("1", "2", ""), ("3", "4", "")]


def test_too_many_headers_are_an_error(spark, tmp_path, monkeypatch):
    from daystrata.sources import headers

    monkeypatch.setattr(headers, "MAX_HEADERS", 1)
    for number in range(2):
        (tmp_path / f"{number}.csv").write_text(f"x{number}\n1\n")
    with pytest.raises(ValueError, match="different headers"):
        read_landing_csv(spark, str(tmp_path), on_header_mismatch="by_name")


def test_landing_files_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Rows go to open files, the session's setting comes back, and more landings than may be open lose no row."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.csv
    monkeypatch.setattr(
        DataFrameWriter, "csv", lambda self, *a, **k: (seen.append(int(spark.conf.get(setting))), write(self, *a, **k))
    )
    numbered = spark.range(1000, numPartitions=3).select(
        F.col("id").cast("string").alias("id"), F.format_string("%08d", F.col("id") % 260).alias("stamp")
    )
    monkeypatch.setattr(inputs, "OPEN_FILES", 7)
    root = inputs.land_csv(numbered, str(tmp_path / "landing"), "stamp")
    assert seen == [7] and spark.conf.get(setting) == "0"
    name = F.regexp_extract("_metadata.file_path", inputs.LANDING_DATE, 1)
    found = read_landing_csv(spark, root, ["id"]).select("id", name.alias("stamp")).collect()
    assert sorted(map(tuple, found)) == sorted((str(i), f"{i % 260:08d}") for i in range(1000))
    with pytest.raises(Exception):
        failing = F.raise_error(F.lit("no")).cast("string").alias("stamp")
        inputs.land_csv(numbered.select("id", failing), f"{root}2", "stamp")
    assert spark.conf.get(setting) == "0"
