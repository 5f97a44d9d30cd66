import io
import zipfile

import pytest
from pyspark.sql import functions as F

from daystrata.sources import archives as archives_module
from daystrata.sources import read_archives, read_landing_csv, unpack_archives, with_file_date

ODD = (
    'a,b\n1,x\n2,"y, z"\n3,"say \\"hi\\""\n4,\n5,""\n6\n7,x,more\n\n   \n8,é\n'
    '9," padded "\n10,"never closed\n11,last without newline'
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def pack(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


@pytest.fixture
def zips(tmp_path):
    pack(
        tmp_path / "one.zip",
        {
            "weather.20160201.csv": 'a,b\n1,x\n2,"y, z"\n',
            "weather/sub.20160301.csv": "a,b\n3,\n",
            "readme.csv": "not,these\n1,2\n",
            "old/weather.20160401.csv": "a,b\n4,no\n",
            "weather.txt": "a,b\n5,no\n",
            "weather.20160501.csv": "a,b\n",
            "weather.20160601.csv": "",
        },
    )
    pack(tmp_path / "two.zip", {"weather.20160701.csv": "A,B\r\n7,w\r\n"})
    return str(tmp_path / "*.zip")


def test_members(spark, zips):
    df = with_file_date(read_archives(spark, zips, ["a", "b"]), name="member")
    assert df.columns == ["a", "b", "archive", "member", "file_date"]
    got = df.select("a", "b", "member", F.col("file_date").cast("string"))
    assert rows(got) == [
        ("1", "x", "weather.20160201.csv", "2016-02-01"),
        ("2", "y, z", "weather.20160201.csv", "2016-02-01"),
        ("3", None, "weather/sub.20160301.csv", "2016-03-01"),
        ("7", "w", "weather.20160701.csv", "2016-07-01"),
    ]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("start", ["", "﻿"])
@pytest.mark.parametrize("block", [5, 1 << 20])
def test_same_rows_as_the_loose_file(spark, tmp_path, monkeypatch, ends, start, block):
    monkeypatch.setattr(archives_module, "BLOCK_CHARS", block)
    data = (start + ODD.replace("\n", ends)).encode()
    (tmp_path / "weather.20160201.csv").write_bytes(data)
    pack(tmp_path / "one.zip", {"weather.20160201.csv": data})
    loose = rows(read_landing_csv(spark, str(tmp_path), ["a", "b"]))
    packed = read_archives(spark, str(tmp_path / "one.zip"), ["a", "b"]).select("a", "b")
    assert len(loose) == 11 and rows(packed) == loose


def test_another_header_fails(spark, zips, tmp_path):
    pack(tmp_path / "three.zip", {"weather.20160801.csv": "b,a\nx,8\n"})
    with pytest.raises(Exception, match="header of weather.20160801.csv"):
        read_archives(spark, zips, ["a", "b"]).collect()


def test_by_name(spark, zips, tmp_path):
    pack(tmp_path / "three.zip", {"weather.20160801.csv": 'c,"b",a\nc8,x8,8\nc9\n'})
    df = read_archives(spark, zips, ["a", "b", "c"], on_header_mismatch="by_name")
    assert rows(df.select("a", "b", "c")) == sorted(
        [
            ("1", "x", None),
            ("2", "y, z", None),
            ("3", None, None),
            ("7", "w", None),
            ("8", "x8", "c8"),
            (None, None, "c9"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("mode", ["fail", "by_name"])
def test_spreading_changes_no_row(spark, tmp_path, monkeypatch, mode):
    monkeypatch.setattr(archives_module, "BLOCK_CHARS", 1000)
    text = "a,b\n" + "".join(f"{i},b{i}\n" for i in range(20000))
    pack(tmp_path / "one.zip", {"weather.20160201.csv": text})
    archives = spark.read.format("binaryFile").load(str(tmp_path / "one.zip"))
    df = unpack_archives(archives, ["a", "b"], on_header_mismatch=mode, spread=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) == 8 and sum(r["count"] for r in per_task) == 20000
    assert df.where("b = concat('b', a)").select("a").distinct().count() == 20000


def test_members_are_dealt_before_they_are_read(spark, tmp_path):
    pack(tmp_path / "a.zip", {f"weather.201602{d:02}.csv": f"a\n{d}\n" for d in range(1, 9)})
    df = read_archives(spark, str(tmp_path / "a.zip"), ["a"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Names move, text does not: the one exchange is below the unzipping.
    assert plan.count("Exchange") == 1 and plan.index("MapInArrow") < plan.index("Exchange")
    assert sorted(r["a"] for r in df.collect()) == [str(d) for d in range(1, 9)]


def test_only_a_hot_archive_is_spread(spark, tmp_path, monkeypatch):
    """In a store that only Spark's readers open."""

    def closed(prefix):
        def listed(batches):
            import pyarrow as pa

            for batch in batches:
                none = pa.nulls(batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), none, none], names=["archive", "member", "header"]
                )

        return listed

    monkeypatch.setattr(archives_module, "_list_members", closed)

    def shuffles(glob):
        df = read_archives(spark, str(tmp_path / glob), ["a"])
        return "Exchange" in df._jdf.queryExecution().executedPlan().toString()

    for number in range(20):
        text = "a\n" + "".join(f"{i * i}\n" for i in range(3 if number else 50_000))
        pack(tmp_path / f"{number:02}.zip", {"weather.20160201.csv": text})
    assert not shuffles("*.zip")
    monkeypatch.setattr(archives_module, "HOT_ARCHIVE_BYTES", 100)
    assert shuffles("00.zip") and shuffles("0*.zip")
    assert not shuffles("1*.zip")


def test_broken_archive_fails(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="not a zip file"):
        read_archives(spark, str(tmp_path / "bad.zip"), ["a"]).collect()


def test_truncated_member_fails(spark, tmp_path):
    packed = io.BytesIO()
    pack(packed, {"weather.20160201.csv": "a\n" + "1\n" * 1000})
    data = bytearray(packed.getvalue())
    data[60] ^= 0xFF
    (tmp_path / "bad.zip").write_bytes(bytes(data))
    with pytest.raises(Exception):
        read_archives(spark, str(tmp_path / "bad.zip"), ["a"]).collect()
