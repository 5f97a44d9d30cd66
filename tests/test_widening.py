"""Columns that come in several types."""

import datetime

import pytest
from pyspark.sql import types as T

from daystrata.sinks import write_clean, write_raw
from daystrata.sources import layer_max, read_clean
from daystrata.sources.schemas import widest

DAYS = [datetime.date(2016, 2, day) for day in range(1, 6)]


def test_lattice():
    order = [T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]
    for i, one in enumerate(order):
        for j, two in enumerate(order):
            assert widest(one, two) == order[max(i, j)]
    assert widest(T.DateType(), T.IntegerType()) == T.StringType()
    assert widest(T.DateType(), T.DateType()) == T.DateType()


def frame(spark, kind, value, day):
    return spark.createDataFrame([(value, "x", day), (None, "y", day)], f"`v w` {kind}, t string, d date")


def test_types_widen_step_by_step(spark, tmp_path):
    root = str(tmp_path / "t")
    steps = [("int", 7, "int"), ("bigint", 1 << 40, "bigint"), ("int", 8, "bigint"), ("double", 0.5, "double")]
    seen = []
    for (kind, value, wide), day in zip(steps, DAYS):
        write_clean(frame(spark, kind, value, day), root, "d", widen=True)
        seen.append(value)
        found = read_clean(spark, root)
        assert dict(found.dtypes)["v w"] == wide and found.columns == ["v w", "t", "d"]
        assert sorted(r[0] for r in found.collect() if r[0] is not None) == sorted(seen)
        assert found.count() == 2 * len(seen)
    assert layer_max(spark, root, "v w").first()[0] == float(1 << 40)
    write_clean(frame(spark, "string", "n/a", DAYS[4]), root, "d", widen=True)
    texts = {r[0] for r in read_clean(spark, root).collect()}
    assert texts == {"7", "8", str(1 << 40), "0.5", "n/a", None}
    # A bound that lists other months sees the same columns.
    assert read_clean(spark, root, "2020-01-01", "2020-02-01").schema == read_clean(spark, root).schema
    # Writing a day again replaces it whatever its type was.
    write_clean(frame(spark, "int", 9, DAYS[4]), root, "d", widen=True)
    assert "n/a" not in {r[0] for r in read_clean(spark, root).collect()}


def test_without_widening_another_type_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    write_raw(frame(spark, "int", 1, DAYS[0]), root, "d")
    with pytest.raises(ValueError, match="v w is int"):
        write_raw(frame(spark, "bigint", 1, DAYS[1]), root, "d")
