"""Counts and maxima of day-partitioned layers out of Parquet footers: no row group is read.

Spark hands COUNT and MAX to its Parquet reader where that is the newer kind and aggregates go by all partition
columns. Both are settings of a session, so these questions run in a child session, and their
few rows (one per cell of the layer) come back through the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.functions.text import quoted
from daystrata.sources.days import DAY, DAY_PARTS, FILE_PART, NULL_PART, REJECTED
from daystrata.sources.files import scratch_dir
from daystrata.sources.schemas import known_columns, shown


def cell_aggregates(spark: SparkSession, root: str, value: str | None = None) -> DataFrame:
    """The lazy question behind the functions here, in the child session: rows, and the largest
    ``value``, by all partition columns of the layer. Its plan shows ``PushedAggregation``."""
    layer = _layer(_child(spark), root)
    return layer.groupBy(*_parts(layer)).agg(*_asked(value))


def cells(spark: SparkSession, root: str, value: str | None = None) -> DataFrame:
    """``(year, month, day[, from_file_date], row_count[, max_value])``: one row per cell; runs now.

    A file without rows counts 0. ``max_value`` is null where all values are. Where footers lack what is asked
    (a column of text, only nulls, or NaN, which Spark takes for the largest number) the column is scanned.
    """
    place = scratch_dir(spark, "cells")
    try:
        cell_aggregates(spark, root, value).write.parquet(place)
    except (PySparkException, Py4JJavaError):
        # What is wrong with more than the statistics fails here again.
        layer = _layer(spark, root)
        layer.groupBy(*_parts(layer)).agg(*_asked(value)).write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def day_counts(spark: SparkSession, root: str) -> DataFrame:
    """``(filename, RowCount)`` by day directory, as ``file_row_counts(name="day")`` gives it; runs now."""
    shown = cells(spark, root).where(F.coalesce(F.col(DAY_PARTS[1]), F.lit(-1)) != REJECTED)
    found = shown.groupBy(*DAY_PARTS).agg(F.sum("row_count").alias("RowCount"))
    return found.select(_directory(DAY_PARTS).alias("filename"), "RowCount")


def file_date_counts(spark: SparkSession, root: str) -> DataFrame:
    """``(file_date, row_count)``: rows by the date of the file they came from; runs now.

    That is the last partition level where the layer has it (clean, with the rows it rejects), else the
    day itself (raw).
    """
    found = cells(spark, root)
    of = F.col(FILE_PART).cast("date") if FILE_PART in found.columns else F.expr(DAY)
    return found.groupBy(of.alias("file_date")).agg(F.sum("row_count").alias("row_count"))


def layer_max(spark: SparkSession, root: str, value: str) -> DataFrame:
    """One row, ``max_<value>``, over rows with a day; runs now."""
    return cells(spark, root, value).where(f"month <> {REJECTED}").agg(F.max("max_value").alias(f"max_{value}"))


def layer_max_per_day(spark: SparkSession, root: str, value: str, day: str) -> DataFrame:
    """``max_<value>`` for each day with rows; runs now."""
    found = cells(spark, root, value).where(f"month <> {REJECTED} and row_count > 0")
    return found.groupBy(F.expr(DAY).alias(day)).agg(F.max("max_value").alias(f"max_{value}"))


def _child(spark: SparkSession) -> SparkSession:
    child = getattr(spark, "_daystrata_footers", None)
    if child is None:
        child = spark.newSession()
        child.conf.set("spark.sql.sources.useV1SourceList", "")
        child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        spark._daystrata_footers = child
    return child


def _layer(spark: SparkSession, root: str) -> DataFrame:
    columns = known_columns(spark, root)
    reader = spark.read.option("mergeSchema", columns is None)
    if columns is not None:
        parts = [T.StructField(name, T.IntegerType()) for name in DAY_PARTS]
        reader = reader.schema(T.StructType([*columns.fields, *parts]))
    return shown(reader.parquet(root), columns)


def _parts(layer: DataFrame) -> Sequence[str]:
    return [name for name in (*DAY_PARTS, FILE_PART) if name in layer.columns]


def _asked(value: str | None) -> list[Column]:
    asked = [F.count(F.lit(1)).alias("row_count")]
    return asked if value is None else [*asked, F.max(quoted(value)).alias("max_value")]


def _directory(names: Sequence[str]) -> Column:
    levels = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit(NULL_PART))) for name in names
    ]
    return F.concat_ws("/", *levels)
