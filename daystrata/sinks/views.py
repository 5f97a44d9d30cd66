"""Temporary views for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    """Whether there was such a view."""
    return spark.catalog.dropTempView(name)
