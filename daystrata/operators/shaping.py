"""Projections and stacking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.functions.text import quoted

_KINDS = {
    "numeric": T.NumericType,
    "string": T.StringType,
    "int": T.IntegerType,
    "bigint": T.LongType,
    "double": T.DoubleType,
    "date": T.DateType,
}


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the columns whose type is of a kind: numeric, string, int, bigint, double, date."""
    return [f.name for f in df.schema if isinstance(f.dataType, _KINDS[kind])]


def reorder_last_first(df: DataFrame) -> DataFrame:
    """Last column to the front, the rest in order."""
    *rest, last = df.columns
    return df.select(quoted(last), *map(quoted, rest))


def label(df: DataFrame, name: str, out: str = "Type") -> DataFrame:
    """Adds a constant text column."""
    return df.withColumn(out, F.lit(name))


def project(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns."""
    return df.select(*map(quoted, names))


def drop_and_rename(df: DataFrame, drop: str, rename: str) -> DataFrame:
    """Lets column ``rename`` take the place and name of ``drop``."""
    return df.drop(quoted(drop)).withColumnRenamed(rename, drop)


def stack_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
