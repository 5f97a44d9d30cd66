"""Questions about the largest value.

The maximum is an uncorrelated scalar subquery: one pass over one column, with partial maxima per
task and a single row per task across the exchange. The outer scan compares with its result, which
Spark pushes into the Parquet reader, so row groups whose statistics exclude the maximum are not
read. No sort, join or window is involved, and skewed days or regions make no difference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.config import WEATHER, ObservationConfig
from daystrata.functions.text import quoted


def global_max(df: DataFrame, value: str) -> DataFrame:
    """One row, ``max_<value>``."""
    return df.agg(F.max(quoted(value)).alias(f"max_{value}"))


def max_per_day(df: DataFrame, value: str, day: str) -> DataFrame:
    """``max_<value>`` for each day."""
    return df.groupBy(quoted(day)).agg(F.max(quoted(value)).alias(f"max_{value}"))


def where_max(df: DataFrame, value: str) -> DataFrame:
    """All rows that hold the column's maximum, ties included."""
    return df.where(quoted(value) == global_max(df, value).scalar())


def where_all(df: DataFrame, equal: Mapping[str, object]) -> DataFrame:
    """Rows for which every named column equals its value."""
    return df.where(_all([quoted(name) == value for name, value in equal.items()]))


def first_max_record(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Rows with the maximum that share the smallest ``order`` columns among the ties.

    Rows with a null in ``value`` or ``order`` do not take part.
    """
    known = df.where(_all([quoted(name).isNotNull() for name in (value, *order)]))
    # The least of (negated value, order) in one pass; Spark holds NaN the largest, so it goes first.
    number = quoted(value)
    top = F.struct((~F.isnan(number.cast("double"))).alias("n"), (-number).alias("v"), *map(quoted, order))
    first = known.agg(F.min(top).alias("first"))
    return known.where(top == first.scalar())


def hottest_record(df: DataFrame, config: ObservationConfig = WEATHER) -> DataFrame:
    """Day, region and value of every record that holds the maximum."""
    return where_max(df, config.value).select(
        quoted(config.day), quoted(config.region), quoted(config.value)
    )


def cell_extremes(df: DataFrame, value: str, day: str, file_date: str, order: Sequence[str]) -> DataFrame:
    """``(file_date, day, value, *order)``: the largest value of each day and file date, and the least
    ``order`` columns among the rows that hold it. Rows with a null in any of them but the file date do not
    take part.

    One row per cell out of partial aggregates, and the tables of two batches merge by ``merge_extremes``,
    so a layer's answers follow from its cells' without its rows.
    """
    known = df.where(_all([quoted(name).isNotNull() for name in (value, day, *order)]))
    return _least_top(known, value, day, file_date, order)


def merge_extremes(tables: DataFrame, value: str, day: str, order: Sequence[str]) -> DataFrame:
    """``(day, value, *order)``: rows of ``cell_extremes`` of any cells, as one per day."""
    return _least_top(tables, value, day, None, order)


def first_of_extremes(tables: DataFrame, value: str, day: str, order: Sequence[str]) -> DataFrame:
    """The one record with the largest value, then the least day, then the least ``order`` columns."""
    found = tables.agg(F.min(_top(value, (day, *order))).alias("first")).where("first is not null")
    return found.select(
        F.col(f"first.{_quote(day)}").alias(day),
        F.col("first.value").alias(value),
        *[F.col(f"first.{_quote(name)}").alias(name) for name in order],
    )


def _least_top(df: DataFrame, value: str, day: str, file_date: str | None, order: Sequence[str]) -> DataFrame:
    keys = [name for name in (file_date, day) if name is not None]
    found = df.groupBy(*map(quoted, keys)).agg(F.min(_top(value, order)).alias("first"))
    return found.select(
        *map(quoted, keys), F.col("first.value").alias(value),
        *[F.col(f"first.{_quote(name)}").alias(name) for name in order],
    )


def _top(value: str, order: Sequence[str]) -> Column:
    """Least for the largest value, NaN before all, and among its rows for the least ``order`` columns."""
    number = quoted(value)
    return F.struct(
        (~F.isnan(number.cast("double"))).alias("n"), (-number).alias("v"),
        *[quoted(name).alias(name) for name in order], number.alias("value"),
    )


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def latest_rows(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the one that is last in the order of ``by``, null first, then of all columns.

    The last row of a key is a partial maximum, so each task sends one row per key. Null keys are keys.
    """
    order = [F.struct(quoted(name).isNotNull(), quoted(name)) for name in by]
    rest = [F.struct(quoted(name).isNotNull(), quoted(name)) for name in df.columns]
    row = F.struct(*map(quoted, df.columns))
    last = F.max_by(row, F.struct(*order, *rest)).alias("last")
    found = df.groupBy(*[quoted(name).alias(f"key{i}") for i, name in enumerate(keys)]).agg(last)
    return found.select("last.*")


def head_n(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; name an ``order`` for a repeatable answer."""
    return (df.orderBy(*map(quoted, order)) if order else df).limit(n)


def _all(tests: Sequence[Column]) -> Column:
    return reduce(and_, tests, F.lit(True))
