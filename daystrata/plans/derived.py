"""Small layers that follow the clean layer, file date by file date and day by day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daystrata.config import WEATHER, ObservationConfig
from daystrata.functions.text import quoted
from daystrata.operators import (
    cell_extremes,
    first_of_extremes,
    latest_rows,
    merge_extremes,
    where_max,
)
from daystrata.sinks.days import write_by_day
from daystrata.sources.days import FILE_PART, read_clean, read_days

_FROM = "file_date"


def keep_extremes(
    spark: SparkSession,
    clean_root: str,
    extremes_root: str,
    file_dates: Sequence[date | None] | None = None,
    config: ObservationConfig = WEATHER,
) -> Observation:
    """Brings the table of extremes up to date with the clean layer, for some file dates or all of them.

    Per file date the table has a row for each day: the largest value and the least region that holds it. Only
    the clean layer's cells of ``file_dates`` are read, and only their rows of the table are replaced.
    """
    rows = read_clean(spark, clean_root, file_dates=file_dates, with_file_date=True)
    rows = rows.withColumn(_FROM, F.col(FILE_PART).cast("date")).drop(FILE_PART)
    found = cell_extremes(rows, config.value, config.day, _FROM, [config.region])
    return write_by_day(
        found, extremes_root, _FROM, drop_null_day=False, file_dates=file_dates, whole=file_dates is None
    )


def max_per_day_kept(spark: SparkSession, extremes_root: str, config: ObservationConfig = WEATHER) -> DataFrame:
    """``max_per_day`` of the layer, out of its table of extremes alone."""
    found = merge_extremes(read_days(spark, extremes_root), config.value, config.day, [config.region])
    return found.select(quoted(config.day), quoted(config.value).alias(f"max_{config.value}"))


def first_max_kept(spark: SparkSession, extremes_root: str, config: ObservationConfig = WEATHER) -> DataFrame:
    """Day, region and value of the layer's first record with the largest value, out of the table alone."""
    found = first_of_extremes(read_days(spark, extremes_root), config.value, config.day, [config.region])
    return found.select(quoted(config.day), quoted(config.region), quoted(config.value))


def hottest_kept(
    spark: SparkSession, extremes_root: str, clean_root: str, config: ObservationConfig = WEATHER
) -> DataFrame:
    """``hottest_record`` of the layer, ties included: the table names the days and file dates that hold the
    maximum, and only their cells of the clean layer are read."""
    top = where_max(read_days(spark, extremes_root), config.value)
    cells = top.select(quoted(config.day).alias("day"), quoted(_FROM).alias("of"), quoted(config.value).alias("top"))
    days, dates = (cells.agg(F.collect_set(F.struct(name))).first()[0] for name in ("day", "of"))
    if not days:
        rows = read_clean(spark, clean_root).where(F.lit(False))
    else:
        bounds = sorted(row["day"] for row in days)
        rows = read_clean(spark, clean_root, bounds[0], bounds[-1], file_dates=[row["of"] for row in dates])
        rows = rows.where(quoted(config.day).isin(bounds))
    return where_max(rows, config.value).select(quoted(config.day), quoted(config.region), quoted(config.value))


def settle_days(
    spark: SparkSession,
    clean_root: str,
    settled_root: str,
    keys: Sequence[str],
    file_dates: Sequence[date | None] | None = None,
    config: ObservationConfig = WEATHER,
) -> Observation:
    """Writes the days that files of these dates have rows in, with the last row of each key: of several
    files' rows for one key of a day, the row of the latest file date counts, null first.

    So a later file corrects single rows of an earlier one, whatever its own date. Days without rows from these
    files are neither read nor written; a day is settled from all of its files.
    """
    touched = None
    if file_dates is not None:
        mine = read_clean(spark, clean_root, file_dates=file_dates).select(quoted(config.day).alias("day"))
        # One value per day of the batch.
        touched = sorted(row["day"] for row in mine.distinct().collect())
    rows = read_days(spark, clean_root, days=touched, with_file_date=True)
    last = latest_rows(rows, [config.day, *keys], [FILE_PART]).drop(FILE_PART)
    return write_by_day(last, settled_root, config.day, drop_null_day=True, whole=file_dates is None)
