"""Landing to raw to clean to answer: one Spark job per written layer, rows never on the driver."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daystrata.config import WEATHER, ObservationConfig
from daystrata.functions.text import FILE_DATE_FORMAT, FILE_DATE_PATTERN, name_date, quoted
from daystrata.operators import (
    clean,
    failed_casts,
    file_row_counts,
    hottest_record,
    reconcile_content,
    row_count_report,
)
from daystrata.operators.cleaning import targets
from daystrata.operators.quality import reconciled_counts
from daystrata.sinks import write_clean, write_raw
from daystrata.sources import (
    list_files,
    read_archives,
    read_clean,
    read_landing_csv,
    read_raw,
    with_file_date,
)
from daystrata.sources.days import DAY_PARTS, FILE_PART, NULL_PART, from_files, read_rejects
from daystrata.sources.footers import day_counts, file_date_counts
from daystrata.sources.marks import mark_dates, marked_dates

# A raw row as text, on its way to the rejects.
_AS_IT_WAS = "_as_it_was"


@dataclass(frozen=True)
class LayerRun:
    """What a run wrote, its answer, and its checks of the file dates that it cleaned.

    ``failures`` counts values that did not survive their cast, per column; it was taken while the clean
    layer was written. The others are worked out when asked for: ``report`` stacks rows per landing file
    (per raw day when archives were read) and per raw day, and ``reconciled`` compares rows by file date
    between raw and what cleaning saw, both from Parquet footers; ``rejects`` are the rows
    without a day, as they were in raw; ``contents`` compares landing files and raw row by row, reading both.
    ``file_dates`` are those that landed, ``None`` standing for files without a date in their name.
    """

    raw: Observation
    clean: Observation
    answer: DataFrame
    failures: DataFrame
    file_dates: tuple[date | None, ...]
    cleaned_dates: tuple[date | None, ...] | None
    raw_root: str
    clean_root: str
    landed: DataFrame
    landing: str | None = None
    unit: str = "file"

    @cached_property
    def report(self) -> DataFrame:
        days = day_counts(self.answer.sparkSession, self.raw_root)
        source = days
        if self.landing is not None:
            source = file_row_counts(self.answer.sparkSession, self.landing, ".csv", "csv", True, name=self.unit)
        return row_count_report("SourceFile", "TargetFile", source, days)

    @cached_property
    def reconciled(self) -> DataFrame:
        spark = self.answer.sparkSession
        sides = [file_date_counts(spark, root) for root in (self.raw_root, self.clean_root)]
        if self.cleaned_dates is not None:
            sides = [side.where(from_files(F.col("file_date"), self.cleaned_dates)) for side in sides]
        return reconciled_counts(*sides)

    @cached_property
    def rejects(self) -> DataFrame:
        found = read_rejects(self.answer.sparkSession, self.clean_root)
        return found if self.cleaned_dates is None else found.where(from_files(F.col(FILE_PART), self.cleaned_dates))

    @cached_property
    def contents(self) -> DataFrame:
        days = self.file_dates if self.landing is not None else None
        return reconcile_content(self.landed, read_raw(self.answer.sparkSession, self.raw_root, days=days))


def landed_dates(
    spark: SparkSession,
    landing: str,
    pattern: str = FILE_DATE_PATTERN,
    fmt: str = FILE_DATE_FORMAT,
    name: str = "_metadata.file_name",
) -> tuple[date | None, ...]:
    """The dates in the names of landing files; one value per day, from the listing alone. ``None``
    comes last where some files have no date."""
    column = {"_metadata.file_name": "file_name", "_metadata.file_path": "file_path"}[name]
    dates = list_files(spark, landing, "*.csv").select(name_date(F.col(column), pattern, fmt).alias("d"))
    found = dates.distinct().orderBy(F.col("d").asc_nulls_last()).collect()
    return tuple(row["d"] for row in found)


def uncleaned_dates(spark: SparkSession, raw_root: str, clean_root: str) -> tuple[date | None, ...]:
    """File dates that landed in raw since they were cleaned last, or that never were, as after a run
    that stopped between the layers. Told from the marks of both layers; where raw has none, or an archive
    brought it dates unnamed, from the files' times."""
    landed = marked_dates(spark, raw_root)
    if landed is None:
        return _uncleaned_files(spark, raw_root, clean_root)
    known = marked_dates(spark, clean_root)
    marks = [("landed", row) for row in landed.collect()]
    marks += [("cleaned", row) for row in known.collect()] if known is not None else []
    last = {(layer, row["every"], row["file_date"]): row["at"] for layer, row in marks}
    whole = last.get(("cleaned", True, None), 0)
    if last.get(("landed", True, None), 0) > whole:
        return _uncleaned_files(spark, raw_root, clean_root)
    return tuple(
        day for (layer, every, day), at in last.items()
        if layer == "landed" and not every and at > max(whole, last.get(("cleaned", False, day), 0))
    )


def _uncleaned_files(spark: SparkSession, raw_root: str, clean_root: str) -> tuple[date | None, ...]:
    """File dates of raw whose files are newer than what the clean layer has from them, or that it has
    nothing from; lists both layers."""

    def newest(root: str, level: str, dated, name: str) -> DataFrame:
        files = list_files(spark, root, "*.parquet")
        part = F.contains("file_path", F.lit(f"/{level}={NULL_PART}/"))
        files = files.select(F.when(part, F.lit(None)).otherwise(dated).alias("d"), "modified", part.alias("undated"))
        return files.where("undated or d is not null").groupBy("d").agg(F.max("modified").alias(name))

    numbers = [F.regexp_extract("file_path", rf"/{name}=([0-9]+)/", 1) for name in DAY_PARTS]
    raw = newest(raw_root, DAY_PARTS[0], F.concat_ws("-", *numbers).try_cast("date"), "landed")
    try:
        of = F.regexp_extract("file_path", rf"/{FILE_PART}=([0-9-]+)/", 1).try_cast("date")
        known = newest(clean_root, FILE_PART, of, "cleaned").withColumnRenamed("d", "k")
        raw = raw.join(known, F.col("d").eqNullSafe(F.col("k")), "left")
        raw = raw.where("cleaned is null or landed > cleaned")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return tuple(row["d"] for row in raw.select("d").collect())


def _in_order(dates: set[date | None]) -> tuple[date | None, ...]:
    return tuple(sorted(dates, key=lambda day: (day is None, day or date.min)))


def land_to_raw(
    spark: SparkSession,
    raw_root: str,
    landing: str | Sequence[str] | None = None,
    archives: str | None = None,
    columns: Sequence[str] | None = None,
    on_header_mismatch: str = "fail",
    gather_days: bool = False,
    file_dates: Sequence[date | None] | None = None,
    **file_date,
) -> Observation:
    """Loose CSV files below ``landing``, or members of ``archives``, into the raw layer.

    Loose files are not shuffled; ``gather_days`` does so where a date comes in very many small
    files, to write fewer. ``on_duplicate_date="latest"`` keeps the last modified file of a date and
    makes the listing for it. ``file_dates`` names the dates that this landing stands for: those
    without rows now are emptied in raw. The dates are marked in raw beforehand, so that a run that
    stops here leaves them to be cleaned.
    """
    if (landing is None) == (archives is None):
        raise ValueError("give either landing or archives")
    if archives is not None and columns is None:
        raise ValueError("archives need columns")
    naming = {k: v for k, v in file_date.items() if k in ("pattern", "fmt", "name")}
    if file_dates is None and landing is not None and naming.get("name", "_metadata.").startswith("_metadata."):
        mark_dates(spark, raw_root, landed_dates(spark, landing, **naming))
    else:
        mark_dates(spark, raw_root, file_dates)
    rows = landed_rows(spark, landing, archives, columns, on_header_mismatch, **file_date)
    # A task unzips members of many dates, and may be handed any part of a large one.
    gather_days = gather_days or archives is not None
    return write_raw(rows, raw_root, gather_days=gather_days, file_dates=file_dates)


def landed_rows(
    spark: SparkSession,
    landing: str | Sequence[str] | None = None,
    archives: str | None = None,
    columns: Sequence[str] | None = None,
    on_header_mismatch: str = "fail",
    **file_date,
) -> DataFrame:
    """The rows of loose files or archives, with the date in their file's name."""
    if landing is None:
        rows = read_archives(spark, archives, columns, on_header_mismatch=on_header_mismatch)
        return with_file_date(rows, name="member", **file_date).drop("archive", "member")
    rows = read_landing_csv(spark, landing, columns, on_header_mismatch=on_header_mismatch)
    if file_date.get("on_duplicate_date") == "latest":
        file_date.setdefault("listing", list_files(spark, landing, "*.csv"))
    return with_file_date(rows, **file_date)


def raw_to_clean(
    spark: SparkSession,
    raw_root: str,
    clean_root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    config: ObservationConfig = WEATHER,
    file_dates: Sequence[date | None] | None = None,
    **fill,
) -> Observation:
    """Cleans raw rows into the clean layer, all of them or those of some file dates.

    The layer keeps apart, within an observation day, what came from which file date. So a bounded run
    replaces exactly what those file dates gave before: rows of other files in the same days stay,
    and days that a corrected file no longer holds lose its rows. Without bounds the layer
    becomes what raw holds, whatever it held before. ``None`` among ``file_dates`` stands for the
    rows of files without a date.
    """
    return _cleaned(spark, raw_root, clean_root, start, end, config, file_dates, fill)[0]


def _cleaned(
    spark: SparkSession, raw_root: str, clean_root: str, start, end, config: ObservationConfig,
    file_dates: Sequence[date | None] | None, fill: Mapping[str, object],
) -> tuple[Observation, DataFrame]:
    """Counts of the write, and casts that failed by column, taken in the one pass over raw."""
    bounded = start is not None or end is not None or file_dates is not None
    raw = read_raw(spark, raw_root, start, end, days=file_dates)
    dates = tuple(file_dates) if file_dates is not None else None
    if start is not None or end is not None:
        known = file_date_counts(spark, raw_root).where("file_date is not null")
        known = known.where(F.col("file_date") >= F.lit(start).cast("date")) if start is not None else known
        known = known.where(F.col("file_date") <= F.lit(end).cast("date")) if end is not None else known
        dates = _in_order({row["file_date"] for row in known.collect()} | set(file_dates or ()))
    begun = time.time_ns()
    failed, text = "_failed_casts", F.to_json(F.struct(*map(quoted, raw.columns)), {"ignoreNullFields": "false"})
    names = list(targets(raw, config.types))
    both = clean(raw, config, **fill, beside={failed: failed_casts(raw, config.types), _AS_IT_WAS: text})
    told = Observation()
    checks = [F.count_if(F.array_contains(failed, name)).alias(name) for name in names]
    counts = write_clean(
        both, clean_root, config.day, file_date="file_date", file_dates=dates, whole=not bounded,
        told=told if names else None, checks=checks, rejects=F.col(_AS_IT_WAS), hidden=[failed, _AS_IT_WAS],
    )
    mark_dates(spark, clean_root, dates, begun)
    failures = spark.createDataFrame([(name, told.get[name]) for name in names], "column string, failures bigint")
    return counts, failures


def run(
    spark: SparkSession,
    raw_root: str,
    clean_root: str,
    landing: str | None = None,
    archives: str | None = None,
    columns: Sequence[str] | None = None,
    on_header_mismatch: str = "fail",
    gather_days: bool = False,
    config: ObservationConfig = WEATHER,
    raise_if_empty: bool = False,
    answer: str = "layer",
    fill: Mapping[str, object] | None = None,
    **file_date,
) -> LayerRun:
    """All layers for what has landed, with the checks of each step, and the hottest record.

    Only the file dates that landed are cleaned, files without a date among them, and those that an
    earlier run left in raw without cleaning them. ``answer`` is over the whole clean layer, or, with
    ``"run"``, over the rows of the file dates that landed. ``fill`` goes to ``fill_by_type``.
    ``raise_if_empty`` makes an empty landing an error.
    """
    if answer not in ("layer", "run"):
        raise ValueError(f"answer={answer!r}")
    naming = {k: v for k, v in file_date.items() if k in ("pattern", "fmt", "name")}
    dates = landed_dates(spark, landing, **naming) if landing is not None else None
    raw = land_to_raw(
        spark, raw_root, landing, archives, columns, on_header_mismatch, gather_days, dates,
        **file_date,
    )
    if raise_if_empty and not raw.get["seen_rows"]:
        raise ValueError("no rows")
    wanted = dates
    if dates is not None:
        wanted = _in_order({*dates, *uncleaned_dates(spark, raw_root, clean_root)})
    cleaned, failures = _cleaned(spark, raw_root, clean_root, None, None, config, wanted, dict(fill or {}))
    layer = read_clean(spark, clean_root, file_dates=dates if answer == "run" else None)
    unit = "file" if naming.get("name", "_metadata.file_name").endswith("name") else r"([^/]+)/[^/]*$"
    rows = landed_rows(spark, landing, archives, columns, on_header_mismatch, **file_date)
    return LayerRun(
        raw, cleaned, hottest_record(layer, config), failures, tuple(dates or ()), wanted, raw_root, clean_root,
        rows, landing, unit,
    )
