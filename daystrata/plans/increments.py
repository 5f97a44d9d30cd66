"""Landing by increments: each file is taken once, and only the dates that it touches are written again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.config import WEATHER, ObservationConfig
from daystrata.functions.text import FILE_DATE_FORMAT, FILE_DATE_PATTERN, name_date
from daystrata.plans.layers import land_to_raw, raw_to_clean
from daystrata.sources.days import from_files, read_raw
from daystrata.sources.files import decoded, list_files

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Increment:
    """One batch of files: their paths, the dates written again, and the counts of both layers' writes."""

    files: tuple[str, ...]
    file_dates: tuple[date | None, ...]
    raw: Mapping[str, int]
    clean: Mapping[str, int]


def land_increments(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    clean_root: str,
    record: str,
    columns: Sequence[str] | None = None,
    on_header_mismatch: str = "fail",
    gather_days: bool = False,
    config: ObservationConfig = WEATHER,
    files_per_batch: int = 1000,
    fill: Mapping[str, object] | None = None,
    **file_date,
) -> list[Increment]:
    """Takes the CSV files below ``landing`` that no earlier call with this ``record`` took, into raw and clean.

    A file stream with ``availableNow`` hands out what is new, ``files_per_batch`` at a time, and notes
    in its checkpoint at ``record`` what was taken; a landing without new files is listed and nothing is read.
    The stream carries names only. A batch is written as ``plans.run`` would write it: the dates of its files
    become what all landed files of these dates hold, so earlier files of a date are read again with it, and
    no others. Both layers are done before the batch counts as taken, and both replace cells as
    wholes, so a batch that failed halfway is simply taken again.

    A file that changes under its name is not new; land corrections under another name, with
    ``on_duplicate_date="latest"`` where they replace the earlier file. The driver holds the names of one batch
    and of the other files of its dates.
    """
    done: list[Increment] = []
    name = file_date.get("name", "_metadata.file_name")
    if name not in ("_metadata.file_name", "_metadata.file_path"):
        raise ValueError(f"name={name!r} is no part of a landing file's path")
    pattern, fmt = file_date.get("pattern", FILE_DATE_PATTERN), file_date.get("fmt", FILE_DATE_FORMAT)

    def dated(path):
        return name_date(F.regexp_extract(path, "([^/]*)$", 1) if name.endswith("name") else path, pattern, fmt)

    def take(batch: DataFrame, number: int) -> None:
        rows = batch.select("path", dated(F.col("path")).alias("date")).collect()
        if not rows:
            return
        dates = tuple(sorted({r["date"] for r in rows}, key=lambda day: (day is None, day or date.min)))
        paths = {_plain(r["path"]) for r in rows}
        if _held(spark, raw_root, dates):
            known = list_files(spark, landing, "*.csv").select(decoded("file_path").alias("path"))
            known = known.where(from_files(dated(F.col("path")), dates))
            paths |= {_plain(r["path"]) for r in known.collect()}
        files = [_literal(path) for path in sorted(paths)]
        raw = land_to_raw(
            spark, raw_root, files, None, columns, on_header_mismatch, gather_days, dates, **file_date
        )
        cleaned = raw_to_clean(spark, raw_root, clean_root, config=config, file_dates=dates, **(fill or {}))
        done.append(Increment(tuple(sorted(r["path"] for r in rows)), dates, raw.get, cleaned.get))

    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )
    query = (
        names.writeStream.foreachBatch(take)
        .option("checkpointLocation", record)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def _held(spark: SparkSession, raw_root: str, dates: Sequence[date | None]) -> bool:
    """Whether raw has rows of any of the dates, so that other files of them were taken before."""
    try:
        return not read_raw(spark, raw_root, days=dates).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _plain(path: str) -> str:
    """A path in one spelling; local ones come with one slash or three."""
    return "file:/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _literal(path: str) -> str:
    """A path whose characters stand for themselves where a pattern is expected."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)
