"""Writing layers partitioned by day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daystrata.functions.text import quoted
from daystrata.sources.days import (
    DAY_PARTS,
    FILE_PART,
    NULL_PART,
    REJECTED,
    REJECTED_ROW,
    cells_of_files,
    from_files,
)
from daystrata.sources.files import checkpointed, list_files
from daystrata.sources.schemas import keep_columns

# For more file dates the whole layer is listed.
_LISTED_CELLS = 400


def write_by_day(
    df: DataFrame,
    root: str,
    date_col: str,
    drop_null_day: bool,
    gather_days: bool = True,
    file_date: str | None = None,
    file_dates: Sequence[date | None] | None = None,
    whole: bool = False,
    told: Observation | None = None,
    checks: Sequence[Column] = (),
    rejects: Column | None = None,
    hidden: Sequence[str] = (),
    lookup: Sequence[str] = (),
    writer_options: Mapping[str, object] | None = None,
    widen: bool = False,
) -> Observation:
    """Replaces days below ``root/year=/month=/day=`` by what ``df`` holds.

    By default the days in ``df`` are replaced and all others stay. ``whole`` replaces the layer.
    ``file_date`` names the column with the date of the file a row came from: it becomes a last
    partition level, so that only those files' share of a day is replaced, and leaves the data. With
    ``file_dates``, the files of the batch, what earlier runs of the same files left in cells that the
    batch no longer holds is emptied: by file date, or, where there is no such level, by day. ``None``
    among them stands for the files without a date.

    ``checks`` are further aggregates over the rows, for ``told`` in the same pass; ``hidden`` columns
    serve them and are not written. With ``rejects``, the text of a row as it was, rows that ``drop_null_day``
    leaves out are written by the same job, that text with them, to a cell of the layer that only
    ``read_rejects`` shows.

    ``lookup`` names columns that rows are looked up by: each file is sorted by them and keeps a Bloom filter
    of each, so that a reader asking for one value (``where_all``) passes over the row groups without it.
    ``writer_options`` go to Spark's Parquet writer. With ``widen`` a column may come in another type than
    before; readers see the type that takes both (int, bigint, double, then text).

    ``gather_days`` brings a day's rows together through ``REBALANCE``: a day below the session's
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` becomes one file, and adaptive execution
    splits a larger one over many tasks and files, so no day passes through a single task. Without
    it nothing is shuffled: right when each input split already holds one day.

    Returns counts, available now the write is done: ``seen_rows``, ``null_days`` and
    ``written_rows``. They, and ``checks``, are taken in the last stage, whose
    tasks Spark counts once each, also when a lost executor makes tasks run again.
    """
    spark = df.sparkSession
    taken = {name.lower() for name in df.columns} & {*DAY_PARTS, FILE_PART, REJECTED_ROW}
    if taken:
        raise ValueError(f"partition columns are already there: {sorted(taken)}")
    if gather_days and spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("gather_days needs spark.sql.adaptive.enabled")
    day = quoted(date_col)
    parts = [f(day) for f in (F.year, F.month, F.dayofmonth)]
    rejecting = drop_null_day and rejects is not None
    if rejecting:
        parts = [F.coalesce(part, F.lit(REJECTED)) for part in parts]
    parts = [part.alias(name) for part, name in zip(parts, DAY_PARTS)]
    kept = [quoted(name) for name in df.columns if name != file_date and name not in hidden]
    if rejecting:
        parts.append(F.when(day.isNull(), rejects).alias(REJECTED_ROW))
    levels = list(DAY_PARTS)
    if file_date is not None:
        parts.append(quoted(file_date).alias(FILE_PART))
        levels.append(FILE_PART)
    held = keep_columns(df.select(*kept), root, widen)
    rows = df.select(
        *[quoted(name).alias(inner) for name, inner in held.items()], *parts, *map(quoted, hidden)
    )
    if gather_days:
        rows = rows.hint("rebalance", *levels)
    counts = Observation()
    null_days = F.count_if(day.isNull())
    seen = F.count(F.lit(1))
    written = F.count(day) if drop_null_day else seen
    rows = rows.observe(
        counts,
        seen.alias("seen_rows"),
        null_days.alias("null_days"),
        written.alias("written_rows"),
    )
    if told is not None:
        rows = rows.observe(told, *checks)
    rows = rows.drop(*hidden)
    if drop_null_day and not rejecting:
        rows = rows.where(day.isNotNull())
    old = _files(spark, root, file_dates, file_date) if whole or file_dates is not None else None
    if lookup:
        rows = rows.sortWithinPartitions(*levels, *[quoted(held[name]) for name in lookup])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    for name in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{held[name]}", "true")
    writer.options(**(writer_options or {})).partitionBy(*levels).parquet(root)
    if old is not None:
        _empty(rows.select(*[quoted(name) for name in held.values()]), old, _files(spark, root, file_dates, file_date))
    return counts


def _files(
    spark: SparkSession, root: str, file_dates: Sequence[date | None] | None, file_date: str | None
) -> DataFrame:
    """Paths of the layer's data files, those of some file dates only; others' directories are not listed."""
    place = root
    if file_dates and file_date is not None:
        place = cells_of_files(root, file_dates) or root
    elif file_dates and len(file_dates) <= _LISTED_CELLS and not set(root) & set("{}[]*?\\"):
        parts = [(day.year, day.month, day.day) if day else [NULL_PART] * 3 for day in file_dates]
        cells = ["/".join(f"{name}={part}" for name, part in zip(DAY_PARTS, cell)) for cell in parts]
        place = f"{root}/{{{','.join(cells)}}}"
    nothing = spark.createDataFrame([], "file_path string")
    if file_dates is not None and not file_dates:
        return nothing
    try:
        found = checkpointed(list_files(spark, place, "*.parquet").select("file_path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing
    if file_dates is None:
        return found
    if file_date is not None:
        dated = F.regexp_extract("file_path", rf"/{FILE_PART}=([0-9-]+)/", 1).try_cast("date")
        undated = F.contains("file_path", F.lit(f"/{FILE_PART}={NULL_PART}/"))
    else:
        numbers = [F.regexp_extract("file_path", rf"/{name}=([0-9]+)/", 1) for name in DAY_PARTS]
        dated = F.concat_ws("-", *numbers).try_cast("date")
        undated = F.contains("file_path", F.lit(f"/{DAY_PARTS[0]}={NULL_PART}/"))
    return found.where(from_files(dated, [day for day in file_dates if day]) | (F.lit(None in file_dates) & undated))


def _empty(rows: DataFrame, old: DataFrame, new: DataFrame) -> None:
    """Takes away the files that outlived the write; usually there are none.

    One job, each task removing its share. A file that is gone already counts as removed, so a task may
    run again. Where a store opens to Spark's writers alone, cells are overwritten with nothing, one by one.
    """

    def removed(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            left = []
            for path in batch.column(0).to_pylist():
                try:
                    store, inner = fs.FileSystem.from_uri(path)
                    if store.get_file_info(inner).type != fs.FileType.NotFound:
                        store.delete_file(inner)
                except FileNotFoundError:
                    pass
                except (OSError, ValueError, NotImplementedError):
                    left.append(path)
            yield pa.RecordBatch.from_pydict({"file_path": pa.array(left, pa.string())})

    spark = rows.sparkSession
    outlived = new.join(old, "file_path", "left_semi")
    left = outlived.mapInArrow(removed, "file_path string")
    cells = left.select(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1).alias("cell")).distinct()
    for cell in cells.toLocalIterator():
        nothing = spark.createDataFrame([], rows.schema).coalesce(1)
        nothing.write.mode("overwrite").parquet(cell["cell"])


def write_raw(
    df: DataFrame,
    root: str,
    date_col: str = "file_date",
    gather_days: bool = False,
    file_dates: Sequence[date] | None = None,
    **options,
) -> Observation:
    """Raw layer by file date. A landing split holds one file date, so by default no shuffle."""
    return write_by_day(
        df, root, date_col, drop_null_day=False, gather_days=gather_days, file_dates=file_dates, **options
    )


def write_clean(
    df: DataFrame,
    root: str,
    date_col: str = "ObservationDate",
    drop_null_day: bool = True,
    file_date: str | None = None,
    file_dates: Sequence[date] | None = None,
    whole: bool = False,
    **options,
) -> Observation:
    """Clean layer by observation day; rows without a day are left out and counted."""
    return write_by_day(
        df, root, date_col, drop_null_day, file_date=file_date, file_dates=file_dates, whole=whole, **options
    )
