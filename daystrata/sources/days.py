"""Reading back day-partitioned layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.sources.schemas import known_columns, shown

# The partition columns of every layer, and of a layer that tells its rows' files apart.
DAY_PARTS = ("year", "month", "day")
FILE_PART = "from_file_date"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
# The day of a partition; null for the cell of rejected rows, as for rows without a day.
DAY = "make_date(year, nullif(month, 0), nullif(day, 0))"
# Rows that a layer keeps but does not show lie in a cell that is no day, as text in this column.
REJECTED = 0
REJECTED_ROW = "rejected_row"

# Longer ranges are cheaper to list as a whole. The columns do not depend on it.
_LISTED_MONTHS = 120
# The same for the cells of some file dates.
_LISTED_CELLS = 400


def read_days(
    spark: SparkSession,
    root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    days: Sequence[date | None] | None = None,
    file_dates: Sequence[date | None] | None = None,
    with_file_date: bool = False,
) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included, or of ``days``; other directories
    are not read. ``None`` among ``days`` stands for the rows without a day; other bounds leave them out.
    ``file_dates`` keeps, in a layer that tells them apart, what came from files of these dates, and lists
    no others' directories. ``with_file_date`` leaves that date in the rows, as ``from_file_date``.

    With both bounds only the months between them are listed, so the cost of planning does not grow
    with the layer. Without bounds all rows come back, those without a day too. The columns are all
    that were ever written to the layer, whatever the bounds; a row written without one has null there.
    """
    first = date.fromisoformat(str(start)) if start is not None else None
    last = date.fromisoformat(str(end)) if end is not None else None
    known = None if days is None else [day for day in days if day is not None]
    directory_day = F.expr(DAY)
    if file_dates is not None:
        df = _days_only(_scan(spark, root, first, last, file_dates=file_dates))
        df = df.where(from_files(F.col(FILE_PART).cast("date"), file_dates))
        df = df.where(directory_day >= F.lit(first)) if first is not None else df
        df = df.where(directory_day <= F.lit(last)) if last is not None else df
        return df.drop(*DAY_PARTS, *([] if with_file_date else [FILE_PART]))
    dropped = [*DAY_PARTS] if with_file_date else [*DAY_PARTS, FILE_PART]
    if days is not None and len(known) < len(days) and first is None and last is None:
        df = _scan(spark, root, min(known, default=None), max(known, default=None), undated=True)
        wanted = directory_day.isNull() | directory_day.isin(known)
        return _days_only(df).where(wanted).drop(*dropped)
    if known:
        first, last = first or min(known), last or max(known)
    df = _scan(spark, root, first, last)
    if first is None and last is None and days is None:
        df = _days_only(df)
    if first is not None:
        df = df.where(directory_day >= F.lit(first))
    if last is not None:
        df = df.where(directory_day <= F.lit(last))
    if days is not None:
        df = df.where(directory_day.isin(known) if known else F.lit(False))
    return df.drop(*dropped)


def cells_of_files(root: str, file_dates: Sequence[date | None]) -> str | None:
    """A path that names the cells of some file dates, or None where the layer has to be listed."""
    if not file_dates or len(file_dates) > _LISTED_CELLS or set(root) & set("{}[]*?\\"):
        return None
    any_day = "/".join(f"{name}=*" for name in DAY_PARTS)
    return f"{root}/{any_day}/{FILE_PART}={{{','.join(str(day or NULL_PART) for day in file_dates)}}}"


def from_files(file_date: Column, dates: Sequence[date | None]) -> Column:
    """Whether a file date is one of ``dates``, ``None`` among them standing for no date."""
    known = [day for day in dates if day is not None]
    wanted = F.coalesce(file_date.isin(known), F.lit(False)) if known else F.lit(False)
    return wanted | file_date.isNull() if len(known) < len(dates) else wanted


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``(from_file_date, rejected_row)``: rows left out of a layer, as JSON of what they were before."""
    schema = f"{REJECTED_ROW} string, {FILE_PART} date"
    cell = "/".join(f"{name}={REJECTED}" for name in DAY_PARTS)
    try:
        return spark.read.schema(schema).parquet(f"{root}/{cell}").select(FILE_PART, REJECTED_ROW)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{FILE_PART} date, {REJECTED_ROW} string")


def _scan(
    spark: SparkSession, root: str, first: date | None, last: date | None, undated: bool = False,
    file_dates: Sequence[date | None] | None = None,
) -> DataFrame:
    columns = known_columns(spark, root)
    # A layer that another tool wrote has no column list: its files are asked, all of them.
    reader = spark.read.option("mergeSchema", columns is None)
    if columns is not None:
        parts = [f"{name} int" for name in DAY_PARTS]
        ddl = ", ".join([*[f"{_quote(f.name)} {f.dataType.simpleString()}" for f in columns.fields], *parts])
        reader = reader.schema(ddl)
    months = _months(first, last) if first and last and not set(root) & set("{}[]*?\\") else []
    if undated and months:
        months.append(f"year={NULL_PART}/month={NULL_PART}")
    cells = f"{root}/{{{','.join(months)}}}" if 0 < len(months) <= _LISTED_MONTHS else None
    if file_dates is not None:
        cells = cells_of_files(root, file_dates)
        reader = reader.schema(f"{ddl}, {FILE_PART} date") if columns is not None else reader
    if columns is not None and cells is not None:
        try:
            return shown(reader.option("basePath", root).parquet(cells), columns)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    # No such month: the whole layer has the columns, and the bounds leave no row.
    return shown(reader.parquet(root), columns)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _days_only(layer: DataFrame) -> DataFrame:
    """Without the cell of rejected rows, whose day is none; a bound on the day does the same."""
    return layer.where(F.coalesce(F.col(DAY_PARTS[1]), F.lit(-1)) != REJECTED)


def _months(first: date, last: date) -> list[str]:
    numbers = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"year={n // 12}/month={n % 12 + 1}" for n in numbers]


def read_raw(spark: SparkSession, root: str, start=None, end=None, **options) -> DataFrame:
    """The raw layer, all text, between two file dates."""
    return read_days(spark, root, start, end, **options)


def read_clean(spark: SparkSession, root: str, start=None, end=None, **options) -> DataFrame:
    """The clean layer, typed, between two observation days."""
    return read_days(spark, root, start, end, **options)
