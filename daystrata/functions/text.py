"""Scalar helpers for hours, dates and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the date stands in a landing file's name, and how it is written.
FILE_DATE_PATTERN = r"\.(\d{8})\.csv$"
FILE_DATE_FORMAT = "yyyyMMdd"


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(col: Column | str) -> Column:
    return quoted(col) if isinstance(col, str) else col


def normalise_hour(col: Column | str) -> Column:
    """Whole hours 0-23 as ``HH:mm:ss`` text.

    Only the third and fourth of four zero-padded digits are kept, so ``900`` gives ``00:00:00``;
    run ``hour_out_of_range`` on the raw value first when the input may hold anything else.
    """
    col = as_column(col)
    # Of four characters, zeros put before a shorter text, the last two.
    head = F.substring(col, 1, 4)
    two = F.right(F.concat(F.lit("00"), head), F.lit(2))
    digit, other = F.substring(two, 2, 1).rlike("[0-9]"), F.substring(two, 1, 1).rlike("[0-9]")
    tail = F.when(digit & other, ":00:00").when(digit, "0:00:0").otherwise("00:00:")
    return F.concat(two, tail)


def name_date(
    name: Column, pattern: str = FILE_DATE_PATTERN, fmt: str = FILE_DATE_FORMAT
) -> Column:
    """The date inside a file name or path, null where there is none."""
    text = F.regexp_extract(name, pattern, 1)
    if fmt != FILE_DATE_FORMAT or r"(\d{8})" not in pattern:
        return F.try_to_date(text, fmt)
    # Eight digits by pattern: cutting them up is far cheaper than a format parser, and every row
    # of a file asks again.
    parts = [F.substring(text, start, length) for start, length in ((1, 4), (5, 2), (7, 2))]
    return F.concat_ws("-", *parts).try_cast("date")


def derive_date(col: Column | str) -> Column:
    """Date part of a timestamp, a date or date-like text."""
    return as_column(col).try_cast("date")
