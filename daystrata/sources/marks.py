"""Which file dates came to a layer, and when: a small table beside the data.

One line per date and run is appended below ``<root>/_dates``, which Spark's scans of the layer pass over,
so that what landed since can be told without listing the layer.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = "_dates"
_SCHEMA = "file_date date, every boolean, at bigint"


def mark_dates(spark: SparkSession, root: str, dates: Sequence[date | None] | None, at: int | None = None) -> int:
    """Notes the dates, ``None`` among them for files without one; ``None`` alone for any date."""
    at = time.time_ns() if at is None else at
    lines = [(None, True, at)] if dates is None else [(day, False, at) for day in dates]
    if lines:
        frame = spark.createDataFrame(lines, _SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(f"{root}/{_FOLDER}")
    return at


def marked_dates(spark: SparkSession, root: str) -> DataFrame | None:
    """``(file_date, every, at)``: the last mark of each date, or None where none were kept."""
    try:
        marks = spark.read.schema(_SCHEMA).parquet(f"{root}/{_FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return marks.groupBy("file_date", "every").agg(F.max("at").alias("at"))
