"""File listings, generic scans and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

# A table with one path per row may be broadcast up to both of these.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 16 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reader(spark: SparkSession, pattern: str = "*") -> DataFrameReader:
    """Reader for the files of a whole directory tree whose names match."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def list_files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """``(file_path, file_name, modified, length)`` of files; their content is not read."""
    files = reader(spark, pattern).format("binaryFile").load(path)
    listing = files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )
    # The scan plans one task per split size of content; a listing needs far fewer.
    return listing.coalesce(spark.sparkContext.defaultParallelism)


def decoded(name: Column | str) -> Column:
    """A ``_metadata`` name or path as it stands on disk; Spark gives it percent-encoded."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_any(spark: SparkSession, path: str, fmt: str, header: bool = False) -> DataFrame:
    """Scan by format name."""
    return spark.read.format(fmt).option("header", header).load(path)


def fits_broadcast(df: DataFrame, path: str) -> bool:
    """Measures up to the row bound only, so a large table is never counted in full."""
    start = df.select(F.octet_length(path).alias("bytes")).limit(BROADCAST_ROWS + 1)
    rows, size = start.agg(F.count("bytes"), F.sum("bytes")).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only on a local master, as in tests, does a machine-local folder serve where that setting is
    absent; on a cluster its nodes could not see each other's, so that is an error. What is written
    there stays, as Spark's own checkpoints do, unless ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, which covers checkpoints only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="daystrata-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Runs ``df`` once and keeps its rows in the shared checkpoint folder.

    A session without a checkpoint folder is given one below ``spark.checkpoint.dir``. The shuffles that led to
    the rows are removed from disk, which else waits for the driver to collect its garbage.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        # A frame keeps the setting that it was made with.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(_CLEANUP, before)
