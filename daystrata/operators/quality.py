"""Checks on the way from landing to clean.

The counting operators put rows to be counted and rows that only name a key into one union, so each
needs a single shuffle of per-task partial sums and no join: a key holding a third of all rows
arrives as one partial sum per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.functions import lenient_cast, quoted
from daystrata.operators.cleaning import targets
from daystrata.operators.shaping import label, reorder_last_first
from daystrata.sources.files import decoded, list_files, reader

DAY_DIRECTORY = r"(year=[^/]+/month=[^/]+/day=[^/]+)/"


def non_empty(df: DataFrame) -> DataFrame:
    """One row, ``non_empty``: stops at the first row found."""
    return df.sparkSession.sql("SELECT EXISTS (SELECT 1 FROM {df}) AS non_empty", df=df)


def check_not_empty(df: DataFrame, raise_if_empty: bool = False) -> bool:
    """Whether there is any row; runs now."""
    empty = df.isEmpty()
    if empty and raise_if_empty:
        raise ValueError("no rows")
    return not empty


def hour_out_of_range(df: DataFrame, col: str, limit: int = 24) -> DataFrame:
    """Rows whose raw hour is ``limit`` or more; none is the pass condition."""
    return df.where(lenient_cast(col, "int") >= limit)


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key."""
    return df.where(quoted(key).isNotNull())


def cast_failures(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(column, failures)``: values that are there but do not survive the cast. One pass."""
    target = targets(df, types)
    if not target:
        raise ValueError("none of the listed columns is there")
    failed = [
        F.count_if(quoted(name).isNotNull() & lenient_cast(name, type_name).isNull()).alias(name)
        for name, type_name in target.items()
    ]
    return df.agg(*failed).unpivot([], list(map(quoted, target)), "column", "failures")


def failed_casts(df: DataFrame, types: Mapping[str, Sequence[str]]) -> Column:
    """Names of the columns whose value is there but does not survive the cast; null for a sound row."""
    names = [
        F.when(quoted(name).isNotNull() & lenient_cast(name, type_name).isNull(), F.lit(name))
        for name, type_name in targets(df, types).items()
    ]
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return F.when(F.size(failed) > 0, failed)


def file_row_counts(
    spark: SparkSession,
    path: str | Sequence[str],
    extension: str = ".csv",
    fmt: str = "csv",
    header: bool = False,
    name: str = "file",
) -> DataFrame:
    """``(filename, RowCount)`` for the files under ``path``, those without rows included.

    ``name="file"`` gives one row per file under its base name, ``name="day"`` one per day
    directory, and any other text is a pattern whose first group is cut from the path. Parquet
    counts come from footers; no column is read.
    """
    pattern = f"*{extension}"
    rows = reader(spark, pattern).format(fmt).option("header", header).load(path)
    counted = rows.select("_metadata.file_path", "_metadata.file_name", F.lit(1).alias("n"))
    listed = list_files(spark, path, pattern).select("file_path", "file_name", F.lit(0).alias("n"))
    # Names are cut from the few per-file sums, not from every row's path.
    files = counted.unionAll(listed).groupBy("file_path", "file_name").agg(F.sum("n").alias("n"))
    if name == "file":
        return files.select(decoded("file_name").alias("filename"), F.col("n").alias("RowCount"))
    cut = F.regexp_extract(decoded("file_path"), DAY_DIRECTORY if name == "day" else name, 1)
    return files.groupBy(cut.alias("filename")).agg(F.sum("n").alias("RowCount"))


def row_count_report(
    source_label: str, target_label: str, source: DataFrame, target: DataFrame
) -> DataFrame:
    """``(Type, filename, RowCount)``: both sides' counts, stacked."""
    return reorder_last_first(label(source, source_label).unionAll(label(target, target_label)))


def reconcile_counts(source: DataFrame, target: DataFrame, key: str = "file_date") -> DataFrame:
    """``(key, source_rows, target_rows, delta)``; a key on one side only counts 0 on the other.

    ``delta`` is target minus source, so lost rows show as negative. Null keys form one group.
    """
    one = F.lit(1).alias("row_count")
    return reconciled_counts(source.select(quoted(key), one), target.select(quoted(key), one), key)


def reconciled_counts(source: DataFrame, target: DataFrame, key: str = "file_date") -> DataFrame:
    """``reconcile_counts`` of sides that are counted already, as ``(key, row_count)``."""
    zero, n = F.lit(0), F.col("row_count")
    here = source.select(quoted(key), n.alias("source_rows"), zero.alias("target_rows"))
    there = target.select(quoted(key), zero.alias("source_rows"), n.alias("target_rows"))
    return (
        here.unionAll(there)
        .groupBy(quoted(key))
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
        .withColumn("delta", F.col("target_rows") - F.col("source_rows"))
    )


def reconcile_content(
    source: DataFrame, target: DataFrame, key: str = "file_date", columns: Sequence[str] | None = None
) -> DataFrame:
    """``(key, source_rows, target_rows, source_digest, target_digest, same)``, by content.

    A side's digest of a key adds up the hashes of its rows, so neither order nor partitioning matters,
    repeated rows count as often as they are there, and each task sends one partial sum per key, as for a
    count. Swapped, changed, lost and doubled rows show at equal counts. A row is its ``columns`` as text
    (all of both sides by default; one that a side lacks is null there). Null keys form one group, and
    a key on one side only has no rows on the other.
    """
    if columns is None:
        columns = list(dict.fromkeys([*source.columns, *target.columns]))
    columns = sorted(name for name in columns if name != key)

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        digest = F.md5(_row_text([quoted(name) if name in df.columns else F.lit(None) for name in columns]))
        high, low = (F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(28,0)") for at in (1, 16))
        nothing = F.lit(0).cast("decimal(28,0)")
        return df.select(
            quoted(key),
            F.lit(1).alias(f"{mine}_rows"), high.alias(f"{mine}_high"), low.alias(f"{mine}_low"),
            F.lit(0).alias(f"{other}_rows"), nothing.alias(f"{other}_high"), nothing.alias(f"{other}_low"),
        )

    both = side(source, "source", "target").unionByName(side(target, "target", "source"))
    sums = [
        F.sum(f"{side}_{part}").alias(f"{side}_{part}") for side in ("source", "target") for part in ("rows", "high", "low")
    ]
    told = [
        F.concat_ws("-", f"{side}_high", f"{side}_low").alias(f"{side}_digest") for side in ("source", "target")
    ]
    found = both.groupBy(quoted(key)).agg(*sums).select(quoted(key), "source_rows", "target_rows", *told)
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_digest") == F.col("target_digest"))
    return found.withColumn("same", same)


def _row_text(columns: Sequence[Column]) -> Column:
    """Values one after another, each with its length, so that no two rows read alike."""
    texts = [column.cast("string") for column in columns]
    return F.concat(
        F.lit(""), *[F.when(t.isNull(), "-").otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts]
    )
