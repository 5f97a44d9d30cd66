"""Landing CSV files: one distributed scan over all of them, every column as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.functions.text import FILE_DATE_FORMAT, FILE_DATE_PATTERN, name_date, quoted
from daystrata.sources import headers as H
from daystrata.sources.files import checkpointed, fits_broadcast, list_files, reader


def read_landing_csv(
    spark: SparkSession,
    root: str | Sequence[str],
    columns: Sequence[str] | None = None,
    pattern: str = "*.csv",
    on_header_mismatch: str = "fail",
) -> DataFrame:
    """Rows of all CSV files below ``root``, large files split across tasks.

    Spark's CSV scan matches columns by position. ``"fail"`` makes it check each file's header and
    raise on another order or other names; ``columns=None`` then takes one file's header.
    ``"by_name"`` matches by header instead: ``columns=None`` takes all names found, and a column a
    file lacks is null. Beforehand the beginning of each file is read, for the headers.

    ``_metadata`` (file name, path, modification time) stays selectable on the result.
    """
    if on_header_mismatch == "by_name":
        return _read_by_name(spark, root, columns, pattern)
    if on_header_mismatch != "fail":
        raise ValueError(f"on_header_mismatch={on_header_mismatch!r}")
    checked = _with_header(spark, pattern).option("enforceSchema", False)
    if columns is None:
        return checked.csv(root)
    return checked.schema(H.all_string(columns)).csv(root)


def with_file_date(
    df: DataFrame,
    pattern: str = FILE_DATE_PATTERN,
    fmt: str = FILE_DATE_FORMAT,
    out: str = "file_date",
    on_duplicate_date: str = "keep",
    listing: DataFrame | None = None,
    name: str = "_metadata.file_name",
    unit: str = r"^(.*)$",
) -> DataFrame:
    """Adds the date in the file's name; null for a name without one.

    Of several files with one date, ``"keep"`` keeps all rows, ``"latest"`` those of the file last
    modified. The latter needs ``listing`` from ``list_files``: the superseded files are worked out
    from it, not from the data, and are usually none or few. ``name`` says where the date stands
    (a ``_metadata`` field or a column), and ``unit`` cuts from the path what counts as one file,
    for files that were written as a directory of parts.
    """
    dated = df.withColumn(out, name_date(F.col(name), pattern, fmt))
    if on_duplicate_date == "keep":
        return dated
    if on_duplicate_date != "latest" or listing is None:
        raise ValueError("on_duplicate_date is 'keep', or 'latest' with a listing")
    if not name.startswith("_metadata."):
        raise ValueError("'latest' tells files apart, so name must be a _metadata field")
    old = _superseded(listing, pattern, fmt, name.removeprefix("_metadata."), unit)
    # Broadcast only when measured small; a longer list goes through an ordinary join.
    old = checkpointed(old)
    if old.isEmpty():
        return dated
    if fits_broadcast(old, "superseded_unit"):
        old = F.broadcast(old)
    here = _unit(F.col("_metadata.file_path"), unit)
    return dated.join(old, here == F.col("superseded_unit"), "left_anti")


def _superseded(listing: DataFrame, pattern: str, fmt: str, name: str, unit: str) -> DataFrame:
    units = (
        listing.withColumn("superseded_unit", _unit(F.col("file_path"), unit))
        .withColumn("date", name_date(F.col(name), pattern, fmt))
        .where("date is not null")
        .groupBy("date", "superseded_unit")
        .agg(F.max("modified").alias("modified"))
    )
    latest = units.groupBy("date").agg(
        F.max(F.struct("modified", "superseded_unit"))["superseded_unit"].alias("latest_unit")
    )
    joined = units.join(latest, "date")
    return joined.where("superseded_unit <> latest_unit").select("superseded_unit")


def _unit(path: Column, unit: str) -> Column:
    return F.regexp_extract(path, unit, 1)


def _with_header(spark: SparkSession, pattern: str):
    return reader(spark, pattern).option("header", True)


def _file_headers(spark: SparkSession, root: str | Sequence[str], pattern: str) -> DataFrame:
    """``(header_path, header)``: each file's first line that is not blank.

    Executors open each file and read its beginning only. Where a store opens to Spark's readers alone,
    the text is scanned instead.
    """

    def beginnings(batches):
        import pyarrow as pa
        from pyarrow import fs

        def header(path):
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_stream(inner) as stream:
                text, more = b"", True
                while more:
                    part = stream.read(1 << 16)
                    more = bool(part)
                    text += part
                    *whole, rest = text.replace(b"\r", b"\n").split(b"\n")
                    for line in whole if more else [*whole, rest]:
                        if any(byte > 32 for byte in line):
                            return line.decode("utf-8", "replace")
                    text = rest
            return None

        for batch in batches:
            paths = batch.column(0).to_pylist()
            found, opened = [], []
            for path in paths:
                try:
                    found.append(header(path))
                    opened.append(True)
                except (OSError, ValueError, NotImplementedError):
                    found.append(None)
                    opened.append(False)
            yield pa.RecordBatch.from_pydict(
                {
                    "header_path": pa.array(paths, pa.string()),
                    "header": pa.array(found, pa.string()),
                    "opened": pa.array(opened, pa.bool_()),
                }
            )

    files = list_files(spark, root, pattern).select("file_path")
    first = checkpointed(
        files.mapInArrow(beginnings, "header_path string, header string, opened boolean")
    )
    if first.where("not opened").isEmpty():
        return first.where("header is not null").select("header_path", "header")
    return _scanned_headers(spark, root, pattern)


def _scanned_headers(spark: SparkSession, root: str | Sequence[str], pattern: str) -> DataFrame:
    text = reader(spark, pattern).text(root)
    first_split = text.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("header_path"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )
    # Within a task line numbers rise along the file, so the least one is the header's.
    lines = first_split.where(F.col("value").rlike(r"[^\x00-\x20]"))
    return lines.groupBy("header_path").agg(F.min_by("value", "line").alias("header"))


def _read_by_name(
    spark: SparkSession, root: str | Sequence[str], columns: Sequence[str] | None, pattern: str
) -> DataFrame:
    found = checkpointed(_file_headers(spark, root, pattern))
    variants = H.variants(found)
    if not variants:
        return _with_header(spark, pattern).schema(H.all_string(columns or [])).csv(root)
    names = list(columns) if columns is not None else H.union_of_names(variants)
    if len(variants) == 1:
        alike = _with_header(spark, pattern).csv(root)
        have = {name.lower(): name for name in alike.columns}
        return alike.select(
            [
                (quoted(have[name.lower()]) if name.lower() in have else F.lit(None).cast("string"))
                .alias(name)
                for name in names
            ]
        )
    generic = H.positional(max(len(fields) for _, fields in variants))
    rows = _with_header(spark, pattern).schema(H.all_string(generic)).csv(root)
    # The commonest header is number 0; only files with another one are looked up.
    numbers = F.array(*[F.lit(header) for header, _ in variants])
    others = found.select(
        "header_path", (F.array_position(numbers, F.col("header")) - 1).alias("number")
    ).where("number > 0")
    # One row per such file: broadcast when measured small, else an ordinary (skew-split) join.
    if fits_broadcast(others, "header_path"):
        others = F.broadcast(others)
    joined = rows.join(others, F.col("_metadata.file_path") == F.col("header_path"), "left")
    number = F.coalesce(F.col("number"), F.lit(0)).cast("int")
    values = F.array(*generic)
    return joined.select(
        [
            F.get(values, F.get(F.array(*map(F.lit, places)), number)).alias(name)
            for name, places in zip(names, H.places(variants, names))
        ]
    )
