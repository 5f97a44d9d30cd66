"""CSV members of zip archives as rows.

Python only unzips, on the executors, and hands over blocks of text; splitting into lines and
parsing is Spark's own CSV parser, so a member reads the same as the loose file would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.functions.text import quoted
from daystrata.sources import headers as H
from daystrata.sources.files import checkpointed, list_files

BLOCK_CHARS = 1 << 20
# Smaller archives are not worth a shuffle whatever their share.
HOT_ARCHIVE_BYTES = 128 << 20
_HEADER_SCHEMA = "archive string, member string, header string"
_MEMBER_SCHEMA = _HEADER_SCHEMA
_BLOCK_SCHEMA = _HEADER_SCHEMA + ", block bigint, lines string"


def read_archives(
    spark: SparkSession,
    glob: str | Sequence[str],
    columns: Sequence[str],
    member_prefix: str = "weather",
    on_header_mismatch: str = "fail",
) -> DataFrame:
    """Rows of all CSV members whose name starts with ``member_prefix``, as text, plus
    ``archive`` and ``member``.

    Members are listed first and dealt out over all tasks, each opening the archive where its member
    lies, so an archive of any size is never held whole. Where a store opens to Spark's readers
    alone, ``unpack_archives`` takes the archives' bytes instead (Spark refuses files over 2 GB with
    an error); if the largest archive is then well above a fair share of the bytes, its text is
    spread over all tasks before parsing.
    """
    if on_header_mismatch not in ("fail", "by_name"):
        raise ValueError(f"on_header_mismatch={on_header_mismatch!r}")
    paths = list_files(spark, glob).select("file_path")
    members = checkpointed(paths.mapInArrow(_list_members(member_prefix), _MEMBER_SCHEMA))
    if members.where("member is null").isEmpty():
        by_name = on_header_mismatch == "by_name"
        expected = None if by_name else list(columns)
        # Keyed by name, not round robin: a task run again is dealt the same members.
        dealt = members.repartition("archive", "member").select("archive", "member")
        blocks = dealt.mapInArrow(_inflate(expected), _BLOCK_SCHEMA)
        return _parsed(blocks, members, columns, by_name)
    archives = spark.read.format("binaryFile").load(glob)
    sizes = archives.select("length").agg(F.max("length"), F.sum("length")).first()
    largest, total = sizes[0] or 0, sizes[1] or 0
    fair = total / spark.sparkContext.defaultParallelism
    lopsided = largest > max(HOT_ARCHIVE_BYTES, 2 * fair)
    return unpack_archives(archives, columns, member_prefix, on_header_mismatch, spread=lopsided)


def _list_members(prefix: str):
    """The executors' function: ``(archive, member, header)`` from an archive's directory and the first
    bytes of each member; a null member says that the store could not be opened."""

    def listed(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        def members(path):
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                for name in archive.namelist():
                    if name.startswith(prefix) and name.endswith(".csv"):
                        with archive.open(name) as stored:
                            text = io.TextIOWrapper(stored, "utf-8-sig", errors="replace")
                            header = next((x for x in text if any(c > " " for c in x)), None)
                        if header is not None:
                            yield path, name, header.rstrip("\n")

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    rows.extend(members(path))
                except (OSError, ValueError, NotImplementedError):
                    rows.append((path, None, None))
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], names=["archive", "member", "header"]
            )

    return listed


def _inflate(expected: list[str] | None):
    """The executors' function: members to blocks of whole lines, one member at a time."""
    block_chars = BLOCK_CHARS

    def inflated(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for path, name in zip(*(column.to_pylist() for column in batch.columns)):
                store, inner = fs.FileSystem.from_uri(path)
                with store.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                    with archive.open(name) as stored:
                        text = io.TextIOWrapper(stored, "utf-8-sig", errors="replace")
                        header = next(x for x in text if any(c > " " for c in x)).rstrip("\n")
                        names = [x.lower() for x in next(csv.reader([header]))]
                        if expected is not None and names != [x.lower() for x in expected]:
                            raise ValueError(f"{path}: header of {name} is {names}")
                        block = 0
                        while lines := text.read(block_chars):
                            # Complete the last line of the block.
                            row = {"archive": path, "member": name, "header": header, "block": block,
                                   "lines": lines + text.readline()}
                            yield pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()})
                            block += 1

    return inflated


def unpack_archives(
    archives: DataFrame,
    columns: Sequence[str],
    member_prefix: str = "weather",
    on_header_mismatch: str = "fail",
    spread: bool = False,
) -> DataFrame:
    """As ``read_archives``, from a frame with ``path`` and ``content``."""
    if on_header_mismatch not in ("fail", "by_name"):
        raise ValueError(f"on_header_mismatch={on_header_mismatch!r}")
    by_name = on_header_mismatch == "by_name"
    zipped = archives.select("path", "content")
    expected = None if by_name else list(columns)
    blocks = zipped.mapInArrow(_member_blocks(member_prefix, expected, False), _BLOCK_SCHEMA)
    if spread:
        # Keyed by place, not round robin: a task run again puts every block where it was.
        blocks = blocks.repartition("archive", "member", "block")
    headers = zipped.mapInArrow(_member_blocks(member_prefix, None, True), _HEADER_SCHEMA)
    return _parsed(blocks, headers, columns, by_name)


def _parsed(
    blocks: DataFrame, headers: DataFrame, columns: Sequence[str], by_name: bool
) -> DataFrame:
    """Lines of the blocks through Spark's CSV parser; by name, each by its own member's header."""
    if not by_name:
        parsed = _lines(blocks).withColumn("r", F.from_csv("line", H.all_string(columns)))
        return parsed.select("r.*", "archive", "member")
    width = headers.agg(F.max(H.width_bound(F.col("header")))).first()[0] or 1
    places = H.with_fields(blocks, "header", width).withColumn(
        "places", H.positions(F.col("fields"), columns)
    )
    generic = H.positional(width)
    parsed = _lines(places, "places").withColumn("r", F.from_csv("line", H.all_string(generic)))
    values = F.array(*[F.col("r")[name] for name in generic])
    return parsed.select(*H.pick(values, F.col("places"), columns), "archive", "member")


def _lines(blocks: DataFrame, *keep: str) -> DataFrame:
    lines = blocks.select(
        "archive", "member", *map(quoted, keep), F.explode(F.split("lines", "\n")).alias("line")
    )
    return lines.where(F.col("line").rlike(r"[^\x00-\x20]"))


def _member_blocks(prefix: str, expected: list[str] | None, headers_only: bool):
    """The executors' function; it carries all it needs, so they need not have this package."""
    block_chars = BLOCK_CHARS

    def unpack(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa

        def members(batch):
            for path, content in zip(batch["path"], batch["content"]):
                raw = pa.BufferReader(content.as_buffer())
                with zipfile.ZipFile(raw) as archive:
                    for member in archive.namelist():
                        if not (member.startswith(prefix) and member.endswith(".csv")):
                            continue
                        with archive.open(member) as stored:
                            # Every kind of line end becomes one newline.
                            text = io.TextIOWrapper(stored, "utf-8-sig", errors="replace")
                            header = next((line for line in text if _printable(line)), None)
                            if header is not None:
                                yield path.as_py(), member, header.rstrip("\n"), text

        def _printable(line):
            return any(char > " " for char in line)

        def check(path, member, header):
            names = [name.lower() for name in next(csv.reader([header]))]
            if names != [name.lower() for name in expected]:
                raise ValueError(f"{path}: header of {member} is {names}")

        def row(**values):
            return pa.RecordBatch.from_pydict({k: [v] for k, v in values.items()})

        for batch in batches:
            for path, member, header, text in members(batch):
                named = {"archive": path, "member": member, "header": header}
                if headers_only:
                    yield row(**named)
                    continue
                if expected is not None:
                    check(path, member, header)
                block = 0
                while lines := text.read(block_chars):
                    # Complete the last line of the block.
                    yield row(**named, block=block, lines=lines + text.readline())
                    block += 1

    return unpack
