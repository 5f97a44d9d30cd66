"""Matching CSV columns by header name when files differ in their headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Different header lines that one scan by name may meet.
MAX_HEADERS = 1000


def all_string(names: Sequence[str]) -> str:
    """DDL of a schema with every column as text."""
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def positional(width: int) -> list[str]:
    return [f"_c{i}" for i in range(width)]


def width_bound(header: Column) -> Column:
    """At least the number of columns of a header line."""
    return F.size(F.split(header, ",")).cast("int")


def with_fields(df: DataFrame, header: str, width: int) -> DataFrame:
    """Adds ``fields``: the header line as an array of names, null past the last."""
    parsed = df.withColumn("_header", F.from_csv(header, all_string(positional(width))))
    fields = F.array(*[F.col("_header")[name] for name in positional(width)])
    return parsed.withColumn("fields", fields).drop("_header")


def positions(fields: Column, columns: Sequence[str]) -> Column:
    """For each wanted column its 0-based place among the header's fields, -1 where absent."""
    lowered = F.transform(fields, lambda name: F.lower(name))
    places = [F.coalesce(F.array_position(lowered, name.lower()), F.lit(0)) for name in columns]
    return F.array(*[(place - 1).cast("int") for place in places])


def pick(values: Column, places: Column, columns: Sequence[str]) -> list[Column]:
    """The wanted columns out of an array of a row's values; place -1 gives null."""
    return [F.get(values, F.get(places, i)).alias(name) for i, name in enumerate(columns)]


def variants(headers: DataFrame) -> list[tuple[str, list[str | None]]]:
    """The different header lines with their fields, the commonest first.

    The driver holds them, so more than ``MAX_HEADERS`` are an error: such files do not share columns.
    """
    counted = headers.groupBy("header").agg(F.count("*").alias("n"))
    width = counted.agg(F.max(width_bound(F.col("header")))).first()[0]
    if width is None:
        return []
    rows = with_fields(counted, "header", width).orderBy(F.col("n").desc(), "header")
    found = rows.limit(MAX_HEADERS + 1).select("header", "fields").collect()
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    return [(row["header"], list(row["fields"])) for row in found]


def union_of_names(known: Sequence[tuple[str, Sequence[str | None]]]) -> list[str]:
    """Every name in any header, by first place."""
    first: dict[str, tuple[int, str]] = {}
    for _, fields in known:
        for place, name in enumerate(fields):
            if name is not None:
                key = name.lower()
                old = first.get(key, (place, name))
                first[key] = (min(old[0], place), min(old[1], name))
    return [name for _, name in sorted(first.values())]


def places(known: Sequence[tuple[str, Sequence[str | None]]], names: Sequence[str]) -> list[list[int]]:
    """For each wanted name its 0-based place in every header, -1 where absent."""
    lowered = [[(name or "").lower() for name in fields] for _, fields in known]
    return [
        [fields.index(name.lower()) if name.lower() in fields else -1 for fields in lowered]
        for name in names
    ]
