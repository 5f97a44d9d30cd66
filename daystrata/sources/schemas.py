"""The columns of a layer, kept beside its data so that every reader sees the same ones.

Each write adds its columns to ``<root>/_columns``, which Spark's scans of the layer pass over. Lines are
only ever appended, so two writers cannot undo each other, and a reader takes all columns of all lines.

Where a column may come in several types, each type has a column of its own in the files, and readers
show the one wide enough for all: each file is read at its own type, in one scan.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.functions.text import quoted

_FOLDER = "_columns"
# A wider type takes every value of those before it; a bigint beyond 2**53 loses its last digits as a
# double. Text takes all types.
_WIDENING = ["int", "bigint", "double"]
_COLUMN = "column"


def widest(one: T.DataType, two: T.DataType) -> T.DataType:
    """The narrowest type that takes the values of both."""
    if one == two:
        return one
    names = [one.simpleString(), two.simpleString()]
    if all(name in _WIDENING for name in names):
        return [one, two][names.index(max(names, key=_WIDENING.index))]
    return T.StringType()


def known_columns(spark: SparkSession, root: str) -> T.StructType | None:
    """The columns in the layer's files in the order they came, or None where none are kept."""
    try:
        lines = spark.read.text(f"{root}/{_FOLDER}").distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    order: dict[str, tuple[int, int, T.StructField]] = {}
    for line in lines:
        number, _, text = line["value"].partition("\t")
        for place, field in enumerate(T.StructType.fromJson(json.loads(text)).fields):
            here = (int(number), place, field)
            if field.name not in order or here[:2] < order[field.name][:2]:
                order[field.name] = here
    names = sorted(order, key=lambda name: (order[name][:2], name))
    fields = [order[name][2] for name in names]
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])


def shown(df: DataFrame, columns: T.StructType | None) -> DataFrame:
    """``df``, read with the columns of a layer's files, with one column for all types of each."""
    kinds = _kinds(columns)
    if all(len(fields) == 1 for fields in kinds.values()):
        return df
    rest = [quoted(name) for name in df.columns if name not in set(columns.names)]
    selected = []
    for name, fields in kinds.items():
        wide = fields[0].dataType
        for field in fields[1:]:
            wide = widest(wide, field.dataType)
        selected.append(F.coalesce(*[quoted(field.name).cast(wide) for field in fields]).alias(name))
    return df.select(*selected, *rest)


def _kinds(columns: T.StructType | None) -> dict[str, list[T.StructField]]:
    """The fields of each column, one per type."""
    kinds: dict[str, list[T.StructField]] = {}
    for field in columns.fields if columns is not None else ():
        kinds.setdefault(field.metadata.get(_COLUMN, field.name), []).append(field)
    return kinds


def keep_columns(df: DataFrame, root: str, widen: bool = False) -> dict[str, str]:
    """Adds the frame's columns to the layer's, and says under which name the files hold each.

    A column of another type than before is refused, or, with ``widen``, held beside it.
    """
    spark = df.sparkSession
    known = known_columns(spark, root)
    kinds, held, fields = _kinds(known), {}, []
    for field in df.schema.fields:
        before = kinds.get(field.name, [])
        same = next((f for f in before if f.dataType == field.dataType), None)
        if before and same is None and not widen:
            raise ValueError(
                f"column {field.name} is {before[0].dataType.simpleString()} in {root}, "
                f"not {field.dataType.simpleString()}"
            )
        name = same.name if same else field.name if not before else f"{field.name}__{field.dataType.simpleString()}"
        held[field.name] = name
        fields.append(T.StructField(name, field.dataType, True, {_COLUMN: field.name} if name != field.name else {}))
    count = len(known.fields) if known is not None else 0
    if known is not None and all(field.name in known.names for field in fields):
        return held
    line = f"{count}\t{T.StructType(fields).json()}"
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(
        f"{root}/{_FOLDER}"
    )
    return held
