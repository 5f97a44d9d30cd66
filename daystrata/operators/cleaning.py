"""Raw text to typed, filled observations: narrow projections only, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.config import WEATHER, ObservationConfig
from daystrata.functions import lenient_cast, normalise_hour, quoted
from daystrata.operators.shaping import columns_of_type


def targets(df: DataFrame, types: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Target type per column, for the listed columns that ``df`` has."""
    wanted = {name: type_name for type_name, names in types.items() for name in names}
    return {name: wanted[name] for name in df.columns if name in wanted}


def cast_by_lists(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Casts the listed columns leniently in one projection; others pass through."""
    target = targets(df, types)
    return df.select(
        [
            lenient_cast(name, target[name]).alias(name) if name in target else quoted(name)
            for name in df.columns
        ]
    )


def fill_by_type(
    df: DataFrame,
    string_default: str | None = "Unknown",
    numeric_default: float | None = 0,
    overrides: Mapping[str, object] | None = None,
    numeric_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Replaces nulls (and NaN) by column first, then by type; ``None`` as default leaves nulls.

    Dates stay null. ``numeric_columns`` narrows which numeric columns are filled.
    """
    own = {name: value for name, value in (overrides or {}).items() if name in df.columns}
    if own:
        df = df.na.fill(own)
    strings = columns_of_type(df, "string")
    if string_default is not None and strings:
        df = df.na.fill(string_default, subset=strings)
    numbers = columns_of_type(df, "numeric") if numeric_columns is None else list(numeric_columns)
    if numeric_default is not None and numbers:
        df = df.na.fill(numeric_default, subset=numbers)
    return df


def clean(
    df: DataFrame, config: ObservationConfig = WEATHER, beside: Mapping[str, Column] | None = None, **fill
) -> DataFrame:
    """Normalises the hour, casts by the type lists and fills nulls.

    ``beside`` adds columns worked out from the row as it was; they are neither cast nor filled.

    Filling comes before any maximum is taken, so when all real values are negative a filled 0 is
    the maximum; pass ``numeric_default=None`` to keep missing numbers null.
    """
    extra = [column.alias(name) for name, column in (beside or {}).items()]
    carried = "_beside"
    if extra:
        df = df.withColumn(carried, F.struct(*extra))
    if config.hour in df.columns:
        df = df.withColumn(config.hour, normalise_hour(config.hour))
    fill.setdefault("overrides", config.overrides)
    cleaned = fill_by_type(cast_by_lists(df, config.types), **fill)
    if not extra:
        return cleaned
    rest = [quoted(name) for name in cleaned.columns if name != carried]
    return cleaned.select(*rest, *[F.col(f"{carried}.{name}").alias(name) for name in beside])
