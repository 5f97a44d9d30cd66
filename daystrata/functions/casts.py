"""Casts that turn bad text into null whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daystrata.functions.text import as_column

_SPELLINGS = {"integer": "int", "long": "bigint"}

# How many digits always fit the type.
_SAFE_DIGITS = {"int": 9, "bigint": 18}
# The characters Spark's own cast trims.
_BLANK = r"[\x00-\x20\x7F]*"


def lenient_cast(col: Column | str, type_name: str) -> Column:
    """Cast to ``int``, ``bigint``, ``date`` or ``double``; text that does not fit becomes null.

    Whole-number targets also take decimals and cut the fraction (``12.7`` gives 12). A failing
    ``try_cast`` to them throws and catches an exception per value, dozens of times the cost of the
    value itself, so only text of the right form gets that far: bad tokens are told by pattern, and
    a short pattern comes first for the usual plain numbers.
    """
    type_name = _SPELLINGS.get(type_name, type_name)
    col = as_column(col)
    if type_name in ("date", "double"):
        return col.try_cast(type_name)
    if type_name not in _SAFE_DIGITS:
        raise ValueError(f"no lenient cast to {type_name!r}")
    safe = _SAFE_DIGITS[type_name]
    plain = r"^[+-]?[0-9]{1,%d}$" % safe
    # One digit more may still fit; only there can the cast itself fail.
    decimal = r"^%s[+-]?0*[0-9]{1,%d}([.][0-9]*)?%s$" % (_BLANK, safe + 1, _BLANK)
    whole = F.substring_index(col, ".", 1)
    return F.when(col.rlike(plain), col.try_cast(type_name)).when(
        col.rlike(decimal), whole.try_cast(type_name)
    )
