import datetime
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daystrata.functions import derive_date, lenient_cast, name_date, normalise_hour

DAY = datetime.date(2016, 2, 1)


def applied(spark, values, expression):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = frame.select("i", expression(F.col("v")).alias("r")).collect()
    return [row["r"] for row in sorted(rows, key=lambda row: row["i"])]


def test_normalise_hour(spark):
    expected = {
        "0": "00:00:00",
        "9": "09:00:00",
        "23": "23:00:00",
        "24": "24:00:00",
        "900": "00:00:00",
        "1330": "30:00:00",
        "12345": "34:00:00",
        "": "00:00:00",
        "ab": "ab00:00:",
        "-1": "-10:00:0",
        None: None,
    }
    assert applied(spark, list(expected), normalise_hour) == list(expected.values())


WHOLE = {
    "12": 12,
    "12.0": 12,
    "12.7": 12,
    "-3.9": -3,
    " 5 ": 5,
    "\t5\n": 5,
    "+7": 7,
    "5.": 5,
    "007": 7,
    "-0": 0,
    "": None,
    "abc": None,
    "1e3": None,
    "1.2.3": None,
    "1 2": None,
    "5.x": None,
    ".5": None,
    "+": None,
    "١٢": None,
    "2147483647": 2147483647,
    "-2147483648": -2147483648,
    None: None,
}
INT_ONLY = {"2147483648": None, "99999999999": None, "00000000000000000012": 12}
BIGINT_ONLY = {
    "99999999999": 99999999999,
    "9223372036854775807": 9223372036854775807,
    "-9223372036854775808": -9223372036854775808,
    "9223372036854775808.5": None,
    "99999999999999999999": None,
}


@pytest.mark.parametrize("type_name,extra", [("int", INT_ONLY), ("bigint", BIGINT_ONLY)])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_whole_numbers(spark, type_name, extra, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = WHOLE | extra
        got = applied(spark, list(cases), lambda c: lenient_cast(c, type_name))
        assert dict(zip(cases, got)) == cases
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def model(text, bits):
    """What a lenient whole-number cast means, in plain Python."""
    found = re.fullmatch(r"[\x00-\x20\x7f]*([+-]?[0-9]+)(\.[0-9]*)?[\x00-\x20\x7f]*", text)
    if not found:
        return None
    value = int(Decimal(found[1]))
    return value if -(1 << bits - 1) <= value < 1 << bits - 1 else None


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="0123456789+-. \te", max_size=14),
            st.integers(-(10**20), 10**20).map(str),
            st.floats(allow_nan=False, allow_infinity=False, width=32).map(str),
        ),
        min_size=150,
        max_size=300,
    )
)
def test_lenient_whole_numbers_agree_with_model(spark, texts):
    for type_name, bits in (("int", 32), ("bigint", 64)):
        got = applied(spark, texts, lambda c: lenient_cast(c, type_name))
        assert got == [model(text, bits) for text in texts]


def test_lenient_date_and_double(spark):
    days = applied(
        spark, ["2016-02-01", "2016-02-01T00:00:00", "abc", "", None], lambda c: lenient_cast(c, "date")
    )
    assert days == [DAY, DAY, None, None, None]
    numbers = applied(spark, ["1.5", " -2 ", "1e3", "x", "", None], lambda c: lenient_cast(c, "double"))
    assert numbers == [1.5, -2.0, 1000.0, None, None, None]


def test_lenient_cast_takes_typed_columns_and_refuses_other_types(spark):
    row = spark.range(1).select(
        lenient_cast(F.lit(24.7), "int").alias("a"), lenient_cast(F.lit(5), "long").alias("b")
    )
    assert row.first() == (24, 5)
    with pytest.raises(ValueError):
        lenient_cast("a", "timestamp")


def test_name_date(spark):
    names = ["weather.20160201.csv", "weather.csv", "weather.20161301.csv", "x.20160201.csv.gz"]
    assert applied(spark, names, name_date) == [DAY, None, None, None]
    other = applied(spark, ["w_01-02-2016.csv", "w_1.csv"], lambda c: name_date(c, r"_([-\d]+)\.", "dd-MM-yyyy"))
    assert other == [DAY, None]


def test_derive_date(spark):
    row = spark.sql("select timestamp_ntz'2016-02-01 23:59:59' t, '2016-02-01T10:00:00' s, 'x' x")
    assert row.select(derive_date("t"), derive_date("s"), derive_date("x")).first() == (DAY, DAY, None)
