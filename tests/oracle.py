"""Runs a query's SQL in DuckDB and compares it with the Spark result as a multiset of rows."""

import glob
import os
from collections import Counter

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return names, Counter(zip(*columns))


def kinds(schema):
    def kind(type_):
        text = str(type_)
        return {"large_string": "string", "string_view": "string"}.get(
            text, "timestamp" if text.startswith("timestamp") else text
        )

    return {field.name: kind(field.type) for field in schema}


def compare(frame, sql, con):
    ours, theirs = frame.toArrow(), con.sql(sql).to_arrow_table()
    names, rows = _rows(ours)
    expected_names, expected = _rows(theirs)
    assert names == expected_names
    assert kinds(ours.schema) == kinds(theirs.schema)
    missing, extra = expected - rows, rows - expected
    assert not missing and not extra, (
        f"{missing.total()} missing, {extra.total()} extra of {expected.total()}: "
        f"{list(missing)[:3]} {list(extra)[:3]}"
    )
    return rows.total()
