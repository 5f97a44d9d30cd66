"""The physical plans that a large cluster needs, for the queries that write no files."""

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
NARROW = [
    "hour_normalise", "typed_cast", "lenient_casts", "fill_by_type", "clean_observations",
    "derive_date", "date_text", "columns_of_type", "drop_and_rename", "project", "label",
    "reorder_last_first", "stack_by_name", "where_all", "hour_out_of_range", "drop_null_key",
]
TINY_EXCHANGE = ["global_max", "cast_failures", "max_per_day", "hottest_record_all", "max_ties"]


def plan_of(spark, name):
    return contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, name):
    plan = plan_of(spark, name)
    for operator in ("Exchange", "Sort", "Window", "Join", "Python", "Cartesian"):
        assert operator not in plan


@pytest.mark.parametrize("name", TINY_EXCHANGE)
def test_aggregates_combine_before_the_exchange(spark, name):
    plan = plan_of(spark, name)
    assert "partial_" in plan
    for operator in ("Window", "Join", "Python", "Cartesian", "SortAggregate"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name,schema",
    [
        ("derive_date", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
        ("project", "struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>"),
        ("global_max", "struct<event_id:bigint,value:double>"),
        ("non_empty", "struct<>"),
    ],
)
def test_scans_read_only_what_is_asked(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan_of(spark, name)
