"""Every operator as a runnable query over whole tables, next to the SQL that must agree."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata import operators as ops
from daystrata import plans, sinks, sources
from daystrata.config import WEATHER
from daystrata.functions import derive_date, lenient_cast, normalise_hour
from daystrata.queries import inputs as I
from daystrata.sources.files import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name or fn.__name__] = fn
        _SQL[name or fn.__name__] = sql
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def obs_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean(I.obs_raw(spark, sf_dir))


# -- scalar functions and cleaning ----------------------------------------------------------------


@query(
    f"{I.RAW_CTE} select event_id, {I.HOUR_SQL.format('ObservationTime')} as hour_text, "
    f"{I.HOUR_SQL.format('cast(event_id as varchar)')} as id_text from obs_raw"
)
def hour_normalise(spark, sf_dir):
    return I.obs_raw(spark, sf_dir).select(
        "event_id",
        normalise_hour("ObservationTime").alias("hour_text"),
        normalise_hour(F.col("event_id").cast("string")).alias("id_text"),
    )


@query(f"{I.RAW_CTE} {I.typed_sql()}")
def typed_cast(spark, sf_dir):
    return ops.cast_by_lists(I.obs_raw(spark, sf_dir), WEATHER.types)


@query(
    f"""with messy as (
      select l_orderkey, l_linenumber, cast(l_extendedprice as varchar) as price,
        '  ' || cast(-l_orderkey as varchar) || '. ' as padded,
        cast(l_orderkey as varchar) || '0000000000' as big,
        l_returnflag || cast(l_linenumber as varchar) as flagged,
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as shipped
      from lineitem)
    select l_orderkey, l_linenumber,
      {I.cast_sql('price', 'int')} as price_int, {I.cast_sql('price', 'double')} as price_double,
      {I.cast_sql('padded', 'bigint')} as padded_bigint, {I.cast_sql('big', 'int')} as big_int,
      {I.cast_sql('big', 'bigint')} as big_bigint, {I.cast_sql('flagged', 'int')} as flagged_int,
      {I.cast_sql('shipped', 'date')} as shipped_date, {I.cast_sql('flagged', 'date')} as no_date
    from messy"""
)
def lenient_casts(spark, sf_dir):
    line = I.table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    price = F.col("l_extendedprice").cast("string")
    padded = F.concat(F.lit("  "), (-key).cast("string"), F.lit(". "))
    big = F.concat(key.cast("string"), F.lit("0000000000"))
    flagged = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    return line.select(
        "l_orderkey",
        "l_linenumber",
        lenient_cast(price, "int").alias("price_int"),
        lenient_cast(price, "double").alias("price_double"),
        lenient_cast(padded, "bigint").alias("padded_bigint"),
        lenient_cast(big, "int").alias("big_int"),
        lenient_cast(big, "bigint").alias("big_bigint"),
        lenient_cast(flagged, "int").alias("flagged_int"),
        lenient_cast(shipped, "date").alias("shipped_date"),
        lenient_cast(flagged, "date").alias("no_date"),
    )


@query(
    f"{I.RAW_CTE} "
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is not null and "
        f"{I.cast_sql(c, t)} is null) as failures from obs_raw"
        for c, t in I.TYPES_SQL.items()
    )
)
def cast_failures(spark, sf_dir):
    return ops.cast_failures(I.obs_raw(spark, sf_dir), WEATHER.types)


@query(f"{I.RAW_CTE} {I.filled_sql('Unknown', I.typed_sql())}")
def fill_by_type(spark, sf_dir):
    return ops.fill_by_type(ops.cast_by_lists(I.obs_raw(spark, sf_dir), WEATHER.types))


@query(f"{I.CLEAN_CTE} select * from obs_clean")
def clean_observations(spark, sf_dir):
    return obs_clean(spark, sf_dir)


@query(
    "select o_orderkey, cast(o_orderdate as date) as observed_date from orders", "derive_date"
)
def derive_observed_date(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", derive_date("o_orderdate").alias("observed_date"))


@query(
    """select event_id, strftime(ts, '%Y/%m/%d') as day_path, strftime(ts, '%Y%m%d') as stamp,
      cast(ts as date) as day_back, 'weather' || strftime(ts, '%Y%m%d') || '.parquet' as file_name
    from events"""
)
def date_text(spark, sf_dir):
    stamp = F.date_format("ts", "yyyyMMdd")
    name = F.concat(F.lit("weather"), stamp, F.lit(".parquet"))
    return I.table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy/MM/dd").alias("day_path"),
        stamp.alias("stamp"),
        sources.landing.name_date(name, r"(\d{8})\.parquet$").alias("day_back"),
        name.alias("file_name"),
    )


# -- shaping --------------------------------------------------------------------------------------


@query(
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax from lineitem"
)
def columns_of_type(spark, sf_dir):
    line = I.table(spark, sf_dir, "lineitem")
    return ops.project(line, *ops.columns_of_type(line, "numeric"))


@query("select event_id, user_id, event_type, value, props, cast(ts as date) as ts from events")
def drop_and_rename(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    return ops.drop_and_rename(events.withColumn("day", derive_date("ts")), "ts", "day")


@query(f"{I.CLEAN_CTE} select ObservationDate, Region, ScreenTemperature from obs_clean")
def project(spark, sf_dir):
    return ops.project(
        obs_clean(spark, sf_dir), "ObservationDate", "Region", "ScreenTemperature"
    )


@query("select *, 'Order' as Type from orders")
def label(spark, sf_dir):
    return ops.label(I.table(spark, sf_dir, "orders"), "Order")


@query("select o_orderpriority, * exclude (o_orderpriority) from orders")
def reorder_last_first(spark, sf_dir):
    return ops.reorder_last_first(I.table(spark, sf_dir, "orders"))


@query(
    """select o_orderkey as order_key, cast(o_orderdate as date) as day, o_totalprice as amount,
      o_orderstatus as status, null as line from orders
    union all
    select l_orderkey, cast(l_shipdate as date), l_extendedprice, null, l_linenumber
    from lineitem"""
)
def stack_by_name(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        derive_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    lines = I.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("amount"),
        F.col("l_linenumber").alias("line"),
        derive_date("l_shipdate").alias("day"),
        F.col("l_orderkey").alias("order_key"),
    )
    return ops.stack_by_name(orders, lines)


@query("select * from events order by event_id limit 3")
def head_n(spark, sf_dir):
    return ops.head_n(I.table(spark, sf_dir, "events"), 3, ["event_id"])


# -- extremes -------------------------------------------------------------------------------------

_MAX = "ScreenTemperature = (select max(ScreenTemperature) from obs_clean)"


@query(f"{I.CLEAN_CTE} select max(ScreenTemperature) as max_ScreenTemperature from obs_clean")
def global_max(spark, sf_dir):
    return ops.global_max(obs_clean(spark, sf_dir), WEATHER.value)


@query(
    f"{I.CLEAN_CTE} select ObservationDate, max(ScreenTemperature) as max_ScreenTemperature "
    "from obs_clean group by ObservationDate"
)
def max_per_day(spark, sf_dir):
    return ops.max_per_day(obs_clean(spark, sf_dir), WEATHER.value, WEATHER.day)


@query(f"{I.CLEAN_CTE} select ObservationDate from obs_clean where {_MAX}")
def date_of_max(spark, sf_dir):
    return ops.project(ops.where_max(obs_clean(spark, sf_dir), WEATHER.value), WEATHER.day)


@query(f"{I.CLEAN_CTE} select Region from obs_clean where {_MAX}")
def region_of_max(spark, sf_dir):
    return ops.project(ops.where_max(obs_clean(spark, sf_dir), WEATHER.value), WEATHER.region)


@query(
    f"{I.CLEAN_CTE} select ObservationDate, Region, ScreenTemperature from obs_clean where {_MAX}"
)
def hottest_record_all(spark, sf_dir):
    return ops.hottest_record(obs_clean(spark, sf_dir))


@query(_SQL["hottest_record_all"])
def hottest_record_view(spark, sf_dir):
    view = "daystrata_observations"
    sinks.register_view(obs_clean(spark, sf_dir), view)
    answer = spark.sql(
        f"SELECT ObservationDate, Region, ScreenTemperature FROM {view} "
        f"WHERE ScreenTemperature = (SELECT MAX(ScreenTemperature) FROM {view})"
    )
    sinks.drop_view(spark, view)
    return answer


@query(
    """select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_quantity = (select max(l_quantity) from lineitem)"""
)
def max_ties(spark, sf_dir):
    ties = ops.where_max(I.table(spark, sf_dir, "lineitem"), "l_quantity")
    return ops.project(ties, "l_orderkey", "l_linenumber", "l_quantity")


@query(
    """with ties as (
      select * from lineitem where l_quantity = (select max(l_quantity) from lineitem))
    select * from ties
    where (l_shipdate, l_orderkey) in
      (select (l_shipdate, l_orderkey) from ties order by l_shipdate, l_orderkey limit 1)"""
)
def hottest_record_first(spark, sf_dir):
    line = I.table(spark, sf_dir, "lineitem")
    return ops.first_max_record(line, "l_quantity", ["l_shipdate", "l_orderkey"])


@query(
    f"""{I.CLEAN_CTE} select * from obs_clean
    where ObservationDate = date '2024-01-15' and Region = 'click' and WindGust = 0"""
)
def where_all(spark, sf_dir):
    wanted = {"ObservationDate": F.lit("2024-01-15").cast("date"), "Region": "click", "WindGust": 0}
    return ops.where_all(obs_clean(spark, sf_dir), wanted)


# -- checks ---------------------------------------------------------------------------------------


@query(
    f"""{I.RAW_CTE} select event_id, cast(cast(ObservationTime as int) + 1 as varchar) as clock_hour
    from obs_raw where cast(ObservationTime as int) + 1 >= 24"""
)
def hour_out_of_range(spark, sf_dir):
    """Hours counted 1 to 24 instead of 0 to 23."""
    clock = (F.col("ObservationTime").cast("int") + 1).cast("string").alias("clock_hour")
    counted = I.obs_raw(spark, sf_dir).select("event_id", clock)
    return ops.hour_out_of_range(counted, "clock_hour")


@query(f"{I.RAW_CTE} select exists (select 1 from obs_raw) as non_empty")
def non_empty(spark, sf_dir):
    return ops.non_empty(I.obs_raw(spark, sf_dir))


@query(f"{I.RAW_CTE} select * from obs_raw where Region is not null")
def drop_null_key(spark, sf_dir):
    return ops.drop_null_key(I.obs_raw(spark, sf_dir), "Region")


# -- files: landing, archives, layers -------------------------------------------------------------


@query("select * from customer")
def read_any(spark, sf_dir):
    return sources.read_any(spark, f"{sf_dir}/customer.parquet", "parquet")


@query(I.ORDER_ROWS_SQL)
def landing_scan(spark, sf_dir):
    rows = sources.read_landing_csv(spark, I.land_orders(spark, sf_dir), I.ORDER_COLUMNS)
    return sources.with_file_date(rows, **I.LANDED)


@query(
    """select cast(o_orderkey as varchar) as o_orderkey,
      strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
      cast(o_totalprice as varchar) as o_totalprice,
      case when o_orderdate < timestamp '1998-01-01' then o_orderstatus end as o_orderstatus,
      case when o_orderdate >= timestamp '1998-01-01' then o_orderstatus end as status_code,
      cast(date_trunc('month', o_orderdate) as date) as file_date
    from orders"""
)
def landing_by_name(spark, sf_dir):
    """Files from 1998 on have another column order and another name for the status."""
    rows = I.order_rows(spark, sf_dir)
    later = F.col("file_month") >= "19980101"
    root = I.land_csv(rows.where(~later), scratch_dir(spark, "landing"), "file_month")
    moved = rows.where(later).select(
        F.col("o_orderstatus").alias("status_code"),
        "o_totalprice",
        "file_month",
        "o_orderkey",
        "o_orderdate",
    )
    I.land_csv(moved, root, "file_month")
    return sources.with_file_date(
        sources.read_landing_csv(spark, root, on_header_mismatch="by_name"), **I.LANDED
    )


@query(
    """select cast(o_orderkey as varchar) as o_orderkey,
      strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
      cast(o_totalprice as varchar) as o_totalprice,
      case when o_orderdate < timestamp '1998-01-01' then o_orderstatus else 'X' end
        as o_orderstatus,
      cast(date_trunc('month', o_orderdate) as date) as file_date
    from orders"""
)
def latest_file_per_date(spark, sf_dir):
    """All months land; then the months from 1998 on land again, corrected."""
    rows = I.order_rows(spark, sf_dir)
    root = scratch_dir(spark, "landing")
    I.land_csv(rows, f"{root}/first", "file_month")
    again = rows.where("file_month >= '19980101'").withColumn("o_orderstatus", F.lit("X"))
    I.land_csv(again, f"{root}/second", "file_month")
    return sources.with_file_date(
        sources.read_landing_csv(spark, root, I.ORDER_COLUMNS),
        on_duplicate_date="latest",
        listing=sources.list_files(spark, root, "*.csv"),
        unit=I.LANDING_UNIT,
        **I.LANDED,
    )


@query(I.ORDER_ROWS_SQL)
def archive_scan(spark, sf_dir):
    archives = I.zipped(I.order_rows(spark, sf_dir), "file_month")
    rows = sources.unpack_archives(archives, I.ORDER_COLUMNS)
    return sources.with_file_date(rows, name="member").drop("archive", "member")


@query(I.ORDER_ROWS_SQL)
def archive_by_name(spark, sf_dir):
    """Members written in another column order, their text spread over tasks before parsing."""
    moved = I.order_rows(spark, sf_dir).select("file_month", *reversed(I.ORDER_COLUMNS))
    rows = sources.unpack_archives(
        I.zipped(moved, "file_month"), I.ORDER_COLUMNS, on_header_mismatch="by_name", spread=True
    )
    return sources.with_file_date(rows, name="member").drop("archive", "member")


def _raw_layer(spark, sf_dir) -> str:
    root = scratch_dir(spark, "raw")
    raw = I.obs_raw(spark, sf_dir).withColumn("file_date", derive_date("ObservationDate"))
    sinks.write_raw(raw, root, gather_days=True)
    return root


@query(
    f"""{I.RAW_CTE} select *, try_cast(ObservationDate as date) as file_date from obs_raw
    where try_cast(ObservationDate as date) between date '2024-01-08' and date '2024-01-20'"""
)
def raw_round_trip(spark, sf_dir):
    return sources.read_raw(spark, _raw_layer(spark, sf_dir), "2024-01-08", "2024-01-20")


@query(f"{I.CLEAN_CTE} select * from obs_clean where Region <> 'Unknown'")
def clean_round_trip(spark, sf_dir):
    """Rows without a region lose their day here, and so do not reach the clean layer."""
    root = scratch_dir(spark, "clean")
    raw = I.obs_raw(spark, sf_dir)
    day = F.when(F.col("Region").isNotNull(), F.col("ObservationDate"))
    sinks.write_clean(ops.clean(raw.withColumn("ObservationDate", day)), root)
    return sources.read_clean(spark, root)


@query(
    f"""{I.RAW_CTE} select * replace
      (case when ObservationDate >= '2024-01-15' and ObservationDate < '2024-01-16'
       then 'corrected' else Region end as Region),
      try_cast(ObservationDate as date) as file_date
    from obs_raw"""
)
def overwrite_day(spark, sf_dir):
    """One day is written again with other values; all other days stay as they were."""
    root = _raw_layer(spark, sf_dir)
    day = sources.read_raw(spark, root, "2024-01-15", "2024-01-15")
    again = I.obs_raw(spark, sf_dir).withColumn("file_date", derive_date("ObservationDate"))
    again = again.where(F.col("file_date") == F.lit("2024-01-15").cast("date"))
    sinks.write_raw(again.withColumn("Region", F.lit("corrected")).select(day.columns), root)
    return sources.read_raw(spark, root)


_LANDED_NAME = "'weather.' || strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '.csv'"


@query(
    f"""select {_LANDED_NAME} as filename, count(*) as RowCount from orders group by 1
    union all select 'weather.19000101.csv', 0"""
)
def file_row_counts(spark, sf_dir):
    """With one file that holds only a header."""
    root = I.land_orders(spark, sf_dir)
    empty = I.order_rows(spark, sf_dir).drop("file_month").where(F.lit(False))
    empty.write.option("header", True).csv(f"{root}/landing=weather.19000101.csv")
    return ops.file_row_counts(spark, root, ".csv", "csv", True, name=I.LANDING_NAME)


_DAY_NAME = "'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts)"


@query(f"select {_DAY_NAME} as filename, count(*) as RowCount from events group by 1")
def day_row_counts(spark, sf_dir):
    """Out of the layer's footers."""
    return sources.day_counts(spark, _raw_layer(spark, sf_dir))


def _clean_layer(spark, sf_dir) -> str:
    root = scratch_dir(spark, "clean")
    sinks.write_clean(obs_clean(spark, sf_dir), root)
    return root


@query(_SQL["global_max"])
def layer_max(spark, sf_dir):
    """The clean layer's maximum out of its footers."""
    return sources.layer_max(spark, _clean_layer(spark, sf_dir), WEATHER.value)


@query(_SQL["max_per_day"])
def layer_max_per_day(spark, sf_dir):
    return sources.layer_max_per_day(spark, _clean_layer(spark, sf_dir), WEATHER.value, WEATHER.day)


@query(
    f"""select 'SourceFile' as Type, {_LANDED_NAME} as filename, count(*) as RowCount
    from orders group by 2
    union all
    select 'TargetFile', 'year=' || year(o_orderdate) || '/month=' || month(o_orderdate) || '/day=1',
      count(*) from orders group by 2"""
)
def row_count_report(spark, sf_dir):
    landing = I.land_orders(spark, sf_dir)
    raw = scratch_dir(spark, "raw")
    plans.land_to_raw(spark, raw, landing, columns=I.ORDER_COLUMNS, **I.LANDED)
    return ops.row_count_report(
        "SourceFile",
        "TargetFile",
        ops.file_row_counts(spark, landing, ".csv", "csv", True, name=I.LANDING_NAME),
        ops.file_row_counts(spark, raw, ".parquet", "parquet", name="day"),
    )


@query(
    """with s as (select cast(date_trunc('month', o_orderdate) as date) as file_date,
        count(*) as n from orders group by 1),
      t as (select * from s where file_date <> date '1998-03-01'
        union all select date '1990-01-01', count(*) from region)
    select coalesce(s.file_date, t.file_date) as file_date, coalesce(s.n, 0) as source_rows,
      coalesce(t.n, 0) as target_rows, coalesce(t.n, 0) - coalesce(s.n, 0) as delta
    from s full outer join t on s.file_date = t.file_date"""
)
def reconcile_counts(spark, sf_dir):
    """One month is lost on the way to raw, and rows turn up for one that never landed."""
    landing = I.land_orders(spark, sf_dir)
    rows = sources.read_landing_csv(spark, landing, I.ORDER_COLUMNS)
    dated = sources.with_file_date(rows, **I.LANDED)
    raw = scratch_dir(spark, "raw")
    sinks.write_raw(dated.where("file_date <> date '1998-03-01'"), raw)
    stray = F.lit("1990-01-01").cast("date").alias("file_date")
    strays = I.table(spark, sf_dir, "region").select(stray)
    return ops.reconcile_counts(
        dated, sources.read_raw(spark, raw).select("file_date").unionAll(strays)
    )


_DIGEST = (
    "sum(('0x' || substr(md5({0}), 1, 15))::bigint)::varchar || '-' || "
    "sum(('0x' || substr(md5({0}), 16, 15))::bigint)::varchar"
)
_ORDER_TEXT = " || ".join(
    f"case when {name} is null then '-' else length({name}) || ':' || {name} end" for name in sorted(I.ORDER_COLUMNS)
)
_CORRUPTED = "o_orderkey = (select min(o_orderkey) from s where file_date = (select max(file_date) from s))"


@query(
    f"""with s as ({I.ORDER_ROWS_SQL}),
      t as (select * replace (case when {_CORRUPTED} then o_orderstatus || '?' else o_orderstatus end
        as o_orderstatus) from s),
      a as (select file_date, count(*) as n, {_DIGEST.format(_ORDER_TEXT)} as d from s group by 1),
      b as (select file_date, count(*) as n, {_DIGEST.format(_ORDER_TEXT)} as d from t group by 1)
    select file_date, a.n as source_rows, b.n as target_rows, a.d as source_digest, b.d as target_digest,
      a.d = b.d as same from a join b using (file_date)"""
)
def reconcile_content(spark, sf_dir):
    """One value of one row is another in raw than in its landing file; all counts agree."""
    landing = I.land_orders(spark, sf_dir)
    rows = sources.with_file_date(sources.read_landing_csv(spark, landing, I.ORDER_COLUMNS), **I.LANDED)
    last = rows.where(F.col("file_date") == rows.agg(F.max("file_date")).scalar())
    changed = F.col("o_orderkey") == last.agg(F.min("o_orderkey")).scalar()
    status = F.when(changed, F.concat("o_orderstatus", F.lit("?"))).otherwise(F.col("o_orderstatus"))
    raw = scratch_dir(spark, "raw")
    sinks.write_raw(rows.withColumn("o_orderstatus", status), raw)
    return ops.reconcile_content(rows, sources.read_raw(spark, raw))


@query(_SQL["hottest_record_all"])
def layers_to_hottest(spark, sf_dir):
    """Landing files through raw and clean to the answer."""
    raw = I.obs_raw(spark, sf_dir)
    stamp = F.date_format(F.trunc(derive_date("ObservationDate"), "month"), "yyyyMMdd")
    columns = ["event_id", *I.OBSERVED]
    landed = raw.select(*columns).withColumn("stamp", stamp)
    landing = I.land_csv(landed, scratch_dir(spark, "landing"), "stamp")
    done = plans.run(
        spark,
        scratch_dir(spark, "raw"),
        scratch_dir(spark, "clean"),
        landing=landing,
        columns=columns,
        **I.LANDED,
    )
    return done.answer


@query(_SQL["clean_observations"])
def archives_to_clean(spark, sf_dir):
    """Archives through raw and clean, row for row."""
    raw = I.obs_raw(spark, sf_dir)
    stamp = F.date_format(derive_date("ObservationDate"), "yyyyMMdd")
    columns = ["event_id", *I.OBSERVED]
    archives = I.zipped(raw.select(*columns).withColumn("stamp", stamp), "stamp")
    rows = sources.with_file_date(sources.unpack_archives(archives, columns), name="member")
    raw_root, clean_root = scratch_dir(spark, "raw"), scratch_dir(spark, "clean")
    sinks.write_raw(rows.drop("archive", "member"), raw_root, gather_days=True)
    plans.raw_to_clean(spark, raw_root, clean_root)
    cleaned = sources.read_clean(spark, clean_root)
    return cleaned.withColumn("event_id", lenient_cast("event_id", "bigint"))


_EARLY = "event_id % 3 <> 0"


def _two_batches(spark, sf_dir, late_columns=None):
    """Raw layer of all observations in two files' dates: a third of every day comes late."""
    raw = I.obs_raw(spark, sf_dir)
    root = scratch_dir(spark, "raw")
    dated = raw.withColumn("file_date", F.expr(
        f"case when {_EARLY} then date'2024-01-01' else date'2024-03-01' end"))
    sinks.write_raw(dated.where(_EARLY).drop(*(late_columns or ())), root, gather_days=True)
    return root, dated.where(f"not ({_EARLY})")


@query(_SQL["clean_observations"])
def clean_incremental(spark, sf_dir):
    """Late rows for days already cleaned: cleaning their file alone leaves the other rows."""
    root, late = _two_batches(spark, sf_dir)
    clean_root = scratch_dir(spark, "clean")
    plans.raw_to_clean(spark, root, clean_root)
    sinks.write_raw(late, root, gather_days=True)
    plans.raw_to_clean(spark, root, clean_root, start="2024-03-01", end="2024-03-31")
    return sources.read_clean(spark, clean_root)


@query(f"{I.CLEAN_CTE} select * from obs_clean where event_id % 3 <> 0 or day(ObservationDate) > 9")
def clean_withdrawn_day(spark, sf_dir):
    """The late file lands again without the first days of each month."""
    root, late = _two_batches(spark, sf_dir)
    clean_root = scratch_dir(spark, "clean")
    sinks.write_raw(late, root, gather_days=True)
    plans.raw_to_clean(spark, root, clean_root)
    sinks.write_raw(late.where("day(cast(ObservationDate as date)) > 9"), root, gather_days=True)
    plans.raw_to_clean(spark, root, clean_root, start="2024-03-01", end="2024-03-31")
    return sources.read_clean(spark, clean_root)


@query(
    f"""{I.RAW_CTE} select * replace (case when event_id % 3 <> 0 then null else Pressure end
      as Pressure), date '2024-01-01' as file_date from obs_raw where event_id % 3 <> 0
    union all select *, date '2024-03-01' from obs_raw where event_id % 3 = 0"""
)
def raw_schema_drift(spark, sf_dir):
    """The first file lacks a column; bounds that list its months and no others still show it."""
    root, late = _two_batches(spark, sf_dir, ["Pressure"])
    sinks.write_raw(late, root, gather_days=True)
    early = sources.read_raw(spark, root, "2024-01-01", "2024-01-31")
    return early.unionByName(sources.read_raw(spark, root, "2024-02-01", "2044-03-31"))


@query(
    f"""{I.CLEAN_CTE} select * replace (case when event_id % 3 <> 0 then 0 else Pressure end
      as Pressure) from obs_clean"""
)
def clean_schema_drift(spark, sf_dir):
    """A column that only the later file has reaches the clean layer, filled for the earlier one."""
    root, late = _two_batches(spark, sf_dir, ["Pressure"])
    sinks.write_raw(late, root, gather_days=True)
    clean_root = scratch_dir(spark, "clean")
    plans.raw_to_clean(spark, root, clean_root)
    return sources.read_clean(spark, clean_root)


@query(_SQL["clean_observations"])
def landing_increments(spark, sf_dir):
    """Two landings into one folder, a third of every month's rows late; a third call finds nothing new."""
    rows = I.obs_raw(spark, sf_dir)
    stamp = F.date_format(F.trunc(derive_date("ObservationDate"), "month"), "yyyyMMdd")
    columns = ["event_id", *I.OBSERVED]
    landed = rows.select(*columns).withColumn("stamp", stamp)
    landing, raw, cleaned, record = (scratch_dir(spark, x) for x in ("landing", "raw", "clean", "record"))
    for part in (F.expr(_EARLY), ~F.expr(_EARLY)):
        I.land_csv(landed.where(part), landing, "stamp")
        plans.land_increments(spark, landing, raw, cleaned, record, columns, **I.LANDED)
    if plans.land_increments(spark, landing, raw, cleaned, record, columns, **I.LANDED):
        raise RuntimeError("files were taken twice")
    found = sources.read_clean(spark, cleaned)
    return found.withColumn("event_id", lenient_cast("event_id", "bigint"))


def _kept_extremes(spark, sf_dir) -> tuple[str, str]:
    """Clean layer of two batches, and the table of extremes brought up to date after each."""
    root, late = _two_batches(spark, sf_dir)
    clean_root, extremes = scratch_dir(spark, "clean"), scratch_dir(spark, "extremes")
    first, second = (datetime.date(2024, month, 1) for month in (1, 3))
    plans.raw_to_clean(spark, root, clean_root)
    plans.keep_extremes(spark, clean_root, extremes)
    sinks.write_raw(late, root, gather_days=True)
    plans.raw_to_clean(spark, root, clean_root, file_dates=[second])
    plans.keep_extremes(spark, clean_root, extremes, [second])
    # The first file lands again as it was: its rows of the table are replaced, not doubled.
    plans.keep_extremes(spark, clean_root, extremes, [first])
    return clean_root, extremes


@query(
    f"""{I.CLEAN_CTE} select ObservationDate, Region, ScreenTemperature from obs_clean
    order by ScreenTemperature desc, ObservationDate, Region limit 1"""
)
def first_max_kept(spark, sf_dir):
    """Out of the table of extremes alone."""
    return plans.first_max_kept(spark, _kept_extremes(spark, sf_dir)[1])


@query(_SQL["max_per_day"])
def max_per_day_kept(spark, sf_dir):
    return plans.max_per_day_kept(spark, _kept_extremes(spark, sf_dir)[1])


@query(_SQL["hottest_record_all"])
def hottest_kept(spark, sf_dir):
    clean_root, extremes = _kept_extremes(spark, sf_dir)
    return plans.hottest_kept(spark, extremes, clean_root)


@query(
    f"""{I.CLEAN_CTE} select * replace (case when event_id % 5 = 0 then 'corrected' else Region end as Region)
    from obs_clean"""
)
def settled_days(spark, sf_dir):
    """A later file brings other regions for a fifth of the rows; the rest of their days stays."""
    raw = I.obs_raw(spark, sf_dir)
    raw_root, clean_root, settled = (scratch_dir(spark, name) for name in ("raw", "clean", "settled"))
    first, second = (datetime.date(2024, month, 1) for month in (1, 3))
    sinks.write_raw(raw.withColumn("file_date", F.lit(first)), raw_root, gather_days=True)
    plans.raw_to_clean(spark, raw_root, clean_root)
    plans.settle_days(spark, clean_root, settled, ["event_id"])
    again = raw.where("event_id % 5 = 0").withColumn("Region", F.lit("corrected"))
    sinks.write_raw(again.withColumn("file_date", F.lit(second)), raw_root, gather_days=True)
    plans.raw_to_clean(spark, raw_root, clean_root, file_dates=[second])
    plans.settle_days(spark, clean_root, settled, ["event_id"], [second])
    return sources.read_clean(spark, settled)


@query(
    f"""{I.CLEAN_CTE} select * from obs_clean
    where ForecastSiteCode = (select max(ForecastSiteCode) from obs_clean) and WindGust = 0"""
)
def point_lookup(spark, sf_dir):
    """Rows of one site out of a layer that is sorted by site and keeps Bloom filters."""
    root = scratch_dir(spark, "clean")
    rows = obs_clean(spark, sf_dir)
    sinks.write_clean(rows, root, lookup=["ForecastSiteCode", "event_id"])
    last = rows.agg(F.max("ForecastSiteCode")).first()[0]
    return ops.where_all(sources.read_clean(spark, root), {"ForecastSiteCode": last, "WindGust": 0})


@query(
    f"""{I.RAW_CTE} select case when event_id % 4 = 0 then 'none' end as day, event_id, Pressure, Region
    from obs_raw where event_id % 4 = 0"""
)
def rejected_rows(spark, sf_dir):
    """A quarter of the rows have a day that is none; the cleaning pass itself puts them aside, as they were."""
    day = F.expr("case when event_id % 4 = 0 then 'none' else ObservationDate end")
    raw = I.obs_raw(spark, sf_dir).withColumn("file_date", derive_date("ObservationDate"))
    raw_root, clean_root = scratch_dir(spark, "raw"), scratch_dir(spark, "clean")
    sinks.write_raw(raw.withColumn("ObservationDate", day), raw_root, gather_days=True)
    plans.raw_to_clean(spark, raw_root, clean_root)
    kept = "ObservationDate string, event_id bigint, Pressure string, Region string"
    row = F.from_json("rejected_row", kept).alias("row")
    return sources.read_rejects(spark, clean_root).select(row).select("row.*").withColumnRenamed("ObservationDate", "day")


@query(
    f"""{I.CLEAN_CTE} select * replace (
      case when event_id % 3 <> 0 then Pressure::bigint else Pressure::bigint + 5000000000 end as Pressure,
      case when event_id % 3 <> 0 then Visibility::double else Visibility / 2.0 end as Visibility,
      case when event_id % 3 <> 0 then WindSpeed::varchar else 'calm' end as WindSpeed) from obs_clean"""
)
def widened_types(spark, sf_dir):
    """A later batch brings three columns in wider types; readers see types that take both."""
    root, rows = scratch_dir(spark, "clean"), obs_clean(spark, sf_dir)
    early, late = (rows.where(part).withColumn("of", F.lit(day).cast("date")) for part, day in (
        (F.expr(_EARLY), "2024-01-01"), (~F.expr(_EARLY), "2024-03-01")))
    wider = late.withColumns({
        "Pressure": F.col("Pressure").cast("bigint") + 5_000_000_000,
        "Visibility": F.col("Visibility") / 2,
        "WindSpeed": F.lit("calm"),
    })
    for part in (early, wider):
        sinks.write_clean(part, root, file_date="of", widen=True)
    return sources.read_clean(spark, root)


_MONTH = "strftime(date_trunc('month', ts), '%Y%m%d')"


@query(
    f"""select 'rows of ' || {_MONTH} as what, count(*)::bigint as n from events group by 1
    union all select 'failed ' || 'Pressure', count(*) from events where event_id % 11 = 0"""
)
def pipeline_checks(spark, sf_dir):
    """A run's own report of rows per landing file, and the casts that failed."""
    raw = I.obs_raw(spark, sf_dir)
    stamp = F.date_format(F.trunc(derive_date("ObservationDate"), "month"), "yyyyMMdd")
    columns = ["event_id", *I.OBSERVED]
    landed = raw.select(*columns).withColumn("stamp", stamp)
    done = plans.run(
        spark,
        scratch_dir(spark, "raw"),
        scratch_dir(spark, "clean"),
        landing=I.land_csv(landed, scratch_dir(spark, "landing"), "stamp"),
        columns=columns,
        raise_if_empty=True,
        **I.LANDED,
    )
    date = F.regexp_replace(F.col("file_date").cast("string"), "-", "")
    rows = done.reconciled.where("delta = 0").select(
        F.concat(F.lit("rows of "), date).alias("what"), F.col("target_rows").alias("n")
    )
    failed = done.failures.where("failures > 0")
    return rows.unionAll(failed.select(F.concat(F.lit("failed "), "column"), "failures"))


@query(
    """select event_id, cast(24 + event_id % 3 as varchar) as ObservationTime from events
    where event_id % 97 = 0"""
)
def landing_hour_check(spark, sf_dir):
    """All landing files stacked by name; by rule some raw hours are past the day's end."""
    late = F.expr("case when event_id % 97 = 0 then cast(24 + event_id % 3 as string) "
                  "else ObservationTime end")
    raw = I.obs_raw(spark, sf_dir).withColumn("ObservationTime", late)
    stamp = F.date_format(F.trunc(derive_date("ObservationDate"), "month"), "yyyyMMdd")
    landed = raw.withColumn("stamp", stamp).select("event_id", "ObservationTime", "stamp")
    landing = I.land_csv(landed, scratch_dir(spark, "landing"), "stamp")
    rows = sources.read_landing_csv(spark, landing, ["event_id", "ObservationTime"])
    return ops.hour_out_of_range(rows, "ObservationTime").withColumn(
        "event_id", lenient_cast("event_id", "bigint")
    )


@query(I.ORDER_ROWS_SQL)
def archive_files(spark, sf_dir):
    """Real archives, written by executors through Spark, read member by member."""
    root = scratch_dir(spark, "archives")
    zips = I.zipped(I.order_rows(spark, sf_dir), "file_month")

    def land(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, content in zip(*(column.to_pylist() for column in batch.columns)):
                store.create_dir(folder)
                # Written aside and moved, so that a task run again leaves a whole file.
                with store.open_output_stream(f"{folder}/_{name}") as out:
                    out.write(content)
                store.move(f"{folder}/_{name}", f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"path": batch.column(0)})

    uri = root if "://" in root or root.startswith("file:") else f"file://{root}"
    zips.mapInArrow(land, "path string").write.format("noop").mode("overwrite").save()
    rows = sources.read_archives(spark, f"{root}/*.zip", I.ORDER_COLUMNS)
    return sources.with_file_date(rows, name="member").drop("archive", "member")
