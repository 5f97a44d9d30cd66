"""Inputs that the queries derive from whole tables, each as a frame and as its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.config import WEATHER
from daystrata.sources.files import scratch_dir

# The observation columns by their roles; the order is the landing files'.
_TYPE_OF = {name: kind for kind, names in WEATHER.types.items() for name in names}
OBSERVED = [WEATHER.hour, *_TYPE_OF, WEATHER.region]
ORDER_COLUMNS = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Observations as text, with nulls and bad tokens put in by rule (no row is left out).
_OBS_RAW = """
select event_id,
  cast(user_id as {text}) as ForecastSiteCode,
  cast(hour(ts) as {text}) as ObservationTime,
  {stamp} as ObservationDate,
  cast(event_id % 16 as {text}) as WindDirection,
  case when event_id % 7 = 0 then null else cast(event_id % 40 as {text}) end as WindSpeed,
  case when event_id % 3 = 0 then null else cast(event_id % 60 as {text}) end as WindGust,
  case when event_id % 5 = 0 then null
       else cast((event_id * 100) % 60000 as {text}) end as Visibility,
  case when event_id % 17 = 0 then null else cast(value as {text}) end as ScreenTemperature,
  case when event_id % 11 = 0 then 'n/a'
       else cast(980 + event_id % 60 as {text}) end as Pressure,
  cast(event_id % 31 as {text}) as SignificantWeatherCode,
  cast(50 + user_id % 10 as {text}) as Latitude,
  cast(-(user_id % 7) as {text}) as Longitude,
  case when event_id % 13 = 0 then null else event_type end as Region
from {events}
"""


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _OBS_RAW.replace("{text}", "string").replace(
        "{stamp}", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    )
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


OBS_RAW_SQL = _OBS_RAW.format(
    text="varchar", stamp="strftime(ts, '%Y-%m-%dT%H:%M:%S')", events="events"
)

# The last two of four characters, zeros put before a shorter text; what is no digit shifts what follows.
_HOUR_TWO = "right('00' || left({0}, 4), 2)"
HOUR_SQL = (
    f"({_HOUR_TWO} || case when regexp_matches({_HOUR_TWO}, '^[0-9][0-9]$') then ':00:00' "
    f"when regexp_matches({_HOUR_TWO}, '[0-9]$') then '0:00:0' else '00:00:' end)"
)
_WHOLE_SQL = "try_cast(regexp_extract(trim({0}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) as {1})"


def cast_sql(name: str, type_name: str) -> str:
    if type_name in ("int", "bigint"):
        return _WHOLE_SQL.format(name, type_name)
    return f"try_cast({name} as {type_name})"


TYPES_SQL = dict(_TYPE_OF)


def typed_sql(hour: str = "ObservationTime") -> str:
    typed = ", ".join(f"{cast_sql(c, t)} as {c}" for c, t in TYPES_SQL.items())
    return f"select event_id, {typed}, {hour} as ObservationTime, Region from obs_raw"


def filled_sql(hour_default: str, source: str) -> str:
    numbers = ", ".join(
        f"coalesce({c}, 0) as {c}" for c, t in TYPES_SQL.items() if t != "date"
    )
    return (
        f"select event_id, {numbers}, ObservationDate, "
        f"coalesce(ObservationTime, '{hour_default}') as ObservationTime, "
        f"coalesce(Region, 'Unknown') as Region from ({source})"
    )


RAW_CTE = f"with obs_raw as ({OBS_RAW_SQL})"
CLEAN_CTE = (
    f"{RAW_CTE}, obs_clean as "
    f"({filled_sql('00:00:00', typed_sql(HOUR_SQL.format('ObservationTime')))})"
)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, with the month of the order as ``file_month``."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        day,
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderstatus",
        F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd").alias("file_month"),
    )


ORDER_ROWS_SQL = """
select cast(o_orderkey as varchar) as o_orderkey,
  strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
  cast(o_totalprice as varchar) as o_totalprice,
  o_orderstatus,
  cast(date_trunc('month', o_orderdate) as date) as file_date
from orders
"""

# A landing file that Spark writes is a directory named like the file, with one or more parts.
LANDING_UNIT = r"^(.*)/[^/]*$"
LANDING_NAME = r"landing=([^/]+)/"
LANDING_DATE = r"landing=weather\.(\d{8})\.csv/"
LANDED = {"name": "_metadata.file_path", "pattern": LANDING_DATE}


# Landing files that a task holds open; only a task with more of them sorts its rows before it writes.
OPEN_FILES = 100
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def land_csv(df: DataFrame, root: str, stamp: str) -> str:
    """Writes one landing file per value of the ``stamp`` column, large ones in several parts.

    Rows go to their files as they come: narrow rows take so much more room in a sort than in the shuffle
    that a task would hold many times its part.
    """
    name = F.concat(F.lit("weather."), F.col(stamp), F.lit(".csv")).alias("landing")
    named = df.select(*[c for c in df.columns if c != stamp], name).hint("rebalance", "landing")
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS)
    if before == "0":
        conf.set(_WRITERS, OPEN_FILES)
    try:
        named.write.partitionBy("landing").option("header", True).mode("append").csv(root)
    finally:
        conf.set(_WRITERS, before)
    return root


def land_orders(spark: SparkSession, sf_dir: str) -> str:
    return land_csv(order_rows(spark, sf_dir), scratch_dir(spark, "landing"), "file_month")


def zipped(rows: DataFrame, stamp: str) -> DataFrame:
    """Archives ``(path, content)`` of the rows: one per Arrow batch, a CSV member per stamp, and
    a member that is no observation file."""
    columns = [c for c in rows.columns if c != stamp]
    lines = rows.select(F.col(stamp).alias("stamp"), F.to_csv(F.struct(*columns)).alias("line"))
    header = ",".join(columns)

    def zip_batches(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        # A task that runs again must give its archives the same names.
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            members: dict[str, list[str]] = {}
            for name, line in zip(batch["stamp"].to_pylist(), batch["line"].to_pylist()):
                members.setdefault(name, [header]).append(line)
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.csv", "not,an,observation\n1,2,3\n")
                for name, text in members.items():
                    archive.writestr(f"weather.{name}.csv", "\n".join(text))
            path = f"task{task}-{number}.zip"
            yield pa.RecordBatch.from_pydict({"path": [path], "content": [packed.getvalue()]})

    return lines.mapInArrow(zip_batches, "path string, content binary")
