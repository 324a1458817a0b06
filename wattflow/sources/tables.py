"""Driver tables read as the reference's roles (meters, buildings, weather).

Each role is defined twice, once as a DataFrame and once as the equivalent SQL
(for the DuckDB oracle), kept side by side so the two cannot drift apart.

Role mapping (see SURVEY §7.6):

* ``meters``       <- ``events``: user_id = building, event_type = carrier,
                      reading hour = hour of ``ts``, ``value``.
* ``meters_daily`` <- ``lineitem`` joined to ``orders``: customer = building,
                      return flag = carrier, ship day, extended price.
* ``buildings``    <- ``customer``: nation = site, market segment = primary use,
                      floor area, floors and year derived from the row.
* ``weather``      <- ``orders`` joined to ``customer``, one row per
                      (nation, order day). Measures are built with exact integer-cent
                      sums so both engines produce identical doubles; zero and
                      NULL readings occur naturally (missing-value encodings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# ---------------------------------------------------------------- meters
def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("bigint").alias("building_id"),
        F.col("event_type").alias("meter_type"),
        F.window("ts", "1 hour").start.alias("ts"),
        F.col("value"),
    )


METERS_SQL = (
    "SELECT CAST(user_id AS BIGINT) AS building_id, event_type AS meter_type, "
    "date_trunc('hour', ts) AS ts, value FROM events"
)


def meters_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("building_id"),
        F.col("l_returnflag").alias("meter_type"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("value"),
    )


METERS_DAILY_SQL = (
    "SELECT CAST(o_custkey AS BIGINT) AS building_id, l_returnflag AS meter_type, "
    "l_shipdate AS ts, l_extendedprice AS value "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)


# ---------------------------------------------------------------- buildings
def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_nationkey").cast("int").alias("site_id"),
        F.col("c_custkey").cast("bigint").alias("building_id"),
        F.col("c_mktsegment").alias("primary_use"),
        F.floor(F.abs(F.col("c_acctbal")) * 10).cast("int").alias("square_feet"),
        (F.col("c_custkey") % 12 + 1).cast("int").alias("floor_count"),
        (F.col("c_custkey") % 120 + 1900).cast("int").alias("year_built"),
    )


BUILDINGS_SQL = (
    "SELECT CAST(c_nationkey AS INTEGER) AS site_id, CAST(c_custkey AS BIGINT) AS building_id, "
    "c_mktsegment AS primary_use, CAST(floor(abs(c_acctbal) * 10) AS INTEGER) AS square_feet, "
    "CAST(c_custkey % 12 + 1 AS INTEGER) AS floor_count, "
    "CAST(c_custkey % 120 + 1900 AS INTEGER) AS year_built FROM customer"
)


# ---------------------------------------------------------------- weather
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    price = F.col("o_totalprice")
    kept = F.col("o_orderpriority") != "5-LOW"
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_nationkey").cast("int").alias("site_id"), F.col("o_orderdate").alias("timestamp"))
        .agg(
            (
                F.sum(F.when(kept, F.round(price * 100).cast("bigint"))).cast("double")
                / 100
                / F.count(F.when(kept, F.lit(1)))
                / 10000
            ).alias("air_temperature"),
            F.count(F.when(F.col("o_orderstatus") == "F", F.lit(1))).cast("int").alias("cloud_coverage"),
            (F.min(price) / 10000).alias("dew_temperature"),
            ((F.max(price) - F.min(price)) / 1000).alias("sea_level_pressure"),
            ((F.count(F.lit(1)) * 45) % 360).cast("int").alias("wind_direction"),
            (F.max(price) / 50000).alias("wind_speed"),
        )
    )


WEATHER_SQL = (
    "SELECT CAST(c_nationkey AS INTEGER) AS site_id, o_orderdate AS timestamp, "
    "CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) "
    "/ 100 / count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) / 10000 AS air_temperature, "
    "CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS INTEGER) AS cloud_coverage, "
    "min(o_totalprice) / 10000 AS dew_temperature, "
    "(max(o_totalprice) - min(o_totalprice)) / 1000 AS sea_level_pressure, "
    "CAST((count(*) * 45) % 360 AS INTEGER) AS wind_direction, "
    "max(o_totalprice) / 50000 AS wind_speed "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, o_orderdate"
)


def weather_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as raw text, the way a CSV delivers it: numbers as strings, with the
    literal ``null`` for a reading with no cloud count and a blank for a wind
    direction of 0 degrees on a single-order day (both derived from the data)."""
    w = weather(spark, sf_dir)
    return w.select(
        "site_id",
        "timestamp",
        F.col("air_temperature").cast("string").alias("air_temperature"),
        F.when(F.col("cloud_coverage") == 0, F.lit("null"))
        .otherwise(F.col("cloud_coverage").cast("string"))
        .alias("cloud_coverage"),
        F.col("dew_temperature").cast("string").alias("dew_temperature"),
        F.col("sea_level_pressure").cast("string").alias("sea_level_pressure"),
        F.when(F.col("wind_direction") == 45, F.lit(" "))
        .otherwise(F.col("wind_direction").cast("string"))
        .alias("wind_direction"),
        F.col("wind_speed").cast("string").alias("wind_speed"),
    )


WEATHER_TEXT_SQL = (
    "SELECT site_id, timestamp, CAST(air_temperature AS VARCHAR) AS air_temperature, "
    "CASE WHEN cloud_coverage = 0 THEN 'null' ELSE CAST(cloud_coverage AS VARCHAR) END AS cloud_coverage, "
    "CAST(dew_temperature AS VARCHAR) AS dew_temperature, "
    "CAST(sea_level_pressure AS VARCHAR) AS sea_level_pressure, "
    "CASE WHEN wind_direction = 45 THEN ' ' ELSE CAST(wind_direction AS VARCHAR) END AS wind_direction, "
    "CAST(wind_speed AS VARCHAR) AS wind_speed FROM weather"
)
