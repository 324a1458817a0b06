"""Shared derived frames for the catalog, each with its SQL twin (CTE text).

``sql(body, *names)`` prefixes a query with the CTEs it needs, in dependency
order, so each oracle string is self-contained DuckDB SQL over the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import IMPUTABLE_WEATHER
from ..plans.features import clean_weather, feature_frame
from ..sources import tables as R

# ------------------------------------------------------------------ SQL twins
_MISSING_NUM = "CASE WHEN {c} = 0 THEN NULL ELSE CAST({c} AS DOUBLE) END"
_KEEP_NUM = "CAST({c} AS DOUBLE)"


def _clean_sql(src: str) -> str:
    cols = []
    for c in IMPUTABLE_WEATHER:
        tpl = _KEEP_NUM if c == "wind_direction" else _MISSING_NUM
        cols.append(f"{tpl.format(c=c)} AS {c}")
    return f"SELECT site_id, timestamp, {', '.join(cols)} FROM {src}"


SIX_LABEL_SQL = (
    "CASE WHEN hour({t}) < 6 THEN '0:00-5:59' WHEN hour({t}) < 12 THEN '6:00-11:59' "
    "WHEN hour({t}) < 18 THEN '12:00-17:59' WHEN hour({t}) IS NOT NULL THEN '18:00-23:59' END"
)
FALLBACK_SQL = (
    "CASE WHEN {m} IN (12, 1, 2, 6, 7, 8) THEN 'peak' WHEN {m} IS NOT NULL THEN 'off-peak' END"
)

CTE: dict[str, tuple[str, tuple[str, ...]]] = {
    "meters": (R.METERS_SQL, ()),
    "meters_daily": (R.METERS_DAILY_SQL, ()),
    "buildings": (R.BUILDINGS_SQL, ()),
    "weather": (R.WEATHER_SQL, ()),
    "weather_text": (R.WEATHER_TEXT_SQL, ("weather",)),
    "readings": (
        "SELECT event_id, CAST(user_id AS BIGINT) AS building_id, event_type AS meter_type, ts, value FROM events",
        (),
    ),
    "wclean": (_clean_sql("weather"), ("weather",)),
    "monthly": (
        "SELECT site_id, CAST(month(timestamp) AS INTEGER) AS month, avg(air_temperature) AS avg_temp FROM wclean GROUP BY 1, 2",
        ("wclean",),
    ),
    "season_labels": (
        "SELECT site_id, month, CASE WHEN dense_rank() OVER (PARTITION BY site_id ORDER BY avg_temp DESC) <= 3 "
        "OR dense_rank() OVER (PARTITION BY site_id ORDER BY avg_temp ASC) <= 3 THEN 'peak' ELSE 'off-peak' END "
        "AS season_flag FROM monthly WHERE avg_temp IS NOT NULL",
        ("monthly",),
    ),
    "wflag": (
        "SELECT w.*, coalesce(l.season_flag, " + FALLBACK_SQL.format(m="month(w.timestamp)") + ") AS season_flag "
        "FROM wclean w LEFT JOIN season_labels l ON w.site_id = l.site_id AND month(w.timestamp) = l.month",
        ("wclean", "season_labels"),
    ),
    "agg_daily": (
        "SELECT building_id, " + SIX_LABEL_SQL.format(t="ts") + " AS interval, ts, sum(value) AS agg_value "
        "FROM meters_daily GROUP BY ALL",
        ("meters_daily",),
    ),
    "site_map": ("SELECT DISTINCT building_id, site_id FROM buildings", ("buildings",)),
    "feature": (
        "SELECT a.building_id, s.site_id, a.ts, a.interval, a.agg_value, w.season_flag, w.air_temperature, "
        "w.dew_temperature, w.sea_level_pressure, w.wind_speed, w.cloud_coverage, w.wind_direction "
        "FROM agg_daily a LEFT JOIN site_map s ON a.building_id = s.building_id "
        "LEFT JOIN wflag w ON w.site_id = s.site_id AND w.timestamp = a.ts",
        ("agg_daily", "site_map", "wflag"),
    ),
    "pairs": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS label, "
        "l_quantity * p_retailprice AS pred_a, "
        "l_quantity * (SELECT CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 / sum(l_quantity) "
        "FROM lineitem) AS pred_b FROM lineitem JOIN part ON l_partkey = p_partkey",
        (),
    ),
    "daily_pred": (
        "SELECT o_orderdate AS day_start, o_orderdate + INTERVAL 1 DAY AS day_end, "
        "CAST(c_nationkey AS INTEGER) AS site_id, round(sum(o_totalprice), 3) AS total_energy_day "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
        (),
    ),
    "metered_site_day": (
        "SELECT s.site_id, CAST(m.ts AS DATE) AS day, round(sum(m.value), 2) AS metered_energy "
        "FROM meters_daily m LEFT JOIN site_map s ON m.building_id = s.building_id GROUP BY ALL",
        ("meters_daily", "site_map"),
    ),
    "six_totals": (
        "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, "
        "time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, building_id, "
        "round(sum(value), 3) AS total_energy_6h FROM readings GROUP BY ALL",
        ("readings",),
    ),
    "records": (
        "SELECT building_id, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, "
        "time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, "
        "round(sum(value) OVER (PARTITION BY building_id, time_bucket(INTERVAL 6 HOUR, ts) ORDER BY ts, event_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS total_energy_6h, ts AS gen_ts, event_id AS seq "
        "FROM readings",
        ("readings",),
    ),
}


def sql(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the named shared CTEs (dependencies first) plus inline ``extra`` CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in CTE[n][1]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({CTE[n][0]})" for n in order] + [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ------------------------------------------------------------------ Spark frames
def readings(spark: SparkSession, d: str) -> DataFrame:
    ev = R.read_table(spark, d, "events")
    return ev.select(
        "event_id",
        F.col("user_id").cast("bigint").alias("building_id"),
        F.col("event_type").alias("meter_type"),
        "ts",
        "value",
    )


def wclean(spark: SparkSession, d: str) -> DataFrame:
    return clean_weather(R.weather(spark, d))


def feature(spark: SparkSession, d: str) -> DataFrame:
    return feature_frame(R.meters_daily(spark, d), R.buildings(spark, d), R.weather(spark, d))


def pairs(spark: SparkSession, d: str) -> DataFrame:
    li = R.read_table(spark, d, "lineitem")
    part = R.read_table(spark, d, "part").select("p_partkey", "p_retailprice")
    rate = li.select(
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).cast("double") / 100 / F.sum("l_quantity")).alias("r")
    ).scalar()
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("pred_a"),
        (F.col("l_quantity") * rate).alias("pred_b"),
    )


PAIR_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def daily_pred(spark: SparkSession, d: str) -> DataFrame:
    o = R.read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = R.read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(
            F.col("o_orderdate").alias("day_start"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("day_end"),
            F.col("c_nationkey").cast("int").alias("site_id"),
        )
        .agg(F.round(F.sum("o_totalprice"), 3).alias("total_energy_day"))
    )


def metered_site_day(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.aggregate import daily_site_energy
    from ..operators.joins import attach_site

    m = attach_site(R.meters_daily(spark, d), R.buildings(spark, d))
    return daily_site_energy(m).select("site_id", "day", F.round("metered_energy", 2).alias("metered_energy"))


def r(col: str, n: int = 6):
    return F.round(F.col(col), n).alias(col)


def dr(col, n: int = 6, name: str | None = None):
    """Half-up decimal rounding for checked outputs (twin of ``DR`` in SQL)."""
    from ..functions.scalar import round_half_up

    c = F.col(col) if isinstance(col, str) else col
    out = round_half_up(c, n)
    alias = name or (col if isinstance(col, str) else None)
    return out.alias(alias) if alias else out


def DR(expr: str, n: int = 6) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{n + 3})), {n}) AS DOUBLE)"
