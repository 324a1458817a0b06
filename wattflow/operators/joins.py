"""Equi-joins of the feature build and the serving path.

Batch joins carry no hints: the planner broadcasts a side whose estimated size
is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans a sort-merge
join into a broadcast join once a shuffle stage has *measured* the side small
(and splits skewed partitions otherwise). The static side of a stream-static join
is written to the shared folder first (``hand_off``): micro-batches then re-read a
table whose size in bytes the planner knows instead of recomputing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import hand_off
from .ranks import range_partitions


def _dim(df: DataFrame, other: DataFrame) -> DataFrame:
    """A static dimension that meets a stream is handed off as a table first."""
    return hand_off(df, "dimension") if other.isStreaming and not df.isStreaming else df


def attach_month_labels(weather: DataFrame, labels: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Left join of (site, month) labels back to readings."""
    return (
        weather.withColumn("_month", F.month(ts_col))
        .join(_dim(labels.withColumnRenamed("month", "_month"), weather), ["site_id", "_month"], "left")
        .drop("_month")
    )


def attach_site(df: DataFrame, buildings: DataFrame, key: str = "building_id") -> DataFrame:
    """Building -> site via the building table (one site per building)."""
    # a building listed under two sites takes the smaller site id
    site_map = buildings.groupBy(key).agg(F.min("site_id").alias("site_id"))
    return df.join(_dim(site_map, df), key, "left")


def attach_weather(df: DataFrame, weather: DataFrame, ts_col: str = "ts", weather_ts: str = "timestamp") -> DataFrame:
    """Left join on exact (site, time); both sides are facts, so no hint."""
    w = weather.withColumnRenamed(weather_ts, ts_col) if weather_ts != ts_col else weather
    return df.join(w, ["site_id", ts_col], "left")


def attach_buildings(df: DataFrame, buildings: DataFrame, key: str = "building_id") -> DataFrame:
    """J4 (first half): building attributes; drops duplicate non-key columns first."""
    dup = [c for c in buildings.columns if c in df.columns and c != key]
    return df.join(_dim(buildings.drop(*dup), df), key, "left")


def fan_out_buildings(stream: DataFrame, buildings: DataFrame, parts: int | None = None) -> DataFrame:
    """One site reading -> one row per building at that site (stream-static, left).

    The result is far larger than the readings, which fill few tasks: they are dealt first
    into even ranges of (site, row hash), ``spark.wattflow.rangePartitions`` of them unless
    given. A task then holds few sites, so what follows counts or stores few buildings in it.
    """
    n = range_partitions(stream, parts)
    dealt = stream.repartitionByRange(n, "site_id", F.xxhash64(*stream.columns))
    return dealt.join(_dim(buildings, stream), "site_id", "left")


def pair_predictions(a: DataFrame, b: DataFrame, keys: list[str], pred_a: str = "pred_a", pred_b: str = "pred_b") -> DataFrame:
    """Align two models' predictions on a real row key (never on row numbers)."""
    return a.select(*keys, "label", F.col("prediction").alias(pred_a)).join(
        b.select(*keys, F.col("prediction").alias(pred_b)), keys
    )


def attach_use(df: DataFrame, buildings: DataFrame, key: str = "building_id") -> DataFrame:
    """Feature rows -> primary use."""
    return df.join(_dim(buildings.select(key, "primary_use"), df), key, "left")
