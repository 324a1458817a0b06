"""Streaming sources (S4, S5, S8, ST1, ST2, S13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import WATERMARK_DELAY
from ..sources.files import tail_parquet
from ..sources.payload import decode_weather


def read_kafka(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Subscribe to a topic. ``earliest`` replays the retained log,
    ``latest`` with a fresh checkpoint gives live-only consumption.

    Needs the Kafka connector on the classpath (not bundled with PySpark).
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def read_value_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Offline stand-in for a topic: Parquet files with a ``value`` column (S17 output)."""
    return tail_parquet(spark, path, max_files_per_trigger=max_files_per_trigger)


def weather_stream(raw: DataFrame, value_col: str = "value", watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """S5 + ST1 + ST2: decode the payload, derive both clocks, watermark the emitted clock.

    Lateness is a transport property, so the watermark is on ``event_time``;
    any stateful aggregate that must evict state groups by a window of it
    (see ``streaming.aggregates``).
    """
    parsed = decode_weather(raw, value_col)
    parsed = parsed.where(F.col("event_time").isNotNull())
    return parsed.withWatermark("event_time", watermark) if watermark else parsed
