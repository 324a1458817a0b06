"""Replay of a historical table as a timed feed, as table jobs.

The reference producer walked a sorted pandas frame in batches of 120 rows.
Here the order, batch numbers and stamps come from one global index (range
partitioned, no single-task window), so the job scales with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import BATCH_SIZE, ROWS_PER_DAY, TICK_SECONDS
from ..operators.ranks import global_index
from .payload import weather_payload


def replay_order(df: DataFrame, order: Sequence[str | Column] = ("site_id", "timestamp")) -> DataFrame:
    """Attach the replay position ``idx`` in (site, time) order."""
    return global_index(df, list(order), out="idx")


def stamp(
    indexed: DataFrame,
    base_epoch: int,
    batch_size: int = BATCH_SIZE,
    rows_per_block: int = ROWS_PER_DAY,
    tick_seconds: int = TICK_SECONDS,
    cycles: int = 1,
) -> DataFrame:
    """batch = idx div batch_size; block = (idx mod batch_size) div rows_per_block;
    weather_ts = base + tick * batch + block. Every row is sent: the last batch is short.

    ``cycles`` > 1 replays the table again after the end (the wrap-around), each
    pass continuing the batch numbering; rows are repeated with a generator, so
    the work is ``cycles`` x the table, never a cross join.
    """
    out = indexed.withColumns(
        {
            "batch_id": F.floor(F.col("idx") / batch_size).cast("bigint"),
            "block": F.floor(F.pmod(F.col("idx"), F.lit(batch_size)) / rows_per_block).cast("int"),
        }
    )
    if cycles > 1:
        n_batches = indexed.select(F.ceil(F.count(F.lit(1)) / batch_size).alias("b")).scalar()
        out = out.withColumn("_cycle", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1)))).withColumn(
            "batch_id", F.col("batch_id") + F.col("_cycle") * n_batches
        ).drop("_cycle")
    return out.withColumn(
        "weather_ts", (F.lit(base_epoch) + F.lit(tick_seconds) * F.col("batch_id") + F.col("block")).cast("bigint")
    )


def payload_frame(stamped: DataFrame) -> DataFrame:
    """One JSON payload per stamped reading, keyed by site."""
    return stamped.select(
        F.col("site_id").cast("string").alias("key"),
        weather_payload(stamped).alias("value"),
        "batch_id",
        "weather_ts",
    )


def publish_files(frame: DataFrame, path: str) -> None:
    """S17 (offline transport): append the feed to a Parquet folder, one write task per partition."""
    frame.write.mode("append").parquet(path)


def batch_ranges(frame: DataFrame, chunks: int) -> list[tuple[int, int]]:
    """``chunks`` consecutive ranges [from, to) of batch numbers that cover the feed (one-row read)."""
    bounds = frame.select(F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).first()
    if bounds["lo"] is None:
        return []
    lo, hi = int(bounds["lo"]), int(bounds["hi"]) + 1
    step = max(-(-(hi - lo) // chunks), 1)
    return [(at, min(at + step, hi)) for at in range(lo, hi, step)]


def publish_kafka(frame: DataFrame, bootstrap: str, topic: str) -> None:
    """Batch publish of key/value rows (needs the Kafka connector)."""
    frame.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option(
        "topic", topic
    ).save()
