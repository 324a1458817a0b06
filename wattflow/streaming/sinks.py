"""Streaming sinks and query control (S6, S7, S9, S10, S11, ST5, ST6, ST13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..runtime import checkpoint_for
from ..sources.payload import keyed_json


def _trigger(writer, trigger: str | None):
    """ST5: ``processingTime`` cadence, or run everything available then stop (tests)."""
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def to_parquet_append(
    df: DataFrame, path: str, name: str, trigger: str | None = None, checkpoint_root: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Native Parquet sink, append mode, own checkpoint: exactly-once files."""
    w = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_for(df.sparkSession, name, checkpoint_root))
        .outputMode("append")
        .queryName(name)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start()


def to_parquet_update(
    df: DataFrame, path: str, name: str, trigger: str | None = None, checkpoint_root: str | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """``foreachBatch`` sink for open-window aggregates (update mode).

    Each micro-batch overwrites its own ``batch_id=N`` folder, so a batch that
    is replayed after a failure rewrites the same files instead of appending
    duplicates. Readers pick the latest record per key (ST9).
    """
    from pyspark.sql import functions as F

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        (
            batch_df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
        )

    w = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_for(df.sparkSession, name, checkpoint_root))
        .queryName(name)
    )
    return _trigger(w, trigger).start()


def to_kafka(df: DataFrame, bootstrap: str, topic: str, key_col: str, name: str, checkpoint_root: str | None = None,
             trigger: str | None = "0 seconds") -> StreamingQuery:
    """Keyed JSON republish to a topic (needs the Kafka connector)."""
    payload = keyed_json(df, key_col)
    w = (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint_for(df.sparkSession, name, checkpoint_root))
        .outputMode("append")
        .queryName(name)
    )
    return _trigger(w, trigger).start()


def to_memory(df: DataFrame, name: str, output_mode: str = "append", trigger: str | None = None) -> StreamingQuery:
    """Preview sink: an in-memory table queryable as ``name`` (driver-side, small previews only)."""
    return _trigger(df.writeStream.format("memory").queryName(name).outputMode(output_mode), trigger).start()


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish (without limit unless ``timeout_s`` is given); raise its error if it failed."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() or True
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name} did not finish in {timeout_s}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    return query


def stop_all(spark: SparkSession) -> list[str]:
    """ST13: stop every active query; returns their names."""
    names = []
    for q in spark.streams.active:
        names.append(q.name)
        q.stop()
    return names
