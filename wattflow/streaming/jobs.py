"""End-to-end streaming jobs over a replayed feed (offline transport = Parquet files).

Each job stamps a table as a timed feed (S14-S17) and publishes it piece by
piece. After each piece the query is started from its checkpoint, takes all
that is new as one micro-batch and stops (``availableNow``), so every piece is
written and read by as many tasks as it has partitions, and a restart from the
checkpoint is part of every run. Output and checkpoint folders are fresh per job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import WATERMARK_DELAY
from ..runtime import scratch_dir
from ..sources.files import tail_parquet
from ..sources.replay import batch_ranges, publish_files, replay_order, stamp
from . import sinks

BASE_EPOCH = 1_700_000_000
HEARTBEAT_SECONDS = (3600, 3601)


@dataclass
class Feed:
    """A stamped table and the folder it is published to, piece by piece."""

    path: str
    stamped: DataFrame
    chunks: int = 1
    heartbeat: bool = False
    resend_first: bool = False

    def pieces(self) -> Iterator[dict]:
        """Publish the next piece, then yield reader options for the run that takes it.

        With ``resend_first`` the first piece is sent once more at the end (a
        transport replay, by then behind the watermark). With ``heartbeat`` two
        control records (no key, stamped an hour after the last reading) close the
        feed: the first moves the watermark, the batch of the second emits and
        evicts every older tick, so nothing stays unflushed.
        """
        ranges = batch_ranges(self.stamped, self.chunks)
        for lo, hi in ranges + (ranges[:1] if self.resend_first else []):
            part = self.stamped if len(ranges) == 1 else self.stamped.where((F.col("batch_id") >= lo) & (F.col("batch_id") < hi))
            publish_files(part, self.path)
            yield {}
        if self.heartbeat and ranges:
            last = self.stamped.agg(F.max("weather_ts")).first()[0]
            spark = self.stamped.sparkSession
            for lag in HEARTBEAT_SECONDS:
                values = [
                    (F.lit(last + lag) if f.name == "weather_ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.stamped.schema.fields
                ]
                publish_files(spark.range(1).select(*values), self.path)
            yield {"max_files_per_trigger": 1}  # one batch for each control record


def replay_feed(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    chunks: int = 1,
    heartbeat: bool = False,
    resend_first: bool = False,
    base_epoch: int = BASE_EPOCH,
) -> Feed:
    """Stamp ``df`` in ``order``; nothing is published yet."""
    return Feed(scratch_dir(df.sparkSession, f"{name}-feed"), stamp(replay_order(df, order), base_epoch), chunks, heartbeat, resend_first)


def read_feed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """The published feed as a stream with ``event_time`` (from the stamp) and its watermark."""
    s = tail_parquet(spark, path, max_files_per_trigger=max_files_per_trigger)
    s = s.withColumn("event_time", F.timestamp_seconds(F.col("weather_ts")))
    return s.withWatermark("event_time", watermark) if watermark else s


STATE_PARTITIONS_CONF = "spark.wattflow.statePartitions"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Shuffle/state partitions of a stateful query, fixed when it first starts.

    Taken from ``n``, else ``spark.wattflow.statePartitions``, else the session's
    ``spark.sql.shuffle.partitions``. Only the starting query sees it; the session
    setting is restored.
    """
    old = spark.conf.get("spark.sql.shuffle.partitions")
    n = n or int(spark.conf.get(STATE_PARTITIONS_CONF, None) or old)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@dataclass
class Run:
    """What a job wrote, and the last state size (rows) and watermark its runs reported."""

    written: DataFrame
    state_rows: int | None = None
    watermark: str | None = None
    names: list[str] = field(default_factory=list)


def run_feed(
    feed: Feed | None,
    build: Callable[..., DataFrame],
    name: str,
    mode: str = "append",
    partitions: int | None = None,
    timeout_s: float | None = None,
) -> Run:
    """Run the stream ``build(**reader options)`` once per published piece into one Parquet folder.

    ``mode`` append uses the native Parquet sink, update the idempotent
    ``foreachBatch`` sink. Without a feed the source is taken as it stands, in one run.
    """
    out = ckpt = None
    run = Run(written=None)
    for options in feed.pieces() if feed is not None else [{}]:
        stream = build(**options)
        spark = stream.sparkSession
        out = out or scratch_dir(spark, f"{name}-out")
        ckpt = ckpt or scratch_dir(spark, f"{name}-ckpt")
        sink = sinks.to_parquet_append if mode == "append" else sinks.to_parquet_update
        with state_partitions(spark, partitions):
            q = sink(stream, out, name, trigger="availableNow", checkpoint_root=ckpt)
        sinks.run_until_done(q, timeout_s)
        last = q.lastProgress
        if last is not None and last.stateOperators:
            run.state_rows = int(last.stateOperators[0].numRowsTotal)
            run.watermark = last.eventTime.get("watermark")
        run.names.append(q.name)
    if out is not None:
        run.written = spark.read.parquet(out)
    return run


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over what its source holds; the written rows."""
    return run_feed(None, lambda: stream, name).written


def run_update(stream: DataFrame, name: str) -> DataFrame:
    """Run an update-mode stream over what its source holds; the written batches."""
    return run_feed(None, lambda: stream, name, mode="update").written
