"""Windowed stream aggregates (ST3, ST4, ST9, ST10), all with state that the watermark evicts.

Windows of the measured clock carry no watermark (that is on the emitted clock), so
their own state would never go. Instead rows are grouped by a tick of the watermarked
``event_time`` plus the measured day / 6-hour block and the key, and the totals are a
batch roll-up of these partials (``roll_up``). Append mode emits each tick's partial
once, when the watermark passes it; update mode (S7) emits it with every batch that
changes it, and the last emission counts (``latest_partials``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TICK_SECONDS
from ..functions.calendar import day_of, six_hour_block


def tick_partials(
    stamped: DataFrame,
    key: str,
    value_col: str = "prediction",
    ts_col: str = "timestamp",
    tick_seconds: int = TICK_SECONDS,
    with_block: bool = True,
) -> DataFrame:
    """ST3/ST4 evictable form: partial sums per (tick of event_time, day, [block], key).

    ``stamped`` must carry a watermarked ``event_time``. Rows later than the
    watermark are dropped by Spark (ST10) and counted in the query progress
    (``numRowsDroppedByWatermark``).
    """
    groups = [F.window("event_time", f"{tick_seconds} seconds").alias("tick"), day_of(ts_col).alias("date")]
    if with_block:
        groups.append(six_hour_block(ts_col).alias("block"))
    groups.append(F.col(key))
    return stamped.groupBy(*groups).agg(F.sum(value_col).alias("partial"), F.count(F.lit(1)).alias("n")).select(
        F.col("tick.start").alias("tick_start"), "date", *(["block"] if with_block else []), key, "partial", "n"
    )


def roll_up(partials: DataFrame, key: str, with_block: bool = True) -> DataFrame:
    """Totals from tick partials: one row per (key, day[, block]) with the 6-hour window bounds.

    Keyless partials (heartbeat/control records) are dropped here.
    """
    groups = [key, "date"] + (["block"] if with_block else [])
    agg = partials.where(F.col(key).isNotNull() & F.col("date").isNotNull()).groupBy(*groups).agg(F.sum("partial").alias("_t"), F.sum("n").alias("n_readings"))
    day0 = F.col("date").cast("timestamp_ntz")
    if with_block:
        start = day0 + F.make_dt_interval(F.lit(0), F.col("block") * 6)
        return agg.select(
            key,
            start.alias("window_start"),
            (start + F.expr("INTERVAL 6 HOURS")).alias("window_end"),
            F.round("_t", 3).alias("total_energy_6h"),
            "n_readings",
        )
    return agg.select(
        key,
        day0.alias("day_start"),
        (day0 + F.expr("INTERVAL 1 DAY")).alias("day_end"),
        F.round("_t", 3).alias("total_energy_day"),
        "n_readings",
    )


def latest_partials(written: DataFrame, key: str, with_block: bool = True) -> DataFrame:
    """The last emission of each partial that update mode re-emitted with ``batch_id``."""
    groups = ["tick_start", "date", *(["block"] if with_block else []), key]
    last = written.groupBy(*groups).agg(F.max_by(F.struct("partial", "n"), "batch_id").alias("_r"))
    return last.select(*groups, "_r.*")


def latest_emission(
    records: DataFrame, keys: list[str], stamp_cols: list[str], stamp: str, span: str = "6 hours", delay: str = "6 hours"
) -> DataFrame:
    """ST9 on a stream: the latest record per key by ``stamp_cols`` (update mode).

    A ``max_by`` aggregate keeps one row of state per key and ``span`` of ``stamp``, the
    time column of a record's generation; each micro-batch emits the keys whose latest
    record changed, and what lies ``delay`` behind the newest stamp is evicted. A key that
    comes back later is emitted again: readers reduce by ``stamp_cols`` once more.
    """
    others = [c for c in records.columns if c not in keys]
    if isinstance(records.schema[stamp].dataType, T.TimestampNTZType):  # a watermark needs an instant: the wall clock read as UTC
        clock = F.timestamp_seconds(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(stamp)))
    else:
        clock = F.col(stamp)
    timed = records.withColumn("_clock", clock).withWatermark("_clock", delay)
    latest = timed.groupBy(F.window("_clock", span).alias("_slot"), *keys).agg(F.max_by(F.struct(*others), F.struct(*stamp_cols)).alias("_r"))
    return latest.select(*keys, "_r.*")
