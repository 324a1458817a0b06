"""Window totals of scored readings on the measured clock, for bounded and streaming frames (ST3, ST4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Span:
    """A tumbling window: its length, its key and the names of its output columns."""

    length: str
    key: str
    start: str
    end: str
    total: str


SIX_HOURS = Span("6 hours", "building_id", "window_start", "window_end", "total_energy_6h")
ONE_DAY = Span("1 day", "site_id", "day_start", "day_end", "total_energy_day")


def window_totals(rows: DataFrame, span: Span, ts_col: str = "timestamp", value_col: str = "prediction", stamped: bool = False) -> DataFrame:
    """Rounded total of ``value_col`` for each key and window of ``span``; ``stamped`` adds the generation time.

    For bounded frames. On a stream the window column carries no watermark (the measured
    clock is not the emitted one), so its state would never be evicted: streams use the
    partials of ``streaming.aggregates``.
    """
    slot = F.window(F.col(ts_col), span.length)
    totals = rows.groupBy(span.key, slot.alias("slot")).agg(F.round(F.sum(value_col), 3).alias(span.total))
    named = totals.withColumns({span.start: F.col("slot.start"), span.end: F.col("slot.end")})
    out = named.select(span.start, span.end, span.key, span.total)
    return out.withColumn("gen_ts", F.current_timestamp()) if stamped else out
