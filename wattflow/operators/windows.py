"""Window-style operators that stay skew-proof.

Per-key orderings never rely on ``partitionBy(key)`` alone when a key may be
hot: positions and "previous row" come from a segmented scan (``scan_in_order``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import scan_in_order


def moving_average(series: DataFrame, order_col: str, value_cols: Sequence[str], rows: int = 3) -> DataFrame:
    """Trailing mean over ``rows`` points, fewer at the start.

    Runs on an already aggregated calendar series (one row per month), so the
    unpartitioned window sees a calendar-bounded number of rows.
    """
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), 0)
    return series.select(
        order_col, *value_cols, *[F.avg(c).over(w).alias(f"{c}_ma") for c in value_cols]
    )


def position_in_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "arrival_index"
) -> DataFrame:
    """0-based position of each row within its key, in ``order`` (a total order)."""
    return scan_in_order(df, keys, order, position=out)


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salt_buckets: int = 32, rank_col: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key in ``order`` (sort expressions), exactly.

    Two stages so a hot key never sorts in one task: top ``n`` per
    (key, salt) first, then top ``n`` among at most ``salt_buckets * n`` rows.
    ``rank_col`` keeps the final 1-based rank.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    s1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(s1)).where(F.col("_r") <= n)
    s2 = Window.partitionBy(*keys).orderBy(*order)
    out = stage1.withColumn("_r", F.row_number().over(s2)).where(F.col("_r") <= n).drop("_salt")
    return out.withColumnRenamed("_r", rank_col) if rank_col else out.drop("_r")


def last_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, salt_buckets: int = 32
) -> DataFrame:
    """W4 (batch): the newest ``n`` rows per key by ``order`` (descending), salted two-stage."""
    order_desc = [F.desc(c) if isinstance(c, str) else c.desc() for c in order]
    return top_n_per_key(df, keys, order_desc, n, salt_buckets)


def changed_from_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], label_col: str, out: str = "is_new"
) -> DataFrame:
    """Flag rows whose label differs from the previous row of the same key.

    One segmented scan finds the previous label, also for a key that fills many
    tasks. The first row of a key is always new; keeping only ``is_new`` rows
    suppresses consecutive repeats.
    """
    scanned = scan_in_order(df, keys, order, previous={"_plab": label_col}, position="_at")
    is_new = (F.col("_at") == 0) | ~F.col(label_col).eqNullSafe(F.col("_plab"))
    return scanned.withColumn(out, is_new).drop("_at", "_plab")
