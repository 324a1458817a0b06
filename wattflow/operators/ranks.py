"""Global positions and tie-averaged ranks without a single-task window.

The global index range-partitions on the ordering key, so each task holds one
contiguous slice of the total order; per-slice totals (one row per partition)
give every slice its starting offset.

The range-partitioned, sorted data is fixed once with a reliable
``checkpoint()`` in the shared checkpoint folder. Without it, the branch that
counts rows per partition and the branch that numbers rows are pruned to
different columns, run separate range exchanges with separately sampled
bounds, and disagree about which rows are in which partition. The checkpoint
also cuts the lineage, so a lost executor does not re-run the range sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import hand_off, shared_root
from .quantiles import ranked_values


RANGE_PARTITIONS_CONF = "spark.wattflow.rangePartitions"


def range_partitions(df: DataFrame, n: int | None) -> int:
    """Range partitions: explicit ``n``, else ``spark.wattflow.rangePartitions``,
    else ``spark.sql.shuffle.partitions``.

    Range partitions are fixed by a checkpoint (not coalesced by AQE), so on a
    cluster set one of these so that input bytes / partitions is ~128 MB
    (about 800,000 for 100 TB). The optimizer's size estimate is not used: for
    joins and aggregates it is often off by orders of magnitude.
    """
    if n:
        return n
    conf = df.sparkSession.conf
    v = conf.get(RANGE_PARTITIONS_CONF, None) or conf.get("spark.sql.shuffle.partitions", "200")
    return max(int(v), 1)


def _fixed_ranges(df: DataFrame, order: Sequence[str | Column], parts: int) -> DataFrame:
    shared_root(df.sparkSession)  # make sure the checkpoint folder is configured
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranged.checkpoint(eager=True)


def _offsets(fixed: DataFrame) -> DataFrame:
    """Prefix counts per fixed range partition, as a small local table.

    One aggregate job; the result has one row per partition (bounded by the
    partition count, never by the data), so it is built once and broadcast
    from the driver. A derived broadcast would be recomputed in every branch
    that reads the index: ``spark_partition_id`` is nondeterministic, which
    stops Spark from reusing the exchange.
    """
    sizes = fixed.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect()
    rows, acc = [], 0
    for pid, n in sorted((int(r["_pid"]), int(r["_n"] or 0)) for r in sizes):
        rows.append((pid, acc))
        acc += n
    return fixed.sparkSession.createDataFrame(rows, "_pid int, _off bigint")


def global_index(df: DataFrame, order: Sequence[str | Column], out: str = "idx", n_parts: int | None = None) -> DataFrame:
    """Attach a 0-based position in the total order ``order`` (must be a total order).

    One range shuffle; inside each fixed partition the rows are already sorted,
    so ``monotonically_increasing_id`` minus the partition base is the local
    position; adding the partition's prefix count gives the global position.
    """
    fixed = _fixed_ranges(df, order, range_partitions(df, n_parts))
    offsets = _offsets(fixed)
    with_pos = fixed.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    )
    return (
        with_pos.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_pos"))
        .drop("_pid", "_pos", "_off")
    )


def tie_average_ranks(
    values: DataFrame,
    value_col: str,
    weight_col: str,
    out: str = "avg_rank",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Average rank (1-based, ties share the mean rank) for each distinct value of each group.

    ``values`` holds one row per (group, distinct value) with its multiplicity
    ``weight_col``. Rank = rows of the group strictly below the value +
    (mult + 1) / 2. Cells of values (``quantiles.ranked_values``) keep every sort bounded.
    """
    table = hand_off(values.withColumn("_v", F.col(value_col).cast("double")), "tie-ranks")
    ranked = ranked_values(table, weight_col, group_cols)
    return ranked.withColumn(out, F.col("_below") + (F.col(weight_col) + 1) / 2.0).drop("_v", "_cell", "_below")
