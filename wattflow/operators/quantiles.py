"""Exact quantiles (linear interpolation) and ranks without collecting a group in one task.

Quantiles are selected by radix. The first pass counts values by the leading digits of an
order-preserving code (sign and binary logarithm: some hundred buckets a group, counted
before the shuffle, each with its least and largest value). Only the bucket that holds a
wanted rank goes on: it is cut into PARTS even steps between its least and largest value,
or, once the buckets left hold few rows, into its distinct values. No table of all values
is written, sorted or ranked.

Ranks of all values (:func:`ranked_values`) need every value: distinct values are counted
(:func:`value_counts`) and cut into cells by bounds taken from a quantile sketch; a cell
of a group is the unit that one task sorts, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import hand_off

CELL_ROWS = 100_000  # distinct values that a cell holds on average
MOST_CELLS = 1 << 16  # bounds are one driver-side list: beyond this, cells grow instead
STEPS, FARTHEST = 32, 40_000  # buckets an octave; more than the buckets of all octaves
PARTS = 1 << 16
FEW_ROWS = 1 << 22  # rows in the buckets left over all groups: their distinct values are counted


def ranked_values(counts: DataFrame, weight: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``counts`` (one row for each group and distinct ``_v``) with ``_cell`` and ``_below``: the summed weight of smaller values of the group.

    ``counts`` is read several times: pass a stored table. The result is stored too.
    """
    groups = list(group_cols)
    cells = int(min(MOST_CELLS, max(1, counts.count() // CELL_ROWS)))
    # the bounds are fixed once: branches with bounds of their own would disagree about the cells
    probs = [i / cells for i in range(1, cells)]
    bounds = counts.select(F.percentile_approx("_v", probs, min(20 * cells, 1_000_000))).first()[0] if probs else None
    splits = [float("-inf"), *sorted(set(bounds or [])), float("inf")]
    placed = counts.withColumn("_cell", F.lit(0.0))
    if len(splits) > 2:
        placed = Bucketizer(splits=splits, inputCol="_v", outputCol="_cell").transform(counts)
    totals = placed.groupBy(*groups, "_cell").agg(F.sum(weight).alias("_t"))
    earlier = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*groups, "_cell", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    below = placed.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    ranked = same_groups(below, starts, [*groups, "_cell"]).withColumn("_below", F.col("_start") + F.col("_in")).drop("_start", "_in")
    return hand_off(ranked, "ranked-values")


def same_groups(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` that also matches NULL groups; ``cols`` appear once."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(other[f"_r_{c}"])
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in cols])


def value_counts(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Non-NULL, non-NaN values as ``(groups..., _v, _n)``, one row for each distinct value of a group; stored."""
    v = F.col(value_col).cast("double")
    base = df.select(*group_cols, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return hand_off(base.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def _code(v: Column) -> Column:
    """Order-preserving bucket of a number: its sign and 1 / STEPS of the binary logarithm of its size."""
    size = F.floor(STEPS * F.log2(F.abs(v))).cast("int") + FARTHEST
    far = F.abs(v) == float("inf")
    return F.when(v == 0, 0).when(far, F.when(v > 0, 2 * FARTHEST).otherwise(-2 * FARTHEST)).when(v > 0, size).otherwise(-size)


def _counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def _holding(counted: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """``counted`` with ``_below``, the rows in smaller buckets of ``step``: at most 4 * FARTHEST, PARTS or FEW_ROWS buckets meet in a window."""
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_below", F.coalesce(F.sum("_n").over(order), F.lit(0)))


def _selected(df: DataFrame, value_col: str, groups: Sequence[str], wanted: Column) -> DataFrame:
    """The values at wanted ranks: rows (groups..., want, frac, value, before), ``before`` being the rows of the rank's
    own value that come before it.

    ``wanted``: array of structs (want, frac, at), at = 0-based rank in the group, over the group
    columns and ``_all``, the group's number of values. NULL and NaN take no part. ``df`` is read
    once for each pass.
    """
    groups = list(groups)
    rows = df.select(*groups, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = rows.withColumn("_b0", _code(F.col("_v")))
    path, ends = ["_b0"], ["_n", "_lo", "_hi"]
    run = _holding(_counted(rows, [*groups, *path]), groups, "_b0").withColumn("_all", F.sum("_n").over(Window.partitionBy(*(groups or [F.lit(0)]))))
    here = (F.col("_at") >= F.col("_below")) & (F.col("_at") < F.col("_below") + F.col("_n"))
    within = (F.col("_at") - F.col("_below")).alias("_at")  # the rank counted from the bucket's start
    picks = run.withColumn("_w", F.explode(wanted)).withColumns({"_want": F.col("_w.want"), "_frac": F.col("_w.frac"), "_at": F.col("_w.at")})
    picks = hand_off(picks.where(here).select(*groups, *path, "_want", "_frac", within, *ends), "quantile-picks")
    few = False
    while not few:
        left = picks.where("_lo < _hi").select(*groups, *path, *ends).distinct()
        n_left = left.agg(F.sum("_n")).first()[0]
        if n_left is None:
            break
        few, step = n_left <= FEW_ROWS, f"_b{len(path)}"
        rows = same_groups(rows, left.drop("_n"), [*groups, *path])
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        rows = rows.withColumn(step, F.col("_v") if few else F.floor(share * PARTS).cast("int")).drop("_lo", "_hi")
        run = _holding(_counted(rows, [*groups, *path, step]), [*groups, *path], step)
        found = same_groups(run, picks.where("_lo < _hi").select(*groups, *path, "_want", "_frac", "_at"), [*groups, *path])
        done = picks.where("_lo = _hi").withColumn(step, F.lit(None).cast(run.schema[step].dataType))
        path = [*path, step]
        columns = [*groups, *path, "_want", "_frac"]
        found = found.where(here).select(*columns, within, *ends).unionByName(done.select(*columns, "_at", *ends))
        picks = hand_off(found, "quantile-picks")
    return picks.select(*groups, F.col("_want").alias("want"), F.col("_frac").alias("frac"), F.col("_lo").alias("value"), F.col("_at").alias("before"))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows (groups..., prob, value) with value = the continuous quantile, as ``quantile_cont``.

    Position p * (n - 1), linear between its floor and ceiling neighbours. NULL and
    NaN values take no part; NULL groups are one group. ``df`` is read once for each
    pass (two or three): pass a stored table if it is dear to compute.
    """
    wanted = []
    for p in probs:
        at = F.lit(float(p)) * (F.col("_all") - 1)
        for side, end in (("low", F.floor(at)), ("high", F.ceil(at))):
            wanted.append(F.struct(F.struct(F.lit(float(p)).alias("prob"), F.lit(side).alias("side")).alias("want"), (at - F.floor(at)).alias("frac"), end.alias("at")))
    ends = _selected(df, value_col, group_cols, F.array(*wanted))
    ends = ends.groupBy(*group_cols, F.col("want.prob").alias("prob")).agg(
        *[F.max(F.when(F.col("want.side") == side, F.col("value"))).alias(f"_{side}") for side in ("low", "high")], F.max("frac").alias("_frac")
    )
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")
    whole = (F.col("_low") == F.col("_high")) | (F.col("_frac") == 0)  # also where an end is infinite
    return ends.select(*group_cols, "prob", F.when(whole, F.col("_low")).otherwise(between).alias("value"))


def kth_smallest(df: DataFrame, value_col: str, k: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows (groups..., value, before): each group's ``k``-th smallest value (from 1; ``k`` over the group columns and
    ``_all``, the number of values) and how many rows of that very value rank before it. Groups with k out of range have no row."""
    wanted = F.array(F.struct(F.lit(0).alias("want"), F.lit(0.0).alias("frac"), (k - 1).cast("long").alias("at")))
    return _selected(df, value_col, group_cols, wanted).drop("want", "frac")


def pivot_quantiles(long: DataFrame, probs: Sequence[float], group_cols: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in probs]
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n) for p, n in zip(probs, names)]
    if group_cols:
        return long.groupBy(*group_cols).agg(*aggs)
    return long.agg(*aggs)


def wide_quantiles(
    df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (), names: Sequence[str] | None = None
) -> DataFrame:
    """Quantiles pivoted to one column per probability."""
    return pivot_quantiles(exact_quantiles(df, value_col, probs, group_cols), probs, group_cols, names)
