"""Distribution statistics and the paired signed-rank test."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import SIGNIFICANCE_LEVEL
from ..functions.normal import two_sided_p_sql
from ..runtime import hand_off
from .quantiles import same_groups, value_counts, wide_quantiles
from .ranks import tie_average_ranks

def correlation_matrix(df: DataFrame, cols: Sequence[str], dropna: bool = True) -> DataFrame:
    """Pearson correlation of every pair, long format, one aggregate over the full data."""
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if dropna:
        base = base.na.drop()
    aggs = [F.corr(a, b).alias(f"{a}__{b}") for a in cols for b in cols]
    row = base.agg(*aggs)
    pairs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr")) for a in cols for b in cols]
    return row.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def box_stats(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Quartiles, IQR fences and whiskers (extreme points inside the fences) per group.

    Quartiles are selected by radix (``exact_quantiles``); the whiskers are one more
    aggregate over the rows, with the fences (one row a group) joined on.
    """
    groups = list(group_cols)
    q = wide_quantiles(df, value_col, (0.25, 0.5, 0.75), groups, ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")).withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    values = df.select(*groups, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if groups:
        fenced = same_groups(values, q.select(*groups, "lo_fence", "hi_fence"), groups)
    else:
        # one row of fences: a scalar subquery, no join
        fenced = values.withColumn("_f", q.select(F.struct("lo_fence", "hi_fence")).scalar()).select("_v", "_f.*")
    v = F.col("_v")
    wh = fenced.groupBy(*groups).agg(
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_lo"), F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_hi"), F.count(v).alias("n")
    )
    if groups:
        return same_groups(q, wh, groups)
    return q.withColumn("_w", wh.select(F.struct("whisker_lo", "whisker_hi", "n")).scalar()).select(*q.columns, "_w.*")


def _group_table(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row a group, stored: the planner sees its size and sends a small one to the tasks, so that the counted values
    joined to it are not shuffled by group into a task a group."""
    return hand_off(df, "group-table") if groups else df


def histogram(df: DataFrame, value_col: str, bins: int = 60, density: bool = True, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over each group's [min, max]; every bin present.

    Bin i covers [min + i*w, min + (i+1)*w), the last bin is closed on the right.
    The ranges meet the counted distinct values, not the rows: as a scalar
    subquery without groups, else by a join that keeps NULL groups.
    """
    groups = list(group_cols)
    counts = value_counts(df, value_col, groups)
    rng = _group_table(counts.groupBy(*groups).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.sum("_n").alias("n")), groups)
    rng = rng.withColumn("width", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0)))
    if groups:
        ranged = same_groups(counts, rng.select(*groups, "lo", "width"), groups)
    else:
        ranged = counts.withColumn("_r", rng.select(F.struct("lo", "width")).scalar()).select("_v", "_n", "_r.*")
    slot = F.least(F.floor((F.col("_v") - F.col("lo")) / F.col("width")).cast("int"), F.lit(bins - 1))
    filled = ranged.groupBy(*groups, slot.alias("bin")).agg(F.sum("_n").alias("count"))
    spine = rng.where("n is not null").select(*groups, "lo", "width", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = same_groups(spine, filled, [*groups, "bin"], "left").fillna(0, subset=["count"])
    return out.select(
        *groups,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_hi"),
        "count",
        (F.col("count") / (F.col("n") * F.col("width"))).alias("density") if density else F.lit(None).alias("density"),
    )


def kernel_density(df: DataFrame, value_col: str, grid: int = 100, bandwidth: float | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density on a fixed grid per group, from every value.

    The density at grid point x is sum over values of phi((x - v) / h) / (n * h);
    bandwidth: Scott's rule (std * n^(-1/5)) unless given. All grid points are sums
    of one aggregate over the counted distinct values: ``grid`` sums a group, with
    partial sums before the shuffle, and no row is repeated.
    """
    groups = list(group_cols)
    counts = value_counts(df, value_col, groups)
    w, v = F.col("_n").cast("double"), F.col("_v")
    base = counts.groupBy(*groups).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum("_n").alias("n"), (F.sum(w * v) / F.sum(w)).alias("mean"))
    base = _group_table(base, groups)
    if groups:
        centred = same_groups(counts, base.select(*groups, "mean"), groups)
    else:
        centred = counts.withColumn("mean", base.select("mean").scalar())
    dev = centred.groupBy(*groups).agg(F.sum(w * (v - F.col("mean")) * (v - F.col("mean"))).alias("_ss"))
    stats = same_groups(base, dev, groups) if groups else base.withColumn("_ss", dev.scalar())
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1)))
    h = F.lit(float(bandwidth)) if bandwidth else sd * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    stats = stats.withColumn("h", F.when(h > 0, h).otherwise(F.lit(1.0))).select(
        *groups, "n", "h", (F.col("lo") - 3 * F.col("h")).alias("g_lo"), ((F.col("hi") - F.col("lo") + 6 * F.col("h")) / (grid - 1)).alias("g_step")
    )
    if groups:
        ready = same_groups(counts, _group_table(stats, groups), groups)
    else:
        ready = counts.withColumn("_s", stats.select(F.struct("n", "h", "g_lo", "g_step")).scalar()).select("_v", "_n", "_s.*")

    def bump(i: int) -> Column:
        z = (F.col("g_lo") + i * F.col("g_step") - v) / F.col("h")
        return F.sum(F.col("_n") * F.exp(-0.5 * z * z))

    sums = ready.groupBy(*groups, "n", "h", "g_lo", "g_step").agg(*[bump(i).alias(f"_k{i}") for i in range(grid)])
    scale = F.lit(math.sqrt(2 * math.pi)) * F.col("n") * F.col("h")
    points = F.array(*[F.struct(F.lit(i).alias("g"), (F.col("g_lo") + i * F.col("g_step")).alias("x"), (F.col(f"_k{i}") / scale).alias("density")) for i in range(grid)])
    return sums.select(*groups, F.explode(points).alias("p")).select(*groups, "p.*")


def signed_rank_tests(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Paired Wilcoxon signed-rank tests on d = a - b, zeros handled by Pratt.

    One row per named pair: n, n_zero, w_plus, w_minus, statistic (the smaller
    rank sum), mean, se, z. Zeros take part in ranking and are then dropped from
    the rank sums; the normal approximation gets Cureton's zero correction and
    the tie correction. All pairs are unpivoted and ranked in one grouped pass:
    aggregates over distinct |d| values plus distributed tie-averaged ranks (no
    single-task window).
    """
    diffs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), (F.col(a).cast("double") - F.col(b).cast("double")).alias("_d"))
            for name, (a, b) in pairs.items()
        ]
    )
    base = df.select(F.explode(diffs).alias("_x")).select("_x.*").where(F.col("_d").isNotNull() & ~F.isnan("_d"))
    per_abs = base.groupBy("metric", F.abs("_d").alias("_ad")).agg(
        F.count(F.lit(1)).alias("_t"),
        F.count_if(F.col("_d") > 0).alias("_np"),
        F.count_if(F.col("_d") < 0).alias("_nn"),
    )
    ranked = tie_average_ranks(per_abs, "_ad", "_t", out="_r", group_cols=["metric"])
    s = ranked.groupBy("metric").agg(
        F.sum("_t").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_ad") == 0, F.col("_t"))), F.lit(0)).alias("n_zero"),
        F.coalesce(F.sum(F.col("_np") * F.col("_r")), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum(F.col("_nn") * F.col("_r")), F.lit(0.0)).alias("w_minus"),
        F.coalesce(
            F.sum(F.when(F.col("_ad") > 0, F.col("_t").cast("double") * (F.col("_t").cast("double") ** 2 - 1))), F.lit(0.0)
        ).alias("_ties"),
    )
    n = F.col("n").cast("double")
    nz = F.col("n_zero").cast("double")
    mean = n * (n + 1) * 0.25 - nz * (nz + 1) * 0.25
    var24 = n * (n + 1) * (2 * n + 1) - nz * (nz + 1) * (2 * nz + 1) - 0.5 * F.col("_ties")
    s = s.select(
        "metric", "n", "n_zero", "w_plus", "w_minus",
        F.least("w_plus", "w_minus").alias("statistic"),
        mean.alias("mean"),
        F.sqrt(var24 / 24).alias("se"),
    )
    return s.withColumn("z", (F.col("statistic") - F.col("mean")) / F.col("se"))


def signed_rank_test(df: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """M17 for one pair (see ``signed_rank_tests``)."""
    return signed_rank_tests(df, {"d": (a_col, b_col)}).drop("metric")


def p_values(tests: DataFrame, z_col: str = "z") -> DataFrame:
    """``tests`` with the two-sided normal p-value of ``z_col``, as a column expression."""
    return tests.withColumn("p_value", F.expr(two_sided_p_sql(f"`{z_col}`")))


def paired_verdict(tests: DataFrame, z_col: str = "z", level: float = SIGNIFICANCE_LEVEL) -> DataFrame:
    """M19, per metric: significant when p < level, i.e. |z| beyond the two-sided critical value."""
    critical = NormalDist().inv_cdf(1 - level / 2)
    return tests.withColumn("significant", F.abs(F.col(z_col)) > F.lit(critical))


def combined_verdict(verdicts: DataFrame) -> DataFrame:
    """The models differ if any of the tests is significant."""
    return verdicts.agg(F.bool_or("significant").alias("models_differ"), F.count(F.lit(1)).alias("tests"))


def median_difference(df: DataFrame, a_col: str, b_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact median of a - b (per group)."""
    d = df.select(*group_cols, (F.col(a_col).cast("double") - F.col(b_col).cast("double")).alias("_d"))
    return wide_quantiles(d, "_d", (0.5,), list(group_cols), ["median_diff"])
