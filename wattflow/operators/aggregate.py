"""Grouped aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import OFF_PEAK, PEAK, SIX_HOUR_LABELS, STANDARD_BUCKETS
from ..functions.calendar import day_of, month_start, six_hour_block, six_hour_label, standard_bucket


def aggregate_energy(meters: DataFrame, ts_col: str = "ts") -> DataFrame:
    """A1: sum of all carriers per (building, interval, ts) -> ``agg_value`` (hourly grain kept).

    The interval label is a function of ``ts``, so the shuffle groups by
    (building, ts) only and the label is attached after the aggregation
    (narrower shuffle rows, same result).
    """
    agg = meters.groupBy("building_id", ts_col).agg(F.sum(F.col("value").cast("double")).alias("agg_value"))
    return agg.select("building_id", six_hour_label(ts_col).alias("interval"), ts_col, "agg_value")


def six_hour_block_totals(meters: DataFrame, ts_col: str = "ts", key: str = "building_id") -> DataFrame:
    """A2: true 6-hour block total per (key, date, interval): four rows per key-day at most.

    Grouped on the integer block (0-3); the label is attached after the aggregation.
    """
    agg = meters.groupBy(key, day_of(ts_col).alias("date"), six_hour_block(ts_col).alias("_block")).agg(
        F.sum(F.col("value").cast("double")).alias("agg_value")
    )
    label = F.element_at(F.array(*[F.lit(x) for x in SIX_HOUR_LABELS]), F.col("_block") + 1)
    return agg.select(key, "date", label.alias("interval"), "agg_value")


def monthly_mean(
    df: DataFrame, value_col: str = "air_temperature", ts_col: str = "timestamp", key: str = "site_id"
) -> DataFrame:
    """A3: mean of ``value_col`` per (key, calendar month)."""
    return df.groupBy(key, F.month(ts_col).alias("month")).agg(F.avg(F.col(value_col).cast("double")).alias("avg_temp"))


def peak_month_counts(labels: DataFrame, key: str = "site_id") -> DataFrame:
    """A4: per key, months flagged peak and months observed."""
    return labels.groupBy(key).agg(
        F.count(F.when(F.col("season_flag") == PEAK, F.lit(1))).alias("peak_months"),
        F.count(F.lit(1)).alias("observed_months"),
    )


def category_balance(df: DataFrame, col: str) -> DataFrame:
    """A5: rows per category (partial aggregation absorbs hot categories)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def monthly_season_totals(feature: DataFrame, ts_col: str = "ts", value_col: str = "agg_value") -> DataFrame:
    """Monthly totals per season flag."""
    return feature.groupBy(month_start(ts_col).alias("month"), "season_flag").agg(
        F.sum(value_col).alias("energy_kwh")
    )


def season_pivot(monthly: DataFrame, value_col: str = "energy_kwh") -> DataFrame:
    """Season flag -> columns (both always present), missing = 0."""
    return (
        monthly.groupBy("month")
        .pivot("season_flag", [PEAK, OFF_PEAK])
        .agg(F.sum(value_col))
        .na.fill(0.0, subset=[PEAK, OFF_PEAK])
    )


def daily_mean_with_spine(df: DataFrame, ts_col: str = "ts", value_col: str = "agg_value") -> DataFrame:
    """Daily mean over a full calendar spine (empty days kept as NULL).

    The spine spans the observed min..max day: its size is bounded by the
    calendar, not by the data volume.
    """
    base = df.where(F.col(ts_col).isNotNull() & F.col(value_col).isNotNull())
    daily = base.groupBy(day_of(ts_col).alias("day")).agg(F.avg(value_col).alias("daily_mean"))
    spine = base.agg(F.min(day_of(ts_col)).alias("lo"), F.max(day_of(ts_col)).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return spine.join(daily, "day", "left")


def use_by_season_top(
    feature: DataFrame, buildings: DataFrame, top: int = 10, key: str = "building_id"
) -> DataFrame:
    """Rows per primary use x season, pivoted, top ``top`` uses by row total."""
    joined = (
        feature.select(key, "season_flag")
        .na.drop()
        .join(buildings.select(key, "primary_use"), key, "left")
    )
    piv = (
        joined.groupBy("primary_use")
        .pivot("season_flag", [PEAK, OFF_PEAK])
        .agg(F.count(F.lit(1)))
        .na.fill(0, subset=[PEAK, OFF_PEAK])
    )
    return (
        piv.withColumn("total", F.col(PEAK) + F.col(OFF_PEAK))
        .orderBy(F.desc("total"), F.asc_nulls_last("primary_use"))
        .limit(top)
    )


def daily_site_energy(meters_with_site: DataFrame, ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """Metered energy per (site, day)."""
    return meters_with_site.groupBy("site_id", day_of(ts_col).alias("day")).agg(
        F.sum(F.col(value_col).cast("double")).alias("metered_energy")
    )


def bucket_means(totals: DataFrame, key: str = "building_id", ts_col: str = "window_start", value_col: str = "total_energy_6h") -> DataFrame:
    """Mean per key per standard 6-hour bucket, all four buckets present."""
    means = totals.groupBy(key, standard_bucket(ts_col).alias("bucket")).agg(F.avg(value_col).alias("mean_energy"))
    spine = totals.select(key).distinct().select(
        key, F.explode(F.array(*[F.lit(b) for b in STANDARD_BUCKETS])).alias("bucket")
    )
    return spine.join(means, [key, "bucket"], "left")


def key_totals(df: DataFrame, key: str, value_col: str, out: str = "total") -> DataFrame:
    """Per-key total."""
    return df.groupBy(key).agg(F.sum(value_col).alias(out))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per named frame, one job per frame, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def padded_range(df: DataFrame, key: str, value_col: str, pad_share: float = 0.1) -> DataFrame:
    """Per key min/max with padding pad = share * greatest(|min|, |max|, 1)."""
    r = df.groupBy(key).agg(F.min(value_col).alias("y_min"), F.max(value_col).alias("y_max"))
    pad = F.lit(pad_share) * F.greatest(F.abs("y_min"), F.abs("y_max"), F.lit(1.0))
    return r.select(key, "y_min", "y_max", (F.col("y_min") - pad).alias("lo"), (F.col("y_max") + pad).alias("hi"))
