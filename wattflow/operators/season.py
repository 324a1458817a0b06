"""Per-site season flag from the site's own monthly temperatures (W1, F6, ST12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contract import OFF_PEAK, PEAK, SEASON_RANK_CUTOFF
from ..functions.calendar import fallback_season_flag
from ..runtime import hand_off
from .aggregate import monthly_mean


def month_labels(
    weather: DataFrame, ts_col: str = "timestamp", temp_col: str = "air_temperature", key: str = "site_id"
) -> DataFrame:
    """(site, month, season_flag). A month is ``peak`` when its mean is among the
    three hottest or three coldest distinct means of its site (``dense_rank``, so
    ties widen the set). Months whose mean is NULL are not ranked (D13).

    The rank windows run over the monthly aggregate: at most 12 rows per site.
    """
    monthly = monthly_mean(weather, temp_col, ts_col, key).where(F.col("avg_temp").isNotNull())
    hot = Window.partitionBy(key).orderBy(F.desc("avg_temp"))
    cold = Window.partitionBy(key).orderBy(F.asc("avg_temp"))
    return monthly.select(
        key,
        "month",
        F.when(
            (F.dense_rank().over(hot) <= SEASON_RANK_CUTOFF) | (F.dense_rank().over(cold) <= SEASON_RANK_CUTOFF),
            F.lit(PEAK),
        )
        .otherwise(F.lit(OFF_PEAK))
        .alias("season_flag"),
    )


def add_season_flag(
    weather: DataFrame, ts_col: str = "timestamp", temp_col: str = "air_temperature", key: str = "site_id"
) -> DataFrame:
    """W1 + J1: label every reading; an unranked (all-NULL) month takes the fallback."""
    # at most 12 rows per site; AQE broadcasts it from its measured size (batch)
    labels = month_labels(weather, ts_col, temp_col, key).withColumnRenamed("month", "_month")
    if weather.isStreaming:
        labels = hand_off(labels, "month-labels")
    return (
        weather.withColumn("_month", F.month(ts_col))
        .join(labels, [key, "_month"], "left")
        .withColumn("season_flag", F.coalesce(F.col("season_flag"), fallback_season_flag("_month")))
        .drop("_month")
    )


def season_flag_from_month(df: DataFrame, month_col: str = "month") -> DataFrame:
    """fallback label for a site never seen in training."""
    return df.withColumn("season_flag", fallback_season_flag(month_col))


def lookup_season(df: DataFrame, labels: DataFrame, month_col: str = "month", key: str = "site_id") -> DataFrame:
    """ST12: persisted (site, month) labels joined at inference; fallback when absent.

    ``labels`` is the static table written at training time; works on a stream.
    """
    lab = labels.select(key, F.col("month").alias("_m"), F.col("season_flag").alias("_lab"))
    if df.isStreaming and not lab.isStreaming:
        lab = hand_off(lab, "month-labels")
    out = df.join(lab, (df[key] == lab[key]) & (df[month_col] == lab["_m"]), "left").drop(lab[key])
    return out.withColumn("season_flag", F.coalesce(F.col("_lab"), fallback_season_flag(month_col))).drop("_m", "_lab")
