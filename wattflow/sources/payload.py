"""Wire payload encode/decode (S5, S16, S9 framing, F20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import WEATHER_PAYLOAD_SCHEMA
from ..functions.calendar import epoch_to_timestamp, parse_timestamp
from ..functions.scalar import nan_to_null


def decode_json(df: DataFrame, schema: T.StructType | str, value_col: str = "value") -> DataFrame:
    """``value`` bytes/text -> struct -> top-level columns; malformed -> NULL fields."""
    return df.select(F.from_json(F.col(value_col).cast("string"), schema).alias("_p")).select("_p.*")


def decode_weather(df: DataFrame, value_col: str = "value") -> DataFrame:
    """S5 + ST1: parse the weather payload and derive both clocks.

    ``timestamp`` (measured, wall clock, NTZ) comes from the ISO text;
    ``event_time`` (emitted, an instant) from the producer's epoch second.
    """
    return (
        decode_json(df, WEATHER_PAYLOAD_SCHEMA, value_col)
        .withColumn("timestamp", parse_timestamp("timestamp"))
        .withColumn("event_time", epoch_to_timestamp("weather_ts"))
    )


def weather_payload(df: DataFrame, ts_col: str = "timestamp", stamp_col: str = "weather_ts") -> Column:
    """The 9-field payload as JSON; missing values are explicit ``null``."""

    def num(c: str, cast: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x).cast(cast).alias(c) if cast == "int" else nan_to_null(x).alias(c)

    fields = [
        F.col("site_id").cast("int").alias("site_id"),
        F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        num("air_temperature", "double"),
        num("cloud_coverage", "int"),
        num("dew_temperature", "double"),
        num("sea_level_pressure", "double"),
        num("wind_direction", "int"),
        num("wind_speed", "double"),
        F.col(stamp_col).cast("int").alias("weather_ts"),
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def keyed_json(df: DataFrame, key_col: str) -> DataFrame:
    """key = the key column as text, value = the whole row as JSON."""
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"),
    )
