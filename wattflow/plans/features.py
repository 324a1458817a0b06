"""Shared feature step and the two composed training frames (ST11, M22, M23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import IMPUTABLE_WEATHER, NUMERIC_INPUTS
from ..functions.calendar import day_of_week, log_area
from ..operators.aggregate import aggregate_energy
from ..operators.clean import add_label, normalise_missing, model_columns
from ..operators.joins import attach_buildings, attach_site, attach_weather
from ..operators.season import add_season_flag
from ..runtime import hand_off


def engineer(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """ST11: the model's inputs from joined weather and building columns, as doubles.

    Expressions only, so bounded and streaming frames take the same path.
    """
    own = {"hour": F.hour(ts_col), "day_of_week": day_of_week(ts_col), "month": F.month(ts_col), "log_sqft": log_area("square_feet")}
    as_double = {c: own.get(c, F.col(c) if c in df.columns else None) for c in NUMERIC_INPUTS}
    return df.withColumns({c: e.cast("double") for c, e in as_double.items() if e is not None})


def clean_weather(weather: DataFrame) -> DataFrame:
    """P10 applied to the six imputable weather columns (reference default zero rule)."""
    return normalise_missing(weather, IMPUTABLE_WEATHER)


def feature_frame(
    meters: DataFrame, buildings: DataFrame, weather: DataFrame, ts_col: str = "ts", materialize_weather: bool = True
) -> DataFrame:
    """Carrier sums (A1) -> site (J2) -> cleaned, season-flagged weather.

    Output columns: building_id, site_id, ts, interval, agg_value, season_flag
    and the six weather measures.

    The weather dimension (sites x hours, small next to the meters) is needed
    twice: for the per-site month ranking and for the join. With
    ``materialize_weather`` it is computed once and written to the shared folder,
    so the raw weather source is read once.
    """
    agg = aggregate_energy(meters, ts_col)
    with_site = attach_site(agg, buildings)
    cleaned = clean_weather(weather)
    if materialize_weather and not weather.isStreaming:
        cleaned = hand_off(cleaned, "weather")
    w = add_season_flag(cleaned, "timestamp").select(
        "site_id",
        "timestamp",
        "season_flag",
        "air_temperature",
        "dew_temperature",
        "sea_level_pressure",
        "wind_speed",
        "cloud_coverage",
        "wind_direction",
    )
    return attach_weather(with_site, w, ts_col, "timestamp").select(
        "building_id",
        "site_id",
        ts_col,
        "interval",
        "agg_value",
        "season_flag",
        "air_temperature",
        "dew_temperature",
        "sea_level_pressure",
        "wind_speed",
        "cloud_coverage",
        "wind_direction",
    )


def model_base(feature: DataFrame, buildings: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Building attributes (J4) + label (P15) + calendar/area features (F2, F3) -> P1.

    Uses the cleaned weather already in ``feature`` (D16); gaps are left for the
    pipeline's imputer (D17).
    """
    base = attach_buildings(feature, buildings.select("building_id", "primary_use", "square_feet", "floor_count", "year_built"))
    return model_columns(engineer(add_label(base), ts_col))
