"""Catalog: sources (S*), projections and cleaning (P*), scalar functions (F*)."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import IMPUTABLE_WEATHER, METERS_SCHEMA
from ..functions import calendar as cal
from ..functions import scalar as sc
from ..operators import clean as P
from ..sources import files as S
from ..sources import tables as R
from ..sources.payload import decode_json, keyed_json
from . import frames as X
from .frames import r, sql
from .registry import query

SIX_COLS = ", ".join(IMPUTABLE_WEATHER)

EVENTS_DECLARED = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


# ------------------------------------------------------------------ sources
@query("s1_typed_scan", sql("SELECT building_id, meter_type, ts, value FROM meters", "meters"))
def s1(spark, d):
    raw = S.typed_scan(spark, R.table_path(d, "events"), EVENTS_DECLARED, fmt="parquet")
    return raw.select(
        F.col("user_id").cast("bigint").alias("building_id"),
        F.col("event_type").alias("meter_type"),
        cal.hour_start("ts").alias("ts"),
        "value",
    )


@query(
    "s2_required_keys",
    sql(
        "SELECT building_id, meter_type, ts, value FROM (SELECT nullif(building_id, 0) AS building_id, meter_type, ts, value "
        "FROM meters) WHERE building_id IS NOT NULL AND ts IS NOT NULL",
        "meters",
    ),
)
def s2(spark, d):
    m = R.meters(spark, d).withColumn("building_id", F.nullif(F.col("building_id"), F.lit(0)))
    return S.require_keys(m, ["building_id", "ts"])


_S3_ROWS = [
    ("meters", "building_id", "bigint", "bigint"),
    ("meters", "meter_type", "string", "string"),
    ("meters", "ts", "timestamp", "timestamp_ntz"),
    ("meters", "value", "decimal(18,3)", "double"),
    ("meters", "row_id", "int", None),
]


def _s3_sql() -> str:
    parts = []
    for ds, f, dt, lt in _S3_ROWS:
        lt_sql = f"'{lt}'" if lt else "CAST(NULL AS VARCHAR)"
        ok = "true" if dt == lt else "false"
        parts.append(
            f"SELECT '{ds}' AS dataset, (SELECT count(*) FROM meters) AS n_rows, '{f}' AS field, "
            f"'{dt}' AS declared_type, {lt_sql} AS loaded_type, {ok} AS ok"
        )
    return sql(" UNION ALL ".join(parts), "meters")


@query("s3_load_verification", _s3_sql())
def s3(spark, d):
    return S.load_report({"meters": (R.meters(spark, d), METERS_SCHEMA)})


@query(
    "s5_json_decode",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def s5(spark, d):
    ev = R.read_table(spark, d, "events").select("event_id", F.col("props").alias("value"))
    parsed = ev.select("event_id", F.from_json("value", "k int").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"))


@query(
    "s9_keyed_json",
    sql(
        "SELECT CAST(site_id AS VARCHAR) AS key, site_id, round(total_energy_day, 3) AS total_energy_day, "
        "CAST(day_start AS DATE) AS day FROM daily_pred",
        "daily_pred",
    ),
)
def s9(spark, d):
    kv = keyed_json(X.daily_pred(spark, d), "site_id")
    back = kv.select("key", F.from_json("value", "site_id int, total_energy_day double, day_start string").alias("v"))
    return back.select(
        "key",
        F.col("v.site_id").alias("site_id"),
        F.round("v.total_energy_day", 3).alias("total_energy_day"),
        cal.day_key("v.day_start").cast("date").alias("day"),
    )


# ------------------------------------------------------------------ projections / cleaning
@query(
    "p1_model_inputs",
    sql(
        "SELECT f.air_temperature, f.dew_temperature, f.sea_level_pressure, f.wind_speed, "
        "round(ln(1 + CAST(b.square_feet AS DOUBLE)), 9) AS log_sqft, CAST(b.floor_count AS DOUBLE) AS floor_count, "
        "CAST(b.year_built AS DOUBLE) AS year_built, CAST(hour(f.ts) AS DOUBLE) AS hour, "
        "CAST(dayofweek(f.ts) + 1 AS DOUBLE) AS day_of_week, CAST(month(f.ts) AS DOUBLE) AS month, "
        "b.primary_use, f.season_flag, f.building_id "
        "FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id",
        "feature", "buildings",
    ),
)
def p1(spark, d):
    from ..operators.joins import attach_buildings
    from ..plans.features import engineer

    b = R.buildings(spark, d).select("building_id", "primary_use", "square_feet", "floor_count", "year_built")
    out = P.model_columns(engineer(attach_buildings(X.feature(spark, d), b)), trace=["building_id"])
    return out.select(*[F.round(c, 9).alias(c) if c == "log_sqft" else F.col(c) for c in out.columns])


@query("p2_align_time", sql("SELECT site_id, timestamp AS ts, air_temperature FROM weather", "weather"))
def p2(spark, d):
    return P.align_time(R.weather(spark, d), "timestamp", "ts").select("site_id", "ts", "air_temperature")


@query("p3_drop_nulls", sql(f"SELECT site_id, timestamp, {SIX_COLS} FROM wclean WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in IMPUTABLE_WEATHER), "wclean"))
def p3(spark, d):
    return P.drop_nulls(X.wclean(spark, d), list(IMPUTABLE_WEATHER))


@query("p4_not_null", sql("SELECT site_id, timestamp, air_temperature FROM weather WHERE air_temperature IS NOT NULL", "weather"))
def p4(spark, d):
    return P.where_not_null(R.weather(spark, d), ["air_temperature"]).select("site_id", "timestamp", "air_temperature")


@query("p5_sample", sql("SELECT event_id, building_id FROM readings WHERE " + P.split_sql(["event_id"], 0.0, 0.05), "readings"))
def p5(spark, d):
    """P5: a seeded 5 % sample by key hash, the same rows in every run (``sample_rows`` is the unkeyed form)."""
    return P.hash_sample(X.readings(spark, d), ["event_id"], 0.05).select("event_id", "building_id")


_STRATA = {"view": 0.1, "click": 0.1, "error": 0.2, "signup": 0.2, "purchase": 0.3}


_QUOTA_SQL = "CASE meter_type " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in _STRATA.items()) + " ELSE 0 END"


@query(
    "p6_stratified_sample",
    sql(
        "SELECT event_id, meter_type FROM (SELECT event_id, meter_type, row_number() OVER (PARTITION BY meter_type ORDER BY " + P.unit_sql(["event_id"])
        + f", event_id) AS k, floor({_QUOTA_SQL} * count(*) OVER (PARTITION BY meter_type)) AS quota FROM readings) WHERE k <= quota",
        "readings",
    ),
)
def p6(spark, d):
    """Each stratum's exact quota, the readings of smallest key hash."""
    return P.stratified_sample(X.readings(spark, d), "meter_type", _STRATA, ["event_id"]).select("event_id", "meter_type")


@query(
    "p7_hash_split",
    sql("SELECT CASE WHEN " + P.split_sql(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 0.0, 0.8) + " THEN 'train' ELSE 'test' END AS part, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM pairs", "pairs"),
)
def p7(spark, d):
    train, test = P.hash_split(X.pairs(spark, d), X.PAIR_KEY, (0.8, 0.2))
    return train.select(F.lit("train").alias("part"), *X.PAIR_KEY).unionByName(test.select(F.lit("test").alias("part"), *X.PAIR_KEY))


@query("p8_drop_columns", sql("SELECT site_id, building_id, primary_use, square_feet FROM buildings", "buildings"))
def p8(spark, d):
    return P.drop_columns(R.buildings(spark, d), ["floor_count", "year_built"])


@query(
    "p9_one_per_building",
    sql(
        "SELECT building_id, meter_type, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY building_id "
        "ORDER BY ts, meter_type, value) AS rn FROM meters) WHERE rn = 1",
        "meters",
    ),
)
def p9(spark, d):
    return P.one_per_key(R.meters(spark, d), ["building_id"], ["ts", "meter_type", "value"])


def _p10_sql() -> str:
    cols = []
    for c in IMPUTABLE_WEATHER:
        num = f"TRY_CAST(trim({c}) AS DOUBLE)"
        zero = "" if c == "wind_direction" else f" WHEN {num} = 0 THEN NULL"
        cols.append(
            f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower(trim({c})) = 'null' THEN NULL{zero} ELSE {num} END AS {c}"
        )
    return sql(f"SELECT site_id, timestamp, {', '.join(cols)} FROM weather_text", "weather_text")


@query("p10_normalise_missing", _p10_sql(), headline=True)
def p10(spark, d):
    return P.normalise_missing(R.weather_text(spark, d), list(IMPUTABLE_WEATHER))


@query(
    "p11_cast_double",
    sql("SELECT site_id, timestamp, CAST(cloud_coverage AS DOUBLE) AS cloud_coverage, CAST(wind_direction AS DOUBLE) AS wind_direction FROM weather", "weather"),
)
def p11(spark, d):
    return P.cast_double(R.weather(spark, d).select("site_id", "timestamp", "cloud_coverage", "wind_direction"), ["cloud_coverage", "wind_direction"])


@query(
    "p12_fill_constants",
    sql("SELECT site_id, timestamp, coalesce(cloud_coverage, 0.0) AS cloud_coverage, coalesce(air_temperature, 0.0) AS air_temperature FROM wclean", "wclean"),
)
def p12(spark, d):
    w = X.wclean(spark, d).select("site_id", "timestamp", "cloud_coverage", "air_temperature")
    return P.fill_constants(w, {"cloud_coverage": 0.0, "air_temperature": 0.0})


@query(
    "p13_fill_means",
    sql(
        "SELECT site_id, timestamp, "
        + ", ".join(f"coalesce({c}, round((SELECT avg({c}) FROM wclean), 6)) AS {c}" for c in IMPUTABLE_WEATHER)
        + " FROM wclean",
        "wclean",
    ),
)
def p13(spark, d):
    w = X.wclean(spark, d)
    flags = w.select("*", *[F.col(c).isNull().alias(f"_miss_{c}") for c in IMPUTABLE_WEATHER])
    out = P.fill_means(flags, list(IMPUTABLE_WEATHER))
    # filled means are rounded (float sums differ by engine); observed values stay exact
    return out.select(
        "site_id", "timestamp",
        *[F.when(F.col(f"_miss_{c}"), F.round(c, 6)).otherwise(F.col(c)).alias(c) for c in IMPUTABLE_WEATHER],
    )


@query("p14_repartition", sql("SELECT building_id, meter_type, ts, value FROM meters", "meters"))
def p14(spark, d):
    return P.repartition_for_fit(R.meters(spark, d), None, "building_id")


@query(
    "p15_label",
    sql("SELECT building_id, interval, ts, round(agg_value, 6) AS agg_value, round(CAST(agg_value AS DOUBLE), 6) AS label FROM agg_daily", "agg_daily"),
)
def p15(spark, d):
    from ..operators.aggregate import aggregate_energy

    out = P.add_label(aggregate_energy(R.meters_daily(spark, d)))
    return out.select("building_id", "interval", "ts", r("agg_value"), r("label"))


@query(
    "p16_isin_months",
    sql("SELECT site_id, count(*) AS n_rows FROM weather WHERE month(timestamp) IN (12, 1, 2, 6, 7, 8) GROUP BY site_id", "weather"),
)
def p16(spark, d):
    w = R.weather(spark, d)
    return w.where(P.in_set(F.month("timestamp"), (12, 1, 2, 6, 7, 8))).groupBy("site_id").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ scalar functions
@query("f1_six_hour_label", sql("SELECT building_id, ts, " + X.SIX_LABEL_SQL.format(t="ts") + " AS interval FROM readings", "readings"), headline=True)
def f1(spark, d):
    return cal.add_six_hour_interval(X.readings(spark, d).select("building_id", "ts"), "ts")


@query(
    "f2_calendar_parts",
    sql(
        "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, "
        "CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year FROM readings",
        "readings",
    ),
)
def f2(spark, d):
    x = X.readings(spark, d)
    return x.select("event_id", F.hour("ts").alias("hour"), cal.day_of_week("ts").alias("day_of_week"), F.month("ts").alias("month"), F.year("ts").alias("year"))


@query("f3_log_area", sql("SELECT building_id, square_feet, round(ln(1 + CAST(square_feet AS DOUBLE)), 9) AS log_sqft FROM buildings", "buildings"))
def f3(spark, d):
    b = R.buildings(spark, d)
    return b.select("building_id", "square_feet", F.round(cal.log_area("square_feet"), 9).alias("log_sqft"))


@query(
    "f4_building_age",
    sql(
        "SELECT m.event_id, CAST(year(m.ts) - b.year_built AS INTEGER) AS age, "
        "CAST(greatest(year(m.ts) - b.year_built, 0) AS INTEGER) AS age_clamped "
        "FROM readings m LEFT JOIN buildings b ON m.building_id = b.building_id",
        "readings", "buildings",
    ),
)
def f4(spark, d):
    from ..operators.joins import attach_buildings

    m = attach_buildings(X.readings(spark, d), R.buildings(spark, d).select("building_id", "year_built"))
    return m.select("event_id", cal.building_age("ts", "year_built").alias("age"), cal.building_age("ts", "year_built", clamp=True).alias("age_clamped"))


@query(
    "f5_calendar_season",
    sql(
        "SELECT site_id, timestamp, CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'Summer' WHEN month(timestamp) IN (3, 4, 5) "
        "THEN 'Autumn' WHEN month(timestamp) IN (6, 7, 8) THEN 'Winter' WHEN month(timestamp) IN (9, 10, 11) THEN 'Spring' END AS season "
        "FROM weather",
        "weather",
    ),
)
def f5(spark, d):
    return R.weather(spark, d).select("site_id", "timestamp", cal.calendar_season(F.month("timestamp")).alias("season"))


@query("f6_fallback_season", sql("SELECT site_id, timestamp, " + X.FALLBACK_SQL.format(m="month(timestamp)") + " AS season_flag FROM weather", "weather"))
def f6(spark, d):
    return R.weather(spark, d).select("site_id", "timestamp", cal.fallback_season_flag(F.month("timestamp")).alias("season_flag"))


@query(
    "f7_epoch_to_timestamp",
    "SELECT event_id, epoch_s, make_timestamp(epoch_s * 1000000) AS event_time FROM "
    "(SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events)",
)
def f7(spark, d):
    ev = R.read_table(spark, d, "events")
    # epoch seconds of the wall-clock reading taken as UTC, computed without the session zone
    epoch = (F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))).alias("epoch_s")
    x = ev.select("event_id", epoch)
    return x.select("event_id", "epoch_s", cal.epoch_to_utc_ntz("epoch_s").alias("event_time"))


@query(
    "f8_parse_timestamp",
    "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS TIMESTAMP) AS parsed FROM events",
)
def f8(spark, d):
    ev = R.read_table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.lit("not-a-time")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return ev.select("event_id", cal.parse_timestamp(text).alias("parsed"))


@query(
    "f9_day_and_month",
    sql("SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('month', ts) AS month_start FROM readings", "readings"),
)
def f9(spark, d):
    return X.readings(spark, d).select("event_id", cal.day_of("ts").alias("day"), cal.month_start("ts").alias("month_start"))


@query(
    "f10_missing_text",
    sql(
        "SELECT site_id, timestamp, (cloud_coverage IS NULL OR trim(cloud_coverage) = '' OR lower(trim(cloud_coverage)) = 'null') AS cloud_missing, "
        "(wind_direction IS NULL OR trim(wind_direction) = '' OR lower(trim(wind_direction)) = 'null') AS wind_direction_missing FROM weather_text",
        "weather_text",
    ),
)
def f10(spark, d):
    w = R.weather_text(spark, d)
    return w.select("site_id", "timestamp", sc.is_missing_text("cloud_coverage").alias("cloud_missing"), sc.is_missing_text("wind_direction").alias("wind_direction_missing"))


@query(
    "f11_clip_at_zero",
    sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(greatest(pred_a - label, 0), 6) AS over_forecast FROM pairs", "pairs"),
)
def f11(spark, d):
    p = X.pairs(spark, d)
    return p.select(*X.PAIR_KEY, F.round(sc.clip_at_zero(F.col("pred_a") - F.col("label")), 6).alias("over_forecast"))


@query(
    "f12_abs_pow_sqrt_round",
    sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(rel), 9) AS abs_err, "
        "round(pow(rel, 2), 9) AS sq_err, round(sqrt(abs(rel)), 9) AS root_abs_err, "
        + X.DR("rel", 3) + " AS err3 FROM (SELECT *, (pred_a - label) / label AS rel FROM pairs)",
        "pairs",
    ),
)
def f12(spark, d):
    p = X.pairs(spark, d)
    e = (F.col("pred_a") - F.col("label")) / F.col("label")  # relative error
    return p.select(*X.PAIR_KEY, F.round(F.abs(e), 9).alias("abs_err"), F.round(F.pow(e, 2), 9).alias("sq_err"), F.round(F.sqrt(F.abs(e)), 9).alias("root_abs_err"), sc.round3(e).alias("err3"))


@query(
    "f13_generation_time",
    sql(
        "SELECT building_id, CAST(ts AS DATE) AS date, " + X.SIX_LABEL_SQL.format(t="ts") + " AS interval, round(sum(value), 6) AS agg_value, TRUE AS stamped FROM meters GROUP BY ALL",
        "meters",
    ),
)
def f13(spark, d):
    """every emitted total carries a generation time, not before the run began."""
    from ..operators.aggregate import six_hour_block_totals

    started = F.lit(datetime.now(UTC))
    out = six_hour_block_totals(R.meters(spark, d)).withColumn("gen_ts", F.current_timestamp())
    return out.select("building_id", "date", "interval", r("agg_value"), (F.col("gen_ts") >= started).alias("stamped"))


_F14_SQL = sql(
    "SELECT site_id, day_start, total_energy_day FROM daily_pred",
    "daily_pred",
)


@query("f14_json_alternatives", _F14_SQL)
def f14(spark, d):
    dp = X.daily_pred(spark, d)
    # producers disagree on field names: the name used depends on the record
    alt = F.pmod(F.col("site_id"), F.lit(3))
    site_name = F.when(alt == 0, "site_id").when(alt == 1, "siteId").otherwise("siteID")
    tot_name = F.when(alt == 0, "total_energy_day").when(alt == 1, "total_energy").otherwise("kwh_day")
    rec = dp.select(
        F.to_json(F.create_map(site_name, F.col("site_id").cast("string"), tot_name, F.col("total_energy_day").cast("string"), F.lit("day_start"), F.date_format("day_start", "yyyy-MM-dd'T'HH:mm:ss"))).alias("value")
    )
    v = F.col("value")
    return rec.select(
        sc.first_present(v, ("site_id", "siteId", "siteID"), "int").alias("site_id"),
        sc.first_present(v, ("day_start",)).try_cast("timestamp_ntz").alias("day_start"),
        sc.first_present(v, ("total_energy_day", "total_energy", "sum_day", "kwh_day", "prediction"), "double").alias("total_energy_day"),
    )


@query("f15_day_key", sql("SELECT site_id, strftime(day_start, '%Y-%m-%d') AS day FROM daily_pred", "daily_pred"))
def f15(spark, d):
    dp = X.daily_pred(spark, d).select("site_id", F.date_format("day_start", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    return dp.select("site_id", cal.day_key("iso").alias("day"))


@query(
    "f16_standard_bucket",
    sql(
        "SELECT building_id, window_start, CASE WHEN hour(window_start) <= 5 THEN '00:00–06:00' WHEN hour(window_start) <= 11 "
        "THEN '06:00–12:00' WHEN hour(window_start) <= 17 THEN '12:00–18:00' WHEN hour(window_start) <= 23 THEN '18:00–24:00' END AS bucket FROM six_totals",
        "six_totals",
    ),
)
def f16(spark, d):
    from ..plans.totals import SIX_HOURS, window_totals

    t = window_totals(X.readings(spark, d), SIX_HOURS, "ts", "value")
    return t.select("building_id", "window_start", cal.standard_bucket("window_start").alias("bucket"))


@query(
    "f17_nan_to_null",
    "SELECT event_id, CASE WHEN value < 250 THEN NULL ELSE round(sqrt(value - 250), 9) END AS excess_root FROM events",
)
def f17(spark, d):
    ev = R.read_table(spark, d, "events")
    return ev.select("event_id", F.round(sc.nan_to_null(F.sqrt(F.col("value") - 250)), 9).alias("excess_root"))


@query(
    "f18_ape_sle",
    sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(label - pred_a) / (label + 1e-9), 9) AS ape, "
        "round(pow(ln(1 + greatest(pred_a, 0)) - ln(1 + greatest(label, 0)), 2), 9) AS sle FROM pairs",
        "pairs",
    ),
)
def f18(spark, d):
    p = X.pairs(spark, d)
    return p.select(*X.PAIR_KEY, F.round(sc.abs_pct_error("label", "pred_a"), 9).alias("ape"), F.round(sc.squared_log_error("label", "pred_a"), 9).alias("sle"))


@query(
    "f19_sign_class",
    sql(
        "SELECT p.site_id, CAST(p.day_start AS DATE) AS day, CASE WHEN p.total_energy_day - m.metered_energy < 0 THEN 'shortfall' "
        "ELSE 'excess' END AS direction FROM daily_pred p JOIN metered_site_day m ON p.site_id = m.site_id AND CAST(p.day_start AS DATE) = m.day",
        "daily_pred", "metered_site_day",
    ),
)
def f19(spark, d):
    from ..plans.serving import daily_shortfall

    s = daily_shortfall(X.daily_pred(spark, d), X.metered_site_day(spark, d))
    return s.select("site_id", "day", sc.sign_class("shortfall").alias("direction"))


@query("f20_json_roundtrip", sql("SELECT building_id, meter_type, ts, value FROM meters", "meters"))
def f20(spark, d):
    m = R.meters(spark, d)
    js = m.select(sc.row_json().alias("j"))
    return decode_json(js, m.schema, "j")



BUILDINGS_DECLARED = T.StructType(
    [
        T.StructField("site_id", T.IntegerType(), False),
        T.StructField("building_id", T.LongType(), False),
        T.StructField("primary_use", T.StringType(), True),
        T.StructField("square_feet", T.IntegerType(), True),
        T.StructField("floor_count", T.IntegerType(), True),
        T.StructField("year_built", T.IntegerType(), True),
    ]
)


@query("s1_typed_csv_scan", sql("SELECT * FROM buildings", "buildings"))
def s1csv(spark, d):
    """S1 + S2 on CSV: the building table exported as CSV with a header, read back
    with the declared schema (header checked against it, no inference), keys enforced."""
    from ..runtime import scratch_dir

    path = scratch_dir(spark, "s1-buildings-csv")
    R.buildings(spark, d).write.option("header", True).csv(path)
    return S.require_keys(S.typed_scan(spark, path, BUILDINGS_DECLARED, fmt="csv"), ["site_id", "building_id"])


@query(
    "s18_persist_reuse",
    sql(
        "SELECT 'season_flag' AS \"column\", coalesce(CAST(season_flag AS VARCHAR), 'NULL') AS value, count(*) AS count FROM feature GROUP BY 2 "
        "UNION ALL SELECT 'interval', coalesce(interval, 'NULL'), count(*) FROM feature GROUP BY 2",
        "feature",
    ),
)
def s18(spark, d):
    """A frame read by two aggregates is computed once, into the shared folder, instead of twice."""
    from ..operators.profile import value_counts_with_null
    from ..runtime import hand_off

    f = hand_off(X.feature(spark, d).select("season_flag", "interval"), "s18-feature")
    a = value_counts_with_null(f, "season_flag").select(F.lit("season_flag").alias("column"), "value", "count")
    b = value_counts_with_null(f, "interval").select(F.lit("interval").alias("column"), "value", "count")
    return a.unionByName(b)


@query(
    "f14_six_hour_json",
    sql("SELECT building_id, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS window_label, total_energy_6h FROM six_totals", "six_totals"),
)
def f14b(spark, d):
    """F14 on six-hour records: totals republished as JSON under producer-specific
    field names (window_start/window_label, total_energy_6h/sum_6hr/kwh6h), decoded back."""
    from ..plans.serving import decode_six_hour_record
    from ..plans.totals import SIX_HOURS, window_totals

    t = window_totals(X.readings(spark, d), SIX_HOURS, "ts", "value")
    alt = F.pmod(F.col("building_id"), F.lit(3))
    label_name = F.when(alt == 0, "window_start").otherwise("window_label")
    total_name = F.when(alt == 0, "total_energy_6h").when(alt == 1, "sum_6hr").otherwise("kwh6h")
    rec = t.select(
        F.to_json(
            F.create_map(
                F.lit("building_id"), F.col("building_id").cast("string"),
                label_name, F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"),
                total_name, F.col("total_energy_6h").cast("string"),
            )
        ).alias("value")
    )
    return decode_six_hour_record(rec)
