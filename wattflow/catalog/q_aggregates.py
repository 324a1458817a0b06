"""Catalog: aggregations (A*), joins (J*), windows (W*), sort/top-k/union (T*, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import IMPUTABLE_WEATHER, OFF_PEAK, PEAK
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import profile as PR
from ..operators import stats as ST
from ..operators import topk as T
from ..operators import windows as W
from ..operators.quantiles import same_groups
from ..operators.ranks import global_index, tie_average_ranks
from ..operators.season import add_season_flag, month_labels
from ..plans import serving as SV
from ..plans.totals import SIX_HOURS, window_totals
from ..sources import tables as R
from . import frames as X
from .frames import DR, dr, sql
from ..operators.clean import unit_sql
from ..runtime import hand_off
from .registry import query

SIX = list(IMPUTABLE_WEATHER)
LBL = X.SIX_LABEL_SQL


# ------------------------------------------------------------------ aggregations
@query(
    "a1_carrier_sum",
    sql(f"SELECT building_id, {LBL.format(t='ts')} AS interval, ts, round(sum(value), 6) AS agg_value FROM meters GROUP BY ALL", "meters"),
    headline=True,
)
def a1(spark, d):
    return A.aggregate_energy(R.meters(spark, d)).select("building_id", "interval", "ts", F.round("agg_value", 6).alias("agg_value"))


@query(
    "a2_six_hour_totals",
    sql(
        f"SELECT building_id, CAST(ts AS DATE) AS date, {LBL.format(t='ts')} AS interval, round(sum(value), 6) AS agg_value "
        "FROM meters GROUP BY ALL",
        "meters",
    ),
    headline=True,
)
def a2(spark, d):
    out = A.six_hour_block_totals(R.meters(spark, d))
    return out.select("building_id", "date", "interval", F.round("agg_value", 6).alias("agg_value"))


@query("a3_monthly_mean", sql(f"SELECT site_id, month, {DR('avg_temp')} AS avg_temp FROM monthly", "monthly"))
def a3(spark, d):
    return A.monthly_mean(X.wclean(spark, d)).select("site_id", "month", dr("avg_temp"))


@query(
    "a4_peak_month_counts",
    sql("SELECT site_id, count(*) FILTER (WHERE season_flag = 'peak') AS peak_months, count(*) AS observed_months FROM season_labels GROUP BY site_id", "season_labels"),
)
def a4(spark, d):
    return A.peak_month_counts(month_labels(X.wclean(spark, d)))


@query("a5_category_balance", sql("SELECT primary_use, count(*) AS count FROM buildings GROUP BY primary_use", "buildings"))
def a5(spark, d):
    return A.category_balance(R.buildings(spark, d), "primary_use")


_W_COLS = ["site_id", "timestamp", "air_temperature", "cloud_coverage", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]


def _a6_sql() -> str:
    parts = []
    for c in _W_COLS:
        zeros = "NULL" if c == "timestamp" else f"count(*) FILTER (WHERE {c} = 0)"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, CAST({zeros} AS BIGINT) AS zeros FROM weather")
    return sql(" UNION ALL ".join(parts), "weather")


@query("a6_nulls_zeros", _a6_sql())
def a6(spark, d):
    return PR.nulls_zeros(R.weather(spark, d))


def _a7_sql() -> str:
    parts = []
    for c in _W_COLS:
        zeros = "0" if c == "timestamp" else f"count(*) FILTER (WHERE {c} = 0)"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) + {zeros} AS missing_total FROM weather")
    return sql(" UNION ALL ".join(parts), "weather")


@query("a7_combined_missing", _a7_sql())
def a7(spark, d):
    return PR.combined_missing(R.weather(spark, d))


@query(
    "a8_missing_after",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing, count({c}) AS non_null, count({c}) = 0 AS fully_missing FROM wclean"
            for c in SIX
        ),
        "wclean",
    ),
)
def a8(spark, d):
    return PR.missing_after(X.wclean(spark, d), SIX)


@query(
    "a9_inspection_table",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, {DR(f'avg({c})', 3)} AS mean, {DR(f'stddev_samp({c})', 3)} AS stddev, "
            f"{DR(f'min({c})', 3)} AS min, {DR(f'max({c})', 3)} AS max FROM wclean"
            for c in SIX
        ),
        "wclean",
    ),
)
def a9(spark, d):
    return PR.inspection_table(X.wclean(spark, d), SIX)


_FEAT_NUM = ["building_id", "site_id", "agg_value", "air_temperature", "dew_temperature", "sea_level_pressure", "wind_speed", "cloud_coverage", "wind_direction"]


def _a10_sql() -> str:
    parts = []
    for c in _FEAT_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({x}) AS DOUBLE) AS count, {DR(f'avg({x})')} AS mean, {DR(f'stddev_samp({x})')} AS stddev, "
            f"min({x}) AS min, max({x}) AS max, {DR(f'quantile_cont({x}, 0.25)')} AS p25, {DR(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{DR(f'quantile_cont({x}, 0.75)')} AS p75 FROM feature"
        )
    return sql(" UNION ALL ".join(parts), "feature")


@query("a10_numeric_summary", _a10_sql(), headline=True)
def a10(spark, d):
    # the joined frame is dear: its numeric columns are written once and read by every pass
    s = PR.numeric_summary(hand_off(X.feature(spark, d).select(*_FEAT_NUM), "a10-columns"), _FEAT_NUM)
    return s.select("column", "count", dr("mean"), dr("stddev"), "min", "max", dr("p25"), dr("p50"), dr("p75"))


@query(
    "a11_top_values",
    sql(
        "SELECT \"column\", value, count, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value ASC NULLS LAST) AS rank "
        "FROM (SELECT 'interval' AS \"column\", interval AS value, count(*) AS count FROM feature GROUP BY ALL UNION ALL "
        "SELECT 'season_flag', season_flag, count(*) FROM feature GROUP BY ALL)) WHERE rank <= 5",
        "feature",
    ),
)
def a11(spark, d):
    return PR.top_values(X.feature(spark, d), ["interval", "season_flag"], 5)


def _a12_sql() -> str:
    num = ["building_id", "site_id", "agg_value", "air_temperature", "dew_temperature", "sea_level_pressure", "wind_speed", "cloud_coverage", "wind_direction", "is_peak"]
    strs = ["interval", "season_flag"]
    parts = []
    for c in num:
        parts.append(
            f"SELECT '{c}' AS \"column\", 'numeric' AS kind, (count(DISTINCT {c}) <= 2 AND coalesce(min({c}) IN (0, 1), true) "
            f"AND coalesce(max({c}) IN (0, 1), true)) AS boolean_like FROM f"
        )
    for c in strs:
        parts.append(f"SELECT '{c}', 'string', count(DISTINCT {c}) <= 2 FROM f")
    return sql(
        "SELECT * FROM (WITH f AS (SELECT *, CAST(season_flag = 'peak' AS INTEGER) AS is_peak FROM feature) " + " UNION ALL ".join(parts) + ")",
        "feature",
    )


@query("a12_boolean_like", _a12_sql())
def a12(spark, d):
    f = X.feature(spark, d).withColumn("is_peak", (F.col("season_flag") == PEAK).cast("int"))
    return PR.boolean_like(f)


@query(
    "a13_value_counts_null",
    sql("SELECT coalesce(CAST(season_flag AS VARCHAR), 'NULL') AS value, count(*) AS count FROM feature GROUP BY 1", "feature"),
)
def a13(spark, d):
    return PR.value_counts_with_null(X.feature(spark, d), "season_flag")


@query(
    "a14_monthly_season_totals",
    sql("SELECT date_trunc('month', ts) AS month, season_flag, round(sum(agg_value), 6) AS energy_kwh FROM feature GROUP BY ALL", "feature"),
)
def a14(spark, d):
    return A.monthly_season_totals(X.feature(spark, d)).select("month", "season_flag", F.round("energy_kwh", 6).alias("energy_kwh"))


_A15_SQL = (
    "SELECT month, round(coalesce(sum(energy_kwh) FILTER (WHERE season_flag = 'peak'), 0), 6) AS \"peak\", "
    "round(coalesce(sum(energy_kwh) FILTER (WHERE season_flag = 'off-peak'), 0), 6) AS \"off-peak\" "
    "FROM (SELECT date_trunc('month', ts) AS month, season_flag, sum(agg_value) AS energy_kwh FROM feature GROUP BY ALL) GROUP BY month"
)


@query("a15_season_pivot", sql(_A15_SQL, "feature"))
def a15(spark, d):
    p = A.season_pivot(A.monthly_season_totals(X.feature(spark, d)))
    return p.select("month", F.round(PEAK, 6).alias(PEAK), F.round(F.col(f"`{OFF_PEAK}`"), 6).alias(OFF_PEAK))


@query(
    "a16_daily_mean_spine",
    sql(
        "SELECT CAST(s.day AS DATE) AS day, " + DR("m.daily_mean") + " AS daily_mean FROM (SELECT generate_series AS day FROM generate_series("
        "(SELECT min(CAST(ts AS DATE)) FROM feature WHERE agg_value IS NOT NULL), (SELECT max(CAST(ts AS DATE)) FROM feature WHERE agg_value IS NOT NULL), INTERVAL 1 DAY)) s "
        "LEFT JOIN (SELECT CAST(ts AS DATE) AS day, avg(agg_value) AS daily_mean FROM feature WHERE ts IS NOT NULL AND agg_value IS NOT NULL GROUP BY 1) m "
        "ON CAST(s.day AS DATE) = m.day",
        "feature",
    ),
)
def a16(spark, d):
    return A.daily_mean_with_spine(X.feature(spark, d)).select("day", dr("daily_mean"))


@query(
    "a17_use_by_season_top10",
    sql(
        "SELECT primary_use, \"peak\", \"off-peak\", \"peak\" + \"off-peak\" AS total FROM (SELECT b.primary_use, "
        "count(*) FILTER (WHERE f.season_flag = 'peak') AS \"peak\", count(*) FILTER (WHERE f.season_flag = 'off-peak') AS \"off-peak\" "
        "FROM (SELECT building_id, season_flag FROM feature WHERE building_id IS NOT NULL AND season_flag IS NOT NULL) f "
        "LEFT JOIN buildings b ON f.building_id = b.building_id GROUP BY 1) ORDER BY total DESC, primary_use ASC NULLS LAST LIMIT 10",
        "feature", "buildings",
    ),
)
def a17(spark, d):
    return A.use_by_season_top(X.feature(spark, d), R.buildings(spark, d))


_CORR_COLS = ["agg_value", "air_temperature", "dew_temperature", "sea_level_pressure", "wind_speed"]


@query(
    "a18_correlation",
    sql(
        "SELECT * FROM (WITH c AS (SELECT " + ", ".join(_CORR_COLS) + " FROM feature WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _CORR_COLS) + ") "
        + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {DR(f'corr({a}, {b})', 9)} AS corr FROM c" for a in _CORR_COLS for b in _CORR_COLS)
        + ")",
        "feature",
    ),
)
def a18(spark, d):
    return ST.correlation_matrix(X.feature(spark, d), _CORR_COLS).select("col_a", "col_b", dr("corr", 9))


_BOX = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"]


@query(
    "a19_box_stats",
    sql(
        "SELECT season_flag, " + ", ".join(f"{DR(c)} AS {c}" for c in _BOX) + ", n FROM ("
        "SELECT q.*, min(v) FILTER (WHERE v >= lo_fence) AS whisker_lo, max(v) FILTER (WHERE v <= hi_fence) AS whisker_hi, count(*) AS n "
        "FROM (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM ("
        "SELECT season_flag, quantile_cont(agg_value, 0.25) AS q1, quantile_cont(agg_value, 0.5) AS median, quantile_cont(agg_value, 0.75) AS q3 "
        "FROM feature WHERE season_flag IS NOT NULL AND agg_value IS NOT NULL GROUP BY 1)) q "
        "JOIN (SELECT season_flag, agg_value AS v FROM feature WHERE season_flag IS NOT NULL AND agg_value IS NOT NULL) x USING (season_flag) "
        "GROUP BY ALL)",
        "feature",
    ),
)
def a19(spark, d):
    f = hand_off(X.feature(spark, d).where(F.col("season_flag").isNotNull()).select("season_flag", "agg_value"), "a19-values")
    b = ST.box_stats(f, "agg_value", ["season_flag"])
    return b.select("season_flag", *[dr(c) for c in _BOX], "n")


@query(
    "a20_histogram",
    sql(
        "SELECT CAST(bin AS INTEGER) AS bin, " + DR("lo + bin * width") + " AS bin_lo, " + DR("lo + (bin + 1) * width") + " AS bin_hi, coalesce(c.cnt, 0) AS count, "
        + DR("coalesce(c.cnt, 0) / (n * width)", 12) + " AS density FROM (SELECT lo, n, CASE WHEN hi > lo THEN (hi - lo) / 60 ELSE 1.0 END AS width, "
        "unnest(range(0, 60)) AS bin FROM (SELECT min(agg_value) AS lo, max(agg_value) AS hi, count(*) AS n FROM feature WHERE agg_value IS NOT NULL)) s "
        "LEFT JOIN (SELECT b, count(*) AS cnt FROM (SELECT least(CAST(floor((agg_value - lo) / width) AS INTEGER), 59) AS b FROM feature, "
        "(SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 60 ELSE 1.0 END AS width FROM (SELECT min(agg_value) AS lo, max(agg_value) AS hi FROM feature)) "
        "WHERE agg_value IS NOT NULL) GROUP BY b) c ON c.b = s.bin",
        "feature",
    ),
)
def a20(spark, d):
    h = ST.histogram(X.feature(spark, d), "agg_value", bins=60)
    return h.select("bin", dr("bin_lo"), dr("bin_hi"), "count", dr("density", 12))


_KDE_SQL = sql(
    "SELECT CAST(g AS INTEGER) AS g, " + DR("x", 6) + " AS x, " + DR("sum(cnt * exp(-0.5 * ((x - centre) / h) * ((x - centre) / h)) / (sqrt(2 * pi()) * n * h))", 12)
    + " AS density FROM grid, hist, st2 GROUP BY g, x",
    "feature",
    extra={
        "v": "SELECT agg_value AS v FROM feature WHERE agg_value IS NOT NULL AND NOT isnan(agg_value)",
        "st": "SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd FROM v",
        "st2": "SELECT lo, hi, n, CASE WHEN sd * pow(CAST(n AS DOUBLE), -0.2) > 0 THEN sd * pow(CAST(n AS DOUBLE), -0.2) ELSE 1.0 END AS h FROM st",
        "hist": "SELECT v AS centre, count(*) AS cnt FROM v GROUP BY 1",
        "grid": "SELECT g, (lo - 3 * h) + g * ((hi - lo + 6 * h) / 99) AS x FROM st2, range(0, 100) t(g)",
    },
)


@query("a21_kernel_density", _KDE_SQL)
def a21(spark, d):
    k = ST.kernel_density(X.feature(spark, d), "agg_value", grid=100)
    return k.select("g", dr("x", 6), dr("density", 12))


@query("a22_daily_site_energy", sql("SELECT site_id, day, metered_energy FROM metered_site_day", "metered_site_day"))
def a22(spark, d):
    return X.metered_site_day(spark, d)


@query(
    "a23_bucket_means",
    sql(
        "SELECT k.building_id, k.bucket, " + DR("m.mean_energy") + " AS mean_energy FROM (SELECT DISTINCT building_id, unnest(['00:00–06:00', '06:00–12:00', '12:00–18:00', '18:00–24:00']) AS bucket FROM six_totals) k "
        "LEFT JOIN (SELECT building_id, CASE WHEN hour(window_start) <= 5 THEN '00:00–06:00' WHEN hour(window_start) <= 11 THEN '06:00–12:00' "
        "WHEN hour(window_start) <= 17 THEN '12:00–18:00' WHEN hour(window_start) <= 23 THEN '18:00–24:00' END AS bucket, avg(total_energy_6h) AS mean_energy "
        "FROM six_totals GROUP BY ALL) m ON k.building_id = m.building_id AND k.bucket = m.bucket",
        "six_totals",
    ),
)
def a23(spark, d):
    t = window_totals(X.readings(spark, d), SIX_HOURS, "ts", "value")
    return A.bucket_means(t).select("building_id", "bucket", dr("mean_energy"))


_SHORT_SQL = (
    "SELECT p.site_id, CAST(p.day_start AS DATE) AS day, p.total_energy_day AS predicted_energy, m.metered_energy, "
    "p.total_energy_day - m.metered_energy AS shortfall FROM daily_pred p JOIN metered_site_day m "
    "ON p.site_id = m.site_id AND CAST(p.day_start AS DATE) = m.day"
)


def _shortfall(spark, d):
    return SV.daily_shortfall(X.daily_pred(spark, d), X.metered_site_day(spark, d))


@query(
    "a24_shortfall_band",
    sql(f"SELECT site_id, {DR('greatest(quantile_cont(abs(shortfall), 0.98), 1.0)')} AS band FROM ({_SHORT_SQL}) GROUP BY site_id", "daily_pred", "metered_site_day"),
)
def a24(spark, d):
    return SV.shortfall_band(_shortfall(spark, d)).select("site_id", dr("band"))


# kept-history chain of the six-hour consumer: W6 (first of each window) -> W4 (last 60) -> A26 -> T4
_KEPT_SQL = (
    "SELECT building_id, window_start, total_energy_6h, gen_ts, seq FROM (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY gen_ts DESC, seq DESC) AS rn "
    "FROM (SELECT * FROM (SELECT *, lag(window_start) OVER (PARTITION BY building_id ORDER BY gen_ts, seq) AS prev FROM records) "
    "WHERE prev IS NULL OR prev <> window_start)) WHERE rn <= 60"
)


def _kept(spark, d):
    rec = SV.re_emitted_totals(X.readings(spark, d))
    firsts = W.changed_from_previous(rec, ["building_id"], ["gen_ts", "seq"], "window_start").where("is_new").drop("is_new")
    return W.last_n_per_key(firsts, ["building_id"], ["gen_ts", "seq"], 60)


@query("a26_building_totals", sql(f"SELECT building_id, round(sum(total_energy_6h), 3) AS total FROM ({_KEPT_SQL}) GROUP BY building_id", "records"))
def a26(spark, d):
    return A.key_totals(_kept(spark, d), "building_id", "total_energy_6h").select("building_id", F.round("total", 3).alias("total"))


@query(
    "a27_row_counts",
    sql(
        "SELECT 'meters' AS dataset, count(*) AS n_rows FROM meters UNION ALL SELECT 'buildings', count(*) FROM buildings "
        "UNION ALL SELECT 'weather', count(*) FROM weather",
        "meters", "buildings", "weather",
    ),
)
def a27(spark, d):
    return A.row_counts({"meters": R.meters(spark, d), "buildings": R.buildings(spark, d), "weather": R.weather(spark, d)})


@query(
    "a28_padded_range",
    sql(
        "SELECT site_id, " + DR("y_min") + " AS y_min, " + DR("y_max") + " AS y_max, " + DR("y_min - 0.1 * greatest(abs(y_min), abs(y_max), 1.0)") + " AS lo, "
        + DR("y_max + 0.1 * greatest(abs(y_min), abs(y_max), 1.0)") + " AS hi FROM (SELECT site_id, min(shortfall) AS y_min, max(shortfall) AS y_max FROM (" + _SHORT_SQL + ") GROUP BY 1)",
        "daily_pred", "metered_site_day",
    ),
)
def a28(spark, d):
    r = A.padded_range(_shortfall(spark, d), "site_id", "shortfall")
    return r.select("site_id", dr("y_min"), dr("y_max"), dr("lo"), dr("hi"))


# ------------------------------------------------------------------ joins
@query("j1_month_labels_join", sql("SELECT site_id, timestamp, season_flag FROM wflag", "wflag"))
def j1(spark, d):
    return add_season_flag(X.wclean(spark, d)).select("site_id", "timestamp", "season_flag")


@query(
    "j2_site_map",
    sql(
        f"SELECT a.building_id, a.interval, a.ts, round(a.agg_value, 6) AS agg_value, s.site_id FROM (SELECT building_id, {LBL.format(t='ts')} AS interval, ts, "
        "sum(value) AS agg_value FROM meters GROUP BY ALL) a LEFT JOIN site_map s ON a.building_id = s.building_id",
        "meters", "site_map",
    ),
)
def j2(spark, d):
    out = J.attach_site(A.aggregate_energy(R.meters(spark, d)), R.buildings(spark, d))
    return out.select("building_id", "interval", "ts", F.round("agg_value", 6).alias("agg_value"), "site_id")


@query(
    "j3_weather_join",
    sql(
        "SELECT a.building_id, s.site_id, a.ts, round(a.agg_value, 6) AS agg_value, w.air_temperature, w.wind_speed FROM agg_daily a "
        "LEFT JOIN site_map s ON a.building_id = s.building_id LEFT JOIN weather w ON w.site_id = s.site_id AND w.timestamp = a.ts",
        "agg_daily", "site_map", "weather",
    ),
    headline=True,
)
def j3(spark, d):
    a = J.attach_site(A.aggregate_energy(R.meters_daily(spark, d)), R.buildings(spark, d))
    w = R.weather(spark, d).select("site_id", "timestamp", "air_temperature", "wind_speed")
    out = J.attach_weather(a, w, "ts", "timestamp")
    return out.select("building_id", "site_id", "ts", F.round("agg_value", 6).alias("agg_value"), "air_temperature", "wind_speed")


@query(
    "j4_building_attributes",
    sql(
        "SELECT f.building_id, f.ts, round(f.agg_value, 6) AS agg_value, b.primary_use, b.square_feet, b.floor_count, b.year_built "
        "FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id",
        "feature", "buildings",
    ),
)
def j4(spark, d):
    b = R.buildings(spark, d).select("building_id", "primary_use", "square_feet", "floor_count", "year_built")
    out = J.attach_buildings(X.feature(spark, d), b)
    return out.select("building_id", "ts", F.round("agg_value", 6).alias("agg_value"), "primary_use", "square_feet", "floor_count", "year_built")


@query(
    "j5_fan_out",
    sql(
        "SELECT w.site_id, count(*) AS n_rows, count(DISTINCT w.timestamp) AS n_readings, count(DISTINCT b.building_id) AS n_buildings, "
        "count(*) FILTER (WHERE b.building_id IS NULL) AS n_without_building FROM weather w LEFT JOIN buildings b ON w.site_id = b.site_id GROUP BY 1",
        "weather", "buildings",
    ),
)
def j5(spark, d):
    """The fanned rows counted by reading and by building, so that no row is repeated for a distinct count."""
    fan = J.fan_out_buildings(hand_off(R.weather(spark, d), "j5-weather"), R.buildings(spark, d))
    per_reading = fan.groupBy("site_id", "timestamp").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("building_id").isNull()).alias("lone"))
    readings = per_reading.groupBy("site_id").agg(F.sum("n").alias("n_rows"), F.count("timestamp").alias("n_readings"), F.sum("lone").alias("n_without_building"))
    owners = fan.select("site_id", "building_id").distinct().groupBy("site_id").agg(F.count("building_id").alias("n_buildings"))
    return same_groups(readings, owners, ["site_id"]).select("site_id", "n_rows", "n_readings", "n_buildings", "n_without_building")


@query(
    "j6_shortfall_inner",
    sql(f"SELECT site_id, day, predicted_energy, metered_energy, {DR('shortfall', 3)} AS shortfall FROM ({_SHORT_SQL})", "daily_pred", "metered_site_day"),
    headline=True,
)
def j6(spark, d):
    return _shortfall(spark, d).select("site_id", "day", "predicted_energy", "metered_energy", dr("shortfall", 3))


@query(
    "j7_shortfall_left_zero",
    sql(
        "SELECT p.site_id, strftime(p.day_start, '%Y-%m-%d') AS day, p.total_energy_day AS predicted_energy, m.metered_energy, "
        + DR("p.total_energy_day - coalesce(m.metered_energy, 0)", 3) + " AS shortfall, 'matched' AS outcome FROM daily_pred p "
        "LEFT JOIN metered_site_day m ON p.site_id = m.site_id AND CAST(p.day_start AS DATE) = m.day",
        "daily_pred", "metered_site_day",
    ),
)
def j7(spark, d):
    dp = X.daily_pred(spark, d).select(
        "site_id", F.date_format("day_start", "yyyy-MM-dd").alias("day"), F.col("total_energy_day").alias("predicted_energy"), F.lit("ok").alias("outcome")
    )
    out = SV.live_shortfall(dp, X.metered_site_day(spark, d), zero_when_no_meter=True)
    return out.select("site_id", "day", "predicted_energy", "metered_energy", dr("shortfall", 3), "outcome")


@query(
    "j8_pair_predictions",
    sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, pred_a, pred_b FROM pairs", "pairs"),
)
def j8(spark, d):
    p = X.pairs(spark, d)
    a = p.select(*X.PAIR_KEY, "label", F.col("pred_a").alias("prediction"))
    b = p.select(*X.PAIR_KEY, F.col("pred_b").alias("prediction"))
    return J.pair_predictions(a, b, X.PAIR_KEY)


@query(
    "j9_use_counts",
    sql("SELECT b.primary_use, count(*) AS count FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id GROUP BY 1", "feature", "buildings"),
)
def j9(spark, d):
    return A.category_balance(J.attach_use(X.feature(spark, d), R.buildings(spark, d)), "primary_use")


# ------------------------------------------------------------------ windows
@query("w1_season_flag", sql("SELECT site_id, month, season_flag FROM season_labels", "season_labels"), headline=True)
def w1(spark, d):
    return month_labels(X.wclean(spark, d))


@query(
    "w2_moving_average",
    sql(
        "SELECT month, \"peak\", \"off-peak\", " + DR("avg(\"peak\") OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)") + " AS peak_ma, "
        + DR("avg(\"off-peak\") OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)") + " AS \"off-peak_ma\" FROM (" + _A15_SQL + ")",
        "feature",
    ),
)
def w2(spark, d):
    p = a15(spark, d)
    m = W.moving_average(p, "month", [PEAK, OFF_PEAK])
    return m.select("month", PEAK, F.col(f"`{OFF_PEAK}`"), dr(f"{PEAK}_ma"), dr(F.col(f"`{OFF_PEAK}_ma`"), 6, f"{OFF_PEAK}_ma"))


@query(
    "w3_stable_row_id",
    sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS idx FROM pairs", "pairs"),
)
def w3(spark, d):
    return global_index(X.pairs(spark, d).select(*X.PAIR_KEY), X.PAIR_KEY, out="idx")


@query(
    "w4_last_n",
    sql(
        "SELECT building_id, window_start, total_energy_6h, gen_ts, seq FROM (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY gen_ts DESC, seq DESC) AS rn FROM records) WHERE rn <= 60",
        "records",
    ),
)
def w4(spark, d):
    rec = SV.re_emitted_totals(X.readings(spark, d)).select("building_id", "window_start", "total_energy_6h", "gen_ts", "seq")
    return W.last_n_per_key(rec, ["building_id"], ["gen_ts", "seq"], 60)


@query(
    "w5_arrival_index",
    sql("SELECT building_id, seq, row_number() OVER (PARTITION BY building_id ORDER BY gen_ts, seq) - 1 AS arrival_index FROM records", "records"),
)
def w5(spark, d):
    rec = SV.re_emitted_totals(X.readings(spark, d)).select("building_id", "gen_ts", "seq")
    return W.position_in_key(rec, ["building_id"], ["gen_ts", "seq"]).select("building_id", "seq", "arrival_index")


@query(
    "w6_suppress_repeats",
    sql(
        "SELECT building_id, window_start, total_energy_6h, seq FROM (SELECT *, lag(window_start) OVER (PARTITION BY building_id ORDER BY gen_ts, seq) AS prev FROM records) "
        "WHERE prev IS NULL OR prev <> window_start",
        "records",
    ),
)
def w6(spark, d):
    rec = SV.re_emitted_totals(X.readings(spark, d))
    out = W.changed_from_previous(rec, ["building_id"], ["gen_ts", "seq"], "window_start")
    return out.where("is_new").select("building_id", "window_start", "total_energy_6h", "seq")


@query(
    "w7_average_ranks",
    sql(
        "SELECT abs_d, cnt, coalesce(sum(cnt) OVER (ORDER BY abs_d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (cnt + 1) / 2.0 AS avg_rank "
        "FROM (SELECT abs(pred_a - label) AS abs_d, count(*) AS cnt FROM pairs GROUP BY 1)",
        "pairs",
    ),
)
def w7(spark, d):
    p = X.pairs(spark, d)
    per = p.groupBy(F.abs(F.col("pred_a") - F.col("label")).alias("abs_d")).agg(F.count(F.lit(1)).alias("cnt"))
    return tie_average_ranks(per, "abs_d", "cnt", out="avg_rank")


# ------------------------------------------------------------------ sort, top-k, union
@query("t1_ordered_preview", sql("SELECT * FROM wclean ORDER BY site_id, timestamp LIMIT 10", "wclean"))
def t1(spark, d):
    return T.ordered_preview(X.wclean(spark, d), ["site_id", "timestamp"], 10)


@query(
    "t2_top5_by_count",
    sql("SELECT building_id, count(*) AS count FROM meters GROUP BY 1 ORDER BY count DESC, building_id LIMIT 5", "meters"),
)
def t2(spark, d):
    return T.top_by(A.category_balance(R.meters(spark, d), "building_id"), "count", 5, ["building_id"])


@query(
    "t3_top10_sites",
    sql("SELECT site_id, count(*) AS count FROM buildings GROUP BY 1 ORDER BY count DESC, site_id LIMIT 10", "buildings"),
)
def t3(spark, d):
    return T.top_by(A.category_balance(R.buildings(spark, d), "site_id"), "count", 10, ["site_id"])


@query(
    "t4_top12_buildings",
    sql(f"SELECT building_id, round(sum(total_energy_6h), 3) AS total FROM ({_KEPT_SQL}) GROUP BY 1 ORDER BY total DESC, building_id LIMIT 12", "records"),
)
def t4(spark, d):
    return T.top_by(a26(spark, d), "total", 12, ["building_id"])


@query(
    "t5_hash_pick",
    sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM pairs ORDER BY "
        + unit_sql(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]) + ", l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20000",
        "pairs",
    ),
)
def t5(spark, d):
    return T.hash_pick(X.pairs(spark, d), X.PAIR_KEY, 20000).select(*X.PAIR_KEY)


@query("t6_final_order", sql("SELECT * FROM daily_pred ORDER BY site_id, day_start", "daily_pred"))
def t6(spark, d):
    return T.final_order(X.daily_pred(spark, d), ["site_id", "day_start"])


@query(
    "u1_union_by_name",
    sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM wclean" for c in SIX), "wclean"),
)
def u1(spark, d):
    w = X.wclean(spark, d)
    parts = [w.agg(F.count_if(F.col(c).isNull()).alias("nulls")).select(F.lit(c).alias("column"), "nulls") for c in SIX]
    return T.union_all_by_name(parts)


_PROFILED = {
    "weather": {"site_id": "numeric", "timestamp": None, **dict.fromkeys(SIX, "numeric")},
    "buildings": {c: "string" if c == "primary_use" else "numeric" for c in ("site_id", "building_id", "primary_use", "square_feet", "floor_count", "year_built")},
    "meters": {"building_id": "numeric", "meter_type": "string", "ts": None, "value": "numeric"},
}


def _u2_sql() -> str:
    rows = []
    for table, cols in _PROFILED.items():
        for c, kind in cols.items():
            checks = {"incomplete": f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR {c} = 0" if kind == "numeric" else "") + ") > 0"}
            if kind:
                checks[kind] = f"count({c}) > 0"
                checks["boolean_like"] = f"count(*) FILTER (WHERE {c} NOT IN (0, 1)) = 0" if kind == "numeric" else f"count(DISTINCT {c}) <= 2"
            rows += [f"SELECT '{c}' AS \"column\", '{k}' AS detected_as, '{table}' AS t FROM {table} HAVING {v}" for k, v in checks.items()]
    return sql("SELECT \"column\", detected_as, string_agg(DISTINCT t, ',' ORDER BY t) AS tables FROM (" + " UNION ALL ".join(rows) + ") GROUP BY 1, 2", "weather", "buildings", "meters")


@query("u2_detected_columns", _u2_sql())
def u2(spark, d):
    roles = {"weather": R.weather, "buildings": R.buildings, "meters": R.meters}
    return PR.detected_columns({t: hand_off(roles[t](spark, d).select(*cols), f"u2-{t}") for t, cols in _PROFILED.items()})
