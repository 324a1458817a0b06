"""Catalog: replay (S14-S17), streaming sinks (S6-S9) and stream operators (ST*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import HISTORY_LEN_SITE, TICK_SECONDS, TRIGGER_DAILY, TRIGGER_PREDICTIONS, TRIGGER_SIXHOUR
from ..functions import calendar as cal
from ..ml import pipelines as ML
from ..operators.joins import fan_out_buildings
from ..operators.season import lookup_season, month_labels
from ..operators.topk import union_all_by_name
from ..operators.windows import last_n_per_key
from ..plans import serving as SV
from ..plans.features import engineer, model_base
from ..runtime import checkpoint_for, hand_off, path_exists, scratch_dir
from ..sources import published as PL
from ..sources import tables as R
from ..sources.files import tail_parquet
from ..sources.payload import keyed_json
from ..sources.replay import payload_frame, publish_files, replay_order, stamp
from ..streaming import aggregates as SA
from ..streaming import jobs as JB
from ..streaming import sinks
from ..streaming.app import prediction_rows
from ..streaming.sources import weather_stream
from . import frames as X
from .frames import DR, dr, sql
from .registry import query

BASE = JB.BASE_EPOCH

# the replayed weather feed in SQL: global position, batch of 120, block of 24, stamp; the last batch is short
_STAMPED_SQL = (
    f"SELECT *, idx // 120 AS batch_id, CAST((idx % 120) // 24 AS INTEGER) AS block, {BASE} + 5 * (idx // 120) + (idx % 120) // 24 AS weather_ts "
    "FROM (SELECT *, row_number() OVER (ORDER BY site_id, timestamp) - 1 AS idx FROM weather)"
)


def _stamped_weather(spark, d):
    return stamp(replay_order(R.weather(spark, d), ["site_id", "timestamp"]), BASE)


# ------------------------------------------------------------------ replay
@query("s14_replay_order", sql("SELECT site_id, timestamp, row_number() OVER (ORDER BY site_id, timestamp) - 1 AS idx FROM weather", "weather"))
def s14(spark, d):
    return replay_order(R.weather(spark, d), ["site_id", "timestamp"]).select("site_id", "timestamp", "idx")


@query("s15_replay_stamp", sql(f"SELECT site_id, timestamp, idx, batch_id, block, weather_ts FROM ({_STAMPED_SQL})", "weather"))
def s15(spark, d):
    return _stamped_weather(spark, d).select("site_id", "timestamp", "idx", "batch_id", "block", "weather_ts")


@query(
    "s16_payload_json",
    sql(
        "SELECT CAST(site_id AS VARCHAR) AS key, air_temperature, cloud_coverage, air_temperature IS NULL AS air_null, "
        "strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS ts_text, weather_ts FROM (" + _STAMPED_SQL + ")",
        "weather",
    ),
)
def s16(spark, d):
    p = payload_frame(_stamped_weather(spark, d))
    v = F.col("value")
    parsed = F.from_json(v, "air_temperature double, cloud_coverage int, timestamp string, weather_ts bigint")
    return p.select(
        "key",
        parsed.getField("air_temperature").alias("air_temperature"),
        parsed.getField("cloud_coverage").alias("cloud_coverage"),
        v.contains('"air_temperature":null').alias("air_null"),
        parsed.getField("timestamp").alias("ts_text"),
        parsed.getField("weather_ts").alias("weather_ts"),
    )


@query("s17_publish_files", sql(f"SELECT batch_id, count(*) AS n_rows FROM ({_STAMPED_SQL}) GROUP BY 1", "weather"))
def s17(spark, d):
    path = scratch_dir(spark, "s17-feed")
    publish_files(payload_frame(_stamped_weather(spark, d)), path)
    return spark.read.parquet(path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ sources
@query("s4_topic_source", sql(f"SELECT site_id, timestamp, air_temperature IS NULL AS air_null, cloud_coverage, weather_ts FROM ({_STAMPED_SQL})", "weather"))
def s4(spark, d):
    """JSON payloads published to a log, subscribed to from its first piece, decoded (S5) and watermarked (ST2)."""
    log = scratch_dir(spark, "s4-log")
    payloads = payload_frame(_stamped_weather(spark, d)).select("key", "value")
    PL.publish(payloads, log)
    raw = PL.read_log(spark, log, payloads.schema, "s4", "earliest")
    return JB.run_append(weather_stream(raw).select("site_id", "timestamp", F.col("air_temperature").isNull().alias("air_null"), "cloud_coverage", "weather_ts"), "s4_decoded")


@query(
    "s13_start_policies",
    "SELECT policy, p.piece, count(*) AS n_rows, count(DISTINCT event_id) AS n_events, CAST(sum(event_id) AS BIGINT) AS id_sum "
    "FROM (VALUES ('earliest', 1), ('earliest', 2), ('earliest', 3), ('latest', 2), ('latest', 3), ('live', 2)) p(policy, piece) "
    "JOIN events ON event_id % 3 = p.piece - 1 GROUP BY 1, 2",
)
def s13(spark, d):
    """Three consumers of one log, all started when its first piece is there.

    ``earliest`` takes all pieces; ``latest`` the later ones, also the piece published while
    it was away; ``live`` only the piece published while it runs, not the one before its
    second start. A restart from the checkpoint repeats nothing.
    """
    events = R.read_table(spark, d, "events").select("event_id", "user_id", "value")
    log = scratch_dir(spark, "s13-log")
    out = {p: scratch_dir(spark, f"s13-{p}") for p in PL.POLICIES}
    root = {p: scratch_dir(spark, f"s13-{p}-ckpt") for p in PL.POLICIES}
    third = lambda k: events.where(F.pmod("event_id", F.lit(3)) == k)

    def start(policy, trigger="availableNow"):
        rows = PL.read_log(spark, log, events.schema, policy, policy)
        return sinks.to_parquet_append(rows, out[policy], f"s13 {policy}", trigger=trigger, checkpoint_root=root[policy])

    def resume():
        for policy in ("earliest", "latest"):
            sinks.run_until_done(start(policy))

    PL.publish(third(0), log)
    resume()
    live = start("live", "0 seconds")
    live.processAllAvailable()
    PL.publish(third(1), log)
    live.processAllAvailable()
    live.stop()
    PL.publish(third(2), log)
    resume()
    root["live"] = scratch_dir(spark, "s13-live-again")
    sinks.run_until_done(start("live"))
    resume()
    kind = T.StructType([*events.schema.fields, T.StructField("piece", T.LongType())])
    read = [spark.read.schema(kind).parquet(out[p]).withColumn("policy", F.lit(p)) for p in PL.POLICIES]
    taken = read[0].unionByName(read[1]).unionByName(read[2])
    return taken.groupBy("policy", F.col("piece").cast("int").alias("piece")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_events"), F.sum("event_id").alias("id_sum")
    )


# ------------------------------------------------------------------ sinks
@query(
    "s6_parquet_append_sink",
    sql(f"SELECT site_id, timestamp, air_temperature, batch_id, block, weather_ts FROM ({_STAMPED_SQL})", "weather"),
    headline=True,
)
def s6(spark, d):
    feed = JB.replay_feed(R.weather(spark, d), ["site_id", "timestamp"], "s6")
    cols = ["site_id", "timestamp", "air_temperature", "batch_id", "block", "weather_ts"]
    return JB.run_feed(feed, lambda **o: JB.read_feed(spark, feed.path, **o).select(*cols), "s6_predictions").written


_SIX_N_SQL = (
    "SELECT building_id, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, "
    "round(sum(value), 3) AS total_energy_6h, count(*) AS n_readings FROM readings GROUP BY ALL"
)


@query("s7_foreach_batch_sink", sql("SELECT window_start, window_end, building_id, total_energy_6h FROM six_totals", "six_totals"))
def s7(spark, d):
    """Totals of windows still open, re-emitted with every batch: update mode over the partials of each tick of
    the emitted clock, whose watermark evicts them; readers add up the last emission of each partial."""
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "s7", chunks=2)
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    written = JB.run_feed(feed, ticks, "s7_sixhour_updates", mode="update").written
    totals = SA.roll_up(SA.latest_partials(written, "building_id"), "building_id")
    return totals.select("window_start", "window_end", "building_id", "total_energy_6h")


@query(
    "s8_parquet_tail",
    sql(
        "SELECT CAST(site_id AS VARCHAR) AS key, site_id, round(total_energy_day, 3) AS total_energy_day, CAST(day_start AS DATE) AS day FROM daily_pred",
        "daily_pred",
    ),
)
def s8(spark, d):
    src = scratch_dir(spark, "s8-daily")
    X.daily_pred(spark, d).write.mode("append").parquet(src)
    tailed = tail_parquet(spark, src)
    out = JB.run_append(keyed_json(tailed, "site_id"), "s8_republish")
    back = out.select("key", F.from_json("value", "site_id int, total_energy_day double, day_start string").alias("v"))
    return back.select(
        "key", F.col("v.site_id").alias("site_id"), F.round("v.total_energy_day", 3).alias("total_energy_day"), cal.day_key("v.day_start").cast("date").alias("day")
    )


# ------------------------------------------------------------------ stream operators
@query(
    "st1_two_clocks",
    sql(f"SELECT site_id, timestamp, weather_ts, make_timestamp(weather_ts * 1000000) AS event_time FROM ({_STAMPED_SQL})", "weather"),
)
def st1(spark, d):
    s = _stamped_weather(spark, d)
    return s.select("site_id", "timestamp", "weather_ts", cal.epoch_to_utc_ntz("weather_ts").alias("event_time"))


@query("st3_six_hour_two_clock", sql(_SIX_N_SQL, "readings"), headline=True)
def st3(spark, d):
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "st3", chunks=2, heartbeat=True)
    # heartbeat rows must reach the watermark node, so no key filter here (it would be
    # pushed below the watermark); their keyless partials are dropped in the roll-up
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    parts = JB.run_feed(feed, ticks, "st3_sixhour_partials").written
    return SA.roll_up(parts, "building_id").select("building_id", "window_start", "window_end", "total_energy_6h", "n_readings")


@query(
    "st4_daily_two_clock",
    sql(
        "SELECT b.site_id, CAST(CAST(r.ts AS DATE) AS TIMESTAMP) AS day_start, CAST(CAST(r.ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS day_end, "
        "round(sum(r.value), 3) AS total_energy_day, count(*) AS n_readings FROM readings r JOIN buildings b ON r.building_id = b.building_id GROUP BY ALL",
        "readings", "buildings",
    ),
)
def st4(spark, d):
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "st4", chunks=2, heartbeat=True)
    sites = hand_off(R.buildings(spark, d).select("building_id", "site_id"), "st4-sites")

    def ticks(**o):
        scored = JB.read_feed(spark, feed.path, **o).join(sites, "building_id", "left")  # left: heartbeat rows pass through
        return SA.tick_partials(scored, "site_id", "value", "ts", with_block=False)

    parts = JB.run_feed(feed, ticks, "st4_daily_partials").written
    return SA.roll_up(parts, "site_id", with_block=False).select("site_id", "day_start", "day_end", "total_energy_day", "n_readings")


@query("st9_latest_emission", sql("SELECT building_id, window_start, window_end, total_energy_6h FROM six_totals", "six_totals"))
def st9(spark, d):
    rec = SV.re_emitted_totals(X.readings(spark, d))
    latest = SV.latest_per_key(rec, ["building_id", "window_start"], ["gen_ts", "seq"])
    return latest.select("building_id", "window_start", "window_end", "total_energy_6h")


_HALF_SQL = "(SELECT CAST(ceil((max(batch_id) + 1) / 2.0) AS BIGINT) FROM fed)"


@query(
    "st10_late_data_drop",
    sql(
        "SELECT count(*) AS rows_aggregated, count(*) + count(*) FILTER (WHERE batch_id < " + _HALF_SQL + ") AS rows_sent, "
        "count(*) FILTER (WHERE batch_id < " + _HALF_SQL + ") AS rows_dropped_late FROM fed",
        "readings",
        extra={"fed": "SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 120 AS batch_id FROM readings"},
    ),
)
def st10(spark, d):
    """A transport replay re-sends the first half after the second: its rows are
    behind the watermark and are dropped, every row of the first sending is aggregated."""
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "st10", chunks=2, heartbeat=True, resend_first=True)
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    parts = JB.run_feed(feed, ticks, "st10_partials").written
    kept = parts.where("date is not null").agg(F.sum("n").alias("rows_aggregated"))
    sent = spark.read.parquet(feed.path).where("event_id is not null").agg(F.count(F.lit(1)).alias("rows_sent")).scalar()
    return kept.withColumn("rows_sent", sent).withColumn("rows_dropped_late", F.col("rows_sent") - F.col("rows_aggregated"))


@query(
    "st11_engineer",
    sql(
        "SELECT a.building_id, a.ts, CAST(hour(a.ts) AS DOUBLE) AS hour, CAST(dayofweek(a.ts) + 1 AS DOUBLE) AS day_of_week, CAST(month(a.ts) AS DOUBLE) AS month, "
        + DR("ln(1 + CAST(b.square_feet AS DOUBLE))", 9) + " AS log_sqft, CAST(b.floor_count AS DOUBLE) AS floor_count, CAST(b.year_built AS DOUBLE) AS year_built "
        "FROM agg_daily a LEFT JOIN buildings b ON a.building_id = b.building_id",
        "agg_daily", "buildings",
    ),
)
def st11(spark, d):
    from ..operators.aggregate import aggregate_energy
    from ..operators.joins import attach_buildings

    a = attach_buildings(aggregate_energy(R.meters_daily(spark, d)), R.buildings(spark, d).select("building_id", "square_feet", "floor_count", "year_built"))
    e = engineer(a)
    return e.select("building_id", "ts", "hour", "day_of_week", "month", dr("log_sqft", 9), "floor_count", "year_built")


@query(
    "st12_season_lookup",
    sql(
        "SELECT w.site_id, w.timestamp, coalesce(l.season_flag, " + X.FALLBACK_SQL.format(m="month(w.timestamp)") + ") AS season_flag "
        "FROM wclean w LEFT JOIN season_labels l ON w.site_id = l.site_id AND month(w.timestamp) = l.month AND l.site_id <> 0",
        "wclean", "season_labels",
    ),
)
def st12(spark, d):
    """Labels of every training reading, persisted and read back at inference; site 0
    counts as new (no labels), so its readings take the calendar fallback."""
    w = X.wclean(spark, d)
    labels = hand_off(month_labels(w).where("site_id <> 0"), "season-labels")
    out = lookup_season(w.withColumn("month", F.month("timestamp")), labels, "month")
    return out.select("site_id", "timestamp", "season_flag")


def _daily_records(spark, d):
    """Daily totals republished as JSON records whose field names vary by producer."""
    dp = X.daily_pred(spark, d)
    alt = F.pmod(F.col("site_id"), F.lit(3))
    site_name = F.when(alt == 0, "site_id").when(alt == 1, "siteId").otherwise("siteID")
    tot_name = F.when(alt == 0, "total_energy_day").when(alt == 1, "sum_day").otherwise("kwh_day")
    day_name = F.when(alt == 2, "date").otherwise("day_start")
    return dp.select(
        F.col("site_id").cast("string").alias("key"),
        F.to_json(
            F.create_map(
                site_name, F.col("site_id").cast("string"), tot_name, F.col("total_energy_day").cast("string"),
                day_name, F.date_format("day_start", "yyyy-MM-dd'T'HH:mm:ss"),
            )
        ).alias("value"),
    )


_ST14_SQL = sql(
    "SELECT p.site_id, strftime(p.day_start, '%Y-%m-%d') AS day, p.total_energy_day AS predicted_energy, m.metered_energy, "
    + DR("p.total_energy_day - coalesce(m.metered_energy, 0)", 3) + " AS shortfall, 'matched' AS outcome FROM daily_pred p "
    "LEFT JOIN metered_site_day m ON p.site_id = m.site_id AND CAST(p.day_start AS DATE) = m.day",
    "daily_pred", "metered_site_day",
)


@query("st14_live_shortfall", _ST14_SQL)
def st14(spark, d):
    src = scratch_dir(spark, "st14-records")
    _daily_records(spark, d).write.parquet(src)
    decoded = SV.decode_daily_record(tail_parquet(spark, src))
    live = SV.live_shortfall(decoded, X.metered_site_day(spark, d), tracked_sites=R.buildings(spark, d))
    out = JB.run_append(live, "st14_shortfall")
    return out.select("site_id", "day", "predicted_energy", "metered_energy", dr("shortfall", 3), "outcome")


def _mixed_records(spark, d):
    """Daily records of which some cannot be used: by site number, junk text, a missing
    total, a total that is no number, or a site that is not tracked."""
    kind = F.pmod(F.col("key").cast("int"), F.lit(6))
    untracked = F.regexp_replace("value", r'"(site_?[iI][dD])":"\d+"', '"$1":"9999"')
    bare = F.to_json(F.create_map(F.lit("site_id"), F.col("key")))
    word = F.to_json(F.create_map(F.lit("site_id"), F.col("key"), F.lit("sum_day"), F.lit("much")))
    value = F.when(kind == 1, F.lit("not json")).when(kind == 2, bare).when(kind == 3, word).when(kind == 4, untracked).otherwise(F.col("value"))
    return _daily_records(spark, d).withColumn("value", value)


_MET = "EXISTS (SELECT 1 FROM metered_site_day m WHERE m.site_id = p.site_id AND m.day = CAST(p.day_start AS DATE))"


@query(
    "a25_outcome_counts",
    sql(
        "SELECT outcome, count(*) AS count FROM (SELECT CASE p.site_id % 6 WHEN 1 THEN 'decode_err' WHEN 2 THEN 'skipped_no_fields' WHEN 3 THEN 'skipped_cast' "
        "WHEN 4 THEN 'missed_site' ELSE CASE WHEN " + _MET + " THEN 'matched' ELSE 'missed_no_meter' END END AS outcome FROM daily_pred p) GROUP BY 1 "
        "UNION ALL SELECT 'msgs', count(*) FROM daily_pred",
        "daily_pred", "metered_site_day",
    ),
)
def a25(spark, d):
    decoded = SV.decode_daily_record(_mixed_records(spark, d))
    live = SV.live_shortfall(decoded, X.metered_site_day(spark, d), tracked_sites=R.buildings(spark, d), zero_when_no_meter=False)
    return SV.outcome_counts(live)


@query(
    "st7_score_stream",
    sql(
        "SELECT w.site_id, b.building_id, w.timestamp, b.building_id IS NOT NULL AS finite, TRUE AS same_as_batch "
        "FROM wclean w LEFT JOIN buildings b ON w.site_id = b.site_id",
        "wclean", "buildings",
    ),
)
def st7(spark, d):
    """Fit the boosted pipeline, save it (S12), load it, and score the replayed
    weather stream fanned out to the buildings of each site (J5 -> ST11 -> ST12 -> ST7 -> ST8).
    Every streamed prediction is held against the saved model's batch score of the same row."""
    base = hand_off(model_base(X.feature(spark, d), R.buildings(spark, d)), "st7-base")
    model_dir = scratch_dir(spark, "best_pipeline")
    ML.save_model(ML.fit_pipeline(ML.pipeline_for("gbt"), base), model_dir)
    model = ML.load_model(model_dir)
    w = hand_off(X.wclean(spark, d), "st7-weather")
    labels = hand_off(month_labels(w), "season-labels")
    b = hand_off(R.buildings(spark, d).select("site_id", "building_id", "primary_use", "square_feet", "floor_count", "year_built"), "st7-buildings")
    feed = JB.replay_feed(w, ["site_id", "timestamp"], "st7")

    def predictions(fanned, *more):
        inputs = engineer(fanned.withColumn("ts", F.col("timestamp")), "ts")
        return prediction_rows(model.transform(lookup_season(inputs, labels, "month")), *more)

    out = JB.run_feed(feed, lambda **o: predictions(fan_out_buildings(JB.read_feed(spark, feed.path, **o), b)), "st7_predictions").written
    # each written row meets its reading and its building again (small tables), not a second fan-out
    written = out.withColumnsRenamed({"predicted_energy": "streamed", "gen_ts": "streamed_at"})
    same_building = (written.site_id == b.site_id) & written.building_id.eqNullSafe(b.building_id)
    own = written.join(b, same_building, "left").drop(b.site_id, b.building_id).join(w, ["site_id", "timestamp"])
    both = predictions(own, "streamed", "streamed_at")
    near = F.abs(F.col("streamed") - F.col("predicted_energy")) <= 1e-9 * F.abs("predicted_energy")
    finite = F.col("building_id").isNotNull() & F.col("streamed_at").isNotNull() & ~F.isnan("streamed")
    return both.select("site_id", "building_id", "timestamp", finite.alias("finite"), near.alias("same_as_batch"))


@query(
    "w4_last_n_stream",
    sql(
        "SELECT building_id, count(*) AS n_seen, CAST(least(count(*), 60) AS INTEGER) AS kept_count, "
        "round(sum(value) FILTER (WHERE rn <= 60), 6) AS kept_total FROM (SELECT *, row_number() OVER "
        "(PARTITION BY building_id ORDER BY ts DESC, event_id DESC) AS rn FROM readings) GROUP BY building_id",
        "readings",
    ),
)
def w4s(spark, d):
    """W4/W5/A26 stream form: bounded state of the newest 60 readings of each building, salted."""
    from ..streaming.state import last_n_states, merge_last_n

    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "w4s", chunks=2)
    newest = lambda **o: last_n_states(JB.read_feed(spark, feed.path, watermark=None, **o), "building_id", "value", ["ts", "event_id"], 60)
    written = JB.run_feed(feed, newest, "w4_last_n_state", mode="update").written
    final = merge_last_n(written, "building_id", "value", ["ts", "event_id"], 60)
    return final.select("building_id", "n_seen", "kept_count", F.round("kept_total", 6).alias("kept_total"))


@query("st2_watermark_eviction", sql("SELECT count(*) AS rows_aggregated, TRUE AS evicted, TRUE AS watermark_trails FROM readings", "readings"))
def st2(spark, d):
    """ST2: the watermark on the emitted clock bounds the state of the six-hour partials:
    once it has passed the last reading, only the control records' groups are held, and
    it trails the newest control record by the declared delay at least."""
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "st2", chunks=2, heartbeat=True)
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    run = JB.run_feed(feed, ticks, "st2_partials")
    last = feed.stamped.agg(F.max("weather_ts")).first()[0]
    mark = F.unix_timestamp(F.to_timestamp(F.lit(run.watermark)))
    trails = (mark > last) & (mark <= last + max(JB.HEARTBEAT_SECONDS) - TICK_SECONDS)
    return run.written.where("date is not null").agg(F.sum("n").alias("rows_aggregated")).select(
        "rows_aggregated", F.lit(run.state_rows <= len(JB.HEARTBEAT_SECONDS)).alias("evicted"), trails.alias("watermark_trails")
    )


@query(
    "st4_daily_updates",
    sql(
        "SELECT CAST(CAST(r.ts AS DATE) AS TIMESTAMP) AS day_start, CAST(CAST(r.ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS day_end, "
        "b.site_id, round(sum(r.value), 3) AS total_energy_day FROM readings r JOIN buildings b ON r.building_id = b.building_id GROUP BY ALL",
        "readings", "buildings",
    ),
)
def st4u(spark, d):
    """ST4, update form: totals of days still open through the idempotent foreachBatch sink (S7). The state holds
    partials of the ticks that the watermark has not passed; readers take each partial's last emission (ST9)."""
    feed = JB.replay_feed(X.readings(spark, d), ["ts", "event_id"], "st4u", chunks=2)
    sites = hand_off(R.buildings(spark, d).select("building_id", "site_id"), "st4u-sites")
    daily = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o).join(sites, "building_id"), "site_id", "value", "ts", with_block=False)
    written = JB.run_feed(feed, daily, "st4_daily_updates", mode="update").written
    totals = SA.roll_up(SA.latest_partials(written, "site_id", with_block=False), "site_id", with_block=False)
    return totals.select("day_start", "day_end", "site_id", "total_energy_day")


@query("st9_latest_emission_stream", sql("SELECT building_id, window_start, window_end, total_energy_6h FROM six_totals", "six_totals"))
def st9s(spark, d):
    """ST9, stream form: re-emitted six-hour records (written to Parquet) are tailed and
    reduced to the latest emission per (building, window); state of windows that the
    watermark on the records' stamp has passed is evicted."""
    src = scratch_dir(spark, "st9-records")
    SV.re_emitted_totals(X.readings(spark, d)).write.parquet(src)
    stream = tail_parquet(spark, src)
    written = JB.run_update(SA.latest_emission(stream, ["building_id", "window_start"], ["gen_ts", "seq"], "gen_ts"), "st9_latest")
    final = SV.latest_per_key(written, ["building_id", "window_start"], ["gen_ts", "seq"])
    return final.select("building_id", "window_start", "window_end", "total_energy_6h")


@query(
    "w4_last_n_site",
    sql(
        "SELECT site_id, count(*) AS kept, round(sum(value), 6) AS kept_total FROM (SELECT b.site_id, r.value, row_number() OVER "
        "(PARTITION BY b.site_id ORDER BY r.ts DESC, r.event_id DESC) AS rn FROM readings r JOIN buildings b ON r.building_id = b.building_id) WHERE rn <= "
        f"{HISTORY_LEN_SITE} GROUP BY 1",
        "readings", "buildings",
    ),
)
def w4site(spark, d):
    """W4 for sites: the newest 6,000 readings of each site, by salted two-stage top-n."""
    rows = X.readings(spark, d).join(R.buildings(spark, d).select("building_id", "site_id"), "building_id")
    kept = last_n_per_key(rows.select("site_id", "ts", "event_id", "value"), ["site_id"], ["ts", "event_id"], HISTORY_LEN_SITE)
    return kept.groupBy("site_id").agg(F.count(F.lit(1)).alias("kept"), F.round(F.sum("value"), 6).alias("kept_total"))


@query("s11_checkpoint_names", "SELECT name, folder, n_events, most_times FROM (VALUES ('daily totals/v1', 'daily_totals_v1'), ('six-hour totals', 'six-hour_totals')) t(name, folder), (SELECT count(DISTINCT event_id) AS n_events, max(n) AS most_times FROM (SELECT event_id, count(*) AS n FROM events GROUP BY 1))")
def s11(spark, d):
    """Each query checkpoints into a folder of its own, named after it, and resumes from it:
    a second run of the same query over the same files appends nothing."""
    src = scratch_dir(spark, "s11-src")
    R.read_table(spark, d, "events").select("event_id").write.parquet(src)
    rows = []
    for name in ("daily totals/v1", "six-hour totals"):
        out, root = scratch_dir(spark, "s11-out"), scratch_dir(spark, "s11-ckpt")
        for _ in range(2):
            sinks.run_until_done(sinks.to_parquet_append(tail_parquet(spark, src), out, name, checkpoint_root=root))
        folder = checkpoint_for(spark, name, root)
        found = folder.rsplit("/", 1)[1] if path_exists(spark, folder) else None
        rows.append(spark.read.parquet(out).select(F.lit(name).alias("name"), F.lit(found).cast("string").alias("folder"), "event_id"))
    taken = union_all_by_name(rows).groupBy("name", "folder", "event_id").agg(F.count(F.lit(1)).alias("times"))
    return taken.groupBy("name", "folder").agg(F.count(F.lit(1)).alias("n_events"), F.max("times").alias("most_times"))


@query(
    "st5_triggers",
    "SELECT trigger, event_type, n_rows, id_sum FROM (VALUES ('5 seconds'), ('7 seconds'), ('14 seconds'), ('availableNow')) t(trigger), "
    "(SELECT event_type, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1)",
)
def st5(spark, d):
    """ST5: the same stream under each cadence writes every row once."""
    src = scratch_dir(spark, "st5-src")
    R.read_table(spark, d, "events").select("event_id", "event_type").write.parquet(src)
    rows = []
    for cadence in (TRIGGER_PREDICTIONS, TRIGGER_SIXHOUR, TRIGGER_DAILY, "availableNow"):
        out = scratch_dir(spark, "st5-out")
        q = sinks.to_parquet_append(tail_parquet(spark, src), out, f"st5 {cadence}", trigger=cadence, checkpoint_root=scratch_dir(spark, "st5-ckpt"))
        if cadence == "availableNow":
            sinks.run_until_done(q)
        else:
            q.processAllAvailable()
            q.stop()
        rows.append(spark.read.parquet(out).withColumn("trigger", F.lit(cadence)))
    return union_all_by_name(rows).groupBy("trigger", "event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))


@query("st6_output_modes", sql("SELECT 'append' AS mode, CAST(site_id AS VARCHAR) AS key, count(*) AS n FROM buildings GROUP BY 2 UNION ALL SELECT 'update', CAST(site_id AS VARCHAR), count(*) FROM buildings GROUP BY 2", "buildings"))
def st6(spark, d):
    """ST6: an append-mode sink of the rows and an update-mode sink of their running counts agree."""
    src = scratch_dir(spark, "st6-src")
    R.buildings(spark, d).select("site_id", "building_id").write.parquet(src)
    rows = JB.run_append(tail_parquet(spark, src), "st6_append")
    appended = rows.groupBy(F.col("site_id").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    counts = tail_parquet(spark, src).groupBy(F.col("site_id").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    updated = SV.latest_per_key(JB.run_update(counts, "st6_update"), ["key"], ["batch_id"]).select("key", "n")
    return appended.select(F.lit("append").alias("mode"), "key", "n").unionByName(updated.select(F.lit("update").alias("mode"), "key", "n"))


@query("st13_stop_all", "SELECT 2 AS stopped, 0 AS still_active, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events")
def st13(spark, d):
    """ST13: every query started here is stopped; what it had written stays."""
    src, out = scratch_dir(spark, "st13-src"), scratch_dir(spark, "st13-out")
    R.read_table(spark, d, "events").select("event_id").write.parquet(src)
    mine = []
    for name, path in (("st13 a", out), ("st13 b", scratch_dir(spark, "st13-out"))):
        mine.append(sinks.to_parquet_append(tail_parquet(spark, src), path, name, trigger="1 second", checkpoint_root=scratch_dir(spark, "st13-ckpt")))
        mine[-1].processAllAvailable()
    names = {q.name for q in mine}
    stopped = names & set(sinks.stop_all(spark))
    active = sum(q.isActive for q in mine)
    kept = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))
    return kept.select(F.lit(len(stopped)).alias("stopped"), F.lit(active).alias("still_active"), "n_rows", "id_sum")


@query(
    "s12_model_round_trip",
    sql("SELECT count(*) AS n_rows, TRUE AS same_predictions, 6 AS n_stages FROM feature", "feature"),
)
def s12(spark, d):
    """S12 + M11: a fitted pipeline saved, overwritten and loaded again predicts the same for every row."""
    base = hand_off(model_base(X.feature(spark, d), R.buildings(spark, d)), "s12-base")
    model, _, _ = ML.fit_and_score(ML.pipeline_for("rf", numTrees=5), base, base)
    path = scratch_dir(spark, "s12-model")
    for _ in range(2):
        ML.save_model(model, path)
    loaded = ML.load_model(path)
    both = loaded.transform(model.transform(base).select("*", F.col("prediction").alias("fitted")).select(*base.columns, "fitted"))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count_if(F.col("prediction") != F.col("fitted")) == 0).alias("same_predictions"), F.lit(len(loaded.stages) + 1).alias("n_stages")
    )


@query(
    "st8_prediction_columns",
    sql("SELECT count(*) AS n_rows, 'site_id,building_id,timestamp,predicted_energy,gen_ts' AS columns, TRUE AS keyed FROM wclean w LEFT JOIN buildings b ON w.site_id = b.site_id", "wclean", "buildings"),
)
def st8(spark, d):
    """ST8: the published projection of a scored stream (here scored by the rate of the weather's own columns)."""
    w, b = hand_off(X.wclean(spark, d), "st8-weather"), R.buildings(spark, d).select("site_id", "building_id")
    feed = JB.replay_feed(w, ["site_id", "timestamp"], "st8")
    score = F.coalesce(F.col("air_temperature"), F.lit(0.0))
    build = lambda **o: prediction_rows(fan_out_buildings(JB.read_feed(spark, feed.path, **o), b).withColumn("prediction", score))
    out = JB.run_feed(feed, build, "st8_predictions").written
    return out.agg(F.count(F.lit(1)).alias("n_rows"), (F.count_if(F.col("site_id").isNull() | F.col("gen_ts").isNull()) == 0).alias("keyed")).withColumn("columns", F.lit(",".join(out.columns)))
