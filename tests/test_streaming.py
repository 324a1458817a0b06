import datetime as dt
import json

from pyspark.sql import functions as F

from wattflow.contract import BATCH_SIZE
from wattflow.plans.totals import SIX_HOURS, window_totals
from wattflow.runtime import scratch_dir
from wattflow.sources.payload import decode_weather, weather_payload
from wattflow.sources.replay import replay_order, stamp
from wattflow.streaming import aggregates as SA
from wattflow.streaming import jobs as JB
from wattflow.streaming import sinks


def _weather_rows(n, site=1):
    t0 = dt.datetime(2016, 1, 1)
    return [(site, t0 + dt.timedelta(hours=i), float(i % 30), None if i % 50 == 0 else 2) for i in range(n)]


WS = "site_id int, timestamp timestamp_ntz, air_temperature double, cloud_coverage int"


def test_replay_blocks_and_tail(spark):
    df = spark.createDataFrame(_weather_rows(360), WS)
    s = stamp(replay_order(df, ["site_id", "timestamp"]), base_epoch=1000).orderBy("idx").collect()
    assert len(s) == 360  # 3 full batches
    assert [r["weather_ts"] for r in s[:BATCH_SIZE:24]] == [1000, 1001, 1002, 1003, 1004]
    assert s[BATCH_SIZE]["weather_ts"] == 1005
    tail = stamp(replay_order(spark.createDataFrame(_weather_rows(180), WS), ["site_id", "timestamp"]), 0)
    assert tail.count() == 180  # the last batch is short, no row is lost


def test_payload_keeps_nulls_and_round_trips(spark):
    df = spark.createDataFrame(_weather_rows(3), WS).withColumn("weather_ts", F.lit(7))
    df = df.withColumn("dew_temperature", F.lit(None).cast("double")).withColumn("sea_level_pressure", F.lit(float("nan")))
    df = df.withColumn("wind_direction", F.lit(0)).withColumn("wind_speed", F.lit(1.5))
    js = df.select(weather_payload(df).alias("value"))
    first = json.loads(js.first()["value"])
    assert len(first) == 9 and first["dew_temperature"] is None and first["sea_level_pressure"] is None
    back = decode_weather(js).orderBy("timestamp").first()
    assert back["timestamp"] == dt.datetime(2016, 1, 1) and back["weather_ts"] == 7 and back["wind_direction"] == 0


def test_malformed_payload_gives_null_fields(spark):
    raw = spark.createDataFrame([("{not json",), ('{"site_id": 3, "timestamp": "junk", "weather_ts": 5}',)], "value string")
    rows = decode_weather(raw).collect()
    assert rows[0]["site_id"] is None
    assert rows[1]["site_id"] == 3 and rows[1]["timestamp"] is None and rows[1]["event_time"] is not None


def test_two_clock_partials_drop_late_replay_and_evict(spark):
    rows = [(1, dt.datetime(2016, 1, 1) + dt.timedelta(hours=i), float(i), i) for i in range(480)]
    df = spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long")
    # the first chunk is sent again at the end: its tick windows ended before the
    # late-events watermark, so Spark drops it (a window still open would be kept)
    feed = JB.replay_feed(df, ["ts", "event_id"], "t-late", chunks=4, heartbeat=True, resend_first=True)
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    run = JB.run_feed(feed, ticks, "t_late")
    totals = SA.roll_up(run.written, "building_id")
    assert totals.agg(F.sum("n_readings")).first()[0] == 480  # nothing counted twice
    assert spark.read.parquet(feed.path).where("event_id is not null").count() > 480
    assert abs(totals.agg(F.sum("total_energy_6h")).first()[0] - sum(float(i) for i in range(480))) < 1e-6
    assert run.state_rows <= 2  # old ticks evicted from state


def test_update_sink_replay_is_idempotent(spark):
    df = spark.createDataFrame([(1, dt.datetime(2016, 1, 1, h), 1.0) for h in range(12)], "building_id int, timestamp timestamp_ntz, prediction double")
    out = scratch_dir(spark, "t-update")

    def write(batch_df, batch_id):
        batch_df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    agg = window_totals(df, SIX_HOURS, stamped=True).drop("gen_ts")
    write(agg, 0)
    write(agg, 0)  # a replayed batch rewrites its own folder
    assert spark.read.parquet(out).count() == 2


def test_stop_all_and_checkpoint_names(spark):
    from wattflow.runtime import checkpoint_for

    assert checkpoint_for(spark, "daily totals/v1", "/x").endswith("/daily_totals_v1")
    src = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = sinks.to_memory(src, "t_rate", trigger="1 second")
    assert "t_rate" in sinks.stop_all(spark) and not q.isActive


def test_last_n_state_matches_brute_force(spark):
    from wattflow.streaming.state import last_n_states, merge_last_n

    rows = [(i % 3, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=i), float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long")
    feed = JB.replay_feed(df, ["ts", "event_id"], "t-lastn", chunks=3)
    newest = lambda **o: last_n_states(JB.read_feed(spark, feed.path, watermark=None, **o), "building_id", "value", ["ts", "event_id"], 7)
    run = JB.run_feed(feed, newest, "t_lastn", mode="update")
    assert run.state_rows > 3 * 8  # a key's rows spread over its salts
    got = {r["building_id"]: (r["n_seen"], r["kept_count"], r["kept_total"]) for r in merge_last_n(run.written, "building_id", "value", ["ts", "event_id"], 7).collect()}
    for b in range(3):
        vals = [r[2] for r in rows if r[0] == b]
        assert got[b] == (len(vals), 7, sum(vals[-7:]))


def test_replay_wraps_and_continues_numbering(spark):
    df = spark.createDataFrame(_weather_rows(180), WS)  # 1.5 batches
    s = stamp(replay_order(df, ["site_id", "timestamp"]), base_epoch=0, cycles=2).orderBy("batch_id", "idx").collect()
    assert len(s) == 360 and sorted({r["batch_id"] for r in s}) == [0, 1, 2, 3]  # each pass ends with a short batch
    again = next(r for r in s if r["batch_id"] == 2)
    assert again["idx"] == 0 and again["weather_ts"] == 10  # the second pass restarts at the first row


def test_contract_cadence_and_batch_shape():
    from wattflow.contract import DAYS_PER_TICK, ROWS_PER_DAY, TICK_SECONDS, WATERMARK_DELAY

    assert BATCH_SIZE == 120 == ROWS_PER_DAY * DAYS_PER_TICK
    assert WATERMARK_DELAY == f"{TICK_SECONDS} seconds"


def test_payload_has_every_field_and_keeps_nulls(spark):
    from wattflow.contract import WEATHER_PAYLOAD_SCHEMA

    df = spark.createDataFrame(_weather_rows(2), WS)
    for c, t in (("dew_temperature", "double"), ("sea_level_pressure", "double"), ("wind_direction", "int"), ("wind_speed", "double")):
        df = df.withColumn(c, F.lit(None).cast(t))
    df = df.withColumn("air_temperature", F.lit(None).cast("double")).withColumn("weather_ts", F.lit(1))
    p = json.loads(df.select(weather_payload(df).alias("v")).first()["v"])
    assert set(p) == set(WEATHER_PAYLOAD_SCHEMA.fieldNames())
    assert p["air_temperature"] is None and p["cloud_coverage"] is None


def test_latest_emission_stream_matches_batch(spark):
    from wattflow.plans.serving import latest_per_key, re_emitted_totals

    rows = [(i % 4, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=37 * i), float(i % 9), i) for i in range(400)]
    readings = spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long")
    rec = re_emitted_totals(readings)
    path = scratch_dir(spark, "t-records")
    rec.write.parquet(path)
    from wattflow.sources.files import tail_parquet

    stream = tail_parquet(spark, path)
    run = JB.run_feed(None, lambda: SA.latest_emission(stream, ["building_id", "window_start"], ["gen_ts", "seq"], "gen_ts"), "t_latest", mode="update")
    final = latest_per_key(run.written, ["building_id", "window_start"], ["gen_ts", "seq"])
    assert run.state_rows <= 3 * 4  # windows within the delay of the newest stamp, of four keys
    batch = latest_per_key(rec, ["building_id", "window_start"], ["gen_ts", "seq"])
    cols = ["building_id", "window_start", "total_energy_6h", "seq"]
    assert sorted(tuple(r) for r in final.select(*cols).collect()) == sorted(tuple(r) for r in batch.select(*cols).collect())


def test_compact_update_output(spark):
    from wattflow.plans.serving import compact_update_output

    out = scratch_dir(spark, "t-compact-src")
    for b, total in ((0, 1.0), (1, 3.0), (2, 6.0)):
        spark.createDataFrame([(7, total), (8, float(b))], "k int, total double").write.parquet(f"{out}/batch_id={b}")
    compact = compact_update_output(spark, out, ["k"], scratch_dir(spark, "t-compact-dst"))
    assert {r["k"]: r["total"] for r in compact.collect()} == {7: 6.0, 8: 2.0}


def test_last_n_state_does_not_depend_on_chunk_order(spark):
    """Twenty rows of one key in falling order, Arrow chunks of two: the newest three are kept."""
    from wattflow.streaming.state import last_n_states, merge_last_n

    rows = [(1, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=i), float(i), i) for i in reversed(range(20))]
    src = scratch_dir(spark, "t-lastn-src")
    spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long").coalesce(1).write.parquet(src)
    from wattflow.sources.files import tail_parquet

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        written = JB.run_update(last_n_states(tail_parquet(spark, src), "building_id", "value", ["ts", "event_id"], 3, salts=2), "t_lastn_order")
        got = merge_last_n(written, "building_id", "value", ["ts", "event_id"], 3).first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert (got["n_seen"], got["kept_count"], got["kept_total"]) == (20, 3, 17.0 + 18 + 19)


def test_update_form_state_is_evicted(spark):
    """Partials of ticks behind the watermark leave the state; their last emissions add up to the totals."""
    rows = [(i % 4, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=13 * i), float(i), i) for i in range(480)]
    df = spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long")
    feed = JB.replay_feed(df, ["ts", "event_id"], "t-open", chunks=2, heartbeat=True)
    ticks = lambda **o: SA.tick_partials(JB.read_feed(spark, feed.path, **o), "building_id", "value", "ts")
    run = JB.run_feed(feed, ticks, "t_open", mode="update")
    assert run.state_rows <= 2  # the control records alone
    totals = SA.roll_up(SA.latest_partials(run.written, "building_id"), "building_id")
    got = {(r.building_id, r.window_start): (r.total_energy_6h, r.n_readings) for r in totals.collect()}
    want: dict = {}
    for b, t, v, _ in rows:
        k = (b, t.replace(hour=t.hour // 6 * 6, minute=0))
        have = want.get(k, (0.0, 0))
        want[k] = (have[0] + v, have[1] + 1)
    assert got == want


def test_last_n_states_hold_many_keys_in_one_state(spark):
    """Python is called once a bucket, not once a key: 600 keys and rows without a key in at most 8 + 2 states."""
    from wattflow.streaming.state import last_n_states, merge_last_n

    rows = [(None if i % 601 == 600 else i % 601, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=i), float(i), i) for i in range(3005)]
    df = spark.createDataFrame(rows, "building_id long, ts timestamp_ntz, value double, event_id long")
    feed = JB.replay_feed(df, ["ts", "event_id"], "t-lastn-keys", chunks=2)
    newest = lambda **o: last_n_states(JB.read_feed(spark, feed.path, watermark=None, **o), "building_id", "value", ["ts", "event_id"], 3, salts=2, buckets=8)
    run = JB.run_feed(feed, newest, "t_lastn_keys", mode="update")
    assert run.state_rows <= 8 + 2
    got = {r["building_id"]: (r["n_seen"], r["kept_count"], r["kept_total"]) for r in merge_last_n(run.written, "building_id", "value", ["ts", "event_id"], 3).collect()}
    want = {k: (5, 3, sum(float(k + 601 * j) for j in (2, 3, 4))) for k in range(600)}
    assert got == want  # rows without a key are kept in the states, the merge joins on the key
    lone = run.written.where("building_id is null").groupBy("salt").agg({"n_seen": "max"}).collect()
    assert sum(r[1] for r in lone) == 5
