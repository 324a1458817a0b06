import datetime as dt
import random

from wattflow.operators import windows as W
from wattflow.plans import serving as SV


def _records(spark):
    rnd = random.Random(5)
    rows = []
    for seq in range(600):
        b = 1 if seq % 3 else rnd.randint(2, 4)  # building 1 is hot
        rows.append((b, dt.datetime(2016, 1, 1) + dt.timedelta(minutes=seq * 7), seq, float(seq % 11)))
    return rows, spark.createDataFrame(rows, "building_id int, gen_ts timestamp_ntz, seq long, v double")


def test_last_n_per_key_matches_sort(spark):
    rows, df = _records(spark)
    got = {(r["building_id"], r["seq"]) for r in W.last_n_per_key(df, ["building_id"], ["gen_ts", "seq"], 60, salt_buckets=8).collect()}
    exp = set()
    for b in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == b], key=lambda r: (r[1], r[2]), reverse=True)[:60]
        exp |= {(b, r[2]) for r in mine}
    assert got == exp


def test_position_in_key(spark):
    rows, df = _records(spark)
    got = {r["seq"]: r["arrival_index"] for r in W.position_in_key(df, ["building_id"], ["gen_ts", "seq"]).collect()}
    for b in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == b], key=lambda r: (r[1], r[2]))
        assert [got[r[2]] for r in mine] == list(range(len(mine)))


def test_changed_from_previous_keeps_first_of_each_run(spark):
    data = [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "a"), (2, 1, "a"), (2, 2, "a")]
    df = spark.createDataFrame(data, "k int, o int, lab string")
    kept = sorted((r["k"], r["o"]) for r in W.changed_from_previous(df, ["k"], ["o"], "lab").where("is_new").collect())
    assert kept == [(1, 1), (1, 3), (1, 4), (2, 1)]


def test_moving_average_fewer_rows_at_start(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 6.0), (3, 9.0), (4, 0.0)], "m int, v double")
    got = [r["v_ma"] for r in W.moving_average(df, "m", ["v"]).orderBy("m").collect()]
    assert got == [3.0, 4.5, 6.0, 5.0]


def test_latest_emission_wins(spark):
    readings = spark.createDataFrame(
        [(1, dt.datetime(2016, 1, 1, 1), 1.0, 1), (1, dt.datetime(2016, 1, 1, 2), 2.0, 2), (1, dt.datetime(2016, 1, 1, 7), 5.0, 3)],
        "building_id int, ts timestamp_ntz, value double, event_id long",
    )
    rec = SV.re_emitted_totals(readings)
    assert rec.count() == 3
    latest = {r["window_start"].hour: r["total_energy_6h"] for r in SV.latest_per_key(rec, ["building_id", "window_start"], ["gen_ts", "seq"]).collect()}
    assert latest == {0: 3.0, 6: 5.0}


def test_daily_record_outcomes_and_live_shortfall(spark):
    recs = spark.createDataFrame(
        [
            ('{"site_id": 1, "total_energy_day": 12.5, "day_start": "2016-01-02T00:00:00"}',),
            ('{"siteId": "2", "kwh_day": "7", "date": "2016-01-03"}',),
            ('{"site_id": 3}',),
            ('{"site_id": "x", "prediction": 1}',),
            ("not json",),
            ("[1, 2]",),
            ('{"site_id": 9, "sum_day": 4, "day": "2016-01-02"}',),
        ],
        "value string",
    )
    dec = SV.decode_daily_record(recs)
    assert [r["outcome"] for r in dec.collect()] == ["ok", "ok", "skipped_no_fields", "skipped_cast", "decode_err", "skipped_no_fields", "ok"]
    metered = spark.createDataFrame([(1, "2016-01-02", 10.0)], "site_id int, day string, metered_energy double")
    sites = spark.createDataFrame([(1,), (2,)], "site_id int")
    live = {r["site_id"]: (r["outcome"], r["shortfall"]) for r in SV.live_shortfall(dec, metered, sites).collect() if r["site_id"] is not None}
    assert live[1] == ("matched", 2.5) and live[2] == ("matched", 7.0) and live[9][0] == "missed_site"
    strict = {r["site_id"]: r["outcome"] for r in SV.live_shortfall(dec, metered, sites, zero_when_no_meter=False).collect() if r["site_id"] is not None}
    assert strict[2] == "missed_no_meter"
    counts = {r["outcome"]: r["count"] for r in SV.outcome_counts(SV.live_shortfall(dec, metered, sites)).collect()}
    assert counts["msgs"] == 7 and counts["decode_err"] == 1 and counts["skipped_no_fields"] == 2


def test_six_hour_record_decoding(spark):
    recs = spark.createDataFrame(
        [('{"building_id": 4, "window_label": "2016-01-01T06:00:00", "kwh6h": 3.5}',), ('{"building_id": "5", "sum_6hr": "x"}',)], "value string"
    )
    rows = SV.decode_six_hour_record(recs).collect()
    assert (rows[0]["building_id"], rows[0]["window_label"], rows[0]["total_energy_6h"]) == (4, "2016-01-01T06:00:00", 3.5)
    assert rows[1]["window_label"] == "" and rows[1]["total_energy_6h"] is None
