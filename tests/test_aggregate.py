import datetime as dt

from pyspark.sql import functions as F

from wattflow.operators import aggregate as A
from wattflow.operators.season import add_season_flag, lookup_season, month_labels
from wattflow.operators import profile as PR

M = "building_id int, meter_type string, ts timestamp_ntz, value double"


def test_carriers_summed_per_building_hour(spark):
    t = dt.datetime(2016, 1, 1, 7)
    df = spark.createDataFrame([(1, "e", t, 1.5), (1, "c", t, 2.0), (1, "s", t, 0.5), (1, "h", t, 1.0)], M)
    r = A.aggregate_energy(df).collect()
    assert len(r) == 1 and r[0]["agg_value"] == 5.0 and r[0]["interval"] == "6:00-11:59"


def test_buildings_kept_apart(spark):
    t = dt.datetime(2016, 1, 1, 7)
    df = spark.createDataFrame([(1, "e", t, 1.0), (2, "e", t, 2.0)], M)
    assert {r["building_id"]: r["agg_value"] for r in A.aggregate_energy(df).collect()} == {1: 1.0, 2: 2.0}


def test_true_six_hour_blocks(spark):
    rows = [(1, "e", dt.datetime(2016, 1, 1, h), 1.0) for h in range(24)]
    out = A.six_hour_block_totals(spark.createDataFrame(rows, M)).collect()
    assert len(out) == 4 and all(r["agg_value"] == 6.0 for r in out)


def _weather(spark, site_temps):
    rows = []
    for site, temps in site_temps.items():
        for m, t in enumerate(temps, start=1):
            rows.append((site, dt.datetime(2016, m, 15), None if t is None else float(t)))
    return spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, air_temperature double")


def test_six_peak_months_per_site(spark):
    temps = [30, 28, 24, 20, 15, 10, 8, 9, 14, 19, 23, 27]
    labels = {r["month"]: r["season_flag"] for r in month_labels(_weather(spark, {1: temps})).collect()}
    assert sorted(m for m, f in labels.items() if f == "peak") == [1, 2, 6, 7, 8, 12]


def test_two_climates_independent(spark):
    north = [0, 3, 6, 12, 17, 22, 25, 24, 19, 13, 7, 2]
    south = [25, 24, 21, 17, 14, 10, 9, 11, 13, 16, 20, 23]
    lab = month_labels(_weather(spark, {1: north, 2: south})).collect()
    n = sorted(r["month"] for r in lab if r["site_id"] == 1 and r["season_flag"] == "peak")
    s = sorted(r["month"] for r in lab if r["site_id"] == 2 and r["season_flag"] == "peak")
    assert n == [1, 2, 6, 7, 8, 12] and s == [1, 2, 6, 7, 8, 12]
    assert len(lab) == 24


def test_ties_widen_peak_set(spark):
    temps = [30, 28, 27, 20, 15, 10, 8, 9, 14, 19, 27, 27]  # tie at the third-hottest rank
    flags = [r["season_flag"] for r in month_labels(_weather(spark, {1: temps})).collect()]
    assert flags.count("peak") == 8


def test_all_null_month_takes_fallback(spark):
    temps = [30, 28, 24, 20, 15, 10, 8, 9, 14, 19, 23, None]
    w = _weather(spark, {1: temps})
    assert month_labels(w).count() == 11
    dec = add_season_flag(w).where(F.month("timestamp") == 12).first()
    assert dec["season_flag"] == "peak"  # December falls back to the calendar rule


def test_lookup_falls_back_for_unseen_site(spark):
    labels = spark.createDataFrame([(1, 3, "peak")], "site_id int, month int, season_flag string")
    df = spark.createDataFrame([(1, 3), (9, 3), (9, 7)], "site_id int, month int")
    got = {(r["site_id"], r["month"]): r["season_flag"] for r in lookup_season(df, labels).collect()}
    assert got == {(1, 3): "peak", (9, 3): "off-peak", (9, 7): "peak"}


def test_profile_single_pass_tables(spark):
    df = spark.createDataFrame([(0, None, "a"), (1, 2.0, None), (None, 0.0, "b")], "x int, y double, s string")
    nz = {r["column"]: (r["nulls"], r["zeros"]) for r in PR.nulls_zeros(df).collect()}
    assert nz == {"x": (1, 1), "y": (1, 1), "s": (1, None)}
    cm = {r["column"]: r["missing_total"] for r in PR.combined_missing(df).collect()}
    assert cm == {"x": 2, "y": 2, "s": 1}
    vc = {r["value"]: r["count"] for r in PR.value_counts_with_null(df, "s").collect()}
    assert vc == {"a": 1, "b": 1, "NULL": 1}


def test_boolean_like_detection(spark):
    df = spark.createDataFrame([(0, "peak", 5, True), (1, "off-peak", 7, False), (None, "peak", 9, None)], "f int, s string, n int, b boolean")
    got = {r["column"]: r["boolean_like"] for r in PR.boolean_like(df).collect()}
    assert got == {"f": True, "s": True, "n": False, "b": True}


def test_daily_mean_keeps_empty_days(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 1, 1, 3), 2.0), (dt.datetime(2016, 1, 1, 9), 4.0), (dt.datetime(2016, 1, 4), 1.0)], "ts timestamp_ntz, agg_value double")
    out = {r["day"]: r["daily_mean"] for r in A.daily_mean_with_spine(df).collect()}
    assert len(out) == 4 and out[dt.date(2016, 1, 1)] == 3.0 and out[dt.date(2016, 1, 2)] is None


def test_season_pivot_has_both_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 1, 1), "peak", 2.0)], "month timestamp_ntz, season_flag string, energy_kwh double")
    r = A.season_pivot(df).first()
    assert r["peak"] == 2.0 and r["off-peak"] == 0.0


def test_numeric_summary_exact_and_approximate(spark):
    import numpy as np

    vals = [float(v) for v in range(1, 1001)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "a double, b double")
    exact = {r["column"]: r for r in PR.numeric_summary(df).collect()}
    assert exact["a"]["p25"] == np.percentile(vals, 25) and exact["b"]["p75"] == np.percentile([v * 2 for v in vals], 75)
    approx = {r["column"]: r for r in PR.numeric_summary(df, relative_error=0.01).collect()}
    assert abs(approx["a"]["p50"] - 500.5) <= 0.01 * 1000 and approx["a"]["count"] == 1000.0


def test_fan_out_keeps_site_without_buildings(spark):
    from wattflow.operators.joins import fan_out_buildings

    w = spark.createDataFrame([(1, 20.0), (2, 15.0)], "site_id int, air_temperature double")
    b = spark.createDataFrame([(1, 10), (1, 11)], "site_id int, building_id int")
    rows = sorted((r["site_id"], r["building_id"]) for r in fan_out_buildings(w, b).collect())
    assert rows == [(1, 10), (1, 11), (2, None)]


def test_day_and_block_ignore_session_zone_on_dst_days(spark):
    from wattflow.functions.calendar import day_of, six_hour_block, six_hour_label

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        # 02:30 does not exist in Berlin on 2016-03-27 (clocks jump), 23:30 is just before local midnight
        df = spark.createDataFrame([(dt.datetime(2016, 3, 27, 2, 30),), (dt.datetime(2016, 10, 30, 23, 30),)], "ts timestamp_ntz")
        rows = df.select(day_of("ts").alias("d"), six_hour_block("ts").alias("b"), six_hour_label("ts").alias("l")).collect()
        assert (rows[0]["d"], rows[0]["b"], rows[0]["l"]) == (dt.date(2016, 3, 27), 0, "0:00-5:59")
        assert (rows[1]["d"], rows[1]["b"], rows[1]["l"]) == (dt.date(2016, 10, 30), 3, "18:00-23:59")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fan_out_deals_few_readings_over_many_tasks(spark):
    from wattflow.operators.joins import fan_out_buildings

    w = spark.range(0, 400, numPartitions=1).select((F.col("id") % 2).cast("int").alias("site_id"), "id")
    b = spark.range(6).select((F.col("id") % 2).cast("int").alias("site_id"), F.col("id").alias("building_id"))
    fan = fan_out_buildings(w, b, 6)
    per_task = fan.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct("site_id").alias("sites")).collect()
    assert sum(r["n"] for r in per_task) == 1200 and len(per_task) > 3
    assert sum(r["sites"] for r in per_task) <= len(per_task) + 1  # ranges of sites, one at most is split


def test_fan_out_counts_meet_null_and_repeated_sites(spark):
    from wattflow.catalog import q_aggregates as Q
    from wattflow.runtime import scratch_dir

    d = scratch_dir(spark, "t-fan")
    spark.createDataFrame(
        [(1, 10, 5.0, "BUILDING"), (2, 10, 5.0, "BUILDING"), (3, None, 5.0, "BUILDING"), (4, 11, 5.0, "BUILDING"), (4, 11, 5.0, "BUILDING")],
        "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
    ).write.parquet(f"{d}/customer.parquet")
    day = dt.datetime(1996, 1, 1)
    orders = [(1, day, 7.0), (2, day, 9.0), (2, day + dt.timedelta(days=1), 9.0), (3, day, 5.0), (4, None, 4.0), (4, day, 4.0)]
    rows = [(c, t, p, "F", "1-URGENT") for c, t, p in orders]
    spark.createDataFrame(rows, "o_custkey long, o_orderdate timestamp_ntz, o_totalprice double, o_orderstatus string, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    got = {r["site_id"]: tuple(r)[1:] for r in Q.j5(spark, d).collect()}
    assert got == {10: (4, 2, 2, 0), 11: (4, 1, 1, 0), None: (1, 1, 0, 1)}
