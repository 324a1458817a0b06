import datetime as dt

from pyspark.sql import functions as F

from wattflow.operators import aggregate as A
from wattflow.operators import topk as T
from wattflow.runtime import checkpoint_for, hand_off, sanitise
from wattflow.streaming.jobs import state_partitions


def test_hand_off_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    out = hand_off(df, "t-hand-off")
    assert out.schema == df.schema and sorted(out.collect()) == sorted(df.collect())
    assert out.inputFiles()


def test_state_partitions_restores_session_setting(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 3) as n:
        assert n == 3 and spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_names_and_checkpoint_paths():
    assert sanitise("six hour/totals v2") == "six_hour_totals_v2"
    assert checkpoint_for(None, "a b", "/root").endswith("/root/a_b")


def test_topk_and_hash_pick_are_deterministic(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(200)], "k int, v int")
    a = [r["k"] for r in T.hash_pick(df, ["k"], 20).collect()]
    b = [r["k"] for r in T.hash_pick(df.repartition(5), ["k"], 20).collect()]
    assert a == b and len(set(a)) == 20
    top = [(r["v"], r["k"]) for r in T.top_by(df, "v", 3, ["k"]).collect()]
    assert top == [(6, 6), (6, 13), (6, 20)]


def test_bucket_means_have_all_four_buckets(spark):
    t = spark.createDataFrame([(1, dt.datetime(2016, 1, 1, 6), 4.0), (1, dt.datetime(2016, 1, 2, 6), 2.0)], "building_id int, window_start timestamp_ntz, total_energy_6h double")
    rows = {r["bucket"]: r["mean_energy"] for r in A.bucket_means(t).collect()}
    assert len(rows) == 4 and rows["06:00–12:00"] == 3.0 and rows["00:00–06:00"] is None


def test_padded_range_and_row_counts(spark):
    df = spark.createDataFrame([(1, -2.0), (1, 5.0), (2, 0.5)], "k int, v double")
    r = {x["k"]: (x["lo"], x["hi"]) for x in A.padded_range(df, "k", "v").collect()}
    assert r[1] == (-2.0 - 0.5, 5.0 + 0.5) and r[2] == (0.5 - 0.1, 0.5 + 0.1)
    counts = {x["dataset"]: x["n_rows"] for x in A.row_counts({"a": df, "b": df.where(F.col("k") == 1)}).collect()}
    assert counts == {"a": 3, "b": 2}
