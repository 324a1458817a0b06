"""Skew and property tests for the distributed ordering operators."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattflow.operators.quantiles import exact_quantiles
from wattflow.operators.ranks import _fixed_ranges, global_index


def test_hot_key_is_spread_over_range_partitions(spark):
    # one key holds a third of all rows
    rows = [("hot" if i % 3 == 0 else f"k{i % 97}", i) for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, seq int")
    fixed = _fixed_ranges(df, ["k", "seq"], 6)
    sizes = [r["n"] for r in fixed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 3  # the hot key does not sit in one task
    hot_parts = fixed.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert hot_parts >= 2


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60))
def test_global_index_property(spark, pairs):
    rows = [(g, v, i) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "g int, v int, i int")
    got = {r["i"]: r["idx"] for r in global_index(df, ["g", "v", "i"], n_parts=3).collect()}
    expected = {i: pos for pos, (_, _, i) in enumerate(sorted(rows))}
    assert got == expected


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.floats(-1e6, 1e6, allow_nan=False, width=32)), min_size=1, max_size=60))
def test_exact_quantiles_property(spark, pairs):
    df = spark.createDataFrame([(g, float(v)) for g, v in pairs], "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in {p[0] for p in pairs}:
        vals = np.array([float(v) for gg, v in pairs if gg == g])
        for p in probs:
            assert abs(got[(g, p)] - np.percentile(vals, p * 100)) <= 1e-9 * max(1.0, abs(got[(g, p)]))


def test_empty_inputs_do_not_fail(spark):
    from wattflow.operators import stats as ST
    from wattflow.operators.profile import numeric_summary
    from wattflow.operators.windows import last_n_per_key, position_in_key

    empty = spark.createDataFrame([], "g string, v double, k int")
    assert global_index(empty, ["g", "v"]).count() == 0
    assert exact_quantiles(empty, "v", [0.5], ["g"]).count() == 0
    assert ST.signed_rank_tests(empty, {"x": ("v", "v")}).count() == 0
    assert position_in_key(empty, ["g"], ["v"]).count() == 0
    assert last_n_per_key(empty, ["g"], ["v"], 3).count() == 0
    s = {r["column"]: r["count"] for r in numeric_summary(empty, ["v"]).collect()}
    assert s == {"v": 0.0}
