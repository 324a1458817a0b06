import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattflow.operators import stats as ST
from wattflow.operators.quantiles import exact_quantiles
from wattflow.operators.ranks import global_index, tie_average_ranks


def _avg_ranks(x):
    order = sorted(range(len(x)), key=lambda i: x[i])
    ranks = [0.0] * len(x)
    i = 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and x[order[j + 1]] == x[order[i]]:
            j += 1
        for k in range(i, j + 1):
            ranks[order[k]] = (i + j) / 2.0 + 1
        i = j + 1
    return ranks


def _pratt_reference(d):
    """Brute-force Pratt signed-rank statistics with the normal approximation."""
    n = len(d)
    r = _avg_ranks([abs(v) for v in d])
    wp = sum(ri for ri, v in zip(r, d) if v > 0)
    wm = sum(ri for ri, v in zip(r, d) if v < 0)
    nz = sum(1 for v in d if v == 0)
    mean = n * (n + 1) / 4 - nz * (nz + 1) / 4
    var = n * (n + 1) * (2 * n + 1) - nz * (nz + 1) * (2 * nz + 1)
    nonzero = [abs(v) for v in d if v != 0]
    for val in set(nonzero):
        t = nonzero.count(val)
        if t > 1:
            var -= 0.5 * t * (t * t - 1)
    se = math.sqrt(var / 24)
    stat = min(wp, wm)
    return stat, (stat - mean) / se, wp, wm, nz


def test_signed_rank_matches_brute_force(spark):
    rnd = random.Random(7)
    a = [round(rnd.uniform(0, 5), 1) for _ in range(400)]
    b = [round(x + rnd.choice([-1, -0.5, 0, 0, 0.5, 1, 1.5]), 1) for x in a]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = ST.signed_rank_test(df, "a", "b").first()
    d = [x - y for x, y in zip(a, b)]
    stat, z, wp, wm, nz = _pratt_reference(d)
    assert got["n_zero"] == nz and got["n"] == len(d)
    assert abs(got["w_plus"] - wp) < 1e-9 and abs(got["w_minus"] - wm) < 1e-9
    assert abs(got["statistic"] - stat) < 1e-9 and abs(got["z"] - z) < 1e-9
    p = ST.paired_verdict(ST.signed_rank_test(df, "a", "b")).first()["significant"]
    assert p == (abs(z) > 1.959963984540054)


def test_p_value_helper(spark):
    zs = [0.0, 1e-9, 0.3, -1.0, 1.959963984540054, 2.5, 3.53, -3.54, 5.0, 8.0, -20.0, 37.0, 100.0, None]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in ST.p_values(df).collect():
        want = None if r.z is None else math.erfc(abs(r.z) / math.sqrt(2))
        assert (r.p_value is None) == (want is None) and (want is None or abs(r.p_value - want) <= 1e-12 * want)


def test_exact_quantiles_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.random() * 100) for _ in range(3000)] + [(f"g{i % 7}", float(i)) for i in range(700)] + [("one", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.98, 1.0], ["g"]).collect()}
    for g in {r[0] for r in rows if r[1] is not None}:
        vals = np.array([r[1] for r in rows if r[0] == g and r[1] is not None])
        for p in [0.0, 0.25, 0.5, 0.98, 1.0]:
            assert abs(got[(g, p)] - np.percentile(vals, p * 100)) < 1e-9
    assert not any(k[0] == "nulls" for k in got)


def test_exact_quantiles_over_octaves_ties_and_passes(spark, monkeypatch):
    from wattflow.operators import quantiles as Q

    rnd = random.Random(4)
    values = [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 5e-324, float("inf"), float("-inf"), float("nan"), None]
    values += [rnd.choice([1, -1]) * rnd.random() * 10.0 ** rnd.randint(-9, 9) for _ in range(500)] + [7.25] * 300 + [7.25 + i * 2**-49 for i in range(50)]
    df = spark.createDataFrame([(None, v) for v in values], "g string, v double")
    plain = np.array([v for v in values if v is not None and v == v])
    probs = [0.0, 0.001, 0.1, 0.25, 0.5, 0.61, 0.75, 0.9, 1.0]
    monkeypatch.setattr(Q, "PARTS", 4)
    for few in (Q.FEW_ROWS, 2):  # distinct values at once; narrower and narrower buckets
        monkeypatch.setattr(Q, "FEW_ROWS", few)
        got = {r.prob: r.value for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
        for p in probs:
            at = sorted(plain)
            k = p * (len(at) - 1)
            lo, hi = at[math.floor(k)], at[math.ceil(k)]
            want = lo if lo == hi else lo + (hi - lo) * (k - math.floor(k))
            assert got[p] == want or abs(got[p] - want) <= 1e-12 * abs(want) or math.isinf(lo) or math.isinf(hi)


def test_kth_smallest(spark):
    from wattflow.operators.quantiles import kth_smallest

    rows = [("a", float(v)) for v in (3, 1, 2, 2, 2, 9)] + [("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.value, r.before) for r in kth_smallest(df, "v", F.lit(4), ["g"]).collect()}
    assert got == {"a": (2.0, 2)}  # the third of the equal values; b has no fourth


def test_global_index_is_the_sorted_position(spark):
    rows = [(i % 5, (i * 37) % 101, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {r["c"]: r["idx"] for r in global_index(df, ["a", "b", "c"], n_parts=6).collect()}
    expected = {c: i for i, (_, _, c) in enumerate(sorted(rows))}
    assert got == expected


def test_tie_average_ranks(spark):
    x = [3.0, 1.0, 3.0, 2.0, 3.0, 0.0]
    counts = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    df = spark.createDataFrame(list(counts.items()), "v double, t long")
    got = {r["v"]: r["avg_rank"] for r in tie_average_ranks(df, "v", "t").collect()}
    ref = dict(zip(x, _avg_ranks(x)))
    assert got == ref


def test_histogram_matches_numpy(spark):
    rnd = random.Random(1)
    vals = [rnd.gauss(10, 3) for _ in range(2000)]
    h = ST.histogram(spark.createDataFrame([(v,) for v in vals], "v double"), "v", bins=60).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=60)
    assert [r["count"] for r in h] == list(counts)
    width = edges[1] - edges[0]
    assert abs(sum(r["density"] for r in h) * width - 1.0) < 1e-9


def test_kernel_density_integrates_to_one(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(3000)], "v double")
    k = ST.kernel_density(df, "v", grid=200).orderBy("g").collect()
    step = k[1]["x"] - k[0]["x"]
    assert abs(sum(r["density"] for r in k) * step - 1.0) < 0.02


def test_correlation_matches_numpy(spark):
    rnd = random.Random(4)
    a = [rnd.random() for _ in range(500)]
    b = [x * 2 + rnd.random() for x in a]
    c = ST.correlation_matrix(spark.createDataFrame(list(zip(a, b)), "a double, b double"), ["a", "b"])
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in c.collect()}
    assert abs(got[("a", "b")] - np.corrcoef(a, b)[0, 1]) < 1e-12 and abs(got[("a", "a")] - 1) < 1e-12


def test_box_stats_whiskers_inside_fences(spark):
    vals = list(range(1, 21)) + [100]
    df = spark.createDataFrame([("x", float(v)) for v in vals], "g string, v double")
    r = ST.box_stats(df, "v", ["g"]).first()
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert r["q1"] == q1 and r["q3"] == q3 and r["whisker_hi"] == 20.0 and r["whisker_lo"] == 1.0 and r["n"] == 21
    one = ST.box_stats(df.select("v"), "v").first()
    assert one["whisker_hi"] == 20.0


def test_median_difference(spark):
    df = spark.createDataFrame([(1.0, 0.0), (5.0, 1.0), (2.0, 1.0)], "a double, b double")
    assert ST.median_difference(df, "a", "b").first()["median_diff"] == 1.0


def test_grouped_histogram_matches_numpy_per_group(spark):
    rnd = random.Random(12)
    rows = [("a", rnd.gauss(0, 1)) for _ in range(800)] + [("b", rnd.expovariate(2.0)) for _ in range(500)]
    h = ST.histogram(spark.createDataFrame(rows, "grp string, v double"), "v", bins=60, group_cols=["grp"]).collect()
    for g in ("a", "b"):
        vals = [v for gg, v in rows if gg == g]
        counts, _ = np.histogram(vals, bins=60)
        got = [r["count"] for r in sorted((r for r in h if r["grp"] == g), key=lambda r: r["bin"])]
        assert got == list(counts)
    k = ST.kernel_density(spark.createDataFrame(rows, "grp string, v double"), "v", group_cols=["grp"], grid=200).collect()
    for g in ("a", "b"):
        pts = sorted((r["x"], r["density"]) for r in k if r["grp"] == g)
        step = pts[1][0] - pts[0][0]
        assert abs(sum(d for _, d in pts) * step - 1.0) < 0.03


def test_group_statistics_meet_the_values_without_a_shuffle_by_group(spark):
    """Two groups must not mean two tasks: the ranges of the groups are sent to the counted values, by their size."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), (F.col("id") / 7).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")  # the counted values are larger, a row a group is not
    try:
        for found, rows in ((ST.histogram(df, "v", bins=4, group_cols=["g"]), 8), (ST.kernel_density(df, "v", grid=5, group_cols=["g"]), 10)):
            first = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin [coalesce(g" in first
            assert found.count() == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
