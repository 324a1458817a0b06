"""Segmented scan: hot keys over many cells, NULL keys and values, one shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattflow.operators.scan import scan_in_order
from wattflow.operators import windows as W
from wattflow.plans import serving as SV

KIND = "k string, w int, o int, v double, lab string"


def plain(rows):
    out, last, n, total, seen = {}, None, 0, 0.0, 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        if last is None or (r[0], r[1]) != (last[0], last[1]):
            n, total, seen, before = 0, 0.0, 0, None
        else:
            before = last[4]
        if r[3] is not None:
            total, seen = total + r[3], seen + 1
        out[r[2]] = (n, total if seen else None, before)
        n, last = n + 1, r
    return out


@pytest.mark.parametrize("parts", [1, 3, 9])
@pytest.mark.parametrize("chunk", ["7", "10000"])
def test_matches_plain_scan(spark, parts, chunk):
    rnd = random.Random(parts)
    rows = []
    for o in range(700):
        key = "hot" if o % 2 else rnd.choice([None, "a", "b", "", "hot"])
        rows.append((key, rnd.choice([1, 1, 1, 2, None]), o, rnd.choice([None, 0.5, 1.25, -3.0]), rnd.choice([None, "x", "y"])))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        got = scan_in_order(df, ["k", "w"], ["o"], sums={"total": "v"}, previous={"before": "lab"}, position="n", parts=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        n, total, before = want[r.o]
        assert (r.n, r.before) == (n, before) and (r.total == total or abs(r.total - total) < 1e-9)


def test_hot_window_spreads_over_cells(spark):
    """Half the rows in one (key, window): no cell holds over three times the median."""
    t0 = dt.datetime(2016, 1, 1)
    rows = [(1, t0 + dt.timedelta(seconds=i), 1.0, i) for i in range(4000)] + [(2 + i % 50, t0 + dt.timedelta(minutes=i), 1.0, 4000 + i) for i in range(4000)]
    readings = spark.createDataFrame(rows, "building_id int, ts timestamp_ntz, value double, event_id long")
    spark.conf.set("spark.wattflow.rangePartitions", "8")
    try:
        records = SV.re_emitted_totals(readings)
        top = records.where("building_id = 1").agg(F.max("total_energy_6h").alias("t"), F.count(F.lit(1)).alias("n")).first()
        cells = [r["count"] for r in scan_in_order(readings, ["building_id"], ["ts", "event_id"], position="n").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.wattflow.rangePartitions")
    assert (top.t, top.n) == (4000.0, 4000)
    assert max(cells) <= 3 * sorted(cells)[len(cells) // 2]


def test_empty_table_and_one_row(spark):
    empty = spark.createDataFrame([], KIND)
    assert scan_in_order(empty, ["k"], ["o"], sums={"t": "v"}, previous={"p": "lab"}).count() == 0
    one = spark.createDataFrame([("a", 1, 1, None, "x")], KIND)
    assert scan_in_order(one, ["k"], ["o"], sums={"t": "v"}, previous={"p": "lab"}, position="n").select("t", "p", "n").first() == (None, None, 0)


def test_repeats_with_null_labels(spark):
    rows = [("a", 1, i, 0.0, lab) for i, lab in enumerate([None, None, "x", "x", None])]
    got = W.changed_from_previous(spark.createDataFrame(rows, KIND), ["k"], ["o"], "lab").where("is_new").select("o").collect()
    assert sorted(r.o for r in got) == [0, 2, 4]
