"""The published log as a stream source: pieces, start policies, restarts, lost pieces."""

import pytest
from pyspark.sql import functions as F

from wattflow.runtime import scratch_dir
from wattflow.sources import published as PL
from wattflow.streaming import sinks


def piece(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.concat(F.lit("v"), "id").alias("text"), F.expr("timestamp_ntz'2016-01-01 00:00:00'").alias("at")).repartition(2)


def run(spark, log, out, root, policy, group="g", strict=False):
    rows = PL.read_log(spark, log, piece(spark, 0, 1).schema, group, policy, fail_on_data_loss=strict)
    sinks.run_until_done(sinks.to_parquet_append(rows, out, f"t {policy}", checkpoint_root=root))
    if not PL._at(spark, out)[0].exists(PL._at(spark, out)[1]):
        return []
    return sorted((r.id, r.piece) for r in spark.read.schema("id long, piece long").parquet(out).collect())


def places(spark):
    return [scratch_dir(spark, f"t-{x}") for x in ("log", "out", "ckpt")]


def test_earliest_takes_all_and_restarts_without_repeats(spark):
    log, out, root = places(spark)
    assert PL.publish(piece(spark, 0, 5), log) == 1 and PL.publish(piece(spark, 5, 9), log) == 2
    want = [(i, 1 if i < 5 else 2) for i in range(9)]
    assert run(spark, log, out, root, "earliest") == want
    assert run(spark, log, out, root, "earliest") == want
    PL.publish(piece(spark, 9, 12), log)
    assert run(spark, log, out, root, "earliest") == want + [(i, 3) for i in range(9, 12)]


def test_latest_keeps_its_place_before_the_first_batch(spark):
    log, out, root = places(spark)
    PL.publish(piece(spark, 0, 5), log)
    assert run(spark, log, out, root, "latest") == []
    PL.publish(piece(spark, 5, 9), log)  # published while the consumer was away; its checkpoint is lost besides
    root = scratch_dir(spark, "t-ckpt")
    assert run(spark, log, out, root, "latest") == [(i, 2) for i in range(5, 9)]
    # another group begins at the end
    assert run(spark, log, scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ckpt"), "latest", group="other") == []


def test_live_begins_at_the_end_each_time(spark):
    log, out, root = places(spark)
    PL.publish(piece(spark, 0, 5), log)
    assert run(spark, log, out, root, "live") == []
    PL.publish(piece(spark, 5, 9), log)
    assert run(spark, log, out, scratch_dir(spark, "t-ckpt"), "live") == []  # a new start
    PL.publish(piece(spark, 9, 12), log)
    assert run(spark, log, out, root, "live") == [(i, 2) for i in range(5, 9)] + [(i, 3) for i in range(9, 12)]  # back from its checkpoint


def test_incomplete_and_lost_pieces(spark):
    log, out, root = places(spark)
    PL.publish(piece(spark, 0, 5), log)
    PL.publish(piece(spark, 5, 9), log)
    piece(spark, 9, 12).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{log}/piece=7")  # no mark: still being written
    assert PL.published_pieces(spark, log) == [1, 2]
    fs, first = PL._at(spark, f"{log}/piece=1")
    fs.delete(first, True)
    with pytest.raises(Exception, match="are gone"):
        run(spark, log, scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ckpt"), "earliest", group="strict", strict=True)
    assert run(spark, log, out, root, "earliest") == [(i, 2) for i in range(5, 9)]


def test_empty_log_and_unknown_policy(spark):
    log, out, root = places(spark)
    assert run(spark, log, out, root, "earliest") == []
    with pytest.raises(ValueError):
        PL.read_log(spark, log, piece(spark, 0, 1).schema, policy="newest")
