"""End-to-end: train on a small frame, then score a replayed feed and roll up the totals."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wattflow.contract import NUMERIC_INPUTS
from wattflow.ml import pipelines as ML
from wattflow.operators.season import month_labels
from wattflow.runtime import scratch_dir
from wattflow.sources.replay import payload_frame, replay_order, stamp
from wattflow.streaming import app, sinks
from wattflow.streaming.sources import read_value_files


def test_score_feed_then_totals(spark):
    rnd = random.Random(9)
    # model trained on a small contract-shaped frame
    schema = ", ".join(f"{c} double" for c in NUMERIC_INPUTS) + ", primary_use string, season_flag string, label double"
    rows = [tuple(rnd.uniform(0, 30) for _ in NUMERIC_INPUTS) + (rnd.choice(["Office", "Retail"]), rnd.choice(["peak", "off-peak"]), rnd.uniform(0, 100)) for _ in range(60)]
    model_path = ML.save_model(ML.pipeline_for("rf", numTrees=3, maxDepth=3, minInstancesPerNode=1).fit(spark.createDataFrame(rows, schema)), scratch_dir(spark, "t-model"))

    # two sites, 48 hourly readings each; buildings: two at site 1, one at site 2
    t0 = dt.datetime(2016, 3, 1)
    w_rows = [(s, t0 + dt.timedelta(hours=h), 10.0 + h % 7, 2, 5.0, 1010.0, 90, 3.0) for s in (1, 2) for h in range(48)]
    weather = spark.createDataFrame(
        w_rows, "site_id int, timestamp timestamp_ntz, air_temperature double, cloud_coverage int, dew_temperature double, sea_level_pressure double, wind_direction int, wind_speed double"
    )
    buildings = spark.createDataFrame(
        [(1, 10, "Office", 1000, 2, 1990), (1, 11, "Retail", 500, 1, 2001), (2, 20, "Office", 800, 3, 1975)],
        "site_id int, building_id int, primary_use string, square_feet int, floor_count int, year_built int",
    )
    labels_path = scratch_dir(spark, "t-labels")
    month_labels(weather).write.parquet(labels_path)

    feed = scratch_dir(spark, "t-feed")
    stamped = stamp(replay_order(weather, ["site_id", "timestamp"]), base_epoch=1_700_000_000)
    payload_frame(stamped).select("value").write.parquet(feed)
    last = stamped.agg(F.max("weather_ts")).first()[0]
    for lag in (3600, 3601):  # control records: move the watermark so every tick is emitted
        spark.createDataFrame([(f'{{"weather_ts": {last + lag}}}',)], "value string").coalesce(1).write.mode("append").parquet(feed)

    out = scratch_dir(spark, "t-app")
    raw = read_value_files(spark, feed, max_files_per_trigger=1)
    sinks.run_until_done(app.start_predictions(raw, buildings, model_path, labels_path, out, trigger="availableNow"))
    preds = spark.read.parquet(f"{out}/predictions").where(F.col("building_id").isNotNull())
    assert preds.count() == 48 * 2 + 48 * 1 and preds.where(F.col("predicted_energy").isNull()).count() == 0

    six_q, day_q = app.start_totals(spark, out, trigger_six="availableNow", trigger_day="availableNow")
    sinks.run_until_done(six_q)
    sinks.run_until_done(day_q)
    six, day = app.read_totals(spark, out)
    total = preds.agg(F.sum("predicted_energy")).first()[0]
    assert abs(six.agg(F.sum("total_energy_6h")).first()[0] - total) < 0.01
    assert abs(day.agg(F.sum("total_energy_day")).first()[0] - total) < 0.01
    assert six.count() == 3 * 8 and day.count() == 2 * 2


def test_train_and_select_on_smallest_tables(spark, sf_small):
    from pyspark.ml import PipelineModel

    from wattflow.plans.training import train_and_select
    from wattflow.sources import tables as R

    res = train_and_select(
        R.meters_daily(spark, sf_small), R.buildings(spark, sf_small), R.weather(spark, sf_small),
        candidates={"rf": {"numTrees": 5, "maxDepth": 3}, "gbt": {"maxIter": 3, "maxDepth": 3}}, tune=False,
    )
    rows = {r["model"]: r for r in res.metrics.collect()}
    assert set(rows) == {"rf", "gbt"} and sum(r["chosen"] for r in rows.values()) == 1
    assert rows[res.chosen]["rmsle"] == min(r["rmsle"] for r in rows.values())
    assert PipelineModel.load(res.model_path) is not None and spark.read.parquet(res.labels_path).count() > 0
