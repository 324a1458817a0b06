import pytest
from pyspark.sql import types as T

from wattflow.contract import METERS_SCHEMA
from wattflow.runtime import scratch_dir
from wattflow.sources import files as S
from wattflow.sources.payload import decode_json, keyed_json

SCHEMA = T.StructType([T.StructField("site_id", T.IntegerType(), False), T.StructField("air_temperature", T.DoubleType(), True)])


def test_typed_csv_scan_with_declared_schema(spark):
    path = scratch_dir(spark, "t-csv")
    spark.createDataFrame([(1, 2.5), (2, None)], SCHEMA).write.option("header", True).csv(path)
    rows = sorted(S.typed_scan(spark, path, SCHEMA).collect())
    assert rows[0]["site_id"] == 1 and rows[0]["air_temperature"] == 2.5 and rows[1]["air_temperature"] is None


def test_reordered_header_fails_instead_of_shifting(spark):
    path = scratch_dir(spark, "t-csv-reordered")
    spark.createDataFrame([(2.5, 1)], "air_temperature double, site_id int").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        S.typed_scan(spark, path, SCHEMA).collect()


def test_bad_key_is_dropped(spark):
    path = scratch_dir(spark, "t-csv-badkey")
    spark.createDataFrame([("x", "1.0"), ("3", "2.0")], "site_id string, air_temperature string").write.option("header", True).csv(path)
    kept = S.require_keys(S.typed_scan(spark, path, SCHEMA), ["site_id"]).collect()
    assert [r["site_id"] for r in kept] == [3]


def test_load_report(spark):
    df = spark.createDataFrame([(1, "e")], "building_id bigint, meter_type string")
    rep = {r["field"]: (r["n_rows"], r["loaded_type"], r["ok"]) for r in S.load_report({"meters": (df, METERS_SCHEMA)}).collect()}
    assert rep["building_id"] == (1, "bigint", True) and rep["ts"] == (1, None, False)


def test_keyed_json_roundtrip(spark):
    df = spark.createDataFrame([(7, None, 1.5)], "site_id int, day string, total double")
    kv = keyed_json(df, "site_id").first()
    assert kv["key"] == "7" and '"day":null' in kv["value"]
    back = decode_json(keyed_json(df, "site_id"), "site_id int, day string, total double").first()
    assert back["site_id"] == 7 and back["total"] == 1.5
