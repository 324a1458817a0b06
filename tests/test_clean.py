import pytest
from pyspark.sql import functions as F

from wattflow.operators import clean as P


def test_normalise_missing_encodings(spark):
    df = spark.createDataFrame([("1013.25",), ("",), ("null",), ("0",), (None,), (" NULL ",), ("abc",)], "sea_level_pressure string")
    vals = [r[0] for r in P.normalise_missing(df, ["sea_level_pressure"]).collect()]
    assert vals == [1013.25, None, None, None, None, None, None]


def test_zero_wind_direction_kept(spark):
    df = spark.createDataFrame([("0",), ("180",)], "wind_direction string")
    vals = [r[0] for r in P.normalise_missing(df, ["wind_direction"]).collect()]
    assert vals == [0.0, 180.0]


def test_zero_valid_set_is_a_parameter(spark):
    df = spark.createDataFrame([(0.0,)], "air_temperature double")
    assert P.normalise_missing(df, ["air_temperature"], zero_valid=["air_temperature"]).first()[0] == 0.0


def test_fill_constants_keeps_fraction_on_int_column(spark):
    df = spark.createDataFrame([(None,), (2,)], "c int")
    assert [r[0] for r in P.fill_constants(df, {"c": 3.9}).collect()] == [3.9, 2.0]


def test_fill_means_one_pass(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (3.0, 2.0)], "a double, b double")
    rows = P.fill_means(df, ["a", "b"]).collect()
    assert [r["a"] for r in rows] == [1.0, 2.0, 3.0] and [r["b"] for r in rows] == [3.0, 4.0, 2.0]


def test_one_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (2, 5, "z"), (1, 2, "w")], "k int, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in P.one_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: (1, "y"), 2: (5, "z")}


def test_hash_split_disjoint_complete_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = P.hash_split(df, ["k"], (0.8, 0.2))
    ka, kb = {r[0] for r in a.collect()}, {r[0] for r in b.collect()}
    assert not ka & kb and len(ka | kb) == 2000 and 1450 < len(ka) < 1750
    a2, _ = P.hash_split(df.repartition(7), ["k"], (0.8, 0.2))
    assert {r[0] for r in a2.collect()} == ka


def test_model_columns_strict(spark):
    df = spark.createDataFrame([(1.0, 2)], "air_temperature double, building_id int")
    assert P.model_columns(df).columns == ["air_temperature", "building_id"]
    with pytest.raises(ValueError):
        P.model_columns(df, strict=True)


def test_drop_and_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert P.drop_nulls(df).count() == 1 and P.drop_nulls(df, ["a"]).count() == 2
    assert P.where_not_null(df, ["b"]).count() == 2
    assert df.where(P.in_set("a", [1, 3])).count() == 2


def test_stratified_sample_takes_exact_quotas(spark):
    rows = [(i, "a" if i < 700 else "b" if i < 730 else None) for i in range(750)]
    df = spark.createDataFrame(rows, "id int, s string")
    got = P.stratified_sample(df, "s", {"a": 0.1, "b": 0.5, "absent": 0.9}, ["id"])
    unit = {r.id: r.u for r in df.select("id", P.hash_unit(["id"]).alias("u")).collect()}
    for s, k in (("a", 70), ("b", 15)):
        want = sorted((i for i, x in rows if x == s), key=lambda i: (unit[i], i))[:k]
        assert sorted(r.id for r in got.where(F.col("s") == s).collect()) == sorted(want)
    assert got.where("s IS NULL").count() == 0
    again = P.stratified_sample(df.repartition(7), "s", {"a": 0.1, "b": 0.5}, ["id"])
    assert {r.id for r in got.collect()} == {r.id for r in again.collect()}


def test_stratified_sample_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, k) for k in range(9)], "id int, k int").withColumn("s", F.lit("x"))
    # all rows hash alike on id: keys (id, k) order them, and the hash is of id and k
    assert P.stratified_sample(df, "s", {"x": 0.5}, ["id"]).count() == 4


def test_repartition_for_fit_spreads_a_large_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3600, 0).otherwise(F.col("id")).alias("building_id"), "id")
    sizes = [r[1] for r in P.repartition_for_fit(df, 8, "building_id").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) <= 1000
