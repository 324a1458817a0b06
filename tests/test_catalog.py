"""Registered queries: contract with the driver, and oracle agreement on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

FAST = [
    "a1_carrier_sum", "a2_six_hour_totals", "a6_nulls_zeros", "a10_numeric_summary", "a19_box_stats",
    "f1_six_hour_label", "j6_shortfall_inner", "m17_wilcoxon", "m22_feature_frame", "p10_normalise_missing",
    "s15_replay_stamp", "st3_six_hour_two_clock", "w1_season_flag", "w6_suppress_repeats", "a26_building_totals",
]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "agg_value" in df.columns


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf_small, duck, name):
    sdf = E.queries()[name](spark, sf_small)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    s_rows = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    d_idx = [dcols.index(c) for c in order]
    d_rows = sorted((tuple(_norm(r[i]) for i in d_idx) for r in res.fetchall()), key=repr)
    assert s_rows == d_rows
