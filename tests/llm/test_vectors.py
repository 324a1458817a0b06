"""Vantage-point search and whitening against plain versions, with odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattflow.llm import vantage, whitening

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())])


@pytest.fixture(scope="module")
def table(spark):
    def make(rows, parts=4):
        return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in rows], ROWS).repartition(parts)

    return make


def usable(rows):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in fine]
    most = max(set(lengths), key=lambda d: (lengths.count(d), d)) if lengths else 0
    return [(i, v) for i, v in fine if len(v) == most]


def plain_search(rows, k=5, every=50):
    fine = {(i, tuple(v)): v for i, v in usable(rows) if i is not None and np.any(v)}
    out = {}
    for (i, _), q in fine.items():
        if i % every == 0:
            q = q[None, :]
            found = sorted((-float(vantage.cosines(q, v[None, :])[0]), j) for (j, _), v in fine.items() if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    out = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(1500)]
    out += [(2000 + i, centres[0].tolist()) for i in range(700)]  # a hot vector: a third of all rows
    out += [(3000 + i, (2.0**i * centres[1]).tolist()) for i in range(12)]  # equal cosines, other lengths
    odd = [None, [], [None] * 16, [float("nan")] * 16, [float("inf")] * 16, [0.0] * 16, [-0.0] * 16, [1.0] * 3, [1.0] * 15 + [None]]
    out += [(4000 + 50 * i, v) for i, v in enumerate(odd)]
    out += [(None, centres[2].tolist()), (50, out[50][1]), (50, out[50][1])]
    return out


@pytest.mark.parametrize("shard_rows", [1 << 16, 300])
def test_factor_one_is_exact(table, rows, shard_rows, monkeypatch):
    monkeypatch.setattr(vantage, "LEAST_ROWS", 100)
    monkeypatch.setattr(vantage, "LEAF", 16)
    got = found(vantage.search(table(rows), F.col("vec_id") % 50 == 0, factor=1.0, shard_rows=shard_rows))
    assert got == plain_search(rows)


def test_default_factor_keeps_recall(table, rows):
    got, want = found(vantage.search(table(rows), F.col("vec_id") % 50 == 0)), plain_search(rows)
    assert got.keys() == want.keys() and all(len(got[q]) == 5 for q in want)
    hits = sum(len({s for _, s in got[q]} & {s for _, s in want[q]}) / len({s for _, s in want[q]}) for q in want)
    assert hits / len(want) >= 0.9


def test_relaxed_pruning_compares_less():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 24))
    points = vantage.unit(np.repeat(centres, 200, axis=0) + 0.2 * rng.normal(size=(4000, 24)))
    tree, seen = vantage.VantageTree(points, 32), {}
    for factor in (1.0, 1.5, 4.0):
        run = vantage.Search(tree, points[::40], np.full(100, 2.0), 6, factor)
        run.run()
        seen[factor] = run.compared
    assert seen[1.0] < 100 * 4000 and seen[4.0] <= seen[1.5] <= seen[1.0]


def test_fewer_candidates_and_empty_tables(table):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert found(vantage.search(table(rows), F.col("vec_id") % 50 == 0)) == plain_search(rows)
    assert vantage.search(table([(0, [1.0, 2.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert vantage.search(table([], 1), F.col("vec_id") % 50 == 0).count() == 0
    assert vantage.search(table([(0, None), (50, [])]), F.col("vec_id") % 50 == 0).count() == 0


def plain_whiten(rows, k=4, copies=False):
    fine = usable(rows)
    x = np.array([np.floor(256 * v) for _, v in fine]).astype(np.int64)
    distinct, count = np.unique(x, axis=0, return_counts=True)
    w = count if copies else np.ones_like(count)
    n, sums = int(w.sum()), (distinct * w[:, None]).sum(axis=0)
    mean = sums / n
    cov = ((distinct - mean) * w[:, None]).T @ (distinct - mean) / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return [i for i, _ in fine], n, dev, (x - mean) @ axes / np.sqrt(e), e / np.trace(cov)


@pytest.mark.parametrize("copies", [False, True])
def test_whitening_matches_plain_version(table, rows, copies):
    fine = [r for r in rows if r[1] is None or len(r[1]) != 16 or r[0] is None or r[0] < 3000 or r[0] >= 4000]
    got = whitening.whiten(table(fine), weigh_copies=copies).collect()
    ids, n, dev, white, explained = plain_whiten(fine, copies=copies)
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {n}
    assert sorted((-1 if r.vec_id is None else r.vec_id, int(r.deviation)) for r in got if r.component == 1) == sorted(
        (-1 if i is None else i, d) for i, d in zip(ids, dev, strict=True)
    )
    by = {i: row for i, row in zip(ids, white, strict=True)}
    for c in range(1, 5):
        mine = np.array([r.whitened for r in sorted((r for r in got if r.component == c and r.vec_id is not None), key=lambda r: r.vec_id)])
        theirs = np.array([by[i][c - 1] for i in sorted(i for i in ids if i is not None)])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8
        assert {round(r.explained / explained[c - 1], 9) for r in got if r.component == c} == {1.0}
    assert {r.identity_error for r in got}.pop() < 1e-9


def test_whitening_odd_tables(table):
    assert whitening.whiten(table([], 1)).count() == 0
    assert whitening.whiten(table([(1, None), (2, [None, 1.0])])).count() == 0
    assert whitening.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    line = whitening.whiten(table([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (2, [2.0, 4.0])])).collect()  # one direction
    assert [(r.vec_id, r.component, r.n) for r in sorted(line, key=lambda r: r.vec_id)] == [(1, 1, 2), (2, 1, 2), (2, 1, 2)]


def test_deviation_beyond_64_bits():
    x = np.array([[3, -5], [1 << 20, 7]])
    sums = [3 + (1 << 20), 2]
    n = 1 << 30
    assert [int(v) for v in whitening._deviation(x, n, sums).to_pylist()] == [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    assert [int(v) for v in whitening._deviation(x[:1], 2, [4, 2]).to_pylist()] == [(6 - 4) ** 2 + (-10 - 2) ** 2]
