"""Nearest neighbours by vantage-point trees.

Metric: the chord between unit vectors, sqrt(2 - 2 cos), whose order is the order of
falling cosines. A router, a vantage-point tree over a bounded sample of SAMPLE rows,
deals all rows into cells; a cell larger than a shard is dealt on by a hash of the
vector. Each shard builds its own tree over its distinct vectors (of equal vectors only
the k + 1 smallest ids can ever be among k neighbours, so a hot vector is one point).
A query's k-th distance within the sample bounds its search radius from the start; it is
sent only to cells that its ball meets, and in a shard only into branches that it meets.

Pruning: a branch whose distances to its vantage point lie in [low, high] holds nothing
nearer than max(low - d, d - high), by the triangle inequality. It is left out if
``factor`` times this bound exceeds the query's radius: factor one is exact search,
larger factors give up some far branches.

Candidates pass with a margin of 1e-9 in the cosine; their scores are then computed anew
from the original vectors in one fixed order of operations, so equal vectors score equal
and ties fall to the smaller id.

What moves: every vector once, every query to the cells it meets. One task holds one
shard and one block of queries.

Defined cases: rows with a null id, and vectors that are null, empty, all zero or hold
null or non-finite entries take no part; of the rest only vectors of the most frequent
length do (ties: the longer); a repeated (id, vector) counts once; a repeated id is one
query (the vector of smallest hash) and never its own neighbour; fewer candidates than k
give all of them; columns other than the two named are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .whitening import matrix, usable

NEIGHBOURS, FACTOR = 5, 1.5
SAMPLE = 4096  # rows that fit the router and bound the radii
CELL_SAMPLE = 16  # sampled rows a router cell has at least
SHARD_ROWS, LEAST_ROWS = 1 << 16, 1024
LEAF, BLOCK = 256, 4096
SLACK, MARGIN = 1e-6, 1e-9  # of chords (a root: errors of 1e-16 grow to 1e-8), of cosines


def exact_scale(raw: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, largest entry in [0.5, 1): cosines stay the same to the last bit."""
    _, power = np.frexp(np.abs(raw).max(axis=1, initial=0))
    return np.ldexp(raw, -power[:, None])


def unit(raw: np.ndarray) -> np.ndarray:
    scaled = exact_scale(raw)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, added up dimension by dimension."""
    a, b = exact_scale(a), exact_scale(b)
    dot, na, nb = (np.zeros(len(a)) for _ in range(3))
    for i in range(a.shape[1]):
        dot += a[:, i] * b[:, i]
        na += a[:, i] * a[:, i]
        nb += b[:, i] * b[:, i]
    return np.clip(dot / np.sqrt(na * nb), -1.0, 1.0)


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class VantageTree:
    """Vantage-point tree over unit vectors, split at the median distance down to leaves of ``leaf`` vectors.

    ``order`` lists the vectors leaf by leaf. A node is (from, to, vantage vector,
    (low, high) of the inner half, of the outer half, inner node, outer node); a leaf
    has no vantage vector.
    """

    def __init__(self, points: np.ndarray, leaf: int, depth: int = 64):
        self.points, self.order, self.nodes, self.leaves = points, np.arange(len(points)), [], []
        self._build(0, len(points), leaf, depth)

    def _build(self, lo: int, hi: int, leaf: int, depth: int) -> int:
        me = len(self.nodes)
        self.nodes.append((lo, hi, None, None, None, -1, -1))
        if hi - lo <= max(leaf, 1) or depth == 0:
            self.leaves.append(me)
            return me
        own = self.order[lo:hi]
        far = chord(self.points[own] @ self.points[own[(hi - lo) // 2]])
        vantage = self.points[own[far.argmax()]]  # a corner sees more spread than the middle
        away = chord(self.points[own] @ vantage)
        half = (hi - lo + 1) // 2
        split = np.argpartition(away, half - 1)
        self.order[lo:hi] = own[split]
        inner, outer = away[split[:half]], away[split[half:]]
        a = self._build(lo, lo + half, leaf, depth - 1)
        b = self._build(lo + half, hi, leaf, depth - 1)
        self.nodes[me] = (lo, hi, vantage, (inner.min(), inner.max()), (outer.min(), outer.max()), a, b)
        return me


def _gap(away: np.ndarray, ring: tuple[float, float]) -> np.ndarray:
    """Least distance to anything in a ring of distances around the vantage point."""
    return np.maximum(np.maximum(ring[0] - away, away - ring[1]), 0.0)


class Router:
    """Cells of the space: the leaves of a vantage-point tree over the sample, rings closed to whole space by the median."""

    def __init__(self, sample: np.ndarray, cells: int):
        depth = max(0, int(cells - 1).bit_length()) if cells > 1 else 0
        tree = VantageTree(sample, CELL_SAMPLE, depth)
        self.nodes = tree.nodes
        self.cell = {node: i for i, node in enumerate(tree.leaves)}
        self.share = np.array([(tree.nodes[x][1] - tree.nodes[x][0]) / max(1, len(sample)) for x in tree.leaves])

    def _walk(self, points: np.ndarray, pick) -> Iterator[tuple[int, np.ndarray]]:
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, act = todo.pop()
            _, _, vantage, inner, _, a, b = self.nodes[node]
            if vantage is None:
                yield self.cell[node], act
                continue
            away = chord(points[act] @ vantage)
            into, out = pick(away, inner[1], act)
            todo += [(a, act[into]), (b, act[out])]

    def home(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point: inside the median distance or outside it, node by node."""
        cell = np.zeros(len(points), np.int32)
        for at, act in self._walk(points, lambda away, cut, _: (away <= cut, away > cut)):
            cell[act] = at
        return cell

    def meets(self, points: np.ndarray, radius: np.ndarray, factor: float) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, points whose ball meets it)."""

        def pick(away, cut, act):
            r = radius[act] + SLACK
            return factor * np.maximum(away - cut, 0.0) <= r, factor * np.maximum(cut - away, 0.0) <= r

        yield from self._walk(points, pick)


class Search:
    """Best cosines of a block of queries in one tree; collects the pairs that may be among the ``want`` nearest points."""

    def __init__(self, tree: VantageTree, queries: np.ndarray, radius: np.ndarray, want: int, factor: float):
        self.tree, self.q, self.factor = tree, queries, factor
        self.best = np.full((len(queries), want), -np.inf)
        self.radius = radius.copy()
        self.floor = 1.0 - radius * radius / 2 - MARGIN
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.compared = 0

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of every pair at or above the query's ``want``-th best cosine, less the margin."""
        self._visit(0, np.arange(len(self.q)))
        if not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, p, s = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        keep = s >= np.maximum(self.best.min(axis=1) - MARGIN, self.floor)[q]
        return q[keep], p[keep]

    def _visit(self, node: int, act: np.ndarray) -> None:
        lo, hi, vantage, inner, outer, a, b = self.tree.nodes[node]
        if not len(act):
            return
        if vantage is None:
            return self._leaf(lo, hi, act)
        away = chord(self.q[act] @ vantage)
        near = away <= inner[1]
        gap_a, gap_b = self.factor * _gap(away, inner), self.factor * _gap(away, outer)
        for child, gap, first in ((a, gap_a, near), (b, gap_b, ~near), (b, gap_b, near), (a, gap_a, ~near)):
            self._visit(child, act[first & (gap <= self.radius[act] + SLACK)])

    def _leaf(self, lo: int, hi: int, act: np.ndarray) -> None:
        members = self.tree.order[lo:hi]
        score = self.q[act] @ self.tree.points[members].T
        self.compared += score.size
        want = self.best.shape[1]
        top = np.concatenate([self.best[act], score], axis=1)
        top = np.partition(top, top.shape[1] - want, axis=1)[:, -want:]
        self.best[act] = top
        least = top.min(axis=1)
        self.radius[act] = np.minimum(self.radius[act], np.where(np.isfinite(least), chord(np.maximum(least, -1.0)), np.inf))
        row, col = np.nonzero(score >= np.maximum(least - MARGIN, self.floor[act])[:, None])
        self.pairs.append((act[row], members[col], score[row, col]))


def _distinct(vectors: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct vectors, start of each one's ids, ids, distinct ids each): the ``keep`` smallest ids of each vector, rising."""
    rows = np.ascontiguousarray(vectors + 0.0)  # -0 as 0
    key = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
    first, group = np.unique(key, return_index=True, return_inverse=True)[1:]
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])]) if len(g) else np.zeros(0, bool)
    g, i = g[fresh], i[fresh]
    start = np.searchsorted(g, np.arange(len(first) + 1))
    rank = np.arange(len(g)) - start[g]
    g, i = g[rank < keep], i[rank < keep]
    start = np.searchsorted(g, np.arange(len(first) + 1))
    return rows[first], start, i, np.diff(start)


def _assign(router: Router, salts: np.ndarray, keep: int):
    """Shard of every row; of equal vectors in a batch only the smallest ids go on."""
    base = np.concatenate([[0], np.cumsum(salts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, start, ids, count = _distinct(matrix(batch.column("v")), batch.column("vec_id").to_numpy(), keep)
            cell = router.home(unit(points))
            mark = _vector_hash(points)
            shard = base[cell] + (mark % salts[cell].astype(np.uint64)).astype(np.int64)
            each = np.repeat(np.arange(len(points)), count)
            yield _rows(shard[each], 0, ids, points[each], np.zeros(len(ids)))

    return run


def _vector_hash(points: np.ndarray) -> np.ndarray:
    h = np.zeros(len(points), np.uint64)
    for i in range(points.shape[1]):
        h = (h ^ np.ascontiguousarray(points[:, i]).view(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return h


def _rows(shard: np.ndarray, kind: int, ids: np.ndarray, vectors: np.ndarray, radius: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * vectors.shape[1], pa.int32()), pa.array(vectors.ravel()))
    arrays = [pa.array(shard.astype(np.int32)), pa.array(np.full(len(ids), kind, np.int8)), pa.array(ids), lists, pa.array(radius)]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "kind", "vec_id", "v", "radius"])


def _send(router: Router, salts: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray, k: int, factor: float):
    """Each query with its radius, once for each shard of the cells that its ball meets."""
    base = np.concatenate([[0], np.cumsum(salts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                raw, ids = matrix(part.column("v")), part.column("vec_id").to_numpy()
                points = unit(raw)
                away = np.where(sample_ids[None, :] == ids[:, None], np.inf, chord(points @ sample.T))
                radius = np.partition(away, k - 1, axis=1)[:, k - 1] if len(sample) >= k else np.full(len(ids), np.inf)
                radius = np.minimum(radius, 2.0)  # no chord is longer
                for cell, act in router.meets(points, radius, factor):
                    for salt in range(salts[cell] if len(act) else 0):
                        yield _rows(np.full(len(act), base[cell] + salt), 1, ids[act], raw[act], radius[act])

    return run


def _seeds(raw: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` nearest sampled rows of each query: pruned branches never leave a query with fewer answers."""
    points = unit(raw) if len(raw) else raw

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows if len(points) else 0, 1024):
                part = batch.slice(lo, 1024)
                asked, own = matrix(part.column("v")), part.column("vec_id").to_numpy()
                near = np.where(ids[None, :] == own[:, None], -np.inf, unit(asked) @ points.T)
                pick = np.argpartition(-near, min(k, len(points)) - 1, axis=1)[:, :k]
                q, p = np.repeat(np.arange(len(own)), pick.shape[1]), pick.ravel()
                other = ids[p] != own[q]
                q, p = q[other], p[other]
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(ids[p]), pa.array(cosines(asked[q], raw[p]))], ["query_id", "vec_id", "score"])

    return run


def _search(k: int, factor: float):
    """Rows sorted by (shard, kind): the vectors of a shard, then the queries that meet it, block by block."""

    def answer(tree: VantageTree, raw: np.ndarray, start: np.ndarray, ids: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        own, asked = part.column("vec_id").to_numpy(), matrix(part.column("v"))
        # k + 1 points: one may hold the query's own id alone
        q, p = Search(tree, unit(asked), part.column("radius").to_numpy(), k + 1, factor).run()
        score = cosines(asked[q], raw[p])
        count = np.diff(start)[p]
        each = np.repeat(np.arange(len(p)), count)
        at = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        found, q, score = ids[start[p][each] + at], q[each], score[each]
        other = found != own[q]
        found, q, score = found[other], q[other], score[other]
        order = np.lexsort((found, -score, q))
        found, q, score = found[order], q[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        best = rank < k
        return pa.RecordBatch.from_arrays([pa.array(own[q[best]]), pa.array(found[best]), pa.array(score[best])], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, built = None, [], None
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            code = shard.astype(np.int64) * 2 + kind
            cuts = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1, [len(code)]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi == lo:
                    continue
                if shard[lo] != now:
                    now, held, built = shard[lo], [], None
                if kind[lo] == 0:
                    held.append(batch.slice(lo, hi - lo))
                    continue
                if built is None:
                    if not held:
                        continue
                    vectors = np.concatenate([matrix(x.column("v")) for x in held])
                    raw, start, ids, _ = _distinct(vectors, np.concatenate([x.column("vec_id").to_numpy() for x in held]), k + 1)
                    built, held = (VantageTree(unit(raw), LEAF), raw, start, ids), []
                for at in range(lo, hi, BLOCK):
                    yield answer(*built, batch.slice(at, min(BLOCK, hi - at)))

    return run


def search(
    rows: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS, factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row that ``queries`` (over ``vec_id``) names."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plain = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    plain = plain.where(F.col("vec_id").isNotNull() & usable("v")).where(F.exists("v", lambda c: c != 0))
    lengths = plain.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return none
    dims, n = lengths[0]["d"], lengths[0]["count"]
    plain = plain.where(F.size("v") == dims)
    # about SAMPLE rows, whatever the table
    got = plain.sample(min(1.0, SAMPLE / n), seed=11).toArrow()
    sample_ids = got.column("vec_id").to_numpy()
    raw = matrix(got.column("v").combine_chunks()) if len(sample_ids) else np.zeros((0, dims))
    sample_ids, once = np.unique(sample_ids, return_index=True)  # an id counts once for the radius
    raw = raw[once]
    sample = unit(raw) if len(raw) else raw
    size = max(LEAST_ROWS, min(shard_rows, n // max(1, _slots(spark))))
    router = Router(np.unique(sample, axis=0), -(-n // size))
    salts = np.maximum(1, np.ceil(router.share * n / size / 1.5)).astype(np.int64) if len(router.share) > 1 else np.array([max(1, -(-n // size))])
    keyed = plain.mapInArrow(_assign(router, salts, k + 1), "shard int, kind byte, vec_id long, v array<double>, radius double")
    asked = plain.where(queries).groupBy("vec_id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
    sent = asked.mapInArrow(_send(router, salts, sample, sample_ids, k, factor), keyed.schema)
    shards = int(salts.sum())
    meet = keyed.unionByName(sent).repartition(2 * shards, "shard").sortWithinPartitions("shard", "kind")
    answer = "query_id long, vec_id long, score double"
    found = meet.mapInArrow(_search(k, factor), answer).unionByName(asked.mapInArrow(_seeds(raw, sample_ids, k), answer))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)  # a row found twice has one rank
    return ranked.dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score")


def _slots(spark) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: no driver-side context
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
