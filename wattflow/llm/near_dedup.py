"""MinHash near-duplicates by an LSH forest, links confirmed on whole shingle sets.

1. Every whole text becomes its set of distinct word shingles and a MinHash
   signature. Equal sets are one class, represented by its smallest id.
2. The forest: TREES sorted orders of the representatives, tree t by its own DEPTH
   signature values. In each order a document is compared with its WINDOW
   predecessors, those of longest common prefix; how deep that prefix is follows
   the density of the region (at least MIN_DEPTH). An order is sorted range by range;
   the rows about the end of a range are compared once more, together with the first
   of the next. A pair whose signatures agree in ESTIMATE of their bytes is a candidate.
3. Candidates' connected components are *families*. Inside a family all pairs are
   compared on whole sets, not only the candidates, so a family loses no link.
   A family above BLOCK documents is dealt over blocks that also get the family's
   pivots; documents that then stand apart from the family's main component are
   compared with every block (the exact way for the rest).
4. Components of equal-set and confirmed links give each document's class.

What can be lost is only a link whose ends share no family: a pair of similarity
0.75 misses all orders with probability (1 - 0.75 ** 2) ** 16, about 2e-6, if its
regions are sparse, and (1 - 0.75 ** 3) ** 16, about 2e-4, if they are dense. The
sketch test is the same in all orders: at 0.75 fewer than 27 of 64 values agree with
probability 1e-8. A region of more than WINDOW documents that all lie between the two
in all 16 orders, and ranges of fewer than WINDOW rows, add to the dense case.

Defined cases: null, empty and word-less texts have an empty set, are linked with
nothing and kept; fewer words than a shingle make one shingle; rows that repeat an
id are one document whose links are united; rows with a null id are linked with
nothing and kept; an empty table gives an empty result; other columns are not
looked at (:func:`keep_first` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import components, keyed_join, stored
from .textops import Flat, mix64, slices, windows

SHINGLE, SIMILARITY = 5, 75  # words; percent
TREES, DEPTH, MIN_DEPTH = 16, 6, 2
WINDOW, SKETCH, ESTIMATE = 16, 64, 0.42
BLOCK = 128
MATRIX_CELLS = 4 << 20

_U = np.uint64


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def shingle_sets(col: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all rows, sorted inside each row; offsets of rows)."""
    flat = Flat(col, fold="lower")
    hashes = flat.word_hash()
    start, value = windows(hashes, flat.words_of, size)
    row = flat.row_of_word()[start]
    for n in range(1, size):  # a text of n < size words is one shingle
        short = np.flatnonzero(flat.n_words == n)
        if len(short):
            own = np.zeros(len(hashes) + 1, dtype=bool)
            own[flat.words_of[short]] = True
            at, whole = windows(hashes, flat.words_of, n)
            keep = own[at]
            row, value = np.concatenate([row, flat.row_of_word()[at[keep]]]), np.concatenate([value, whole[keep]])
    order = np.argsort(value)
    order = order[np.argsort(row[order], kind="stable")]
    row, value = row[order], value[order]
    if len(row):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])
        row, value = row[new], value[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=flat.rows))]).astype(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, two set hashes and signature values of every text."""
    factors = _multipliers(TREES * DEPTH)
    for batch in batches:
        for part in slices(batch, "text"):
            value, at = shingle_sets(part.column("text"))
            n = np.diff(at)
            some = np.flatnonzero(n)
            sums = np.zeros((2, len(n)), np.uint64)
            sign = np.zeros((len(n), len(factors)), dtype=">u4")
            if len(some):
                starts = at[some]
                sums[0, some] = np.add.reduceat(mix64(value), starts)
                sums[1, some] = np.add.reduceat(mix64(value ^ _U(0x5851F42D4C957F2D)), starts)
                for k, a in enumerate(factors):
                    sign[some, k] = np.minimum.reduceat((value * a) >> _U(32), starts)
            raw = sign.tobytes()
            width = 4 * len(factors)
            signs = pa.Array.from_buffers(pa.binary(width), len(n), [None, pa.py_buffer(raw)]).cast(pa.binary())
            arrays = [part.column("did"), pa.array(n.astype(np.int64)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), signs]
            yield pa.RecordBatch.from_arrays(arrays, ["did", "n", "s1", "s2", "sign"])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document and tree: sort key (tree, DEPTH values), sketch (one byte of SKETCH values)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            n = part.num_rows
            sign = np.frombuffer(b"".join(part.column("sign").to_pylist()), dtype=np.uint8).reshape(n, TREES * DEPTH, 4)
            sketch = np.ascontiguousarray(sign[:, :SKETCH, 3])
            keys = np.empty((n, TREES, 1 + 4 * DEPTH), dtype=np.uint8)
            keys[:, :, 0] = np.arange(TREES, dtype=np.uint8)
            keys[:, :, 1:] = sign.reshape(n, TREES, 4 * DEPTH)
            key = pa.Array.from_buffers(pa.binary(keys.shape[2]), n * TREES, [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
            wide = pa.Array.from_buffers(pa.binary(SKETCH), n * TREES, [None, pa.py_buffer(np.repeat(sketch, TREES, axis=0).tobytes())]).cast(pa.binary())
            ids = pa.array(np.repeat(part.column("did").to_numpy(), TREES))
            yield pa.RecordBatch.from_arrays([key, ids, wide], ["key", "did", "sketch"])


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place of each place's component under the pairs (a, b): one edge a place stands for all its pairs."""
    lead = np.arange(n)
    while True:
        low = np.minimum(lead[a], lead[b])
        new = lead.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, lead[a], low)
        np.minimum.at(new, lead[b], low)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new


FOUND = "a long, b long, score long, edge int, key binary, sketch binary"


def _neighbours(edges: bool):
    """Documents of a sorted order joined by pairs that lie within WINDOW, share a prefix and whose sketches agree;
    a row (a, a) carries how much a document's sketch agrees with its neighbours'.

    With ``edges`` the task's first and last WINDOW rows follow, filed under the end of the
    range before it and of its own. Rows of another ``part`` (where there is one) start anew.
    """
    width = 1 + 4 * DEPTH
    prefix = 1 + 4 * MIN_DEPTH
    names = ["a", "b", "score", "edge", "key", "sketch"]

    def pairs(a, b, weight):
        n = len(a)
        empty = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(weight), *empty], names)

    def filed(edge, key, ids, sketch):
        n = len(ids)
        raw = [pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (key, sketch)]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, edge, np.int32)), *raw], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held = fresh_held = (np.zeros((0, width), np.uint8), np.zeros(0, np.int64), np.zeros((0, SKETCH), np.uint8))
        part_of, first = None, None
        for batch in batches:
            parts = batch.column("part").to_numpy() if "part" in batch.schema.names else np.zeros(batch.num_rows, np.int32)
            cuts = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [batch.num_rows]]) if batch.num_rows else np.zeros(1, np.int64)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if parts[lo] != part_of:
                    held, part_of = fresh_held, parts[lo]
                for at in range(lo, hi, 8192):
                    part = batch.slice(at, min(8192, hi - at))
                    key = np.frombuffer(b"".join(part.column("key").to_pylist()), np.uint8).reshape(-1, width)
                    sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
                    key, ids, sketch = (np.concatenate(x) for x in zip(held, (key, part.column("did").to_numpy(), sketch), strict=True))
                    fresh = len(held[1])
                    if edges and (first is None or len(first[1]) < WINDOW):
                        rows = (key[fresh:], ids[fresh:], sketch[fresh:])
                        first = rows if first is None else tuple(np.concatenate(x) for x in zip(first, rows, strict=True))
                        first = tuple(x[:WINDOW] for x in first)
                    region = np.concatenate([[0], np.cumsum((key[1:, :prefix] != key[:-1, :prefix]).any(axis=1))]) if len(ids) else np.zeros(0, np.int64)
                    upper, lower = [], []
                    score = np.zeros(len(ids), np.int64)
                    for j in range(1, min(WINDOW, len(ids) - 1) + 1):
                        hit = np.flatnonzero(region[j:] == region[:-j]) + j
                        hit = hit[hit >= fresh]
                        if not len(hit):
                            break  # no region is longer
                        agree = (sketch[hit] == sketch[hit - j]).sum(axis=1)
                        close = agree >= ESTIMATE * SKETCH
                        near = hit[close]
                        score[near] += agree[close]
                        score[near - j] += agree[close]
                        upper.append(near)
                        lower.append(near - j)
                    if upper:
                        lead = _joined(len(ids), np.concatenate(upper), np.concatenate(lower))
                        own, typical = np.flatnonzero(lead != np.arange(len(ids))), np.flatnonzero(score)
                        a, b = np.concatenate([ids[own], ids[typical]]), np.concatenate([ids[lead[own]], ids[typical]])
                        yield pairs(a, b, np.concatenate([np.zeros(len(own), np.int64), score[typical]]))
                    held = (key[-WINDOW:], ids[-WINDOW:], sketch[-WINDOW:])
        if edges and first is not None:
            yield filed(place - 1, *first)
            yield filed(place, *held)

    return run


def linked_roots(sets: list[np.ndarray], ids: np.ndarray, percent: int = SIMILARITY) -> np.ndarray:
    """Smallest id of each set's component under ``100 * intersection >= percent * union``, over all pairs."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    value = np.concatenate(sets)
    row = np.repeat(np.arange(m), sizes)
    order = np.argsort(value)
    ranked = value[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1  # a shingle of one set joins nothing
    row, column = row[order][often], column[often]
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    shared = np.zeros((m, m), dtype=np.float64)
    columns = int(column[-1]) + 1 if len(column) else 0
    wide = max(1, min(columns, MATRIX_CELLS // m))  # most groups are small: no more cells than they fill
    for lo in range(0, columns, wide):
        a, b = np.searchsorted(column, [lo, lo + wide])
        cells = np.zeros((m, wide), dtype=np.float32)
        cells[row[a:b], column[a:b] - lo] = 1
        shared += cells @ cells.T
    link = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(link, True)
    root = ids.copy()
    while True:
        lower = np.where(link, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (lower == root).all():
            return root
        root = lower


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) inside each group of rows sorted by ``part``: b is the smallest id of a's component there."""

    def close(sets, ids):
        own = np.asarray(ids, dtype=np.int64)
        root = linked_roots(sets, own)
        far = root != own
        return pa.RecordBatch.from_arrays([pa.array(own[far]), pa.array(root[far])], ["a", "b"])

    last, sets, ids = None, [], []
    for batch in batches:
        for piece in slices(batch, "text"):
            value, at = shingle_sets(piece.column("text"))
            keys, dids = piece.column("part").to_pylist(), piece.column("did").to_pylist()
            for i, key in enumerate(keys):
                if key != last:
                    if len(ids) > 1:
                        yield close(sets, ids)
                    last, sets, ids = key, [], []
                sets.append(value[at[i] : at[i + 1]].copy())
                ids.append(dids[i])
    if len(ids) > 1:
        yield close(sets, ids)


def _links(rows: DataFrame, name: str, count: int | None = None) -> DataFrame:
    """Confirmed links of ``part, did, text``; the rows of a part are few by construction. ``count``: the rows, if known."""
    # a fixed number of partitions: the work is in comparing, not in bytes, so they must not be merged by size
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = n if count is None else max(1, min(n, count // (2 * BLOCK)))  # a task for a handful of rows costs more than they
    dealt = rows.repartition(n, "part").sortWithinPartitions("part")
    return stored(dealt.mapInArrow(_confirm, "a long, b long"), name)


def families(signed: DataFrame) -> DataFrame:
    """``did, family, score``: candidates' components and how much each document agrees with its neighbours."""
    reps = signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("did").alias("did"), F.first("sign").alias("sign")).select("did", "sign")
    orders = stored(reps.mapInArrow(_orders, "key binary, did long, sketch binary"), "orders", compression="zstd")
    dealt = orders.repartitionByRange("key", "did").sortWithinPartitions("key", "did")
    found = stored(dealt.mapInArrow(_neighbours(True), FOUND), "neighbours")
    # at most 2 * WINDOW rows meet at the end of a range
    ends = found.where("edge is not null").select(F.col("edge").alias("part"), F.col("a").alias("did"), "key", "sketch")
    ends = ends.repartition("part").sortWithinPartitions("part", "key", "did")
    across = ends.mapInArrow(_neighbours(False), FOUND).select("a", "b", "score")
    found = stored(found.where("edge is null").select("a", "b", "score").unionByName(across), "candidates")
    roots = components(found.where("a <> b").select("a", "b"), "families")
    score = found.where("a = b").groupBy("a").agg(F.sum("score").alias("score"))
    return stored(roots.join(score, roots["node"] == score["a"], "left").select(F.col("node").alias("did"), F.col("root").alias("family"), "score"), "members")


def confirmed_links(docs: DataFrame, member: DataFrame) -> DataFrame:
    """Links (a, b) of similar documents of one family; ``docs``: ``did, text``."""
    size = stored(member.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.max(F.struct("score", "did")).getField("did").alias("pivot")), "family-sizes")
    member = stored(keyed_join(member.select("did", "family"), size, ["family"]), "member-sizes")
    # always by shuffle, so that what moves grows with the table alone; repeated rows meet on the same key
    texts = docs.withColumn("th", F.xxhash64("text")).join(member.hint("merge"), "did").dropDuplicates(["did", "th"]).drop("th")
    texts = stored(texts, "family-texts", compression="zstd")
    small = texts.where(F.col("m") <= BLOCK).select(F.col("family").cast("string").alias("part"), "did", "text")
    found = _links(small, "links-small", small.count())
    large = texts.where(F.col("m") > BLOCK)
    if large.isEmpty():
        return found
    blocks = F.ceil(F.col("m") / (BLOCK // 2)).cast("int")  # about half a block each, so that hashing keeps them below one
    large = large.withColumn("block", F.pmod(F.xxhash64("did"), blocks).cast("int"))
    named = lambda *c: F.concat_ws("-", *[F.col(x).cast("string") for x in c]).alias("part")
    guides = large.where("did = pivot or did = family").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    first = _links(large.unionByName(guides).select(named("family", "block"), "did", "text"), "links-large", large.count())
    roots = components(first, "large")
    placed = large.select("did", "family", "block", "m").distinct().join(roots.withColumnRenamed("node", "did"), "did", "left")
    placed = stored(placed.withColumn("root", F.coalesce("root", "did")), "placed")
    weight = placed.groupBy("family", "root").agg(F.count(F.lit(1)).alias("k"))
    main = stored(weight.groupBy("family").agg(F.max(F.struct("k", "root")).getField("root").alias("main")), "main-roots")
    apart = stored(keyed_join(placed, main, ["family"]).where("root <> main").select("did", "family", "m"), "apart")
    if apart.isEmpty():
        return found.unionByName(first)
    # every document that stands apart meets every block of its family but its own, where it was compared already
    count = stored(apart.groupBy("family").agg(F.count(F.lit(1)).alias("r")), "apart-sizes")
    batches = F.ceil(F.col("r") / (BLOCK // 2)).cast("int")
    rest = keyed_join(apart.select("did", "family"), count, ["family"]).withColumn("batch", F.pmod(F.xxhash64("did", F.lit(7)), batches).cast("int"))
    rest = large.withColumnRenamed("block", "own").join(rest.select("did", "batch"), "did").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    every = keyed_join(large, count, ["family"]).withColumn("batch", F.explode(F.sequence(F.lit(0), batches - 1)))
    columns = [named("family", "block", "batch"), "did", "text"]
    second = _links(rest.where("block <> own").select(*columns).unionByName(every.select(*columns)), "links-apart")
    return found.unionByName(first).unionByName(second)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``did, n_shingles, component_id``."""
    plain = docs.select(F.col(doc_id).alias("did"), F.col(text).alias("text"))
    signed = stored(plain.mapInArrow(_sign, "did long, n long, s1 long, s2 long, sign binary"), "signed")
    known = signed.where("did is not null")
    same = known.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("did").alias("b"), F.max("did").alias("last")).where("b < last").drop("last")
    copies = keyed_join(known.select("did", "n", "s1", "s2"), stored(same, "equal-sets"), ["n", "s1", "s2"])
    copies = copies.where("did <> b").select(F.col("did").alias("a"), "b")
    links = confirmed_links(plain.where("did is not null"), families(known))
    roots = components(copies.unionByName(links), "classes")
    out = signed.select("did", "n").join(roots.withColumnRenamed("node", "did"), "did", "left")
    return out.select("did", F.col("n").alias("n_shingles"), F.coalesce("root", "did").alias("component_id"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each group of near duplicates: the row of smallest id; all columns stay.

    Of rows that repeat that id any one stays; rows without an id all stay.
    """
    kept = classes(docs, doc_id, text).where("did = component_id").select(F.col("did").alias("_d")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("did", F.col(f"row.{doc_id}"))
    named = rows.where("did is not null").join(kept, F.col("did") == F.col("_d"), "left_semi").dropDuplicates(["did"])
    return named.unionByName(rows.where("did is null")).select("row.*")
