"""Substring dedup by prefix-partitioned suffix trees.

The suffixes of all texts (one for each word that starts a window of SPAN words)
are split by variable-length prefixes: a short prefix that few suffixes share is a
partition; a prefix above the memory budget is lengthened (PREFIXES words), and at
the last length by the whole window's hash. Prefix counts cover all texts; small
prefixes share a group. One task builds the part of the tree below its prefixes:
suffixes ordered by their path label of SPAN words, equal labels being the deep
internal nodes. Every leaf of such a node but its earliest in (doc_id, start) order
repeats earlier text, and the union of repeated windows is the maximal repeats.

What moves: texts are read where they lie, in chunks of rows of one file. A chunk
sends to each group the 8-byte labels of its first occurrences (occurrences inside
the chunk are settled there, so a passage costs one label a chunk however often it
occurs), with the ids of just the documents that they stand in, and gets one bit a
label back; the chunk's texts are moved once, to meet the bits. Chunks grow with the
number of groups, so that a message stays about MESSAGE_TEXT of text and the messages
grow with the table, not with chunks times groups. Labels of different windows are
equal with probability 2 ** -64.

Defined cases: a null text has no words; a text shorter than the window loses
nothing; rows that repeat a doc_id are separate documents, earlier file row first;
a null doc_id comes after all others; columns other than the two named are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import stored
from .textops import Flat, windows

SPAN = 20
PREFIXES = (1, 3, 8, 20)  # words; the last is the window itself
CELLS = 1 << 14
GROUP_LABELS = 2_000_000  # labels that one task's subtrees hold
CHUNK_TEXT, MOST_TEXT = 1 << 20, 1 << 26  # bytes of text in a chunk, on average: least, most
MESSAGE_TEXT = 6 << 10  # bytes of text whose labels a chunk sends to one group, on average
CHUNK_ROWS = 1 << 20  # rows of a chunk at most
LAST_ID = np.iinfo(np.int64).max

_U = np.uint64


def _labels(col: pa.Array, span: int, prefixes: tuple[int, ...]) -> tuple[Flat, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(flat text, window starts, window labels, cell of each prefix length)."""
    flat = Flat(col)
    word = flat.word_hash()
    start, label = windows(word, flat.words_of, span)
    cells = []
    for n in prefixes:
        at, value = (start, label) if n == span else windows(word, flat.words_of, n)
        if n != span:  # windows of n words start wherever windows of span words do, and elsewhere
            value = value[np.searchsorted(at, start)]
        cells.append((value >> _U(50)).astype(np.int64))
    return flat, start, label, cells


def _count(span: int, prefixes: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(prefixes), CELLS), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                _, _, _, cells = _labels(batch.column("text").slice(at, 256), span, prefixes)
                for i, c in enumerate(cells):
                    total[i] += np.bincount(c, minlength=CELLS)
        level, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(level.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[level, cell])], ["level", "cell", "n"])

    return run


class Routes:
    """Group of a suffix: by the shortest prefix whose cell fits the budget, else by the window's label."""

    def __init__(self, counts: np.ndarray, budget: int):
        self.group = np.full(counts.shape, -1, dtype=np.int32)
        self.fan = np.ones(CELLS, dtype=np.int32)
        at, filled = 0, 0
        for level in range(len(counts)):
            last = level == len(counts) - 1
            for cell in np.flatnonzero(counts[level]).tolist():
                n = int(counts[level, cell])
                if n > budget and not last:
                    continue
                fan = -(-n // budget)
                if fan > 1:
                    at, filled = at + 1, 0
                elif filled + n > budget:
                    at, filled = at + 1, 0
                self.group[level, cell] = at
                filled += n
                if fan > 1:
                    self.fan[cell] = fan
                    at, filled = at + fan, 0

    @property
    def groups(self) -> int:
        return int((self.group + 1).max(initial=0) + self.fan.max(initial=1) - 1)

    def of(self, cells: list[np.ndarray], label: np.ndarray) -> np.ndarray:
        out = np.full(len(label), -1, dtype=np.int32)
        for level, cell in enumerate(cells):
            out = np.where(out < 0, self.group[level][cell], out)
        wide = self.fan[cells[-1]] > 1
        if wide.any():
            # only suffixes that no shorter prefix settled are spread over the fan
            settled = np.zeros(len(label), dtype=bool)
            for level in range(len(cells) - 1):
                settled |= self.group[level][cells[level]] >= 0
            spread = wide & ~settled
            out[spread] += ((label[spread] >> _U(7)) % self.fan[cells[-1][spread]].astype(np.uint64)).astype(np.int32)
        return out


def _first_in_chunk(label: np.ndarray) -> np.ndarray:
    """Flags of the first occurrence of each label."""
    order = np.argsort(label, kind="stable")
    ranked = label[order]
    first = np.zeros(len(label), dtype=bool)
    if len(label):
        first[order[np.concatenate([[True], ranked[1:] != ranked[:-1]])]] = True
    return first


def _part(did: pa.Array, text: pa.Array, span: int, prefixes: tuple[int, ...], routes: Routes):
    """A chunk's rows in (doc_id, row) order with their labels; the same for sending and for marking."""
    ids = did.fill_null(LAST_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    flat, start, label, cells = _labels(text.take(pa.array(order)), span, prefixes)
    first = _first_in_chunk(label)
    group = routes.of([c[first] for c in cells], label[first])
    by_group = np.argsort(group, kind="stable")
    return ids[order], order, flat, start, label, first, group, by_group


def _short(values: np.ndarray) -> bytes:
    """Rising numbers as the first one and their differences, in as few bytes each as the largest needs."""
    step = np.diff(values).astype(np.uint64)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or step.max(initial=0) < 1 << (8 * w))
    return bytes([width]) + values[:1].astype("<i8").tobytes() + step.astype(f"<u{width}").tobytes()


def _long(raw: bytes) -> np.ndarray:
    first = np.frombuffer(raw, "<i8", 1, 1)
    return np.cumsum(np.concatenate([first, np.frombuffer(raw, f"<u{raw[0]}", offset=9).astype(np.int64)]))


def _send(span: int, prefixes: tuple[int, ...], routes: Routes):
    names = ["group", "file", "chunk", "first_row", "n_rows", "labels", "ends", "ids"]

    def emit(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        did, text = (pa.concat_arrays(table.column(c).chunks) if table.num_rows else table.column(c) for c in ("did", "text"))
        ids, _, flat, start, label, first, group, by_group = _part(did, text, span, prefixes, routes)
        if not len(group):
            return None
        row = np.searchsorted(flat.words_of, start[first], side="right") - 1
        label, row, group = label[first][by_group], row[by_group], group[by_group]
        other = group[1:] != group[:-1]
        edge = np.concatenate([[0], np.flatnonzero(other) + 1, [len(group)]])
        # rows rise inside a message: one id and one end for each document that has labels in it
        begin = np.concatenate([[0], np.flatnonzero(other | (row[1:] != row[:-1])) + 1])
        at = np.searchsorted(begin, edge)
        owner, end = ids[row[begin]], np.append(begin[1:], len(group))
        n = len(edge) - 1
        head = [table.column(c)[0].as_py() for c in ("file", "chunk", "row")]
        cols = [pa.array(group[edge[:-1]]), *(pa.array([v] * n) for v in (*head, table.num_rows))]
        cols.append(pa.array([label[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()))
        cols.append(pa.array([_short(end[i:j] - e) for i, j, e in zip(at[:-1], at[1:], edge[:-1], strict=True)], pa.binary()))
        cols.append(pa.array([_short(owner[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()))
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("file").to_pylist(), batch.column("chunk").to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                to = at + 1
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if keys[at] != key and held:
                    out = emit(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                    held = []
                key = keys[at]
                held.append(batch.slice(at, to - at))
                at = to
        if held:
            out = emit(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return run


def _subtrees(table: pa.Table) -> pa.Table:
    """Of a group's labels flag every leaf of a deep node but the earliest; one bit mask for each chunk."""
    table = table.sort_by([("file", "ascending"), ("first_row", "ascending")])
    labels, owner = [], []
    for label, end, ids in zip(*(table.column(c).to_pylist() for c in ("labels", "ends", "ids")), strict=True):
        labels.append(np.frombuffer(label, np.uint64))
        owner.append(np.repeat(_long(ids), np.diff(_long(end), prepend=0)))
    sizes = [len(x) for x in labels]
    label, owner = np.concatenate(labels), np.concatenate(owner)
    del labels
    order = np.argsort(label)
    ranked = label[order]
    node = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    leaves = np.diff(np.append(node, len(ranked)))
    least = np.repeat(np.minimum.reduceat(owner[order], node), leaves)
    place = np.where(owner[order] == least, order, len(order))
    winner = np.minimum.reduceat(place, node)
    late = np.ones(len(label), dtype=bool)
    late[winner] = False
    masks, at = [], 0
    for n in sizes:
        bits = late[at : at + n]
        masks.append(np.packbits(bits).tobytes() if bits.any() else b"")
        at += n
    return table.select(["file", "chunk", "first_row", "n_rows", "group"]).append_column("mask", pa.array(masks, pa.binary()))


def _clean(span: int, prefixes: tuple[int, ...], routes: Routes, texts: bool):
    def part(did: pa.Array, text: pa.Array, masks: dict[int, bytes]):
        _, order, flat, start, label, first, group, by_group = _part(did, text, span, prefixes, routes)
        late_first = np.zeros(len(group), dtype=bool)
        ranked = group[by_group]
        edge = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1, [len(ranked)]]) if len(ranked) else np.zeros(1, np.int64)
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            mask = masks.get(int(ranked[a]), b"")
            if mask:
                late_first[by_group[a:b]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=int(b - a)).astype(bool)
        late = ~first
        late[first] = late_first
        words = len(flat.word_from)
        step = np.zeros(words + 1, np.int64)
        np.add.at(step, start[late], 1)
        np.add.at(step, start[late] + span, -1)
        keep = np.cumsum(step[:-1]) == 0
        # kept words, each with the byte after it turned into one space
        data = flat.raw.copy()
        data[flat.word_to[keep]] = 32
        edge = np.zeros(len(data) + 1, np.int8)
        edge[flat.word_from[keep]] += 1
        edge[flat.word_to[keep] + 1] -= 1
        stay = np.cumsum(edge[:-1]) > 0
        at = np.concatenate([[0], np.cumsum(stay)])[flat.row_at]
        kept = data[stay].tobytes()
        total = np.concatenate([[0], np.cumsum(~keep)])
        removed = total[flat.words_of[1:]] - total[flat.words_of[:-1]]
        rows = [kept[a : max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        digest = [hashlib.sha256(x).hexdigest() for x in rows]
        cols = [did.take(pa.array(order)), pa.array(flat.n_words.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(digest)]
        return [*cols, pa.array([x.decode("utf-8", "replace") if texts else None for x in rows], pa.string())]

    def run(docs: pa.Table, bits: pa.Table) -> pa.Table:
        docs = docs.sort_by("row").combine_chunks()
        row = docs.column("row").to_numpy()
        known: dict[tuple[int, int], dict[int, bytes]] = {}
        for a, n, g, m in zip(*(bits.column(c).to_pylist() for c in ("first_row", "n_rows", "group", "mask")), strict=True):
            known.setdefault((a, n), {})[g] = m
        spans, at = [], 0
        for a, n in sorted(known):
            lo = int(np.searchsorted(row, a))
            spans += [(at, lo, {})] * (lo > at) + [(lo, lo + n, known[a, n])]
            at = lo + n
        spans += [(at, len(row), {})] * (len(row) > at)
        did, text = (docs.column(c).combine_chunks() for c in ("did", "text"))
        out = [part(did.slice(a, b - a), text.slice(a, b - a), m) for a, b, m in spans]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        return pa.concat_tables([pa.table(x, names) for x in out])

    return run


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``did, text`` with the file and the row in it; a frame that is no plain file scan is stored first."""
    plain = docs.select(F.col(doc_id).cast("long").alias("did"), F.col(text).alias("text"))
    try:
        return docs.select(
            F.col(doc_id).cast("long").alias("did"), F.col(text).alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
        )
    except AnalysisException:
        return stored(plain, "texts", compression="zstd").select("did", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, prefixes: tuple[int, ...] = PREFIXES, texts: bool = True
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256, kept_text`` (null unless ``texts``)."""
    spark: SparkSession = docs.sparkSession
    rows = _placed(docs, doc_id, text)
    counted = rows.select("text").mapInArrow(_count(span, prefixes), "level int, cell int, n long")
    cells = counted.groupBy("level", "cell").agg(F.sum("n").alias("n")).collect()  # at most len(prefixes) * CELLS rows
    counts = np.zeros((len(prefixes), CELLS), np.int64)
    for r in cells:
        counts[r["level"], r["cell"]] = r["n"]
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routes = Routes(counts, int(max(50_000, min(GROUP_LABELS, counts[0].sum() // (4 * parts) + 1))))
    chunk_text = max(CHUNK_TEXT, min(MOST_TEXT, MESSAGE_TEXT * routes.groups))
    per_chunk = int(max(1, min(CHUNK_ROWS, chunk_text * max(1, size["n"]) // max(1, size["b"]))))
    rows = rows.withColumn("chunk", F.floor(F.col("row") / per_chunk))
    sent = rows.mapInArrow(
        _send(span, prefixes, routes), "group int, file string, chunk long, first_row long, n_rows long, labels binary, ends binary, ids binary"
    )
    bits = sent.groupBy("group").applyInArrow(_subtrees, "file string, chunk long, first_row long, n_rows long, group int, mask binary")
    bits = stored(bits, "repeat-bits")
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return rows.groupBy("file", "chunk").cogroup(bits.groupBy("file", "chunk")).applyInArrow(_clean(span, prefixes, routes, texts), kind)
