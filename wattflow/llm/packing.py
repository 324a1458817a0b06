"""Packing token sequences by minimum bin slack.

Documents longer than a window give full windows; what remains (1 to capacity - 1
tokens) is packed. For each window a bitset subset-sum dynamic programme over the
multiset of remaining lengths finds the sum closest to the capacity, with the
longest remaining length fixed in it, and backtracks how many pieces of each
length to take; the same choice is repeated as often as the counts allow. A gap
that no multiset fills is closed by cutting a piece, whose rest goes back to the
multiset. The programme works on the histogram of lengths (at most capacity - 1
rows whatever the input); documents are ranked inside each length and look their
pieces up.

Defined cases: a null text has no tokens but the end token; repeated rows are
packed each; a document of exact windows has no rest; columns other than the two
named are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored, text_key
from .textops import Flat, slices, span_hash

CAPACITY, END_ID = 4096, 2
VOCABULARY = "word_bpe_49k.json"
RANK_ROWS = 50_000  # rows that one ranking group holds on average
CACHE_PIECES = 1_000_000  # distinct pieces whose ids a task keeps


class WordTokenizer:
    """Ids of whole texts, each distinct piece of a word encoded once.

    The vocabulary's pre-tokenizer drops white space, no rule of it looks across
    it, and it cuts a word where letters, single digits and other marks meet. Words
    of Latin-1 letters, digits and ASCII marks are folded and cut here, a batch of
    texts at a time, and each distinct piece goes to the BPE model once; a word with
    an apostrophe or any other character is encoded by itself, by the whole
    tokenizer if need be. Texts that hold a special token's opening mark are encoded
    whole, as such tokens are found first. Pieces are known by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.places: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)  # of piece number i; its ids end where the next one's start
        self.used = 0

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, folded: bytes) -> list[int]:
        text = folded.decode("ascii") if folded.isascii() else folded.decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.model.tokenize(text)]

    def _word(self, raw: bytes) -> list[int]:
        word = raw.decode("utf-8", "surrogatepass")
        if not PLAIN.fullmatch(word):
            return self._whole(word)
        return [i for piece in PIECES.findall(word.lower()) for i in self._piece(piece.encode())]

    def _learn(self, hashes: list[int], found: list[list[int]]) -> None:
        total = sum(map(len, found))
        first = len(self.places)
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(total, len(self.flat)), np.uint32)])
        if first + len(found) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(len(found) + 1, len(self.starts)), np.int64)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.starts[first + 1 : first + 1 + len(found)] = self.used + np.cumsum([len(ids) for ids in found])
        self.used += total
        self.places.update(zip(hashes, range(first, first + len(found)), strict=True))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each)."""
        flat = Flat(texts)
        raw = flat.raw
        kind = KIND[raw]
        pair = np.zeros(len(raw), dtype=bool)  # second byte of a Latin-1 letter
        pair[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0xBF) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        odd = (kind == 4) & ~pair
        odd[:-1] &= ~((raw[:-1] == 0xC3) & pair[1:])
        upto = np.concatenate([[0], np.cumsum(odd)])
        odd_word = upto[flat.word_to] > upto[flat.word_from]
        kind[kind == 4] = 1
        folded = FOLD[raw]
        folded[pair & (raw <= 0x9E)] += 0x20
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        if odd_word.any():
            span = np.zeros(len(raw) + 1, np.int8)
            span[flat.word_from[odd_word]] += 1
            span[flat.word_to[odd_word]] -= 1
            inside = np.cumsum(span[:-1]) > 0
            cut[:-1] &= ~inside
            folded = np.where(inside, raw, folded)
        cut[:-1] &= flat.solid
        cut[flat.word_from] = True
        start = np.flatnonzero(cut[:-1])
        word = np.searchsorted(flat.word_from, start, side="right") - 1
        end = flat.word_to[word]
        same = word[1:] == word[:-1]
        end[:-1][same] = start[1:][same]
        flat.data = folded
        value = span_hash(flat.byte_prefix(), start, end)
        value[odd_word[word]] ^= np.uint64(0x5851F42D4C957F2D)
        kinds, lead, which = np.unique(value, return_index=True, return_inverse=True)
        keys = kinds.tolist()
        if len(self.places) + len(keys) > CACHE_PIECES:
            self._forget()
        known = self.places
        new = [i for i, k in enumerate(keys) if k not in known]
        if new:
            at = lead[new]
            text, own = folded.tobytes(), odd_word[word[at]].tolist()
            spans = zip(start[at].tolist(), end[at].tolist(), own, strict=True)
            self._learn([keys[i] for i in new], [self._word(text[a:b]) if o else self._piece(text[a:b]) for a, b, o in spans])
        place = np.fromiter((known[k] for k in keys), np.int64, len(keys))[which]
        first = self.starts[place]
        count = self.starts[place + 1] - first
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(first - upto[:-1], count) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(start, flat.row_at)])

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text:
            return np.asarray(self._whole(text), dtype=np.uint32)
        return self.batch(pa.array([text]))[0]


def _kinds() -> np.ndarray:
    """Of each byte: 0 white space, 1 letter, 2 digit, 3 mark, 4 none of these by itself."""
    kind = np.full(256, 4, dtype=np.uint8)
    kind[33:127] = 3
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = 1
    kind[39] = 4  # an apostrophe may open one of the pre-tokenizer's endings
    return kind


KIND = _kinds()
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
# fixed values of the vocabulary's pre-tokenizer, for lower-case text of the letters in PLAIN
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u017f0-9]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others, in order, from code point 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenise(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = WordTokenizer(path)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                ids, count = tokenizer.batch(texts)
                own = np.split(ids, np.cumsum(count)[:-1])
                marked = pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(marked).tolist():
                    own[i] = tokenizer.ids(texts[i].as_py())
                own = [np.append(x, np.uint32(end)) for x in own]
                small = [x.max() < 1 << 16 for x in own]
                wide = [x.astype("<u2").tobytes() if s else b"" for x, s in zip(own, small, strict=True)]
                full = [b"" if s else x.astype("<u4").tobytes() for x, s in zip(own, small, strict=True)]
                arrays = [part.column("did"), part.column("rid"), pa.array([len(x) for x in own], pa.int64()), pa.array(wide, pa.binary()), pa.array(full, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["did", "rid", "n", "ids16", "ids32"])

    return run


def tokenised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end: int = END_ID) -> DataFrame:
    """``did, rid, row, n, ids16, ids32``: ids with the end token, two bytes each where all fit; stored once."""
    plain = docs.select(F.col(doc_id).alias("did"), F.col(text).alias("text")).select("did", text_key("text").alias("rid"), "text")
    kind = "did long, rid long, n long, ids16 binary, ids32 binary"
    done = plain.mapInArrow(_tokenise(path or vocabulary_path(), end), kind)
    return stored(done.withColumn("row", F.monotonically_increasing_id()), "tokens", compression="zstd")


def fill_window(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The multiset (length, how many) of ``counts``, the longest length in it, whose sum is closest to ``capacity`` from below.

    Bit s of a set says that s tokens can be reached; counts are split into powers
    of two, so a length enters with as many shifts as its count has bits.
    """
    longest = max(counts)
    room = capacity - longest
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        take = 1
        while left > 0 and not reach >> room & 1:
            k = min(take, left)
            grown = (reach | reach << k * length) & mask
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            left -= k
            take *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    used = {longest: 1}
    for length, k, before in reversed(steps):
        if not before >> best & 1:
            used[length] = used.get(length, 0) + k
            best -= k * length
    return sorted(used.items(), reverse=True)


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int, int]]:
    """Segments (rest, rank_from, times, start, length, sequence, offset) that place every rest.

    The document of rank ``rank_from + j`` among those with ``rest`` tokens left
    puts its tokens ``start .. start + length`` of that rest into window
    ``sequence + j`` at ``offset``. The plan's size depends on the capacity, not
    on the number of documents.
    """
    # a stack of runs per current length: (rest, rank_from, how many, start in the rest)
    runs: dict[int, list[list[int]]] = {n: [[n, 0, c, 0]] for n, c in histogram.items() if c}
    counts = {n: c for n, c in histogram.items() if c}
    plan, sequence = [], 0
    while counts:
        chosen = fill_window(counts, capacity)
        gap = capacity - sum(n * k for n, k in chosen)
        items = [n for n, k in chosen for _ in range(k)]
        free = {n: counts[n] - dict(chosen).get(n, 0) for n in counts}
        cut = max((n for n in free if n > gap and free[n] > 0), default=0) if gap else 0
        if cut:
            items.append(cut)
        need: dict[int, int] = {}
        for n in items:
            need[n] = need.get(n, 0) + 1
        times = min(counts[n] // k for n, k in need.items())
        done = 0
        while done < times:  # a stretch in which every item stays inside one run
            tops = {n: runs[n][-1] for n in need}
            stretch = min(times - done, *(tops[n][2] // need[n] for n in need))
            if not stretch:  # a run too short for all items of its length: join runs by single windows
                stretch = 1
            offset = 0
            for i, n in enumerate(items):
                is_cut = bool(cut) and i == len(items) - 1
                length, left = (gap if is_cut else n), stretch
                j = 0
                while left:
                    run = runs[n][-1]
                    k = min(left, run[2])
                    plan.append((run[0], run[1], k, run[3], length, sequence + j, offset))
                    if is_cut:
                        runs.setdefault(n - gap, []).append([run[0], run[1], k, run[3] + gap])
                        counts[n - gap] = counts.get(n - gap, 0) + k
                    run[1] += k
                    run[2] -= k
                    counts[n] -= k
                    if not run[2]:
                        runs[n].remove(run)
                    left -= k
                    j += k
                offset += length
            sequence += stretch
            done += stretch
        for n in [n for n, c in counts.items() if not c]:
            del counts[n]
            runs.pop(n, None)
    return plan


def ranked(tokens: DataFrame, capacity: int) -> DataFrame:
    """``row, did, n, rest, rank``: ranks from 0 inside each rest, without sorting a rest in one place.

    Rows of a rest are dealt over groups whose number grows with the table; group
    totals give each group its first rank.
    """
    slim = tokens.select("row", "did", "rid", "n", (F.col("n") % capacity).alias("rest"))
    total = slim.count()
    groups = max(1, -(-total // RANK_ROWS)) * 4
    slim = slim.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    sizes = slim.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = Window.partitionBy("rest", "part").orderBy("did", "rid", "row")
    slim = slim.withColumn("i", F.row_number().over(inside) - 1)
    return slim.join(sizes, ["rest", "part"]).select("row", "did", "n", "rest", (F.col("base") + F.col("i")).alias("rank"))


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        small, large, pieces = batch.column("ids16"), batch.column("ids32"), batch.column("pieces").to_pylist()
        out: dict[str, list] = {k: [] for k in ("did", "start", "length", "ids_crc32", "n", "sequence_id", "offset")}
        ids, n = batch.column("did").to_pylist(), batch.column("n").to_pylist()
        for i, own in enumerate(pieces):
            raw = small[i].as_py()
            values = np.frombuffer(raw, "<u2").astype("<u4") if raw else np.frombuffer(large[i].as_py(), "<u4")
            for p in own:
                piece = values[p["start"] : p["start"] + p["length"]]
                row = (ids[i], p["start"], p["length"], zlib.crc32(piece.tobytes()), n[i], p["sequence_id"], p["offset"])
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    tokens = tokenised(docs, doc_id, text, path, end)
    rows = stored(ranked(tokens, capacity), "ranks")
    histogram = {r["rest"]: r["c"] for r in rows.where("rest > 0").groupBy("rest").agg(F.count(F.lit(1)).alias("c")).collect()}
    segments = plan_windows(histogram, capacity)  # fewer than `capacity` histogram rows: a bounded driver-side table
    spark = docs.sparkSession
    kind = "rest long, rank_from long, times long, cut long, length long, sequence long, offset long"
    plan = spark.createDataFrame(segments, kind)
    rest = rows.join(F.broadcast(plan), "rest").where("rank >= rank_from and rank < rank_from + times")
    rest = rest.select(
        "row", (F.col("n") - F.col("rest") + F.col("cut")).alias("start"), "length",
        (2 * (F.col("sequence") + F.col("rank") - F.col("rank_from"))).alias("sequence_id"), "offset",
    )
    # full windows: even ids are packed windows, odd ids full ones, numbered by row and place
    full = rows.where(F.col("n") >= capacity).select("row", (F.col("n") / capacity).cast("long").alias("w"))
    order = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("part", F.shiftright("row", 33))  # the writing task of the token table
    firsts = full.groupBy("part").agg(F.sum("w").alias("t"))
    firsts = firsts.withColumn("base", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    full = full.withColumn("i", F.coalesce(F.sum("w").over(order), F.lit(0))).join(firsts.select("part", "base"), "part")
    full = full.select("row", F.posexplode(F.sequence(F.lit(0), F.col("w") - 1)).alias("k", "_"), (F.col("base") + F.col("i")).alias("first"))
    full = full.select(
        "row", (F.col("k") * F.lit(capacity)).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"),
        (2 * (F.col("first") + F.col("k")) + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    pieces = rest.unionByName(full).groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    out = tokens.select("row", "did", "n", "ids16", "ids32").join(pieces, "row").drop("row")
    out = out.mapInArrow(_checks, "did long, start long, length long, ids_crc32 long, n long, sequence_id long, offset long")
    return out.select(F.col("did").alias("doc_id"), "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset")
