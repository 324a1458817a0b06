"""Phrase collocations by an FM-index per shard over word ids.

Texts are read where they lie, in shards of about SHARD_WORDS words. A piece of text
between separators is a run of words; a phrase is LEAST to MOST consecutive words of a
piece. All counts are per language: a word of another language is another word.

1. Each shard builds an FM-index of its word ids (Burrows-Wheeler transform ordered to
   the depth needed, occurrence ranks) and extends the interval of every word to the
   left by every word that precedes it: all word pairs with their counts, each also the
   right extension of its first word (the interval it lies in). The sums over shards are
   the counts of words and pairs; one shard that holds a frequent pair spells it.
2. Words in no frequent pair leave the shards' texts; the index of what is left finds the
   intervals of the pairs by backward search and extends them to MOST words. A phrase is
   kept only while the phrases without its first and without its last word are still
   there. A shard sends the phrases that end where its text does, or at MOST words, with
   the number of those ends: each place of the text starts at most one of them. A
   shorter phrase is the start of those that it grows into, so its count is the sum of
   theirs, taken where phrases of the same first words meet.

Extension runs over all intervals of a length at once, a few numpy passes over the
shard. Right extensions need no second index: the intervals of length k + 1 inside the
interval of a phrase of length k are its right extensions, those reached through the
transform its left ones. The scores, cuts and nested phrases are joins of counts.

What moves: vocabularies and word pairs with their counts, once for a shard; of longer
phrases at most a row for each word of the text; and the shards' id sequences, once, to
meet the pairs that they keep. Words are told apart by 64-bit hashes of (language, word):
two of a hundred million are one with probability 3e-4. Pairs are by a 64-bit hash of
theirs: one of a million frequent pairs takes up another of a billion with probability
5e-5.

Defined cases: a null text is an empty one; a null language is ``und``; repeated rows
each count; texts of any length are taken whole (one row is never split over shards); a
piece without words counts for nothing; columns other than the two named are not looked
at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattflow.operators.windows import top_n_per_key

from .frames import keyed_join, stored
from .textops import _BYTE_CODE, _LOWER, _prefix, mix64, slices, span_hash, with_newline

LEAST, MOST = 2, 5
LEAST_COUNT, LIMIT = 100, 2000
SHARD_WORDS = 1 << 20
NO_LANGUAGE = "und"

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _BREAK.copy()
_GAP[[0x09, 0x20]] = True
_U = np.uint64
_LOW = np.int64((1 << 32) - 1)


def _spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings of byte spans."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[at])))


def words_of(texts: pa.Array, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word from, word to, row of word, key of (language, word), starts a piece) of all words."""
    col = with_newline(texts)
    ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    low = _LOWER[np.frombuffer(col.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]]
    solid = ~_GAP[low]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(solid) and solid[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    row = np.searchsorted(ends - ends[0], start, side="right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[low])])  # the newline after a row is one too
    fresh = np.ones(len(start), bool)
    fresh[1:] = breaks[start[1:]] != breaks[end[:-1]]
    # the language is mixed once more: a word may itself be a language's code
    key = mix64(span_hash(_prefix(_BYTE_CODE[low]), start, end) + mix64(lang)[row]) if len(start) else np.zeros(0, np.uint64)
    return low, start, end, row, key, fresh


class _Shard:
    """Words of the rows so far: one vocabulary and sequence a slice, merged when the shard is full."""

    def __init__(self):
        self.keys, self.counts, self.words, self.langs, self.ids, self.fresh = [], [], [], [], [], []
        self.n = 0

    def add(self, texts: pa.Array, langs: pa.Array) -> None:
        coded = langs.dictionary_encode()
        names = coded.dictionary
        lang = np.array([hash64(x) for x in names.to_pylist()], dtype=np.uint64)[coded.indices.to_numpy()]
        low, start, end, row, key, fresh = words_of(texts, lang)
        if not len(key):
            return
        unique, first, ids, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        self.keys.append(unique)
        self.counts.append(count)
        self.words.append(_spans(low, start[first], end[first]))
        self.langs.append(names.take(pa.array(coded.indices.to_numpy()[row[first]])).cast(pa.string()))
        self.ids.append(ids.astype(np.int32))
        self.fresh.append(fresh)
        self.n += len(key)

    def batch(self, shard: int) -> Iterator[pa.RecordBatch]:
        """All rows of the shard: its text and words, and its pairs."""
        for batch in self.texts(shard):
            yield batch.append_column("pair", pa.nulls(batch.num_rows, pa.int32()))
            if batch.column("seq")[0].is_valid:
                seq, keys = (batch.column(c)[0].as_py() for c in ("seq", "keys"))
        for pair, _ in pairs_of(unpacked(seq), np.frombuffer(keys, np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(cell_of(pair))], ["pair"])

    def texts(self, shard: int) -> Iterator[pa.RecordBatch]:
        """One row with the id sequence (0 between pieces) and the keys of its ids, and one for each word."""
        unique, first, to = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        count = np.zeros(len(unique), np.int64)
        np.add.at(count, to, np.concatenate(self.counts))
        at = np.concatenate([[0], np.cumsum([len(k) for k in self.keys])])
        ids = np.concatenate([to[a:b][i] for a, b, i in zip(at[:-1], at[1:], self.ids, strict=True)]).astype(np.int32) + 1
        seq = with_gaps(ids, np.concatenate(self.fresh))
        word = pa.concat_arrays(self.words).take(pa.array(first)).cast(pa.string())
        lang = pa.concat_arrays(self.langs).take(pa.array(first))
        none = {f.name: pa.nulls(1, f.type) for f in ROW}

        def rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, none[f.name] if n == 1 else pa.nulls(n, f.type)) for f in ROW], schema=ROW)

        yield rows(1, shard=pa.array([shard]), seq=pa.array([packed(seq)], pa.binary()), keys=pa.array([unique.tobytes()], pa.binary()))
        n = len(unique)
        yield rows(n, shard=pa.array(np.full(n, shard)), lang=lang, word=word, count=pa.array(count))


ROW = pa.schema([("shard", pa.int64()), ("seq", pa.binary()), ("keys", pa.binary()), ("lang", pa.string()), ("word", pa.string()), ("count", pa.int64())])
KIND = "shard long, seq binary, keys binary, lang string, word string, count long"


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit key of each pair of word keys."""
    return mix64(a + mix64(b)).view(np.int64)


def cell_of(pair: np.ndarray) -> np.ndarray:
    """First 32 bits of pair keys: enough to say which pairs may go."""
    return (pair >> 32).astype(np.int32)


def pairs_of(seq: np.ndarray, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, occurrences) of the word pairs of a text, a part at a time."""
    index = FMIndex(seq, 1)
    one, lo, size = index.words()
    for ids, found in phrases(index, one[:, None], lo, size, 2):
        for at in range(0, len(found), 1 << 17):
            part = ids[at : at + (1 << 17)] - 1
            yield pair_key(keys[part[:, 0]], keys[part[:, 1]]), found[at : at + (1 << 17)]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word pairs of each shard."""
    for batch in batches:
        for shard, blob, raw in zip(batch.column("shard"), batch.column("seq"), batch.column("keys"), strict=True):
            for pair, count in pairs_of(unpacked(blob.as_py()), np.frombuffer(raw.as_py(), np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), shard.as_py())), pa.array(pair), pa.array(count)], ["shard", "pair", "count"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of every (language, word)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("lang").dictionary_encode()
        lang = np.array([hash64(x) for x in coded.dictionary.to_pylist()], dtype=np.uint64)[coded.indices.to_numpy()]
        key = words_of(batch.column("word"), lang)[4]  # a word is one word: one key a row
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "word", "f")), pa.array(key.view(np.int64))], ["lang", "word", "f", "key"])


def hash64(text: str) -> int:
    code = _BYTE_CODE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    return int(span_hash(_prefix(code), np.array([0]), np.array([len(code)]))[0])


def with_gaps(ids: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The sequence with one 0 before each word that starts a run, and one at the end."""
    seq = np.zeros(len(ids) + int(fresh.sum()) + 1, np.int32)
    seq[np.arange(len(ids)) + np.cumsum(fresh)] = ids
    return seq


def packed(seq: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(seq, dtype=np.int32)
    return len(raw).to_bytes(8, "little") + pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), np.int32)


def _shards(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, k = TaskContext.get().partitionId(), _Shard(), 0
        for batch in batches:
            for piece in slices(batch, "text"):
                now.add(piece.column("text"), piece.column("lang"))
                if now.n >= words:
                    yield from now.texts((part << 32) + k)
                    now, k = _Shard(), k + 1
        if now.n:
            yield from now.texts((part << 32) + k)

    return run


class FMIndex:
    """FM-index of an id sequence (0 separates), its transform ordered by ``depth`` following ids.

    ``rank`` holds (symbol, row) of the transform in order: the place of (c, i) in it is
    the row that row i steps to by the symbol c before it, and the number of c before
    row i lies between that place and the first c.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        place = np.arange(n, dtype=np.int64)
        order = np.sort((text.astype(np.int64) << 32) | place) & _LOW
        if depth > 1:
            level, step = _dense(text[order], order), 1
            while step < depth:
                ahead = np.zeros(n, np.int64)
                more = min(step, depth - step)
                ahead[: n - more] = level[more:]
                key = level * (n + 1) + ahead
                order = np.argsort(key, kind="stable")
                level, step = _dense(key[order], order), step + more
        self.n = n
        self.rank = np.sort((text[order - 1].astype(np.int64) << 32) | place)
        self.symbol = (self.rank >> 32).astype(np.int32)  # first id of each row
        self.came = self.rank & _LOW  # the row that steps to each row

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, first row, rows) of every single id."""
        lo = np.flatnonzero(np.concatenate([[True], self.symbol[1:] != self.symbol[:-1]]))
        size = np.diff(np.concatenate([lo, [self.n]]))
        some = self.symbol[lo] > 0
        return self.symbol[lo][some], lo[some], size[some]

    def step(self, symbol: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of ``symbol`` + phrase from the phrases' intervals."""
        code = symbol.astype(np.int64) << 32
        at = np.searchsorted(self.rank, code | lo)
        return at, np.searchsorted(self.rank, code | (lo + size)) - at

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of phrases (one a row), last id first."""
        lo, size = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for j in range(phrases.shape[1] - 1, -1, -1):
            lo, size = self.step(phrases[:, j], lo, size)
        return lo, size

    def extend(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All left extensions of phrases of one length (intervals rising) whose first words are such a phrase too.

        (symbol, phrase extended to the left, phrase extended to the right, first row, rows).
        """
        label = np.zeros(self.n, np.int32)
        at = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
        label[at] = np.repeat(np.arange(1, len(lo) + 1, dtype=np.int32), size)
        rest = label[self.came]
        row = np.flatnonzero((rest > 0) & (label > 0) & (self.symbol > 0))
        same = np.zeros(len(row), bool)
        same[1:] = (self.symbol[row[1:]] == self.symbol[row[:-1]]) & (rest[row[1:]] == rest[row[:-1]])
        first = np.flatnonzero(~same)
        start = row[first]
        return self.symbol[start], rest[start] - 1, label[start] - 1, start, np.diff(np.concatenate([first, [len(row)]]))


def _dense(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of each place's key, from the keys in order."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]])) if len(order) else 0
    return out


def phrases(index: FMIndex, ids: np.ndarray, lo: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, one phrase a row; occurrences) for every length above that of the phrases given, up to ``most``."""
    by = np.argsort(lo)
    ids, lo, size = ids[by], lo[by], size[by]
    while ids.shape[1] < most and len(ids):
        symbol, rest, _, lo, size = index.extend(lo, size)
        ids = np.concatenate([symbol[:, None], ids[rest]], axis=1)
        yield ids, size


def ends(index: FMIndex, ids: np.ndarray, lo: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, occurrences that no word of the text follows; at ``most`` words all) of the phrases that ``phrases`` gives."""
    by = np.argsort(lo)
    ids, lo, size = ids[by], lo[by], size[by]
    first = ids.shape[1]
    while len(ids):
        longer, last = ids[:0], size
        if ids.shape[1] < most:
            symbol, rest, start, lo, more = index.extend(lo, size)
            longer = np.concatenate([symbol[:, None], ids[rest]], axis=1)
            last, size = size - np.bincount(start, more, len(size)).astype(np.int64), more
        if ids.shape[1] > first:
            yield ids[last > 0], last[last > 0]
        ids = longer


def _names(most: int) -> list[str]:
    return [f"w{i}" for i in range(1, most + 1)] + ["count"]


def _rows(words: np.ndarray, count: pa.Array, most: int) -> pa.RecordBatch:
    """Phrases of one length with their counts; 0 for the words that are not there."""
    wide = np.zeros((len(words), most), np.int64)
    wide[:, : words.shape[1]] = words
    return pa.RecordBatch.from_arrays([*(pa.array(wide[:, i]) for i in range(most)), count], _names(most))


def _spelled(most: int):
    """The pairs that each shard is asked to spell, with their counts over all shards, and its longer phrases."""
    longer = _longer(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, raw, own in zip(batch.column("seq"), batch.column("keys"), batch.column("own"), strict=True):
                pair, f = own.values.flatten()
                if len(pair):
                    seq, keys = unpacked(blob.as_py()), np.frombuffer(raw.as_py(), np.uint64)
                    side = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
                    two = np.stack([keys[seq[side] - 1], keys[seq[side + 1] - 1]], axis=1)
                    key, first = np.unique(pair_key(two[:, 0], two[:, 1]), return_index=True)
                    yield _rows(two[first[np.searchsorted(key, pair.to_numpy())]].view(np.int64), f, most)
            yield from longer([batch])

    return run


def _longer(most: int):
    """Phrases of three words and more that ``ends`` gives of each shard, of the pairs that the table keeps, by the keys of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, raw, known in zip(batch.column("seq"), batch.column("keys"), batch.column("known"), strict=True):
                seq, keys = unpacked(blob.as_py()).astype(np.int64), np.frombuffer(raw.as_py(), np.uint64)
                cells = np.sort(known.values.to_numpy())
                side = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
                cell = cell_of(pair_key(keys[seq[side] - 1], keys[seq[side + 1] - 1]))
                near = side[cells[np.minimum(np.searchsorted(cells, cell), len(cells) - 1)] == cell]
                held = np.zeros(len(seq) - 1, bool)
                held[near] = True
                hold = np.concatenate([[False], held, [False]])  # between each word and the one before
                stay = np.flatnonzero(hold[:-1] | hold[1:])
                local, ids = np.unique(seq[stay], return_inverse=True)
                text = with_gaps(ids.astype(np.int32) + 1, ~hold[:-1][stay])
                pair = np.unique((text[:-1].astype(np.int64) << 32) | text[1:])
                two = np.stack([pair >> 32, pair & _LOW], axis=1).astype(np.int32)
                two = two[(two > 0).all(axis=1)]
                index = FMIndex(text, most - 1)
                lo, size = index.find(two)
                key = keys[local - 1].view(np.int64)
                for found, count in ends(index, two, lo, size, most):
                    yield _rows(key[found - 1], pa.array(count), most)

    return run


def _starts(rows: DataFrame, least: int, most: int) -> DataFrame:
    """``ws, f`` of the phrases that occur ``least`` times, from phrases as far as their text goes.

    All phrases with the same first three words meet once; sorted there, each length's
    sums are taken over neighbours, and a phrase is named at the first of its own.
    """
    names = _names(most)[:-1]
    short = min(LEAST + 1, most)
    rows = rows.repartition(*names[:short]).groupBy(*names).agg(F.sum("count").alias(f"f{most}"))
    out = []
    for k in range(short, most):
        group = Window.partitionBy(*names[:k]).orderBy(*names[k:])
        whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.select("*", F.sum(f"f{most}").over(whole).alias(f"f{k}"), F.row_number().over(group).alias(f"at{k}"))
        rows = rows.where(F.col(f"f{k}") >= least) if k == short else rows
        named = (F.col(f"at{k}") == 1) & (F.col(names[k - 1]) != 0) if k > short else F.col(f"at{k}") == 1  # a pair has no third word
        out.append(F.when(named & (F.col(f"f{k}") >= least), F.struct(F.array(*names[:k]).alias("ws"), F.col(f"f{k}").alias("f"))))
    whole = F.struct(F.array(*names).alias("ws"), F.col(f"f{most}").alias("f"))
    out.append(F.when((F.col(f"f{most}") >= least) & ((F.col(names[-1]) != 0) | F.lit(short == most)), whole))
    rows = rows.select(F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("found"))
    return rows.select(F.filter("found.ws", lambda w: w != 0).alias("ws"), "found.f")


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, most: int = MOST, shard_words: int = SHARD_WORDS):
    """(words: lang, word, f, key; totals: lang, n; phrases: ws, f) of the words and phrases that occur ``least`` times."""
    plain = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"))
    shards = stored(plain.mapInArrow(_shards(shard_words), KIND), "phrase-shards", compression="zstd")
    vocabulary = shards.where(F.col("word").isNotNull())
    totals = stored(vocabulary.groupBy("lang").agg(F.sum("count").alias("n")), "phrase-totals")
    words = vocabulary.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    words = stored(words.mapInArrow(_keys, "lang string, word string, f long, key long"), "phrase-words")
    # a shard has one row of a pair: the sum is taken where its rows meet, which moves them once
    texts = shards.where(F.col("seq").isNotNull()).select("shard", "seq", "keys")
    same = Window.partitionBy("pair")
    kept = texts.mapInArrow(_pairs, "shard long, pair long, count long")
    kept = kept.select("shard", "pair", F.sum("count").over(same).alias("f"), F.min("shard").over(same).alias("first")).where(F.col("f") >= least)
    own = F.when(F.col("shard") == F.col("first"), F.struct("pair", "f"))
    cell = F.shiftright("pair", 32).cast("int")
    known = kept.groupBy("shard").agg(F.collect_list(cell).alias("known"), F.collect_list(own).alias("own"))  # at most one for each word of the shard
    meet = texts.join(known, "shard").select("seq", "keys", "known", "own")
    longer = meet.mapInArrow(_spelled(most), ", ".join(f"{c} long" for c in _names(most)))
    found = stored(_starts(longer, least, most), "phrase-found")
    return words, totals, found


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, limit: int = LIMIT, most: int = MOST, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``limit`` phrases by score.

    The score of a cut is floor(1000 * a * n / (l * r)) in 38-digit integers; the cut of
    lowest score counts, ties to the shorter first part. A phrase inside a longer one of
    equal count is left out.
    """
    words, totals, found = count_phrases(docs, text, lang, least, most, shard_words)
    # a longer phrase of equal count has, between, one that is longer by one word
    longer = found.where(F.size("ws") > LEAST)
    inner = F.array(F.slice("ws", 1, F.size("ws") - 1), F.slice("ws", 2, F.size("ws") - 1))
    nested = longer.select(F.explode(inner).alias("ws"), "f").distinct()
    left = stored(found.join(nested, ["ws", "f"], "left_anti"), "phrase-left")
    # the words' language and total once a phrase, the words' own text once a word
    per_word = keyed_join(words, totals, ["lang"]).select("key", "lang", "word", "n", F.col("f").alias("f1"))
    spelled = left.select("ws", "f", F.posexplode("ws").alias("at", "key"))
    spelled = spelled.join(per_word, "key").groupBy("ws", "f").agg(
        F.first("lang").alias("lang"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "word", "f1"))).alias("parts")
    )
    spelled = stored(spelled, "phrase-spelled")
    cuts = spelled.select("ws", F.col("f").alias("a"), "lang", "n", "parts", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    one, last = F.col("k") == 1, F.col("k") == F.size("ws") - 1
    cuts = cuts.select(
        "ws", "a", "n", "lang", "k",
        F.when(one, F.col("parts")[0]["f1"]).alias("l1"), F.when(~one, F.slice("ws", F.lit(1), F.col("k"))).alias("lw"),
        F.when(last, F.element_at("parts", -1)["f1"]).alias("r1"), F.when(~last, F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k"))).alias("rw"),
    )
    cuts = cuts.join(found.select(F.col("ws").alias("lw"), F.col("f").alias("l2")), "lw", "left")
    cuts = cuts.join(found.select(F.col("ws").alias("rw"), F.col("f").alias("r2")), "rw", "left")
    cuts = cuts.select("ws", "k", "a", "n", F.coalesce("l1", "l2").alias("l"), F.coalesce("r1", "r2").alias("r"))
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    score = F.expr("div(top, bottom)")
    cuts = cuts.withColumns({"top": F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"], "bottom": wide["l"] * wide["r"]}).withColumn("score", score)
    best = cuts.groupBy("ws").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    phrase = F.concat_ws(" ", F.col("parts")["word"])
    rows = spelled.join(best, "ws").select("lang", phrase.alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    rows = top_n_per_key(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], limit, rank_col="rank")
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
