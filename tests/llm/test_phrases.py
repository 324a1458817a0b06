"""Phrase mining: the index against plain search, the operator against plain counts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattflow.llm import phrases


def plain(docs, least, limit):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if a >= least and len(p) >= 2}
        inside = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= c[p[i : i + k]]}
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]) for i, r in enumerate(sorted(rows)[:limit], 1)]
    return sorted(out)


def texts(words):
    pool = words(30, 4)
    rng = np.random.default_rng(8)
    out = []
    for i in range(120):
        body = [pool[min(29, int(x))] for x in rng.exponential(6, size=int(rng.integers(1, 90)))]
        for at in range(9, len(body), 11):
            body[at] += ".,;:!?\n\r\x0b\x0c"[at % 10]
        out.append((" ".join(body), ("en", "de", None, "und")[i % 4]))
    # words that are language codes, capitals, tabs, separators inside a word, other scripts, nothing at all
    out += [("de en de en es de en", "en"), ("en de EN De\ten de", "de"), ("a.b,c d  e", "fr"), ("日本 語 日本 語 Ä ä", "fr"), (None, "en"), ("", None), (" \t.,;", "de")]
    out += [("same words again and again " * 40, "en")] * 3 + [("hot word " * 3000, "en")]
    return out


def rows_of(spark, docs, parts):
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string")
    return frame.withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).repartition(parts)


@pytest.mark.parametrize(("least", "limit", "shard"), [(2, 25, 400), (6, 2000, 1 << 21)])
def test_equals_plain_counts(spark, words, least, limit, shard):
    docs = texts(words)
    got = sorted(tuple(r) for r in phrases.collocations(rows_of(spark, docs, 5), least=least, limit=limit, shard_words=shard).collect())
    assert got == plain(docs, least, limit)


def test_nothing_to_find(spark):
    for docs in ([], [(None, None)], [("", "en"), ("one two three", "en")]):
        assert phrases.collocations(rows_of(spark, docs, 1) if docs else spark.createDataFrame([], "text string, lang string")).count() == 0


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big * 4, big + 7, big + 9)], "a long, n long, l long, r long")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in "anlr"}
    got = row.select((F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"]).alias("top"), (wide["l"] * wide["r"]).alias("bottom")).selectExpr("div(top, bottom) AS s").first().s
    assert got == 1000 * big * big * 4 // ((big + 7) * (big + 9))


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_index_finds_and_extends(depth):
    rng = np.random.default_rng(depth)
    text = phrases.with_gaps(rng.integers(1, 5, 300).astype(np.int32), rng.random(300) < 0.1)
    index = phrases.FMIndex(text, depth)
    runs = [r for r in "".join(chr(48 + c) for c in text).split("0") if r]
    count = Counter(tuple(ord(c) - 48 for c in r[i : i + k]) for r in runs for k in range(1, depth + 2) for i in range(len(r) - k + 1))
    word, lo, size = index.words()
    assert {(w,): s for w, s in zip(word.tolist(), size.tolist(), strict=True)} == {p: c for p, c in count.items() if len(p) == 1}
    for ids, found in phrases.phrases(index, word[:, None], lo, size, depth + 1):
        got = {tuple(p): c for p, c in zip(ids.tolist(), found.tolist(), strict=True)}
        assert got == {p: c for p, c in count.items() if len(p) == ids.shape[1]}
    if depth > 1:
        two = np.array([[1, 2], [4, 4], [3, 1]], np.int32)
        lo, size = index.find(two)
        assert size.tolist() == [count[tuple(p)] for p in two.tolist()]


def test_sequences_round_trip():
    seq = phrases.with_gaps(np.arange(1, 9, dtype=np.int32), np.array([1, 0, 0, 1, 1, 0, 0, 1], bool))
    assert seq.tolist() == [0, 1, 2, 3, 0, 4, 0, 5, 6, 7, 0, 8, 0]
    assert phrases.unpacked(phrases.packed(seq)).tolist() == seq.tolist()


def test_copies_send_no_more_rows(words):
    """What a shard sends is a row for each distinct phrase: copies add none, and no word stands for more than four."""
    text = " ".join(words(300, 5))

    def sent(copies):
        shard = phrases._Shard()
        shard.add(pa.array([text] * copies), pa.array(["en"] * copies))
        batches = list(shard.batch(0))
        cells = np.unique(np.concatenate([b.column("pair").drop_null().to_numpy() for b in batches]))
        one = [batches[0].column("seq"), batches[0].column("keys"), pa.array([cells], pa.list_(pa.int32()))]
        return sum(b.num_rows for b in phrases._longer(5)([pa.record_batch(one, ["seq", "keys", "known"])]))

    assert sent(1) == sent(40) <= 4 * 300


def shard_rows(texts):
    """(seq, keys, pairs with their counts) of one shard."""
    shard = phrases._Shard()
    shard.add(pa.array(texts), pa.array(["en"] * len(texts)))
    first = next(iter(shard.texts(0)))
    seq, keys = first.column("seq")[0].as_py(), first.column("keys")[0].as_py()
    pairs = list(phrases.pairs_of(phrases.unpacked(seq), np.frombuffer(keys, np.uint64)))
    return seq, keys, np.concatenate([p for p, _ in pairs]), np.concatenate([c for _, c in pairs])


def test_a_place_sends_one_row(words):
    """Of longer phrases a shard sends at most one row for each word, and their counts add up to the places that start one."""
    shard = phrases._Shard()
    shard.add(pa.array([" ".join(words(400, 5))]), pa.array(["en"]))
    batches = list(shard.batch(0))
    cells = np.unique(np.concatenate([b.column("pair").drop_null().to_numpy() for b in batches]))
    one = [batches[0].column("seq"), batches[0].column("keys"), pa.array([cells], pa.list_(pa.int32()))]
    sent = list(phrases._longer(5)([pa.record_batch(one, ["seq", "keys", "known"])]))
    assert sum(b.num_rows for b in sent) <= 400
    assert sum(sum(b.column("count").to_pylist()) for b in sent) == 400 - 2


def test_a_pair_is_spelled_once():
    """A frequent pair is spelled by the one shard that is asked to, with its count over all of them."""
    seq, keys, pair, count = shard_rows(["red blue red blue", "blue green"])
    cells = pa.array([np.unique(phrases.cell_of(pair))] * 2, pa.list_(pa.int32()))
    kind = pa.list_(pa.struct([("pair", pa.int64()), ("f", pa.int64())]))
    own = pa.array([[], [{"pair": p, "f": 100 + c} for p, c in zip(pair.tolist(), count.tolist(), strict=True)]], kind)
    batch = pa.record_batch([pa.array([seq] * 2), pa.array([keys] * 2), cells, own], ["seq", "keys", "known", "own"])
    rows = [r for b in phrases._spelled(5)([batch]) for r in b.to_pylist() if r["w3"] == 0]
    assert sorted(r["count"] for r in rows) == [101, 101, 102] and len({(r["w1"], r["w2"]) for r in rows}) == 3


def test_ends_are_the_longest_phrases():
    rng = np.random.default_rng(3)
    text = phrases.with_gaps(rng.integers(1, 4, 400).astype(np.int32), rng.random(400) < 0.2)
    runs = [tuple(ord(c) - 48 for c in r) for r in "".join(chr(48 + c) for c in text).split("0") if r]
    want = Counter(r[i : i + 5] for r in runs for i in range(len(r) - 2))
    index = phrases.FMIndex(text, 4)
    two = np.array(sorted({r[i : i + 2] for r in runs for i in range(len(r) - 1)}), np.int32)
    got = Counter()
    for ids, last in phrases.ends(index, two, *index.find(two), 5):
        got.update({tuple(p): c for p, c in zip(ids.tolist(), last.tolist(), strict=True)})
    assert got == want
