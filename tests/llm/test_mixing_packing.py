"""Mixing and packing: targets, reruns, round trips, edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattflow.llm import mixing, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, budget = {}, set(names), share * sum(sizes.values())
    while free:
        level = budget / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        budget -= sum(most * sizes[s] for s in over)
        free -= over
    return target


def make_docs(words, seed=0):
    out, i = [], 0
    for s, n in (("a", 300), ("b", 40), (None, 60), ("é", 30), ("B", 5), ("empty", 3)):
        for k in range(n):
            text = " ".join(words((7 * k) % 50 + 1, i + seed)) if s != "empty" else ["", None, " \n"][k]
            out.append((i, text, s))
            i += 1
    return out


def test_mix_targets_and_takes(docs_of, words):
    rows = make_docs(words)
    out = mixing.mix(docs_of(rows)).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    target = plain_targets(size)
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert r.size == len(WORD.findall(rows[r.did][1] or "")) and r.source_size == size[r.source]
        assert r.copies in (0, 1, 2)
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        taken[r.source] += r.copies * r.size
    for s, t in taken.items():
        assert abs(t - target[s]) <= 50
    again = mixing.mix(docs_of(rows, parts=5)).collect()
    assert sorted((r.did, r.copies) for r in again) == sorted((r.did, r.copies) for r in out)


def plain_fill(rows, want):
    """Documents (rank order) taken in rounds as far as they fit, then one that brings the source nearer."""
    out, gap = set(), want
    for _ in range(mixing.ROUNDS):
        upto, took = 0, 0
        for i, n in rows:
            if i not in out and n <= gap:
                upto += n
                if upto > gap:
                    break
                took += n
                out.add(i)
        gap -= took
        if not took:
            break
    near = [i for i, n in rows if i not in out and n <= 2 * gap]
    return out | set(near[:1])


@pytest.mark.parametrize("seed", range(5))
def test_one_huge_text_does_not_spoil_the_target(docs_of, words, seed):
    """A 6,000-word text among 100 of 40 words: the words taken lie within one small text of the target."""
    rows = [(i, " ".join(words(40, i)), "a") for i in range(100)] + [(100, " ".join(words(6000, 5)), "a"), (200, " ".join(words(20_000, 7)), "b")]
    out = mixing.mix(docs_of(rows), seed=seed, share=0.75, weights=(1.0, 1.0)).collect()
    taken = sum(r.copies * r.size for r in out if r.source == "a")
    target = next(r.target for r in out if r.source == "a")
    assert abs(taken - target) <= 40 and all(r.copies <= 2 for r in out)
    assert {r.did: r.copies for r in mixing.mix(docs_of(rows, parts=6), seed=seed, share=0.75, weights=(1.0, 1.0)).collect()} == {r.did: r.copies for r in out}


def test_rounds_match_plain_fill(spark, docs_of, words):
    rows = [(i, " ".join(words([3, 900, 40, 7, 150][i % 5] + i % 11, i)), "a") for i in range(120)]
    total = sum(len(t.split()) for _, t, _ in rows)
    out = mixing.mix(docs_of(rows), share=0.37).collect()
    share = 0.37
    rank = {}
    for r in docs_of(rows).select("doc_id", mixing.drawn("doc_id", "text", mixing.SEED).alias("x")).collect():
        u = (r.x + 0.5) / (1 << 40)
        rank[r.doc_id] = u * (1 - share) / ((1 - u) * share)
    order = sorted(((i, len(t.split())) for i, t, _ in rows), key=lambda x: (rank[x[0]], x[0]))
    assert {r.did for r in out if r.copies} == plain_fill(order, share * total)


def test_mixed_rows_follow_copies(docs_of, words):
    rows = make_docs(words) + [(1000, "same same", "b")] * 7
    docs = docs_of(rows).withColumnRenamed("lang", "k").withColumnRenamed("n_chars", "row")
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.did] += r.copies
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +copies


def test_inclusion_follows_probability(docs_of, words):
    """Over seeds a document of a source with fraction p is taken about p of the time."""
    rows = [(i, " ".join(words(10, i)), "a" if i < 60 else "b") for i in range(80)]
    hits, runs = Counter(), 6
    for seed in range(runs):
        for r in mixing.mix(docs_of(rows), seed=seed).collect():
            hits[r.source] += r.copies
    target = plain_targets({"a": 600, "b": 200})
    assert all(abs(hits[s] - runs * target[s] / 10) <= runs for s in "ab")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 40), max_size=12))
def test_plan_places_every_token_once(histogram):
    places, windows = defaultdict(list), defaultdict(list)
    for rest, rank, times, start, length, seq, offset in packing.plan_windows(histogram, 32):
        for j in range(times):
            places[rest, rank + j].append((start, length))
            windows[seq + j].append((offset, length))
    assert set(places) == {(n, r) for n, c in histogram.items() for r in range(c)}
    for (rest, _), cuts in places.items():
        at = 0
        for start, length in sorted(cuts):
            assert start == at and length > 0
            at += length
        assert at == rest
    padding = 0
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 32
        padding += 32 - at
    total = sum(n * c for n, c in histogram.items())
    assert padding < 32 * 8 and len(windows) >= -(-total // 32)


def test_window_is_closest_to_capacity():
    for counts in ({7: 3, 5: 2, 3: 1}, {30: 1, 3: 1}, {9: 5}, {17: 2, 8: 1, 6: 3}):
        got = packing.fill_window(dict(counts), 32)
        longest = max(counts)
        best = {longest}
        for n, c in counts.items():
            for _ in range(c - (n == longest)):
                best |= {b + n for b in best if b + n <= 32}
        assert sum(n * k for n, k in got) == max(best)
        assert all(k <= counts[n] for n, k in got)


TEXTS = [None, "", " \n", "Hello World's 2024 test", "don't   stop\tme", "ÀÉ é ́x ΑΣ ΟΔΟΣ Σ", "a <|endoftext|> b", "x" * 300, "日本語 テキスト😀", "z y w", "\x00\x01 q", "nbsp\x85line"]


def test_word_cache_equals_plain_tokenizer(words):
    t = Tokenizer.from_file(packing.vocabulary_path())
    ours = packing.WordTokenizer(packing.vocabulary_path())
    for text in [x or "" for x in TEXTS] + [" ".join(words(500, s)) for s in range(3)]:
        assert ours.ids(text).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def packed(docs_of, words):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(words(3 + 37 * i % 400, i)), "s") for i in range(60)]
    rows += [(200, " ".join(words(9000, 5)), "s"), (201, "twice", "s"), (201, "twice", "s")]
    return rows, packing.pack(docs_of(rows)).collect()


def test_pack_round_trip(packed):
    rows, out = packed
    t = Tokenizer.from_file(packing.vocabulary_path())
    want = defaultdict(list)
    for i, text, _ in rows:
        want[i].append(np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, docs in want.items():
        ids = docs[0]
        cover = Counter()
        for p in pieces[i]:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
            cover.update(range(p.start, p.start + p.length))
        assert cover == Counter({k: len(docs) for k in range(len(ids))})
    windows = defaultdict(list)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for v in windows.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 4096 - at
    assert padding < 4096


def test_empty(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert mixing.mixed(docs_of([])).collect() == []
    assert packing.pack(docs_of([])).collect() == []
