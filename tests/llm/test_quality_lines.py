"""Quality rules, line dedup: brute force, edge cases."""

import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattflow.llm import line_dedup, near_dedup, quality
from wattflow.llm.frames import probably_in, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n_dup = len(lines) - len(set(lines))
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    cover = set()
    for i in range(len(words) - 2):
        if tri[tuple(words[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), n_dup, len(cover)


def fold(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else "0" if c in "0123456789" else c for c in line)
    return " ".join(WORD.findall(line))


EDGE = [None, "", " \n\t ", "a", "a b c a b c a b c", "x\ny\nx\n  x\nx", "é ü z # $\n| <b>\r\nq", "word " * 5000, "a\x0bb\x0cc", "日本 語\n日本 語\n"]


@pytest.fixture(scope="module")
def rows(words):
    out = [(i, t, None if i % 2 else "s") for i, t in enumerate(EDGE)]
    notice = "Read our Terms 2024 and accept them now please"
    for i in range(60):
        body = "\n".join(" ".join(words(20, 100 * i + k)) for k in range(4))
        out.append((100 + i, body + ("\n" + notice.replace("2024", str(2000 + i)) if i < 40 else ""), "big"))
    for i in range(45):  # documents that are little but frequent lines
        out.append((300 + i, "\n".join(" ".join(words(17, k)) for k in range(900, 904)) + "\n" + " ".join(words(3, 5000 + i)), "thin"))
    out += [(500, "copy " + " ".join(words(80, 9)), "big")] * 50  # repeated rows: one document
    return out


def test_base_counts(docs_of, rows):
    got = {(r.did, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(docs_of(rows)).collect()}
    assert got == {(i, *base(t)) for i, t, _ in rows}


def test_verdicts_match_plain_version(docs_of, rows):
    ratio, least, depleted = 0.2, 20, 70
    docs, held = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        docs[s].add(t)
        for line in {fold(x) for x in (t or "").split("\n")} - {""}:
            held[s, line].add(t)
    often = {k for k, v in held.items() if len(v) > least and len(v) > ratio * len(docs[k[0]])}
    want = set()
    for i, t, s in rows:
        n, _, _, _, rep = base(t)
        lost = sum(len(x.split(" ")) for x in map(fold, (t or "").split("\n")) if x and (s, x) in often)
        failed = n < 50 or 100 * rep > 50 * n
        want.add((i, lost, failed, not failed and 100 * lost <= depleted * n))
    out = quality.judge(docs_of(rows), ratio=ratio, least=least, depleted_percent=depleted, near_copies=False).collect()
    assert len(out) == len(rows)
    assert {(r.did, r.n_line_words, r.base_failed, r.kept) for r in out} == want
    assert {r.kept for r in out if 300 <= r.did < 345} == {False}
    assert {r.kept for r in out if 100 <= r.did < 160} == {True}


def test_keep_good_passes_columns(spark, docs_of, rows):
    docs = docs_of(rows).withColumnRenamed("lang", "did").withColumnRenamed("n_chars", "rid")
    out = quality.keep_good(docs, ratio=0.2, least=20, near_copies=False)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([*range(100, 160), *[500] * 50])


def test_line_dedup_matches_plain_version(docs_of, rows):
    docs, held = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        docs[s].add(t)
        for line in {fold(x) for x in (t or "").split("\n")} - {""}:
            held[s, line].add(t)
    often = {k for k, v in held.items() if len(v) > 4 and len(v) > 0.1 * len(docs[k[0]])}
    want = Counter()
    for i, t, s in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (s, fold(x)) not in often]
        want[i, t if len(kept) == len(lines) else "\n".join(kept), len(lines) - len(kept) if t else 0] += 1
    out = line_dedup.drop_boilerplate(docs_of(rows), ratio=0.1, least=4, near_copies=False)
    assert Counter((r.row.doc_id, r.text, r.n_removed) for r in out.collect()) == want
    assert any(k[2] for k in want)


def test_line_dedup_counts_and_clashing_columns(docs_of, rows):
    docs = docs_of(rows).withColumnRenamed("lang", "drop")
    out = line_dedup.without_boilerplate(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_empty_tables(docs_of):
    assert quality.judge(docs_of([])).collect() == []
    assert quality.keep_good(docs_of([])).collect() == []
    assert line_dedup.without_boilerplate(docs_of([])).collect() == []


def test_lines_of_the_host_go():
    texts = ["a\nb", "b\na 1\n", "a\nb", None, "x\n\nA\ny\nb", "", "b", "a 7\nb\na 8", "é\nb\n日本"]
    hosts = [1, 1, 2, 1, 3, 1, 1, 3, 3]
    gone = {1: ["b"], 3: ["a", "a 0", "b"]}
    value = {x: int(line_dedup.hashed_lines(pa.array([x]))[4].view(np.int64)[0]) for x in ("a", "b", "a 0")}
    lines = pa.array([[value[x] for x in gone[h]] if h in gone else None for h in hosts], pa.list_(pa.int64()))
    new, lost = line_dedup.without_lines(pa.record_batch([pa.array(texts), pa.array(hosts), lines], ["text", "host", "lines"]))
    kept = [None if t is None else [x for x in t.split("\n") if fold(x) not in gone.get(h, [])] for t, h in zip(texts, hosts, strict=True)]
    assert new.to_pylist() == [None if k is None else "\n".join(k) for k in kept]
    assert lost.tolist() == [0 if k is None else t.count("\n") + 1 - len(k) for t, k in zip(texts, kept, strict=True)]


def test_pages_are_rewritten_where_they_lie(docs_of, rows):
    plan = line_dedup.drop_boilerplate(docs_of(rows), ratio=0.1, least=4)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26])
def test_filter_lets_all_keys_pass_and_moves_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr("wattflow.llm.frames.FILTER_BITS", bits)
    rows = spark.range(-20000, 20000).select(F.xxhash64("id").alias("key"), "id")
    keys = stored(rows.where("id % 20 = 0").select("key"), "t-keys")
    got = probably_in(rows, "key", keys)
    assert got.columns == rows.columns and "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
    ids = {r.id for r in got.collect()}
    assert ids >= set(range(-20000, 20000, 20)) and len(ids) < 2000 + 38000 * (0.05 if bits > 1 << 20 else 0.1)
    assert probably_in(rows, "key", keys.where("key is null")).count() == 0


def test_texts_without_a_frequent_line_stay_where_they_are(docs_of, rows, monkeypatch):
    met = []
    monkeypatch.setattr(quality, "probably_in", lambda *a: met.append(probably_in(*a)) or met[-1])
    quality.judge(docs_of(rows), ratio=0.2, least=20)
    texts = {t for _, t, _ in rows}
    assert 85 <= met[0].select("text").distinct().count() < len(texts) - 20


def test_small_groups_take_little_memory():
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 2, 90)]
    tracemalloc.start()
    roots = near_dedup.linked_roots(sets, np.array([7, 8, 9]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert roots.tolist() == [7, 7, 9] and peak < 1 << 20
