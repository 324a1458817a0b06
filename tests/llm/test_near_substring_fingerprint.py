"""Near-duplicates, substring dedup, fingerprints against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wattflow.llm import fingerprints, near_dedup, substring_dedup

WORD = re.compile(rb"[ \t\n\x0b\x0c\r]+")


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def plain_components(rows):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = [(i, s) for i, v in sets.items() for s in v if s]
    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            n = len(a & b)
            if 100 * n >= 75 * (len(a) + len(b) - n):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def star(words, n, size=200, edits=11, seed=1):
    """A base text and copies with scattered edits: near the base, far from each other."""
    base = words(size, seed)
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for e in range(edits):
            own[(k * 13 + e * (size // edits)) % size] = f"edit{k}x{e}"
        out.append(" ".join(own))
    return out


EDGE = [(1, None), (2, ""), (3, "  \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (None, "one two"), (None, None), (7, "É é x"), (8, "é é x")]


@pytest.fixture(scope="module")
def near_rows(words):
    rows = list(EDGE)
    rows += [(1000 + i, t) for i, t in enumerate(star(words, 40))]
    rows += [(5000 - i, t) for i, t in enumerate(star(words, 30, edits=5, seed=2))]
    rows += [(2000 + i, " ".join(words(150, 77))) for i in range(30)]  # exact copies
    rows += [(3000 + i, " ".join(words(120, 500 + i) + words(60, 9))) for i in range(40)]  # a shared passage, no link
    long = words(6000, 31)
    rows += [(6000, " ".join(long)), (6001, " ".join(long[:5900])), (6001, " ".join(long[:5900]))]
    rows += [(6002, " ".join(words(90, 3))), (6002, " ".join(words(90, 4))), (6003, " ".join(words(90, 3))), (6004, " ".join(words(90, 4)))]  # an id with two texts
    return rows


def test_near_classes(docs_of, near_rows):
    out = near_dedup.classes(docs_of([(i, t, "s") for i, t in near_rows])).collect()
    assert len(out) == len(near_rows)
    want = plain_components(near_rows)
    assert {(r.did, r.component_id) for r in out if r.did is not None} == set(want.items())
    assert Counter((r.did, r.n_shingles) for r in out) == Counter((i, len(shingles(t))) for i, t in near_rows)
    assert all(r.component_id is None for r in out if r.did is None)


def test_large_family_goes_by_blocks(docs_of, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = [(10_000 - 7 * i, t) for i, t in enumerate(star(words, 60, edits=9, seed=5))]
    rows += [(20_000 + i, t) for i, t in enumerate(star(words, 50, edits=16, seed=5))]  # too far from the base
    out = near_dedup.classes(docs_of([(i, t, "s") for i, t in rows])).collect()
    assert {r.did: r.component_id for r in out} == plain_components(rows)


def test_keep_first(docs_of, near_rows):
    docs = docs_of([(i, t, "s") for i, t in near_rows]).withColumnRenamed("lang", "did").withColumnRenamed("n_chars", "_d")
    out = near_dedup.keep_first(docs)
    assert out.columns == docs.columns
    want = plain_components(near_rows)
    assert Counter(r.doc_id for r in out.collect()) == Counter([i for i, c in want.items() if i == c] + [None, None])


def plain_repeats(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        w = (rows[k][1] or "").encode().split()
        gone = set()
        for a in range(len(w) - 19):
            key = tuple(w[a : a + 20])
            if key in seen:
                gone |= set(range(a, a + 20))
            seen.add(key)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((rows[k][0], len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return Counter(out)


@pytest.mark.parametrize("chunk,budget", [(1 << 20, 2_000_000), (2_000, 50)])
def test_substring_dedup(docs_of, words, monkeypatch, chunk, budget):
    monkeypatch.setattr(substring_dedup, "CHUNK_TEXT", chunk)
    monkeypatch.setattr(substring_dedup, "GROUP_LABELS", budget)
    passage = words(55, 8)
    rows = [(None, " ".join(passage)), (3, None), (4, ""), (5, "short text"), (6, " ".join(words(19, 1))), (7, " ".join(words(20, 1))), (8, " ".join(words(20, 1)))]
    rows += [(100 - i, " ".join(words(30 + i, 40 + i) + passage + words(9, 60 + i))) for i in range(25)]
    rows += [(200, "la " * 90), (201, "x " * 19 + "y"), (202, "Case " * 25), (203, "case " * 25), (204, "é ü " * 30), (205, "la\n" * 40)]
    rows += [(300 + i, "\n".join([" ".join(words(12, i % 3)), " ".join(words(14, 1 + i % 2))])) for i in range(12)]
    out = substring_dedup.remove_repeats(docs_of([(i, t, "s") for i, t in rows])).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in out) == plain_repeats(rows)


def test_substring_dedup_repeated_ids(docs_of, words):
    text = " ".join(words(30, 2))
    out = substring_dedup.remove_repeats(docs_of([(1, text, "s"), (1, text, "s"), (2, text, "s")])).collect()
    assert sorted(r.n_removed for r in out) == [0, 30, 30]


def test_fingerprints_compare(docs_of, words):
    rows = [(5, None), (7, ""), (9, "abc"), (20, " ".join(words(300, 1))), (21, " ".join(words(300, 1))), (30, "日本語😀" * 40), (31, "é" * 50), (40, "z" * 2000), (2, " ".join(words(5000, 4)))]
    got = {r.doc_id: r for r in fingerprints.compare_edited(docs_of([(i, t, "s") for i, t in rows])).collect()}
    order = sorted((i, t or "") for i, t in rows)
    marks = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs_of([(i, t, "s") for i, t in rows])).collect()}
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and r.fingerprint == marks[i]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[20].near_next == 1 and got[20].fingerprint == got[21].fingerprint and got[5].near_edited == 1
    assert got[2].near_edited > 0.2 > got[2].near_next


def test_single_document_is_its_own_next(docs_of):
    (r,) = fingerprints.compare_edited(docs_of([(1, "abcdefgh", "s")])).collect()
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_repeated_and_null_ids(docs_of):
    rows = [(1, "same text here"), (1, "same text here"), (None, "late"), (None, None)]
    out = fingerprints.compare_edited(docs_of([(i, t, "s") for i, t in rows])).collect()
    assert len(out) == 4


def plain_order_minhash(text):
    """Straight from the definition, sharing only the hash functions."""
    value = fingerprints.kmers(fingerprints.points_of(text)).tolist()
    seen, keys = Counter(), []
    for v in value:
        keys.append((v, seen[v]))
        seen[v] += 1
    mix = fingerprints.mix64
    base = [int(mix(np.array([v], np.uint64) + np.uint64(c) * np.uint64(0x9E3779B97F4A7C15))[0] >> np.uint64(32)) for v, c in keys]
    out = []
    for f in fingerprints._multipliers().tolist():
        rank = []
        for b in base:
            x = b * f % (1 << 32)
            rank.append(x ^ (x >> 15))
        best = sorted(sorted(range(len(rank)), key=lambda i: (rank[i], i))[: fingerprints.TUPLE])
        while len(best) < fingerprints.TUPLE:
            best.append(best[0])
        h = np.zeros(1, np.uint64)
        for t, i in enumerate(best):
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + np.array([value[i]], np.uint64) + np.uint64(t + 1))
        out.append(int(h[0] >> np.uint64(32)))
    return out


@pytest.mark.parametrize("text", ["ab", "abcdefgh", "abcabcabcabcabcabc", "the quick brown fox jumps over the lazy dog " * 4])
def test_order_minhash_definition(text):
    assert fingerprints.signature(text, fingerprints._multipliers()).tolist() == plain_order_minhash(text)


def test_order_matters(words):
    """Swapped halves keep the k-mers but not the tuples."""
    f = fingerprints._multipliers()
    w = words(400, 6)
    a, b = fingerprints.signature(" ".join(w), f), fingerprints.signature(" ".join(w[200:] + w[:200]), f)
    c = fingerprints.signature(" ".join(w[:190] + w[210:]), f)
    assert (a == c).mean() > (a == b).mean() + 0.15


def test_empty(docs_of):
    e = docs_of([])
    assert near_dedup.classes(e).collect() == [] and near_dedup.keep_first(e).collect() == []
    assert substring_dedup.remove_repeats(e).collect() == []
    assert fingerprints.compare_edited(e).collect() == [] and fingerprints.fingerprint(e).collect() == []


def test_pairs_across_range_ends_are_compared(spark, docs_of, words):
    """Near copies in as many ranges as there are rows or so: none of their links is lost."""
    base = words(60, 3)
    rows = []
    for i in range(90):
        own = list(base) if i % 3 == 0 else words(60, 100 + i)
        own[i % 60] = f"w{i}"
        rows.append((i, " ".join(own), "s"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = {r.did: r.component_id for r in near_dedup.classes(docs_of(rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t, _ in rows}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    assert got == root and len(set(root.values())) < 70


def test_short_lists_round_trip():
    for values in ([5], [0, 1, 1, 4], [7, 300, 70_000, 5_000_000_000], [3, substring_dedup.LAST_ID], [-4, 0, 9]):
        raw = substring_dedup._short(np.array(values, np.int64))
        assert substring_dedup._long(raw).tolist() == values
    assert len(substring_dedup._short(np.arange(10**9, 10**9 + 400))) == 9 + 399


@pytest.mark.parametrize("budget", [3000, 40_000, 10**9])
def test_id_bytes_stay_small_beside_labels(budget):
    """From few to many groups: the ids of a chunk's messages stay under a tenth of its labels, and so do the ends."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).slice(0, 3000)
    span, prefixes = substring_dedup.SPAN, substring_dedup.PREFIXES
    count = next(substring_dedup._count(span, prefixes)(iter([docs.combine_chunks().to_batches()[0]])))
    counts = np.zeros((len(prefixes), substring_dedup.CELLS), np.int64)
    counts[count.column("level").to_numpy(), count.column("cell").to_numpy()] = count.column("n").to_numpy()
    routes = substring_dedup.Routes(counts, budget)
    text = max(substring_dedup.CHUNK_TEXT, substring_dedup.MESSAGE_TEXT * routes.groups)
    rows = max(1, text * 3000 // sum(len(t or "") for t in docs.column("text").to_pylist()))
    table = pa.table({"did": docs.column("doc_id"), "text": docs.column("text").cast(pa.string()), "file": ["f"] * 3000, "row": list(range(3000)), "chunk": [i // rows for i in range(3000)]})
    sent = list(substring_dedup._send(span, prefixes, routes)(iter(table.to_batches())))
    size = {c: sum(sum(map(len, b.column(c).to_pylist())) for b in sent) for c in ("labels", "ends", "ids")}
    assert max(size["ids"], size["ends"]) < 0.1 * size["labels"], (routes.groups, size)
