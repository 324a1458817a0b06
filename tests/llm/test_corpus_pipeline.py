"""The pipeline's stages one after the other."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from wattflow.llm import quality  # noqa: E402
from wattflow.llm.frames import stored  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else "0" if c in "0123456789" else c for c in line)
    return " ".join(WORD.findall(line))


def through(spark, docs, upto):
    """``docs`` after each of the first ``upto`` stages."""
    out = []
    for _, stage in corpus_pipeline.STAGES[:upto]:
        docs = stored(stage(spark, docs, ""), "t-stage")
        out.append(docs)
    return out


@pytest.mark.parametrize("size", [6, 30])
def test_near_copies_do_not_reject_each_other(spark, docs_of, words, size):
    """A third of a source are near copies of one text: it stays, whole, and its copies go as near duplicates."""
    base = [" ".join(words(20, 40 + k)) for k in range(8)]
    rows = [(i, "\n".join([*base, f"edit{i} " + " ".join(words(3, 900 + i))]), "s") for i in range(size)]
    rows += [(1000 + i, "\n".join(" ".join(words(20, 10_000 + 10 * i + k)) for k in range(5)), "s") for i in range(2 * size)]
    rows += [(None, rows[0][1] + " more", "s")]  # without an id it is of the family too
    good, lines, kept = through(spark, docs_of(rows), 3)
    text = {i: t for i, t, _ in rows}
    assert good.count() == len(rows)
    assert {r.doc_id: r.text for r in lines.collect()} == text
    assert {r.doc_id for r in kept.collect()} == {None, 0, *range(1000, 1000 + 2 * size)}


def test_line_rule_rejects_what_is_little_but_repeated_lines(spark, docs_of, words):
    """Lines that 1.8 % of a source hold are frequent, and a document that is little else goes."""
    notes = [" ".join(words(20, 50 + k)) for k in range(31)]
    rows = [(i, "\n".join(" ".join(words(20, 10_000 + 10 * i + k)) for k in range(4)), "s") for i in range(300)]
    # each note in 6 documents, two documents share one note: none are near copies
    rows += [(500 + i, "\n".join(notes[(i + k) % 31] for k in (1, 5, 11, 24, 25, 27)) + "\nown " + " ".join(words(6, 700 + i)), "s") for i in range(31)]
    (good,) = through(spark, docs_of(rows), 1)
    assert {r.doc_id for r in good.collect()} == set(range(300))


def test_line_rule_acts_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = quality.judge(docs)
    assert out.where("n_line_words > 0").count() > 2000
    assert out.where("100 * n_line_words > 70 * n_words").count() > 20


def test_lines_of_every_source_go_from_every_source(spark):
    """Lines above 1 % of the distinct texts in each source of a whole table: none is left in any source."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source", "n_chars")

    def held(rows):
        texts, lines = defaultdict(set), defaultdict(set)
        for r in rows:
            texts[r.source].add(r.text)
            for line in {fold(x) for x in (r.text or "").split("\n")} - {""}:
                lines[line, r.source].add(r.text)
        return texts, lines

    texts, before = held(docs.collect())
    common = {line for line, _ in before if all(len(before.get((line, s), ())) > 0.0101 * len(t) for s, t in texts.items())}
    assert len(common) >= 7
    _, after = held(corpus_pipeline.drop_boilerplate_lines(spark, docs, "").collect())
    assert {k for k in after if k[0] in common} == set()


def plain_words(text):
    return WORD.findall(text or "")


def test_five_stages_against_plain_versions(spark, docs_of, words):
    """Nulls, empty texts, repeated rows, exact and near copies and a notice through the whole chain."""
    notice = "read our terms and accept all of them now"
    body = [[" ".join(words(20, 1000 * i + k)) for k in range(4)] for i in range(40)]
    text = {i: "\n".join(b + ([notice] if i % 3 == 0 else [])) for i, b in enumerate(body)}
    rows = [(i, t, "ab"[i % 2]) for i, t in text.items()]
    rows += [(100, text[4], "a"), (101, text[4].replace(words(20, 4000)[3], "changed"), "a")]  # an exact and a near copy of 4
    rows += [(200, None, "a"), (201, "", "b"), (202, "too short", None), (203, "again and again " * 60, "a")]
    rows += [(300, " ".join(words(90, 77)), None)] * 2  # one row twice
    stages = through(spark, docs_of(rows), 5)
    good, lines, kept, mixed, packed = stages
    assert all(s.columns == good.columns for s in (lines, kept, mixed))
    want = {i: t for i, t, _ in rows if len(plain_words(t)) >= 50 and i != 203}
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, t, _ in rows if i in want)
    want = {i: t.replace("\n" + notice, "") for i, t in want.items()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    want = {i: t for i, t in want.items() if i not in (100, 101)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)  # the repeated row is one document
    source = {i: s for i, _, s in rows}
    size, taken = defaultdict(int), defaultdict(int)
    for i, t in want.items():
        size[source[i]] += len(plain_words(t))
    copies = defaultdict(int)
    for r in mixed.collect():
        assert r.text == want[r.doc_id] and r.source == source[r.doc_id]
        copies[r.doc_id] += 1
        taken[r.source] += len(plain_words(r.text))
    assert max(copies.values()) <= 2
    longest = max(len(plain_words(t)) for t in want.values())
    # weights 3, 1, 2 of 1.5 times all words; no source beyond twice its own
    left, weight, target = 1.5 * sum(size.values()), {"a": 3, "b": 1, None: 2}, {}
    while weight:
        full = [s for s in weight if left * weight[s] / sum(weight.values()) > 2 * size[s]]
        if not full:
            target |= {s: left * w / sum(weight.values()) for s, w in weight.items()}
            break
        for s in full:
            target[s] = 2 * size[s]
        left -= sum(target[s] for s in full)
        weight = {s: w for s, w in weight.items() if s not in full}
    assert all(abs(taken[s] - target[s]) <= longest for s in target)
    tokens = defaultdict(list)
    for r in packed.collect():
        tokens[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert tokens.keys() == copies.keys()
    for i, parts in tokens.items():
        assert sum(n for _, n, _ in parts) == copies[i] * parts[0][2]


def test_empty_table_through_all_stages(spark, docs_of):
    assert [s.count() for s in through(spark, docs_of([]), 5)] == [0] * 5
