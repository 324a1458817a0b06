"""Quality rules by cross-document line frequency.

Normalised lines are hashed, distinct documents that hold a line are counted for
each host, lines above the host's limit are boilerplate, and a document that has
little left without them is rejected. Base rules on the document alone come first.

Defined cases: a null text counts as empty and fails the base rules (under 50
words); a null host is a host of its own; exact copies count as one document, and
near copies (unless ``near_copies`` is off) as one document that holds a line, so
copies never make their own lines frequent; repeated rows get equal verdicts;
columns other than the three named ones are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_dedup
from .frames import keyed_join, probably_in, stored, text_key
from .textops import Flat, list_column, mix64, slices, span_hash, span_of_words, windows

SYMBOLS = b"#*$%&|<>"  # fixed value of the base rules
MIN_WORDS, REPEAT_PERCENT = 50, 50  # fixed values of the base rules
# lines repeated on purpose lie at 1 to 13 % of a source's texts on the given tables; the floor is against chance
HOST_RATIO, MIN_DOCUMENTS, DEPLETED_PERCENT = 0.01, 4, 70

PROFILE = (
    "did long, rid long, host long, doc_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, line_hash array<long>, line_words array<long>"
)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of byte or word flags of each row."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _group_sizes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group start in order, group size) of equal keys."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(key) else np.zeros(0, np.int64)
    return order, start, np.diff(np.append(start, len(key)))


def profile_texts(col: pa.Array) -> dict[str, pa.Array]:
    """Base counts and distinct normalised lines (hash, words in them) of each text."""
    flat = Flat(col)
    rows, at = flat.rows, flat.row_at
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    lead = ((flat.raw & 0xC0) != 0x80) & flat.solid

    row_of = flat.row_of_word()
    hashes = flat.word_hash()
    start, win = windows(hashes, flat.words_of, 3)
    order, first, size = _group_sizes(mix64(win ^ mix64(row_of[start].astype(np.uint64))))
    often = np.zeros(len(start), dtype=bool)
    often[order] = np.repeat(size > 1, size)
    covered = np.zeros(len(hashes) + 3, dtype=bool)
    hit = start[often]
    for k in range(3):
        covered[hit + k] = True

    # lines with a word: raw bytes for repeats inside the text, normalised words for the corpus
    line_to = np.flatnonzero(flat.raw == 10)
    line_from = np.concatenate([[0], line_to[:-1] + 1]).astype(np.int64) if len(line_to) else line_to
    word_a = np.searchsorted(flat.word_from, line_from)
    word_b = np.searchsorted(flat.word_from, line_to)
    some = word_b > word_a
    line_from, line_to, word_a, word_b = line_from[some], line_to[some], word_a[some], word_b[some]
    line_row = row_of[word_a] if len(word_a) else np.zeros(0, np.int64)
    salt = mix64(line_row.astype(np.uint64) + np.uint64(1))
    raw_key = mix64(span_hash(flat.byte_prefix(), line_from, line_to) ^ salt)
    order, first, size = _group_sizes(raw_key)
    n_lines = np.bincount(line_row, minlength=rows)
    n_kinds = np.bincount(line_row[order[first]], minlength=rows) if len(order) else np.zeros(rows, np.int64)

    normal = Flat(col, fold="normal").word_hash()
    line_hash = span_of_words(normal, word_a, word_b)
    order, first, size = _group_sizes(mix64(line_hash ^ salt))
    lead_line = order[first] if len(order) else order
    words = np.add.reduceat((word_b - word_a)[order], first) if len(order) else np.zeros(0, np.int64)
    by_row = np.argsort(line_row[lead_line], kind="stable")
    kinds = np.bincount(line_row[lead_line], minlength=rows) if len(lead_line) else np.zeros(rows, np.int64)
    return {
        "n_words": pa.array(flat.n_words.astype(np.int64)),
        "word_chars": pa.array(_per_row(lead, at)),
        "n_symbols": pa.array(_per_row(symbol[flat.raw], at)),
        "n_dup_lines": pa.array((n_lines - n_kinds).astype(np.int64)),
        "n_repeat_words": pa.array(_per_row(covered[: len(hashes)], flat.words_of)),
        "line_hash": list_column(line_hash[lead_line][by_row].view(np.int64), kinds, pa.int64()),
        "line_words": list_column(words[by_row].astype(np.int64), kinds, pa.int64()),
    }


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PROFILE.split(", ")]
    for batch in batches:
        for part in slices(batch, "text"):
            got = profile_texts(part.column("text"))
            got |= {k: part.column(k) for k in ("did", "rid", "host", "doc_hash")}
            yield pa.RecordBatch.from_arrays([got[k] for k in names], names)


def line_profile(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: base counts and its distinct normalised lines; written once."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host"))
    keyed = plain.select(
        F.col("doc_id").alias("did"), text_key("host", "text").alias("rid"), text_key("host").alias("host"), text_key("text").alias("doc_hash"), "text"
    )
    return stored(keyed.mapInArrow(_profile, PROFILE), "line-profile")


def frequent_lines(profile: DataFrame, docs: DataFrame | None, ratio: float, least: int, text: str = "text") -> DataFrame:
    """(host, line, n_docs): lines that more than ``max(least, ratio * distinct texts of the host)`` documents hold; stored.

    With ``docs`` a family of near copies counts as one document. A line of too few
    distinct texts cannot have more families, so only texts that hold a line above
    the limits are compared, each distinct one once.
    """
    lines = profile.select("host", "doc_hash", F.explode("line_hash").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("doc_hash").alias("n_docs")).where(F.col("n_docs") > least)
    totals = stored(profile.groupBy("host").agg(F.countDistinct("doc_hash").alias("n_host")), "host-totals")
    often = keyed_join(stored(counts, "line-counts"), totals, ["host"]).where(F.col("n_docs") > ratio * F.col("n_host"))
    often = stored(often.select("host", "line", "n_docs", "n_host"), "often-lines")
    if docs is None:
        return often.drop("n_host")
    held = stored(keyed_join(lines, often.select("host", "line", "n_host"), ["host", "line"]), "often-holders")
    few = stored(held.select("doc_hash").distinct(), "holders")
    # texts stand for themselves, so rows without an id have a family too; most hold no such line and need not move
    texts = docs.select(F.col(text).alias("text")).select(text_key("text").alias("doc_hash"), "text")
    # an inner join: Spark would take a semi join before the filter and the distinct, where it moves every text
    texts = probably_in(texts, "doc_hash", few).dropDuplicates(["doc_hash"]).join(few, "doc_hash").select("doc_hash", "text")
    texts = stored(texts, "holder-texts", compression="zstd")
    found = near_dedup.classes(texts, "doc_hash", "text").where("did <> component_id")
    family = stored(found.select(F.col("did").alias("doc_hash"), F.col("component_id").alias("family")).distinct(), "text-families")
    counted = keyed_join(held, family, ["doc_hash"], "left").withColumn("one", F.coalesce("family", "doc_hash"))
    counted = counted.groupBy("host", "line").agg(F.countDistinct("one").alias("n_docs"), F.first("n_host").alias("n_host"))
    return stored(counted.where((F.col("n_docs") > least) & (F.col("n_docs") > ratio * F.col("n_host"))).select("host", "line", "n_docs"), "frequent-lines")


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    ratio: float = HOST_RATIO,
    least: int = MIN_DOCUMENTS,
    depleted_percent: int = DEPLETED_PERCENT,
    near_copies: bool = True,
) -> DataFrame:
    """Verdict of every row: base counts, words in frequent lines, ``base_failed``, ``kept``; ``did``/``rid`` name the row.

    With ``near_copies`` a family of near copies counts as one document that holds a line.
    """
    profile = line_profile(docs, doc_id, text, host)
    often = frequent_lines(profile, docs if near_copies else None, ratio, least, text)
    lines = profile.select("did", "rid", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("l"))
    lines = lines.select("did", "rid", "host", F.col("l.line_hash").alias("line"), F.col("l.line_words").alias("words"))
    # repeated rows share (did, rid): their lines are equal, so the larger of equal values is taken per line
    hit = keyed_join(lines, often.select("host", "line"), ["host", "line"])
    lost = hit.groupBy("did", "rid", "line").agg(F.max("words").alias("words")).groupBy("did", "rid").agg(F.sum("words").alias("n_line_words"))
    base = profile.drop("line_hash", "line_words", "host", "doc_hash")
    lost = lost.select(F.col("did").alias("_d"), F.col("rid").alias("_r"), "n_line_words")
    out = base.join(lost, F.col("did").eqNullSafe(F.col("_d")) & (F.col("rid") == F.col("_r")), "left").drop("_d", "_r")
    out = out.withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * F.col("n_line_words") > depleted_percent * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted)


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """``docs`` without the rows that :func:`judge` rejects; all columns stay."""
    bad = judge(docs, doc_id, text, host, **limits).where(~F.col("kept")).select("did", "rid").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("did", F.col(f"row.{doc_id}")).withColumn("h", F.col(f"row.{host}")).withColumn("t", F.col(f"row.{text}"))
    rows = rows.select("row", F.col("did"), text_key("h", "t").alias("rid"))
    gone = bad.select(F.col("did").alias("_d"), F.col("rid").alias("_r"))
    return rows.join(gone, F.col("did").eqNullSafe(F.col("_d")) & (F.col("rid") == F.col("_r")), "left_anti").select("row.*")
