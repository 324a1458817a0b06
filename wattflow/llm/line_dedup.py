"""Line dedup by site-relative frequency.

Pages are grouped by host; a line whose share of the host's pages exceeds the
boilerplate ratio is dropped from every page of that host. The share counts
distinct page texts, and a family of near copies (unless ``near_copies`` is off) as
one page that holds a line, so a host full of copies of one page, exact or near, does
not turn that page into boilerplate.

Defined cases: a null text stays null; a null host is a host of its own; lines
without a word are never boilerplate; a text with no dropped line is returned
unchanged, any other is its kept lines joined by newlines (empty if none is
left); repeated rows are treated alike; other columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import keyed_join, stored, text_key
from .quality import _group_sizes, frequent_lines
from .textops import Flat, list_column, mix64, slices, span_of_words

BOILERPLATE_RATIO, MIN_PAGES = 0.01, 4  # see quality.HOST_RATIO

LINES = "host long, doc_hash long, line_hash array<long>"


def hashed_lines(col: pa.Array) -> tuple[Flat, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(flat text, line from, line to, row of line, hash) of the lines with a word; case, digits and white space are folded."""
    flat = Flat(col, fold="normal")
    line_to = np.flatnonzero(flat.raw == 10)
    line_from = np.concatenate([[0], line_to[:-1] + 1]).astype(np.int64) if len(line_to) else line_to
    a, b = np.searchsorted(flat.word_from, line_from), np.searchsorted(flat.word_from, line_to)
    row = np.searchsorted(flat.row_at, line_from, side="right") - 1
    value = np.zeros(len(a), np.uint64)
    some = b > a
    value[some] = span_of_words(flat.word_hash(), a[some], b[some])
    return flat, line_from, line_to, row, np.where(some, value, 0).astype(np.uint64)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in LINES.split(", ")]
    for batch in batches:
        for part in slices(batch, "text"):
            flat, _, _, row, value = hashed_lines(part.column("text"))
            row, value = row[value != 0], value[value != 0]
            order, first, _ = _group_sizes(mix64(value ^ mix64(row.astype(np.uint64) + np.uint64(1))))
            lead = np.sort(order[first]) if len(order) else order
            counts = np.bincount(row[lead], minlength=flat.rows) if len(lead) else np.zeros(flat.rows, np.int64)
            got = {k: part.column(k) for k in ("host", "doc_hash")}
            got["line_hash"] = list_column(value[lead].view(np.int64), counts, pa.int64())
            yield pa.RecordBatch.from_arrays([got[k] for k in names], names)


def without_lines(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """(texts without the lines whose hash is in the row's ``lines``, lines dropped); rows of a ``host`` have equal ``lines``."""
    texts = part.column("text")
    flat, line_from, line_to, row, value = hashed_lines(texts)
    host = part.column("host").to_numpy().view(np.uint64)
    hosts, first = np.unique(host, return_index=True)
    lists = part.column("lines").take(pa.array(first))
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    listed = mix64(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ mix64(np.repeat(hosts, size)))
    gone = np.isin(mix64(value ^ mix64(host[row])), listed) & (value != 0)
    lost = np.bincount(row[gone], minlength=flat.rows)
    if not gone.any():
        return texts, lost
    keep = np.repeat(~gone, line_to + 1 - line_from)
    kept = np.flatnonzero(~gone)
    last = kept[np.flatnonzero(np.append(row[kept][1:] != row[kept][:-1], True))] if len(kept) else kept
    keep[line_to[last]] = False  # no newline after a row's last line
    ends = np.concatenate([[0], np.cumsum(keep)])[flat.row_at].astype(np.int64)
    new = pa.LargeStringArray.from_buffers(flat.rows, pa.py_buffer(ends), pa.py_buffer(flat.raw[keep])).cast(pa.string())
    return pc.if_else(texts.is_valid(), new, pa.scalar(None, pa.string())), lost


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            new, lost = without_lines(part)
            yield pa.RecordBatch.from_arrays([part.column("row"), new.cast(pa.string()), pa.array(lost.astype(np.int64))], ["row", "text", "n_removed"])


def boilerplate(docs: DataFrame, text: str, host: str, ratio: float, least: int, near_copies: bool = True) -> DataFrame:
    """(host, line) above the ratio."""
    plain = docs.select(F.col(text).alias("text"), F.col(host).alias("host"))
    keyed = plain.select(text_key("host").alias("host"), text_key("text").alias("doc_hash"), "text")
    lines = stored(keyed.mapInArrow(_lines, LINES), "page-lines")
    return frequent_lines(lines, docs if near_copies else None, ratio, least, text)


def drop_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", ratio: float = BOILERPLATE_RATIO, least: int = MIN_PAGES,
    near_copies: bool = True,
) -> DataFrame:
    """Columns ``row`` (the input row without its text), ``text`` (rewritten), ``n_removed`` (lines dropped).

    A page meets the lines of its host, at most ``1 / ratio`` times those of a mean page,
    and is rewritten where it lies; pages move only if the hosts' lines are too many to be broadcast.
    """
    often = boilerplate(docs, text, host, ratio, least, near_copies)
    hosts = stored(often.groupBy("host").agg(F.collect_list("line").alias("lines")), "host-lines")
    bare = T.StructType([f for f in docs.schema if f.name != text])
    pages = docs.select(F.struct(*[F.col(f"`{c}`") for c in bare.names]).alias("row"), F.col(text).alias("text"), text_key(host).alias("host"))
    kind = T.StructType([T.StructField("row", bare), T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])
    return keyed_join(pages, hosts, ["host"], "left").select("row", "text", "host", "lines").mapInArrow(_rewrite, kind)


def without_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", length: str = "n_chars", **limits
) -> DataFrame:
    """``docs`` with boilerplate lines dropped from ``text``; same columns in the same order, ``length`` counted anew."""
    out = drop_boilerplate(docs, doc_id, text, host, **limits)
    new = {text: F.col("text")}
    if length in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema[length].dataType)).otherwise(F.col(f"row.`{length}`"))
        new[length] = changed
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
