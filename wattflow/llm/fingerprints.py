"""Document fingerprints by Order MinHash.

A text's characters give its k-mers, each numbered by its occurrence so far. For
each of SKETCHES hash functions the TUPLE smallest numbered k-mers are selected,
put back into text order, and the tuple of k-mers is hashed: one element of the
signature. Two texts agree in an element with a probability that grows as their
edit distance falls, also where the same k-mers stand in another order. Likeness
is the share of agreeing elements.

Defined cases: a null text is an empty one; a text shorter than a k-mer is one
k-mer, the empty text too, so empty texts are alike; equal texts have equal
fingerprints; columns other than the two named are not looked at; an empty table
gives an empty result. For :func:`compare_edited`, the next document of the last is
the first, a single document is its own next, rows that repeat an id follow each
other by text, and rows with a null id come after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import mix64

KMER, TUPLE, SKETCHES = 8, 2, 64
ROWS_BLOCK = 1 << 19  # numbered k-mers hashed at once
RANGES = 1 << 16  # id ranges at most; their first rows are the only table-wide state

_U = np.uint64
_FACTOR = _U(0x9FB21C651E98DF25)


def _multipliers() -> np.ndarray:
    return (mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407)) >> _U(32)).astype(np.uint32) | np.uint32(1)


def kmers(points: np.ndarray, k: int = KMER) -> np.ndarray:
    """64-bit hash of every k-mer of a text's code points, in text order; a shorter text is one k-mer."""
    k = min(k, len(points))
    n = len(points) - k + 1
    out = np.full(n, len(points) if k < KMER else 0, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for j in range(k):
        out = out * _FACTOR + wide[j : j + n] + _U(1)
    return mix64(out)


def numbered(value: np.ndarray) -> np.ndarray:
    """Hash of (k-mer, how often it occurred before) for each k-mer in text order."""
    bits = max(1, int(len(value) - 1).bit_length())
    low = _U((1 << bits) - 1)
    # hash in the high bits, place in the low ones: one plain sort groups equal k-mers in text order
    ranked = np.sort((value & ~low) | np.arange(len(value), dtype=np.uint64))
    place = (ranked & low).astype(np.int64)
    head = ranked >> _U(bits) if bits < 64 else ranked
    start = np.concatenate([[True], head[1:] != head[:-1]])
    at = np.arange(len(value))
    times = at - np.maximum.accumulate(np.where(start, at, 0))
    again = np.zeros(len(value), dtype=np.uint64)
    again[place] = times
    return mix64(value + again * _U(0x9E3779B97F4A7C15))


def order_minhash(points: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Signature of SKETCHES 32-bit elements."""
    value = kmers(points)
    base = (numbered(value) >> _U(32)).astype(np.uint32)
    n = len(base)
    best = np.empty((len(factors), TUPLE), dtype=np.int64)
    step = max(1, ROWS_BLOCK // n)
    for lo in range(0, len(factors), step):
        ranks = np.multiply.outer(factors[lo : lo + step], base)
        ranks ^= ranks >> np.uint32(15)
        rows = np.arange(len(ranks))
        for t in range(TUPLE):
            pick = ranks.argmin(axis=1)
            best[lo : lo + step, t] = pick
            ranks[rows, pick] = np.uint32(0xFFFFFFFF)
    best.sort(axis=1)  # text order
    out = np.zeros(len(factors), dtype=np.uint64)
    for t in range(TUPLE):
        out = mix64(out * _FACTOR + value[best[:, t]] + _U(t + 1))
    return (out >> _U(32)).astype(np.uint32)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def signature(text: str, factors: np.ndarray) -> np.ndarray:
    return order_minhash(points_of(text), factors) if text else np.zeros(len(factors), np.uint32)


def _hex(sign: np.ndarray) -> str:
    return sign.astype(">u4").tobytes().hex()


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = _multipliers()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        marks = [_hex(signature(t or "", factors)) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks)], ["doc_id", "fingerprint"])


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(_fingerprint, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` (rounded down) replaced by as many first characters of ``following``, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, id, text); each row meets the next of its bucket, a guest row closes the bucket."""
    factors = _multipliers()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    last = None
    for batch in batches:
        rows: list[tuple] = []
        cols = (batch.column(c).to_pylist() for c in ("bucket", "did", "guest", "text"))
        for bucket, did, guest, text in zip(*cols, strict=True):
            sign = signature(text, factors)
            if last is not None and last[0] == bucket:
                _, own_id, own, mine = last
                changed = edited(own, text)
                other = mine if changed == own else signature(changed, factors)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((own_id, len(own), digest, _hex(mine), _hex(other), float((mine == other).mean()), float((mine == sign).mean())))
            last = None if guest else (bucket, did, text, sign)
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    Rows are dealt into id ranges by bounds from a quantile sketch of the ids, so
    neighbours meet in one task without a global sort; the first row of each range
    is also sent, as a guest, to the range before it.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("did"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark = docs.sparkSession
    parts = min(RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = plain.select(F.coalesce(F.col("did").cast("double"), F.lit(float("inf"))).alias("x"))
    bounds = ids.where("x < double('infinity')").approxQuantile("x", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    keyed = plain.withColumn("x", F.coalesce(F.col("did").cast("double"), F.lit(float("inf")))).withColumn("b", F.lit(0.0))
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) > 2:
        keyed = Bucketizer(splits=splits, inputCol="x", outputCol="b", handleInvalid="keep").transform(keyed.drop("b"))
    bucket = F.when(F.col("did").isNull(), F.lit(len(splits))).otherwise(F.col("b").cast("int"))
    keyed = keyed.select("did", "text", bucket.alias("bucket"), F.xxhash64("text").alias("th"))
    # the first row of each range: at most one row for each of the RANGES + 1 ranges
    place = F.struct(F.col("did").isNull().alias("late"), "did", "th")
    firsts = [r["f"] | {"bucket": r["bucket"]} for r in _as_dicts(keyed.groupBy("bucket").agg(F.min(place).alias("f")).orderBy("bucket"))]
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    guests = [(f["bucket"], firsts[i - 1]["bucket"], f["did"], f["th"]) for i, f in enumerate(firsts)]
    known = spark.createDataFrame(guests, "bucket int, before int, did long, th long")
    # one row for each range: a bounded side
    lead = keyed.join(F.broadcast(known), ["bucket"]).where(known["did"].eqNullSafe(keyed["did"]) & (known["th"] == keyed["th"]))
    lead = lead.select(keyed["did"], "text", F.col("before").alias("bucket"), keyed["th"]).dropDuplicates(["bucket", "did", "th"])
    rows = keyed.withColumn("guest", F.lit(False)).unionByName(lead.withColumn("guest", F.lit(True)))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "guest", F.col("did").isNull(), "did", "th").select("bucket", "did", "guest", "text")
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(_walk, kind)


def _as_dicts(frame: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in frame.collect()]
