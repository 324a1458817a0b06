"""WARC archives: written by Spark, read back by boundary-chain verification.

Writing: one record per page, payload the page in UTF-8. Of records with equal
payloads of at least REVISIT_BYTES bytes the one with the largest id is the
response, the others are revisit records without payload. Spark's text writer
puts the WARC record separator (CRLF CRLF) after each row, in plain (splittable)
files of the shared folder.

Reading: Spark's text reader cuts the files at every occurrence of the version
line, also inside payloads, at any split. Each cut is a *candidate* record; its
header's Content-Length gives the offset of its successor. Only candidates that
the chain of successors reaches from the file start are records: the chain is
first followed inside each block of candidates, then block entries are followed
by pointer jumping (doubling), so the number of rounds is the logarithm of the
blocks of the longest file. Bytes of the candidates between two records are put
back into the payload of the first.

Defined cases: a null page is an empty payload; null ids are written as such and
lose against any other id of equal payload; rows that repeat the largest id of
equal payloads are all responses; payloads may hold version lines, CRLFs, whole
records or nothing; columns other than the three named are not looked at; an
empty table gives an empty archive and result. A payload is one string column
value (Spark's limit of 2 GB for a value holds).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattflow.runtime import scratch_dir

from .frames import keyed_join, stored

REVISIT_BYTES = 1000  # fixed value
MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"  # fixed values of the format
DATE = "2026-01-01T00:00:00Z"  # archives are reproducible: no clock
URN = "urn:wattflow:page:"
BLOCK_BYTES = 16 << 20  # bytes of archive whose candidates one group follows


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Every page with its digest, byte count and, for a revisit, the id it refers to.

    Only digests and ids are grouped and joined by digest; the payload is joined
    once, by page.
    """
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    sized = plain.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("n", F.octet_length("payload").cast("long"))
    slim = stored(sized.select("page_id", "digest", "n"), "digests")
    large = slim.where(F.col("n") >= least)
    last = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and last is not null")
    again = keyed_join(large, stored(last, "last-copies"), ["digest"]).where("not (page_id <=> last)")
    # stored, so its size is known when the payload join is planned: broadcast if small, else a shuffle join by page
    again = stored(again.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "last").distinct(), "revisits")
    return sized.join(again, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("digest") == F.col("_d")), "left").drop("_p", "_d")


def record_text() -> Column:
    """The record of a row of :func:`plan_records`, up to the separator."""
    revisit = F.col("last").isNotNull()
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    head = [
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <" + URN), number(F.col("page_id")), F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "), uri,
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <" + URN), number(F.col("last")), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nX-Payload-Length: "), F.col("n").cast("string"),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string")), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    ]
    return F.concat(*head)


def write_archives(pages: DataFrame, path: str | None = None, **columns) -> str:
    """Write the records of ``pages`` as plain WARC files in a folder; returns it."""
    path = path or scratch_dir(pages.sparkSession, "warc")
    plan_records(pages, **columns).select(record_text().alias("value")).write.option("lineSep", END).text(path)
    return path


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every cut at a version line, stored: ``file, split, id, n`` (bytes of ``value``), ``head, length, size, own, value``.

    ``size`` is the byte length of the whole record that the header declares,
    separators included; null if the cut is followed by no sound header. ``own`` is
    the SHA-1 of the payload if the whole record lies in this cut.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"),
        F.octet_length("value").cast("long").alias("n"), F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1)).alias("head"), "value",
    )
    length = F.when(_field("Content-Length").rlike(r"^[0-9]{1,15}$"), _field("Content-Length")).try_cast("long")
    raw = raw.withColumn("length", length)
    size = len(MAGIC) + F.octet_length("head") + len(END) + F.col("length") + len(END)
    raw = raw.withColumn("size", size)
    raw = raw.withColumn("own", F.when(F.col("size") <= F.col("n") + len(MAGIC), F.sha1(_payload("cast(value as binary)"))))
    return stored(raw, "candidates", compression="zstd")


def _payload(body: str) -> Column:
    """The declared number of bytes after the header of the binary SQL expression ``body``."""
    return F.expr(f"substring({body}, octet_length(head) + {len(END) + 1}, int(length))")


def _field(name: str) -> Column:
    return F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r]*)", 1)


def placed(chunks: DataFrame) -> DataFrame:
    """``file, split, id, at`` (offset of the cut), ``next`` (offset of its successor) and ``block``, without the text files' first chunk."""
    magic = len(MAGIC)
    before = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    slim = chunks.select("file", "split", "id", "n", "size", (F.col("n") + magic).alias("step"))
    slim = slim.withColumn("inside", F.coalesce(F.sum("step").over(before), F.lit(0)))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = chunks.groupBy("file", "split").agg(F.sum(F.col("n") + magic).alias("total"))
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))).drop("total")
    at = F.col("base") + F.col("inside") - magic
    out = slim.join(splits, ["file", "split"]).withColumn("at", at).where("at >= 0")
    out = out.withColumn("next", F.col("at") + F.col("size")).withColumn("block", F.floor(F.col("at") / BLOCK_BYTES))
    return stored(out.select("file", "split", "id", "at", "next", "block"), "placed")


def _leave(group: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate leaves its block (null: it breaks off)."""
    group = group.sort_values("at")
    at, succ = group["at"].to_numpy(), group["next"].to_numpy(dtype="float64", na_value=-1).astype("int64")
    end = (int(group["block"].iloc[0]) + 1) * BLOCK_BYTES
    leaves: dict[int, int | None] = {}
    for a, b in zip(at[::-1].tolist(), succ[::-1].tolist(), strict=True):
        leaves[a] = None if b < 0 else b if b >= end else leaves.get(b)
    out = group[["file", "at"]].copy()
    out["jump"] = pd.array([leaves[a] for a in at.tolist()], dtype="Int64")
    return out


def _mark(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates of a block that the chain from its entry reaches."""
    entry = group["entry"].iloc[0]
    if pd.isna(entry):
        return group.iloc[:0][["file", "split", "id", "at"]]
    follow = dict(zip(group["at"].tolist(), group["next"].fillna(-1).astype("int64").tolist(), strict=True))
    hit, at = set(), int(entry)
    while at in follow and at not in hit:
        hit.add(at)
        at = follow[at]
    return group[group["at"].isin(hit)][["file", "split", "id", "at"]]


def reachable(places: DataFrame) -> DataFrame:
    """``file, split, id, at`` of the candidates on the chain that starts at offset 0 of their file."""
    jumps = stored(places.groupBy("file", "block").applyInPandas(_leave, "file string, at long, jump long"), "jumps")
    reach = places.where("at = 0").select("file", "at")
    turn = 0
    while not jumps.where("jump is not null").isEmpty():
        turn += 1
        hop = jumps.where("jump is not null")
        reach = stored(reach.union(reach.join(hop, ["file", "at"]).select("file", F.col("jump").alias("at"))).distinct(), f"reach{turn}")
        then = jumps.select("file", F.col("at").alias("jump"), F.col("jump").alias("far"))
        jumps = stored(hop.join(then, ["file", "jump"]).where("far is not null").select("file", "at", F.col("far").alias("jump")), f"jumps{turn}")
    entry = reach.groupBy("file", F.floor(F.col("at") / BLOCK_BYTES).alias("block")).agg(F.min("at").alias("entry"))
    return places.join(entry, ["file", "block"]).groupBy("file", "block").applyInPandas(_mark, "file string, split long, id long, at long")


def chained(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``file, split, id, at`` of every real record's first cut; ``file, at, text`` of the records cut up by version lines in them).

    Bodies move only for records of several cuts.
    """
    places = placed(chunks)
    real = stored(reachable(places).withColumnRenamed("at", "own"), "reachable")
    so_far = Window.partitionBy("file").orderBy("at")
    owned = places.join(real, ["file", "split", "id"], "left").withColumn("record", F.last("own", ignorenulls=True).over(so_far))
    owned = stored(owned.where("record is not null").select("file", "split", "id", "at", "record"), "owned")
    parts = owned.groupBy("file", "record").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    cut_up = stored(owned.join(parts, ["file", "record"]).select("file", "split", "id", "at", "record"), "cut-up")
    body = chunks.select("file", "split", "id", "value").join(cut_up, ["file", "split", "id"])
    body = body.groupBy("file", "record").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "value"))).getField("value"), MAGIC).alias("text"))
    return owned.where("at = record").select("file", "split", "id", "at"), body.withColumnRenamed("record", "at")


def _fields() -> list[Column]:
    number = lambda name: F.regexp_extract(_field(name), r":(-?[0-9]+)>", 1).try_cast("long")
    return [
        _field("WARC-Type").alias("type"), number("WARC-Record-ID").alias("page_id"), number("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("header_digest"), _field("X-Payload-Length").try_cast("long").alias("header_bytes"),
    ]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives in ``path``: ``file, at, type, page_id, refers_to, header_digest, header_bytes, payload`` (binary)."""
    chunks = candidates(spark, path)
    firsts, bodies = chained(chunks)
    whole = chunks.join(firsts, ["file", "split", "id"]).join(bodies, ["file", "at"], "left")
    whole = whole.withColumn("text", F.coalesce("text", "value").cast("binary"))
    return whole.select("file", "at", *_fields(), _payload("text").alias("payload"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_records`, with ``n_bytes`` and ``digest`` of the payload read instead of the payload itself.

    Digests of records of one cut are taken where the archive is read, so no body moves.
    """
    chunks = candidates(spark, path)
    firsts, bodies = chained(chunks)
    slim = chunks.select("file", "split", "id", "head", "length", "own").join(firsts, ["file", "split", "id"])
    digests = bodies.join(slim.select("file", "at", "head", "length"), ["file", "at"]).withColumn("text", F.col("text").cast("binary"))
    digests = stored(digests.select("file", "at", F.sha1(_payload("text")).alias("whole"), F.octet_length(_payload("text")).alias("read")), "cut-up-digests")
    out = slim.join(digests, ["file", "at"], "left")
    n = F.coalesce(F.col("read").cast("long"), F.when(F.col("own").isNotNull(), F.col("length")))
    return out.select("file", "at", *_fields(), n.alias("n_bytes"), F.coalesce("whole", "own").alias("digest"))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write the archives of ``pages``, read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A response's figures come from the payload read back; a revisit has none, so
    its header's figures of the full payload are given.
    """
    records = read_index(pages.sparkSession, write_archives(pages, **columns))
    again = F.col("type") == "revisit"
    return records.select(
        "page_id",
        F.when(again, F.col("header_bytes")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
        F.when(again, F.col("header_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
