"""Registered queries of the operators over the driver tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, html_extract, line_dedup, mixing, near_dedup, oracle, packing, phrases, quality, substring_dedup, url_filter, vantage, warc, whitening

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def put(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op2_packing")
def op2(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query("op3_mixing", oracle.MIXING)
def op3(spark, sf_dir):
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select(F.col("did").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


@_query("op4_line_dedup", oracle.LINE_DEDUP)
def op4(spark, sf_dir):
    """Every document with its text after the drop and the number of lines dropped."""
    out = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("row.doc_id", "row.source", "text", "n_removed")


@_query("op7_url_filter")
def op7(spark, sf_dir):
    """Labels teach by equal number: the label of document d is the label of page d."""
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), labels)


@_query("op8_warc", oracle.WARC)
def op8(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


@_query("op9_near_dedup", oracle.NEAR)
def op9(spark, sf_dir):
    out = near_dedup.classes(_table(spark, sf_dir, "documents"))
    return out.select(F.col("did").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("did") == F.col("component_id"), F.lit(True)).alias("kept"))


@_query("op10_quality", oracle.QUALITY)
def op10(spark, sf_dir):
    out = quality.judge(_table(spark, sf_dir, "documents"))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_line_words"]
    return out.select(F.col("did").alias("doc_id"), *cols)


@_query("op6_substring_dedup", oracle.SUBSTRINGS)
def op6(spark, sf_dir):
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), texts=False).drop("kept_text")


@_query("op5_fingerprints")
def op5(spark, sf_dir):
    return fingerprints.compare_edited(_table(spark, sf_dir, "documents"))


@_query("op1_html_extract")
def op1(spark, sf_dir):
    return html_extract.extract(_table(spark, sf_dir, "pages"))


@_query("op11_nearest", oracle.NEIGHBOURS)
def op11(spark, sf_dir):
    return vantage.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op12_whitening")
def op12(spark, sf_dir):
    """The deviation as a 64-bit number; null where it needs more (the operator itself holds 38 digits)."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@_query("op13_phrases", oracle.PHRASES)
def op13(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))
