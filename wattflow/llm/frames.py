"""DataFrame helpers shared by the operators: hand-off tables, row keys, salted joins, components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattflow.runtime import scratch_dir


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage: what follows re-reads files instead of recomputing, also after
    a lost executor.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(*cols: str) -> Column:
    """64-bit hash of columns that tells null from every value."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))])


def keyed_join(rows: DataFrame, keyed: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with a stored table ``keyed`` (at most one row for a key), whatever share of ``rows`` one key holds.

    ``keyed`` must be a stored table: its bytes are known, so it is broadcast only
    below ``spark.sql.autoBroadcastJoinThreshold``. Otherwise the join stands
    directly on both shuffles, and Spark splits the partition of a hot key over
    tasks (adaptive skew join).
    """
    return rows.join(keyed, on, how)


FILTER_BITS = 1 << 26


def probably_in(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in the stored table ``keys`` (column of that name), and few others, without a shuffle.

    A bitmap of at least 32 bits a key, and of FILTER_BITS (8 MB) at most, is broadcast: in
    front of an exact join it spares the rows that meet nothing their move. With many
    more keys than that it lets more and more rows pass, in the end all.
    """
    bits = min(FILTER_BITS, max(1 << 15, 1 << (32 * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    cell = {"_page": F.shiftright(slot, 15), "_place": slot.bitwiseAND(F.lit((1 << 15) - 1))}
    pages = keys.select(F.col(key)).withColumns(cell).groupBy("_page").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    found = rows.withColumns(cell).join(F.broadcast(pages), "_page")
    byte = "cast(conv(hex(substring(_bits, cast(_place div 8 as int) + 1, 1)), 16, 10) as int)"
    return found.where(F.expr(f"bit_get({byte}, cast(_place % 8 as int)) = 1")).select(*rows.columns)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) for each node, root = smallest node.

    Contraction: every node takes its smallest neighbour (one aggregate with
    partial results before the shuffle), edges are rewritten to those labels and
    made distinct, and the labels so far are moved along. Rounds grow with the
    logarithm of the longest path. Every round's tables are written to the shared
    folder, so no lineage grows and no hot node needs one task: joins stand
    directly on stored tables, whose skewed keys Spark splits.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    roots: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        label = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), f"{name}-label{turn}")
        if roots is None:
            roots = label.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = label.select(F.col("a").alias("root"), "to")
            roots = stored(roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"{name}-roots{turn}")
        one = stored(edges.join(label.select("a", F.col("to").alias("x")), "a").select("x", "b"), f"{name}-half{turn}")
        two = one.join(label.select(F.col("a").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        edges = stored(two.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-edges{turn}")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
