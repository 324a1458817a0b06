"""Mixing sources to target weights by Pareto order sampling.

Every document is owed ``target / source size`` expected copies. The whole part
is allocated with certainty; the fraction is its inclusion probability p. A
document's rank is the Pareto statistic ``(u / (1 - u)) / (p / (1 - p))`` with u
uniform from a hash of the document, and the documents of smallest rank are taken
until the source's words are reached: a fixed-size sample, unequal between
sources, that reruns reproduce.

A source is filled in rounds. In each, the documents that are still out and no larger
than the gap are taken in rank order as far as they fit; one that does not fit is larger
than the gap it leaves, so the next round passes it over and goes on behind it. After ROUNDS
rounds, or when none takes anything, one more document may close the gap if that brings
the source nearer to its target.

The cut of a round is found without sorting a source in one place: ranks fall into
BUCKETS cells per source, cells below the cut are taken whole, and only the cell at the
cut is ordered document by document. What a round took is one gap and one last place for
each source, so no row is rewritten.

Defined cases: a null text has size 0; a null source is a source of its own, after
all others; sources with no words get target 0; rows of size 0 are taken no words;
rows with equal id and text tie and are taken in any order, which gives the same rows; a
text of any length is one document; columns other than the three named are not looked
at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import keyed_join, stored, text_key

WEIGHTS = (3.0, 1.0, 2.0)  # fixed values, repeating over the sources by code point
SHARE, MOST_COPIES = 1.5, 2.0
BUCKETS = 4096
ROUNDS = 6
WORD = r"[^\x20\x09-\x0D]+"
SEED = 2026


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """Target words of each source: (source, source_size, target) from (source, source_size).

    The budget is shared by weight; a source that would exceed ``most`` times its
    size is fixed there and the rest is shared anew by weight. A source is capped
    exactly if its size per weight lies below the water level, so the level follows
    from running sums over sources in that order: one aggregate table, one row per source.
    """
    by_code = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    w = F.array(*[F.lit(x) for x in weights])
    ranked = sizes.withColumn("i", F.row_number().over(by_code) - 1).withColumn("weight", F.get(w, F.col("i") % len(weights)))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("unit", F.col("cap") / F.col("weight"))
    up = Window.orderBy("unit", "i").rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.partitionBy(F.lit(1))
    run = ranked.withColumn("capped", F.sum("cap").over(up)).withColumn("used", F.sum("weight").over(up))
    run = run.withColumn("budget", share * F.sum("source_size").over(all_rows)).withColumn("weights", F.sum("weight").over(all_rows))
    # all sources up to this one are capped if the level that is left beyond them still exceeds its unit
    left = F.col("budget") - F.col("capped") + F.col("cap")
    open_weight = F.col("weights") - F.col("used") + F.col("weight")
    run = run.withColumn("is_capped", left >= F.col("unit") * open_weight)
    fixed = F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("cap"))).over(all_rows), F.lit(0.0))
    rest = F.sum(F.when(~F.col("is_capped"), F.col("weight"))).over(all_rows)
    level = (F.col("budget") - fixed) / rest
    return run.withColumn("target", F.when(F.col("is_capped"), F.col("cap")).otherwise(level * F.col("weight"))).select("source", "source_size", "target")


def drawn(did: str, text: str, seed: int) -> Column:
    """40 random bits of a document: from the MD5 of seed, id and text, the same in every run and engine."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(did).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 10), 16, 10).cast("long")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **shares
) -> DataFrame:
    """Per row: ``did, rid, source, size, source_size, target, copies`` (0, 1 or 2 copies in the mix)."""
    plain = docs.select(F.col(doc_id).alias("did"), F.col(source).alias("source"), F.col(text).alias("text"))
    sized = stored(
        plain.select(
            "did", "source", text_key("source").alias("skey"), text_key("source", "text").alias("rid"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"), drawn("did", "text", seed).alias("draw"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "sizes",
    )
    per_source = sized.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = stored(targets(per_source, **shares).withColumn("skey", text_key("source")), "targets")
    owed = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = keyed_join(sized, plan.drop("source"), ["skey"]).withColumn("owed", owed)
    rows = rows.withColumn("whole", F.floor("owed").cast("long")).withColumn("p", F.col("owed") - F.col("whole"))
    u = (F.col("draw") + F.lit(0.5)) / F.lit(float(1 << 40))
    rows = rows.withColumn("rank", F.try_divide(u * (1 - F.col("p")), (1 - u) * F.col("p")))
    # rank / (1 + rank) grows with the rank and lies in (0, 1)
    rows = rows.withColumn("cell", F.when(F.col("p") > 0, F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS).cast("int")))
    rows = stored(rows, "ranked")
    want = F.col("target") - F.floor(F.col("target") / F.greatest("source_size", F.lit(1))) * F.col("source_size")
    filled, last = _fill(rows, plan.select("skey", want.alias("gap0")))
    rows = keyed_join(rows, filled, ["skey"])
    more = F.coalesce((F.col("size") > 0) & F.col("cell").isNotNull() & (_taken(last) | (_key() == F.col("closing"))), F.lit(False))
    return rows.select("did", "rid", "source", "size", "source_size", "target", (F.col("whole") + more.cast("long")).alias("copies"))


def _key() -> Column:
    """Place of a row in its source's order; the last part tells repeated rows apart."""
    return F.struct("rank", F.coalesce("did", F.lit(-(1 << 63))).alias("did"), "rid", "place")


def _taken(rounds: int) -> Column:
    """Whether one of the first rounds took the row: no larger than the round's gap, not behind its last place."""
    out = F.lit(False)
    for r in range(rounds):
        out = out | F.coalesce((F.col("size") <= F.col(f"gap{r}")) & (_key() <= F.col(f"cut{r}")), F.lit(False))
    return out


def _fill(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, int]:
    """(skey, gap0, cut0, gap1, ..., closing), rounds: what each round took of each source, and the document that closes the gap."""
    open_rows = rows.where("cell is not null and size > 0").select("skey", "cell", "rank", "did", "rid", "place", "size")
    state = stored(state, "mix-gaps")
    r = 0
    while r < ROUNDS:
        gap = F.col(f"gap{r}")
        left = keyed_join(open_rows, state, ["skey"]).where(~_taken(r) & (F.col("size") <= gap)).select("skey", "cell", "size", _key().alias("key"), gap.alias("gap"))
        cells = left.groupBy("skey", "cell", "gap").agg(F.sum("size").alias("words"), F.max("key").alias("key"))
        up = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = stored(cells.withColumn("below", F.coalesce(F.sum("words").over(up), F.lit(0))), "mix-cells")
        whole = cells.where("below + words <= gap").groupBy("skey").agg(F.max("key").alias("k1"), F.sum("words").alias("w1"))
        edge = cells.where("below <= gap and below + words > gap").select("skey", "cell", "below")
        within = Window.partitionBy("skey").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fits = left.join(edge, ["skey", "cell"]).withColumn("upto", F.col("below") + F.sum("size").over(within)).where("upto <= gap")
        fits = fits.groupBy("skey").agg(F.max("key").alias("k2"), F.sum("size").alias("w2"))
        took = (F.coalesce("w1", F.lit(0)) + F.coalesce("w2", F.lit(0))).alias("took")
        state = state.join(whole, "skey", "left").join(fits, "skey", "left")
        state = stored(state.select(*[c for c in state.columns if c not in ("k1", "w1", "k2", "w2", "took")], F.coalesce("k2", "k1").alias(f"cut{r}"), (gap - took).alias(f"gap{r + 1}"), took), "mix-gaps")
        r += 1
        if state.where("took > 0").isEmpty():
            break
    left = keyed_join(open_rows, state, ["skey"]).where(~_taken(r) & (F.col("size") <= 2 * F.col(f"gap{r}")))
    closing = left.groupBy("skey").agg(F.min(_key()).alias("closing"))
    return stored(state.drop("took").join(closing, "skey", "left"), "mix-filled"), r


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **shares) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it was taken (none: dropped); all columns stay."""
    taken = mix(docs, doc_id, text, source, seed, **shares)
    # repeated rows cannot be told apart: the copies of equal rows are dealt as one sum over them
    each = taken.groupBy("did", "rid").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    each = each.select(F.col("did").alias("_d"), F.col("rid").alias("_r"), "copies", "n")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("did", F.col(f"row.{doc_id}")).withColumn("s", F.col(f"row.{source}")).withColumn("t", F.col(f"row.{text}"))
    rows = rows.select("row", "did", text_key("s", "t").alias("rid"))
    rows = rows.join(each, F.col("did").eqNullSafe(F.col("_d")) & (F.col("rid") == F.col("_r")))
    # of n equal rows with c copies in all, the j-th gets floor or ceiling of c / n
    once = rows.where("n = 1").select("row", F.col("copies").alias("k"))
    same = Window.partitionBy("_d", "_r").orderBy(F.lit(1))
    many = rows.where("n > 1").withColumn("j", F.row_number().over(same) - 1)
    many = many.select("row", (F.floor(F.col("copies") / F.col("n")) + (F.col("j") < F.col("copies") % F.col("n")).cast("long")).alias("k"))
    return once.unionByName(many).where("k > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("i")).select("row.*")
