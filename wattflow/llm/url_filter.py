"""URL filter by association rules.

Each url becomes a set of tokens (host suffixes, path words, file ending, query
keys). FP-growth over labelled urls mines token combinations; a combination becomes
a rule for a label, block or allow, if its support and its confidence for that label
reach the floors, the confidence exceeds the label's share of all labelled urls, and no
shorter rule for the label inside it is as confident. Rules are matched by an inverted
index: a rule is filed under its rarest token, so only urls that hold that token look at
it; the rule of greatest lift (confidence over its label's share) decides, block before
allow if two are equal, then the greater token list. Fixed prefix rules (host and path) go
before mined ones.

Mining is bounded: it learns from at most about MOST_LABELLED labelled urls, drawn at
random; tokens too rare for a rule of either label are left out first; tokens that occur in
the very same labelled urls are one item (their least stands for them), so the words of
one long path count once instead of in all their combinations.

Defined cases: a null url, or one without ``://``, has empty host and path and
no tokens, no fixed rule fits it, and it is allowed; repeated rows are judged
alike; labels that are null or whose url is null teach nothing; no labels or no
rule above the floors: every url without a fixed rule is allowed; urls of any
length are taken whole; columns other than the named ones are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stored

# fixed values: (host/path prefix, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MIN_CONFIDENCE, MIN_COUNT, LONGEST = 0.8, 30, 3
MOST_LABELLED = 200_000  # labelled urls that rules are learnt from
LABELS = {"\x00block": "block", "\x00allow": "allow"}  # the labels' items; no token holds a NUL


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the url's host or a parent domain and whose path starts the url's path."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # the longest is tested last and wins
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: ``h:`` host suffixes of two labels or more, ``w:`` words of the host, ``p:`` path words without digits,
    ``e:`` file ending, ``q:`` query keys."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, n), ".")))
    words = F.transform(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("w:"), x))
    parts = F.transform(F.regexp_extract_all(path, F.lit(r"([^/.\d]+)(?=[/.]|$)"), 1), lambda x: F.concat(F.lit("p:"), x))
    ending = F.transform(F.regexp_extract_all(path, F.lit(r"\.([A-Za-z]+)$"), 1), lambda x: F.concat(F.lit("e:"), x))
    keys = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), 1), lambda x: F.concat(F.lit("q:"), x))
    every = F.array_distinct(F.concat(F.when(n > 1, suffixes).otherwise(F.array().cast("array<string>")), words, parts, ending, keys))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def tokenised(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    plain = plain.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return plain.withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))


def merged_tokens(held: DataFrame, least: int, confidence: float) -> DataFrame:
    """(token, item, n): tokens frequent enough for a rule of either label, with the least of those that occur in the same urls."""
    each = held.select("row", "blocked", F.explode("tokens").alias("token"))
    x, y = F.xxhash64("row"), F.xxhash64("row", F.lit(1))
    count = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("n_block"), F.bit_xor(x).alias("x"), F.bit_xor(y).alias("y"))
    floor = max(math.ceil(confidence * least), 1)
    count = stored(count.where((F.col("n") >= least) & (F.greatest("n_block", F.col("n") - F.col("n_block")) >= floor)), "url-token-counts")
    least_of = count.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return stored(count.join(least_of, ["n", "x", "y"]).select("token", "item", "n"), "url-items")


def mine_rules(labelled: DataFrame, support: float | None = None, confidence: float = MIN_CONFIDENCE, least: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """Rules (tokens, key, n_both, n_all, label, lift) from (tokens, blocked): ``n_both`` of ``n_all`` labelled urls have the label.

    Combinations of at most ``longest`` tokens that hold in ``least`` of the labelled urls
    taken, whatever the share: sets are mined from the least count of urls of its label
    that such a rule can have. A ``support`` that is given is a floor on the share besides.
    ``key`` is the rule's rarest token. A rule goes if a rule inside it for the same label is
    at least as confident (confidence pruning).
    """
    held = labelled.where("blocked is not null and size(tokens) > 0").select("tokens", "blocked")
    n = held.count()
    if n > MOST_LABELLED:
        held = held.sample(MOST_LABELLED / n, seed=5)
    held = stored(held.withColumn("row", F.monotonically_increasing_id()), "url-labelled")
    known = merged_tokens(held, least, confidence)
    items = held.select("row", "blocked", F.explode("tokens").alias("token")).join(known.select("token", "item"), "token")
    items = items.groupBy("row", "blocked").agg(F.collect_set("item").alias("tokens"))
    label = F.when(F.col("blocked"), F.lit(next(iter(LABELS)))).otherwise(F.lit(list(LABELS)[1]))
    items = stored(items.select(F.concat("tokens", F.array(label)).alias("items")), "url-baskets")
    size = held.agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("n_block")).first()
    total = max(size["n"], 1)
    base = F.when(F.col("label") == "block", F.lit(size["n_block"] / total)).otherwise(F.lit(1 - size["n_block"] / total))
    if support is None:  # a rule of ``least`` urls needs ``confidence * least`` of its label; half below, as the product is rounded up
        support = max(math.ceil(confidence * least) - 0.5, 0.5) / total
    share = min(support * total / max(items.count(), 1), 1.0)  # urls without a frequent token are in no basket
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(items)
    sets = stored(model.freqItemsets.where(F.size("items") <= longest + 1), "itemsets")
    marks = F.array(*[F.lit(m) for m in LABELS])
    named = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    both = sets.withColumn("mark", F.array_intersect("items", marks)).where(F.size("mark") == 1)
    both = both.select(F.array_sort(F.array_except("items", marks)).alias("tokens"), named[F.col("mark")[0]].alias("label"), F.col("freq").alias("n_both"))
    alone = sets.where(~F.arrays_overlap("items", marks)).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n_all"))
    rules = both.where(F.size("tokens") > 0).join(alone, "tokens").where((F.col("n_all") >= least) & (F.col("n_both") >= confidence * F.col("n_all")))
    rules = stored(rules.withColumn("lift", F.col("n_both") / F.col("n_all") / base).where("lift > 1"), "rules")
    # a rule meets the rules inside it through its own sub-combinations, at most 2 ** longest of them
    subs = rules.select("tokens", "label", "n_both", "n_all", F.posexplode(_subsets(F.col("tokens"), longest)).alias("i", "sub"))
    inner = rules.select(F.col("tokens").alias("sub"), "label", F.col("n_both").alias("s_both"), F.col("n_all").alias("s_all"))
    beaten = subs.where(F.size("sub") < F.size("tokens")).join(inner, ["sub", "label"]).where(F.col("s_both") * F.col("n_all") >= F.col("n_both") * F.col("s_all"))
    rules = rules.join(beaten.select("tokens", "label").distinct(), ["tokens", "label"], "left_anti")
    keyed = rules.select("*", F.explode("tokens").alias("token")).join(known.select("token", F.col("n").alias("n_token")), "token")
    rarest = keyed.groupBy("tokens", "label", "n_both", "n_all", "lift").agg(F.min(F.struct("n_token", "token")).alias("k"))
    return stored(rarest.select("tokens", F.col("k.token").alias("key"), "n_both", "n_all", "label", "lift"), "url-rules")


def _subsets(tokens: Column, longest: int) -> Column:
    masks = [[i for i in range(longest) if m >> i & 1] for m in range(1, 1 << longest)]
    picks = [F.filter(F.array(*[F.get(tokens, F.lit(i)) for i in at]), lambda x: x.isNotNull()) for at in masks]
    return F.array_distinct(F.array(*picks))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined, label): for each distinct token set that some rule fits, its rule of greatest lift.

    Urls with equal token sets are one row here, so a host with a third of all
    urls is looked up once for each of its distinct sets.
    """
    sets = urls.where(F.size("tokens") > 0).select(F.array_sort("tokens").alias("tokens")).distinct()
    index = rules.select("key", F.col("tokens").alias("need"), "label", "lift")
    seen = sets.select("tokens", F.explode("tokens").alias("key")).join(index, "key")
    fits = seen.where(F.size(F.array_except("need", "tokens")) == 0)
    best = fits.groupBy("tokens").agg(F.max(F.struct("lift", "label", "need")).alias("m"))  # "block" is the greater label
    return best.select("tokens", F.array_join("m.need", " & ").alias("mined"), "m.label")


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, **floors) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` for every row; ``labels``: (page_id, blocked)."""
    rows = stored(tokenised(pages, page_id, url), "url-tokens")
    taught = rows.select("page_id", "tokens").join(labels.select("page_id", "blocked"), "page_id").select("tokens", "blocked")
    found = match_rules(rows, mine_rules(taught, **floors))
    found = stored(found.select(F.xxhash64("tokens").alias("_k"), F.col("tokens").alias("_t"), "mined", "label"), "url-matches")
    rows = rows.withColumn("rule", fixed_rule(F.col("host"), F.col("path"), rules)).withColumn("_s", F.array_sort("tokens")).withColumn("_h", F.xxhash64("_s"))
    out = rows.join(found, (F.col("_h") == F.col("_k")) & (F.col("_s") == F.col("_t")), "left")
    fixed = F.lit(None).cast("string")
    for rule, verdict in rules:
        fixed = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(fixed)
    verdict = F.coalesce(fixed, "label", F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "mined")
