"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded along the tree.

* Each block node (and text run beside blocks) gets features: purpose words of its
  tag and attributes, here and above; text, link and node density of its subtree;
  depth; place among, likeness to and weight against its siblings (:mod:`.dom`).
* The trees are trained on a bounded sample of the table's pages: at most
  SAMPLE_PAGES pages, chosen by a hash of their id, give the words, and each is
  rendered RENDERS times into labelled layouts (articles under semantic, named or
  nameless containers among menus, adverts, notices, forms, sidebars, comments).
  Nothing but the model, whose size the parameters fix, goes to the tasks.
* Decoding is hierarchical: the assignment of keep / drop to all nodes with the
  largest likelihood under the rule that a kept node's ancestors are kept, found
  bottom-up and read top-down, so that no node contradicts its ancestors.

Defined cases: a null or empty page has the empty text; a page without an article
has the empty text; broken markup is read as far as it goes; repeated rows get the
same text; columns other than the named ones are not looked at; an empty table
gives an empty result and trains on the layouts with stand-in words.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import Node, measure, read_page, text_of
from .textops import slices

SAMPLE_PAGES, RENDERS, SEED = 150, 4, 2026
ROUNDS, TREE_DEPTH, STEP = 20, 4, 0.3
MARK = "\ue000"  # stands before kept text in training pages only

# stand-in words for tables that give none
STAND_IN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


class Layout:
    """Random labelled pages over given words."""

    def __init__(self, words: list[str], seed: int):
        self.rng = random.Random(seed)
        self.words = words or STAND_IN

    def some(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        at = self.rng.randrange(len(self.words))
        return " ".join(self.words[(at + i) % len(self.words)] for i in range(n)) + self.rng.choice([".", ".", "", "!"])

    def esc(self, text: str) -> str:
        return html.escape(text, quote=False)

    def name(self, *options: str) -> str:
        noise = ["col-8", "row", "wrap", "inner", "u-12", "block", "box", "grid-2", "x1"]
        pick = [self.rng.choice(options)] if options else []
        pick += self.rng.sample(noise, self.rng.choice([0, 0, 1, 2]))
        if not pick:
            return ""
        return f' {self.rng.choice(["class", "class", "id"])}="{" ".join(pick)}"'

    def links(self, n: int, low: int = 1, high: int = 3) -> str:
        rows = "".join(f'<li><a href="/x{i}">{self.esc(self.some(low, high))}</a></li>' for i in range(n))
        return f"<ul>{rows}</ul>"

    def inline(self, text: str) -> str:
        parts = self.esc(text).split(" ")
        for _ in range(self.rng.choice([0, 0, 1, 2])):
            i = self.rng.randrange(len(parts))
            tag = self.rng.choice(["b", "i", "em", "strong", "span", 'a href="/y"'])
            parts[i] = f"<{tag}>{parts[i]}</{tag.split()[0]}>"
        return " ".join(parts)

    def kept(self) -> str:
        """One block of article text."""
        r = self.rng.random()
        if r < 0.65:
            low, high = self.rng.choice([(1, 3), (5, 30), (20, 120), (20, 120)])
            text = self.inline(MARK + self.some(low, high))
            return self.rng.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<div>{text}</div>"])
        if r < 0.77:
            level = self.rng.choice("234")
            return f"<h{level}>{MARK}{self.esc(self.some(1, 8))}</h{level}>"
        if r < 0.87:
            rows = "".join(f"<li>{self.inline(MARK + self.some(2, 25))}</li>" for _ in range(self.rng.randint(2, 6)))
            return f"<ul>{rows}</ul>"
        if r < 0.93:
            return f"<blockquote><p>{MARK}{self.esc(self.some(5, 40))}</p></blockquote>"
        rows = "".join("<tr>" + "".join(f"<td>{MARK}{self.esc(self.some(1, 5))}</td>" for _ in range(3)) + "</tr>" for _ in range(3))
        return f"<table>{rows}</table>"

    def away(self, inside: bool = False) -> str:
        """One block that is no article text."""
        rng = self.rng
        text = lambda a, b: f"<p>{self.inline(self.some(a, b))}</p>"
        box = rng.choice(["div", "div", "section", "aside"])
        kind = rng.choice(["ad", "notice", "share", "related", "newsletter"] if inside else
                          ["nav", "header", "footer", "side", "ad", "notice", "form", "comments", "comments", "related", "crumbs", "share", "newsletter", "links"])
        if kind == "nav":
            return rng.choice([f"<nav>{self.links(rng.randint(3, 9))}</nav>", f"<div{self.name('menu', 'main-nav', 'navbar', 'navigation')}>{self.links(rng.randint(3, 9))}</div>"])
        if kind == "header":
            logo = f"<a href='/'>{self.esc(self.some(1, 3))}</a>"
            return rng.choice([f"<header>{logo}{text(2, 9)}</header>", f"<div{self.name('header', 'masthead', 'site-header', 'topbar')}>{logo}{text(2, 9)}</div>"])
        if kind == "footer":
            low, high = rng.choice([(3, 15), (10, 50)])
            return rng.choice([f"<footer>&copy; {self.esc(self.some(low, high))}</footer>", f"<footer>{text(low, high)}{self.links(3)}</footer>", f"<div{self.name('footer', 'site-footer', 'bottom', 'copyright')}>{text(low, high)}</div>"])
        if kind == "side":
            tag, name = rng.choice([("aside", self.name()), ("div", self.name("sidebar", "widget", "right-rail", "side")), ("section", self.name("sidebar", "widget"))])
            return f"<{tag}{name}><h3>{self.esc(self.some(1, 4))}</h3>{text(5, 60)}{self.links(rng.randint(2, 6), 1, 8)}</{tag}>"
        if kind == "ad":
            return f"<{box}{self.name('ad', 'ads', 'advert', 'promo', 'sponsored', 'banner', 'ad-slot')}>{rng.choice([self.esc(self.some(3, 30)), text(3, 50)])}</{box}>"
        if kind == "notice":
            return f"<{box}{self.name('notice', 'cookie-banner', 'alert', 'consent', 'popup', 'cookie-notice', 'disclaimer')}>{rng.choice([self.esc(self.some(5, 40)), text(5, 60)])}</{box}>"
        if kind == "form":
            return f"<form{self.name('search', 'contact', 'login')}><label>{self.esc(self.some(1, 3))}</label><input name='q'>{text(2, 25)}<button>Go</button></form>"
        if kind == "comments":
            one, low, high = rng.choice(["div", "li", "article"]), *rng.choice([(3, 20), (10, 90)])
            rows = "".join(f"<{one}{self.name('comment', 'reply', 'comment-body')}>{text(low, high)}</{one}>" for _ in range(rng.randint(1, 6)))
            box = rng.choice(["div", "section"])
            return f"<{box}{self.name('comments', 'comment-list', 'reader-comments', 'discussion', 'disqus')}><h3>{self.esc(self.some(1, 3))}</h3>{rows}</{box}>"
        if kind == "related":
            return f"<{box}{self.name('related', 'recommended', 'more-stories')}><h4>{self.esc(self.some(1, 3))}</h4>{self.links(rng.randint(2, 5), 4, 12)}</{box}>"
        if kind == "crumbs":
            return f"<div{self.name('breadcrumb', 'breadcrumbs', 'pagination', 'tags')}><a href='/'>{self.esc(self.some(1, 2))}</a> &gt; <a href='/a'>{self.esc(self.some(1, 2))}</a></div>"
        if kind == "share":
            return f"<div{self.name('share', 'social', 'sharing')}><a href='#'>{self.esc(self.some(1, 2))}</a> <a href='#'>{self.esc(self.some(1, 2))}</a></div>"
        if kind == "newsletter":
            return f"<{box}{self.name('newsletter', 'subscribe', 'signup')}>{text(4, 40)}</{box}>"
        return f"<div{self.name()}>{self.links(rng.randint(4, 12), 1, 6)}</div>"

    def page(self) -> str:
        rng = self.rng
        body = [self.kept() for _ in range(rng.choice([1, 2, 4, 8, 14]))]
        if rng.random() < 0.8:
            head = f"<h1>{MARK}{self.esc(self.some(2, 12))}</h1>"
            body.insert(0, rng.choice([head, head, f"<header>{head}</header>"]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            body.insert(rng.randint(1, len(body)), self.away(inside=True))
        shape = rng.random()
        if shape < 0.35:
            centre = f"<article{self.name()}>{''.join(body)}</article>"
        elif shape < 0.5:
            centre = f"<main{self.name()}>{''.join(body)}</main>"
        elif shape < 0.9:
            box = rng.choice(["div", "section"])
            centre = f"<{box}{self.name('content', 'article', 'post-body', 'entry-content', 'story', 'main-content', 'article-body', 'post')}>{''.join(body)}</{box}>"
        else:
            centre = f"<div{self.name()}>{''.join(body)}</div>"
        for _ in range(rng.choice([0, 0, 1])):
            centre = f"<div{self.name()}>{centre}{self.away() if rng.random() < 0.4 else ''}</div>"
        front = [self.away() for _ in range(rng.choice([0, 1, 2, 3]))]
        back = [self.away() for _ in range(rng.choice([0, 1, 2, 3]))]
        if rng.random() < 0.06:
            centre = ""  # a page without an article
        return f"<!DOCTYPE html><html><head><title>{self.esc(self.some(1, 5))}</title><script>var a='<p>';</script></head><body>{''.join(front)}{centre}{''.join(back)}</body></html>"


def labelled(page: str) -> tuple[list[Node], list[int]]:
    """Nodes of a marked page and whether each holds kept text; marks are taken out."""
    nodes = read_page(page)
    keep = [0] * len(nodes)
    for i, node in enumerate(nodes):
        node.index = i
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if any(MARK in t for t in node.text):
            keep[i] = 1
            node.text = [t.replace(MARK, "") for t in node.text]
        if keep[i] and node.parent is not None:
            keep[node.parent.index] = 1
    return nodes, keep


def _examples(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, page in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist(), strict=True):
                words = [w.replace(MARK, "") for n in read_page(page or "") for w in text_of(n).split()][:4000]
                rows, labels = [], []
                for k in range(RENDERS):
                    nodes, keep = labelled(Layout([w for w in words if w], seed + 31 * key + k).page())
                    rows += measure(nodes)[1:]
                    labels += keep[1:]
                values = pa.array(rows, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([values, pa.array(labels, pa.float64())], ["x", "label"])

    return run


def train(pages: DataFrame, page_id: str = "page_id", page: str = "html", sample: int = SAMPLE_PAGES, seed: int = SEED) -> list[tuple]:
    """The boosted trees as plain arrays: (feature, threshold, left, right, value, weight) for each tree."""
    spark = pages.sparkSession
    chosen = pages.select(F.col(page).alias("html"), F.xxhash64(F.col(page_id), F.lit(seed)).alias("h")).where("html is not null")
    chosen = chosen.orderBy("h", F.length("html")).limit(sample).select(F.pmod("h", F.lit(1 << 20)).cast("int").alias("key"), "html")
    stand_in = spark.range(sample).select(F.col("id").cast("int").alias("key"), F.lit("").alias("html"))
    source = stand_in if chosen.isEmpty() else chosen
    rows = source.repartition(4).mapInArrow(_examples(seed), "x array<double>, label double")
    rows = rows.select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=TREE_DEPTH, stepSize=STEP, seed=seed, maxBins=64, subsamplingRate=1.0).fit(rows)
    return read_trees(model.toDebugString, list(model.treeWeights))


def read_trees(text: str, weights: list[float]) -> list[tuple]:
    """Arrays of each tree from the model's printed form; a leaf points to itself."""
    trees: list[tuple] = []
    for part, weight in zip(re.split(r"\n\s*Tree \d+ \(weight [^)]*\):", text)[1:], weights, strict=True):
        feature, bound, left, right, value = [], [], [], [], []
        open_nodes: list[int] = []

        def add(f: int, t: float, v: float) -> int:
            n = len(feature)
            feature.append(f), bound.append(t), left.append(n), right.append(n), value.append(v)  # noqa: B023
            return n

        side = {}
        for line in part.strip().splitlines():
            line = line.strip()
            m = re.match(r"(If|Else) \(feature (\d+) (<=|>) ([^)]*)\)", line)
            if m and m.group(1) == "If":
                n = add(int(m.group(2)), float(m.group(4)), 0.0)
                if open_nodes:
                    (left if side[open_nodes[-1]] == "If" else right)[open_nodes[-1]] = n
                open_nodes.append(n)
                side[n] = "If"
            elif m:
                while side[open_nodes[-1]] == "Else":
                    open_nodes.pop()
                side[open_nodes[-1]] = "Else"
            elif line.startswith("Predict:"):
                n = add(0, math.inf, float(line.split(":")[1]))
                if open_nodes:
                    (left if side[open_nodes[-1]] == "If" else right)[open_nodes[-1]] = n
        trees.append((np.array(feature), np.array(bound), np.array(left), np.array(right), np.array(value), weight))
    return trees


def score(trees: list[tuple], rows: np.ndarray) -> np.ndarray:
    """Probability that each node holds kept text."""
    margin = np.zeros(len(rows))
    every = np.arange(len(rows))
    for feature, bound, left, right, value, weight in trees:
        at = np.zeros(len(rows), dtype=np.int64)
        for _ in range(TREE_DEPTH):
            at = np.where(rows[every, feature[at]] <= bound[at], left[at], right[at])
        margin += weight * value[at]
    return 1 / (1 + np.exp(-2 * margin))


def decode(nodes: list[Node], p: np.ndarray) -> list[bool]:
    """Most likely keep / drop of all nodes such that a kept node's ancestors are kept; hidden nodes are dropped."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    yes, no = np.log(p).tolist(), np.log1p(-p).tolist()
    best, gone = [0.0] * len(nodes), [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        gone[i] += no[i]
        best[i] += yes[i] if not node.hidden else -1e9
        if node.parent is not None:
            j = node.parent.index
            gone[j] += gone[i]
            best[j] += max(best[i], gone[i])
    keep = [False] * len(nodes)
    for i, node in enumerate(nodes):
        keep[i] = node.parent is None or (keep[node.parent.index] and best[i] > gone[i])
    return keep


def main_texts(pages: list[str], trees: list[tuple]) -> list[str]:
    """Kept text of each page: blocks in page order, white space folded, one space between."""
    parsed = [read_page(p) if p else [] for p in pages]
    rows = [r for nodes in parsed if nodes for r in measure(nodes)]
    p = score(trees, np.array(rows, dtype=np.float64)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes in parsed:
        keep = decode(nodes, p[at : at + len(nodes)]) if nodes else []
        at += len(nodes)
        out.append(" ".join(t for t in (text_of(n) for n, k in zip(nodes, keep, strict=True) if k and n.text) if t))
    return out


def _extract(trees: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = main_texts(part.column("html").to_pylist(), trees)
                cols = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, trees: list[tuple] | None = None, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    trees = trees if trees is not None else train(pages, page_id, page)
    plain = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    return plain.mapInArrow(_extract(trees), "page_id long, url string, text string, n_chars long")
