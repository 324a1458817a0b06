"""Block trees of web pages: a tolerant reader and the features of each node.

The reader is a small state machine over tags, made for text extraction: inline
elements are part of their block, raw-text elements (scripts, styles) and form
controls give no text, end tags that are missing are implied by the block that
follows, and end tags without a start are skipped.
"""

from __future__ import annotations

import html
import math
import re

# fixed values: element names by their role in HTML
RAW = frozenset("script style noscript template iframe object svg math title textarea noembed noframes xmp head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTROL = frozenset("button select option optgroup datalist input textarea label fieldset legend output progress meter".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var ruby rb rt rp wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

# fixed values: words in tag names, classes, ids and roles that tell a node's purpose
AWAY = frozenset(
    "nav navbar navigation menu menubar topbar toolbar masthead header banner footer foot bottom sidebar side aside rail widget ad ads adv advert adverts "
    "advertisement adbox sponsor sponsored promo promotion notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe signup "
    "login search searchbox form comment comments commentlist reply replies respond discussion disqus share sharing social related recommended recommend more "
    "breadcrumb breadcrumbs pagination pager tags copyright legal disclaimer skip sitemap feedback rating reviews complementary contentinfo".split()
)
CENTRE = frozenset("article main content contents post entry story body text page maincontent articlebody richtext prose document paragraph".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    # possessive: quotes that do not match up are read once, not in every way they could be paired
    r"|<(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>",
    re.S,
)
# a tag whose quotes swallow the rest of the page ends at its first ">"
BROKEN = re.compile(r"<(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>]*)>(?P<cdata>)?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "words", "parent", "children", "text", "link", "depth", "hidden", "chars", "links", "nodes", "marks", "index")

    def __init__(self, tag: str, words: tuple[str, ...], parent: Node | None, hidden: bool = False):
        self.tag, self.words, self.parent, self.hidden = tag, words, parent, hidden
        self.children: list[Node] = []
        self.text: list[str] = []
        self.link = 0
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.links = self.nodes = self.marks = self.index = 0


def _tokens(rest: str) -> tuple[tuple[str, ...], bool]:
    """(purpose words of class, id, role and the like; whether the element is hidden)."""
    words: list[str] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(rest):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-component", "name"):
            words += [w.lower() for w in WORDS.findall(value)]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            hidden = True
    return tuple(words), hidden


def read_page(page: str) -> list[Node]:
    """Nodes of the page in document order, the root first; text runs beside blocks are nodes of their own (tag ``#text``)."""
    root = Node("#root", (), None)
    stack = [root]  # open blocks
    inline: list[tuple[str, bool]] = []  # open inline elements of the current block: (name, drops its text)
    run: Node | None = None  # text node that inline content goes to
    nodes = [root]
    links = dropped = 0
    at, end = 0, len(page)

    def write(raw: str) -> None:
        nonlocal run
        if dropped or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if run is None:
            if text.isspace():
                return
            run = Node("#text", (), stack[-1])
            stack[-1].children.append(run)
            nodes.append(run)
        run.text.append(text)
        if links:
            run.link += len(text)

    def break_run() -> None:
        nonlocal run
        run = None

    def close(to: int) -> None:
        """Close open blocks down to ``to`` (kept)."""
        nonlocal links, dropped
        del stack[to:]
        inline.clear()
        links = dropped = 0
        break_run()

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            write(page[at:])
            break
        if lt > at:
            write(page[at:lt])
        m = TOKEN.match(page, lt) or BROKEN.match(page, lt)
        if m is None:
            rest = page[lt + 1 : lt + 2]
            if rest.isalpha() or rest == "/":  # an unfinished tag at the end
                if page.find(">", lt) < 0:
                    break
            write("<")
            at = lt + 1
            continue
        at = m.end()
        name = m.group("name")
        if name is None:
            if m.group("cdata"):
                write(m.group("cdata").replace("&", "&amp;"))
            continue
        name = name.lower()
        if not m.group("close"):
            rest = m.group("rest")
            if name in RAW and name != "head":
                if rest.endswith("/") and name in ("svg", "math", "object"):
                    continue
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
                continue
            if name == "br":
                write(" ") if run is not None else None
                continue
            if name in VOID:
                if name == "hr":
                    break_run()
                continue
            if name in INLINE or name in CONTROL and name not in ("fieldset",):
                if not rest.endswith("/"):
                    words, hidden = _tokens(rest) if rest else ((), False)
                    drop = hidden or name in CONTROL
                    inline.append((name, drop))
                    dropped += drop
                    links += name == "a"
                continue
            if name in ("html", "body", "tbody", "thead", "tfoot"):
                break_run()
                if name == "body" and stack[-1].tag in ("head",):
                    close(len(stack) - 1)
                if not rest:
                    continue
                continue
            if name == "head":
                continue
            # a block: implied ends, then a node of its own
            if name in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
            if name in SAME:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in SAME[name]:
                        close(i)
                        break
                    if stack[i].tag in SCOPE[name]:
                        break
            words, hidden = _tokens(rest) if rest else ((), False)
            break_run()
            inline.clear()
            links = dropped = 0
            node = Node(name, words, stack[-1], hidden)
            stack[-1].children.append(node)
            nodes.append(node)
            if not rest.endswith("/"):
                stack.append(node)
        else:
            if name in INLINE or name in CONTROL and name != "fieldset":
                for i in range(len(inline) - 1, -1, -1):
                    if inline[i][0] == name:
                        for other, drop in inline[i:]:
                            dropped -= drop
                            links -= other == "a"
                        del inline[i:]
                        break
                continue
            if name in ("html", "body", "head", "tbody", "thead", "tfoot") or name in VOID:
                break_run()
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    close(i)
                    break
            else:
                break_run()
    return nodes


def text_of(node: Node) -> str:
    return " ".join("".join(node.text).split())


FEATURES = (
    "away_own", "centre_own", "away_above", "centre_above", "away_gap", "tag_text", "tag_p", "tag_heading", "tag_list", "tag_form", "tag_table", "tag_container",
    "log_chars", "link_share", "log_nodes", "chars_per_node", "depth", "place", "log_siblings", "share_of_parent", "share_of_page", "mean_word", "stops", "siblings_same", "near_chars",
)

HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
STOPS = re.compile(r"[.!?…。]")


def measure(nodes: list[Node]) -> list[list[float]]:
    """Feature rows of the nodes: purpose words here and above, text and link density of the subtree, size, depth, siblings."""
    for i, node in enumerate(nodes):
        node.index = i
    size = len(nodes)
    words, stops = [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        node = nodes[i]
        if node.text:
            own = text_of(node)
            node.chars += len(own)
            node.links += min(node.link, len(own))
            words[i] += own.count(" ") + 1 if own else 0
            stops[i] += len(STOPS.findall(own))
        node.nodes += 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.links += node.links
            up.nodes += node.nodes
            words[up.index] += words[i]
            stops[up.index] += stops[i]
    total = max(1, nodes[0].chars)
    away, centre, last = [0] * size, [0] * size, [0] * size
    rows = []
    for i, node in enumerate(nodes):
        up = node.parent
        own = (node.tag, *node.words) if node.words else (node.tag,)
        # a header inside an article is part of it
        a = sum(w in AWAY for w in own)
        c = sum(w in CENTRE for w in own)
        if node.tag == "header" and a == 1 and up is not None and centre[up.index]:
            a = 0
        j = up.index if up is not None else 0
        away[i] = (away[j] if i else 0) + a
        centre[i] = (centre[j] if i else 0) + c
        # +1: the nearest purpose word upwards is of the article, -1: of the rest
        last[i] = -1 if a > c else 1 if c > a else -1 if a else (last[j] if i else 0)
        tag = node.tag
        n = len(up.children) if up is not None else 1
        brothers = up.children if up is not None else [node]
        near = sum(b.chars for b in brothers) - node.chars
        chars = node.chars
        rows.append([
            a, c, away[i] - a, centre[i] - c, last[i], tag == "#text", tag in ("p", "pre", "blockquote"), tag in HEADING, tag in ("ul", "ol", "li", "dl", "dt", "dd", "menu"),
            tag in ("form", "fieldset"), tag in ("table", "tr", "td", "th"), tag in ("div", "section", "article", "main", "#root"),
            math.log1p(chars), node.links / chars if chars else 0.0, math.log1p(node.nodes), chars / node.nodes, node.depth, 0.0, math.log1p(n),
            chars / up.chars if up is not None and up.chars else 1.0, chars / total, chars / words[i] if words[i] else 0.0, stops[i] / words[i] if words[i] else 0.0,
            0.0, math.log1p(near),
        ])
    place, same = FEATURES.index("place"), FEATURES.index("siblings_same")
    for node in nodes:
        kids = node.children
        kinds: dict[str, int] = {}
        for k in kids:
            kinds[k.tag] = kinds.get(k.tag, 0) + 1
        for i, k in enumerate(kids):
            rows[k.index][place] = i / max(1, len(kids) - 1)
            rows[k.index][same] = kinds[k.tag] / len(kids)
    return rows
