"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Each element gets features of its own and of its subtree (text and link density, tag, words in its class and
id, depth, place among its siblings, how its siblings look). Gradient-boosted trees, trained here in numpy,
give the odds that its own text belongs to the article. Decoding picks, for the whole tree at once, the best
labelling in which an element is outside, inside or removed: below a removed element all is removed, below
an inside one nothing is outside again. So an article can lose an advert inside it, but no child
contradicts its ancestors.

Training pages are a bounded sample of the table. Their labels come from their markup (article and main
against nav, header, footer, aside, form, ...), and each page is also learnt in altered forms: with the
telling tags renamed, and with notices, comments, forms and side bars of other pages' text put in. So the
model must weigh density and neighbours, not names alone.

Null and empty html give the empty text. Broken markup is read as browsers do in the plain cases: a block
ends an open paragraph, end tags close what is open inside them, stray end tags are passed over, an
unfinished page ends all. Time grows with a page's length however it is nested or broken. Ties of odds (a node as well
inside as outside) go to outside. An empty table gives an empty table. Repeated rows come back each; other columns pass
through by name, whatever their names, and one named like the output is replaced by it. Where no page of a table has article or main, labels
come from what pages share: text that many other pages have too tells of no article, and the article is the deepest element that holds
most of a page's other text. Where no page has any text there is nothing to learn and nothing to keep.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import small_batches

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
PLAIN = re.compile(r"[^>\"']*")
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select")}
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul head".split())
ENDS_P = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot"} | {"hr"}
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body main aside nav".split())

#: Words in tags, classes, ids and roles, by what they tell. Groups of features, not rules.
GROUPS: dict[str, frozenset[str]] = {
    "article": frozenset("article main content post entry story body text".split()),
    "menu": frozenset("nav menu navbar breadcrumb breadcrumbs navigation toc pagination pager tabs links".split()),
    "edge": frozenset("header footer masthead banner copyright foot topbar bottom".split()),
    "side": frozenset("aside sidebar side related recommended widget rail complementary more".split()),
    "notice": frozenset("notice cookie cookies consent alert popup modal newsletter subscribe signup promo gdpr dialog".split()),
    "advert": frozenset("ad ads advert adverts advertisement sponsor sponsored promoted".split()),
    "form": frozenset("form search login input button select textarea fieldset label".split()),
    "comment": frozenset("comment comments reply replies respond discussion disqus reader readers".split()),
    "share": frozenset("share social tags meta author byline".split()),
}


#: Pages whose nodes are scored together.
GROUP = 100


class Node:
    __slots__ = ("tag", "names", "parent", "parts", "kids", "depth", "hidden", "order")

    def __init__(self, tag: str, names: frozenset[str], parent: Node | None, hidden: bool) -> None:
        self.tag, self.names, self.parent, self.hidden = tag, names, parent, hidden
        self.parts: list[str | Node] = []
        self.kids: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.order = 0
        if parent:
            parent.parts.append(self)
            parent.kids.append(self)


def _names(tag: str, attributes: str) -> tuple[frozenset[str], bool]:
    if not attributes.strip(" /\t\n\r\f"):
        return frozenset((tag,)), False
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    words = {w.lower() for k in ("class", "id", "role") if k in got for w in WORDS.findall(got[k])}
    hidden = "hidden" in got or got.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", got.get("style", "")))
    return frozenset({tag} | words), hidden


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the tag ends whose attributes begin at ``at``: at the first > outside quotes, or after a quote that no other one
    closes; -1 if there is none. ``last``: the last place of each of the characters, so that nothing is searched for in vain."""
    while True:
        at = PLAIN.match(page, at).end()
        if at >= len(page) or at > last[">"]:
            return -1
        if page[at] == ">":
            return at
        quote = page[at]
        if at < last[quote]:
            at = page.index(quote, at + 1) + 1
        else:
            return page.find(">", at)


class _Open:
    """The elements that are open, and where each tag and each scope was opened last."""

    def __init__(self, root: Node) -> None:
        self.nodes, self.at, self.scopes = [root], {}, []

    def last(self, tag: str) -> int:
        return (self.at.get(tag) or (0,))[-1]

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else 0

    def push(self, node: Node) -> None:
        k = len(self.nodes)
        self.nodes.append(node)
        self.at.setdefault(node.tag, []).append(k)
        if node.tag in SCOPE:
            self.scopes.append(k)

    def close_to(self, k: int) -> None:
        while len(self.nodes) > k:
            node = self.nodes.pop()
            self.at[node.tag].pop()
            if node.tag in SCOPE:
                self.scopes.pop()


def parse(page: str) -> Node:
    """The block tree: elements inside a line (b, a, span, ...) are nodes too; their text stays in place. Every step moves on
    in the page, and stacks by tag tell what an end tag closes, so time grows with the page's length however it is nested or broken."""
    root = Node("#page", frozenset(), None, False)
    open_, at, n = _Open(root), 0, len(page)
    last = {c: page.rfind(c) for c in (">", '"', "'")}
    text: list[str] = []

    def put_text() -> None:
        if text:
            open_.nodes[-1].parts.append(entities.unescape("".join(text)))
            text.clear()

    while at < n:
        start = page.find("<", at)
        if start < 0:
            text.append(page[at:])
            break
        if start > at:
            text.append(page[at:start])
        after = page[start + 1 : start + 2]
        closing = after == "/"
        if after in ("!", "?"):
            put_text()
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", start) if start < last[">"] else -1
                at = n if end < 0 else end + 1
            continue
        m = NAME.match(page, start + 1 + closing)
        if m is None:
            if closing and start + 2 < n and start < last[">"]:  # </> and the like
                put_text()
                at = page.index(">", start) + 1
            else:
                text.append("<")
                at = start + 1
            continue
        end = _tag_end(page, m.end(), last)
        if end < 0:  # an unfinished tag at the end is no text
            break
        put_text()
        attributes, tag, at = page[m.end() : end], m[0].lower(), end + 1
        if closing:
            k = open_.last(tag)
            if k and (tag in BLOCK or k >= open_.scope()):
                open_.close_to(k)
        elif tag == "br":
            open_.nodes[-1].parts.append("\n")
        elif tag in VOID:
            pass
        elif tag in RAW:
            found = RAW[tag].search(page, at)
            at = found.end() if found else n
            open_.nodes[-1].parts.append(" ")
        else:
            k = max((open_.last(t) for t in ENDS_OWN.get(tag, ())), default=0)
            if tag in ENDS_P:
                k = max(k, open_.last("p"))
            if k > open_.scope():
                open_.close_to(k)
            names, hidden = _names(tag, attributes)
            node = Node(tag, names, open_.nodes[-1], hidden)
            if not attributes.endswith("/") or tag in BLOCK:
                open_.push(node)
    put_text()
    return root


def _walk(root: Node, first: int = 0) -> list[Node]:
    """All nodes, parents before children, in page order, numbered from ``first``."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        node.order = first + len(out)
        out.append(node)
        todo.extend(reversed(node.kids))
    return out


FEATURES = 28 + 2 * len(GROUPS)


def node_features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Features (nodes, FEATURES) and the length of each node's own text. ``nodes`` are all nodes of one page or of
    several, numbered through, parents first: so a subtree is a run of nodes, and its sums are differences of running sums."""
    n, known = len(nodes), {}
    own_, words_, stops_, kids_, flag_ = [], [], [], [], []
    index, last, size = [0] * n, [0] * n, [1] * n
    above_, root, linked_ = [0] * n, list(range(n)), [False] * n
    for i, x in enumerate(nodes):
        length = count = marks = 0
        for p in x.parts:
            if type(p) is str:
                length += len(p)
                count += p.count(" ")
                marks += p.count(".") + p.count(",")
        own_.append(length)
        words_.append(count)
        stops_.append(marks)
        m = len(x.kids)
        kids_.append(m)
        for k, c in enumerate(x.kids):
            index[c.order], last[c.order] = k, m - 1 - k
        if (f := known.get(x.names)) is None:
            f = known[x.names] = sum((not x.names.isdisjoint(g)) << k for k, g in enumerate(GROUPS.values()))
        flag_.append(f)
        linked_[i] = x.tag == "a"
        if x.parent is not None:
            j = x.parent.order
            above_[i], root[i], linked_[i] = above_[j] | flag_[j], root[j], linked_[i] or linked_[j]
    for i in range(n - 1, -1, -1):
        if nodes[i].parent is not None:
            size[nodes[i].parent.order] += size[i]
    own, words, stops, kids, index, last, size = (np.array(v, np.float64) for v in (own_, words_, stops_, kids_, index, last, size))
    flags, above = ((np.array(v)[:, None] >> np.arange(len(GROUPS)) & 1).astype(np.float64) for v in (flag_, above_))
    tag = [x.tag for x in nodes]
    is_a, is_p, is_li = (np.array([t == k for t in tag], np.float64) for k in ("a", "p", "li"))
    parent = np.array([x.parent.order if x.parent else x.order for x in nodes])
    depth = np.array([x.depth for x in nodes])
    end = np.arange(n) + size.astype(np.int64)
    upto = np.cumsum(np.stack([np.zeros(7), *np.stack([own, np.ones(n), stops, words, is_p, is_li, own * np.array(linked_)]).T]), axis=0)
    total, tags, dots, spaces, ps, lis, links = (upto[end] - upto[:-1]).T
    whole = np.maximum(total[root], 1.0)
    log = np.log1p
    density, linked = total / tags, links / np.maximum(total, 1)
    sib_text, sib_link = (total[parent] - total) / np.maximum(kids[parent] - 1, 1), (links[parent] - links) / np.maximum(total[parent] - total, 1)
    columns = [
        log(own), log(total), log(density), linked, total / whole, log(dots), dots / np.maximum(total, 1) * 100, log(spaces), log(ps), log(lis), lis / tags, ps / tags,
        depth, log(kids), log(index), log(last), index / np.maximum(index + last, 1), log(np.maximum(sib_text, 0)), sib_link,
        density[parent] / np.maximum(density, 1), linked[parent], total / np.maximum(total[parent], 1), is_p, is_a, [t in BLOCK for t in tag], [t[0] == "h" and t[1:].isdigit() for t in tag], [x.hidden for x in nodes], own / np.maximum(total, 1),
    ]
    return np.column_stack([*columns, flags, above]).astype(np.float32), own


@dataclass(frozen=True)
class Trees:
    """Boosted trees of one shape: ``depth`` levels of (feature, threshold), then leaves."""

    depth: int
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)
    start: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 2.0) -> Trees:
    """Second-order boosting of the logistic loss over histograms of each feature."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    start = float(np.log(((w * y).sum() + 1) / ((w * (1 - y)).sum() + 1)))
    score, inner = np.full(len(x), start), 2**depth - 1
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, 2**depth))
    columns = np.arange(x.shape[1])
    for k in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = w * (p - y), w * p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) > 1:
                flat = (code[rows] + columns * bins).ravel()
                gs = np.bincount(flat, np.repeat(g[rows], x.shape[1]), bins * x.shape[1]).reshape(-1, bins).cumsum(1)
                hs = np.bincount(flat, np.repeat(h[rows], x.shape[1]), bins * x.shape[1]).reshape(-1, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, b] > 1e-6 and b < len(edges[j]):
                    feature[k, node], threshold[k, node] = j, edges[j][b]
            at[rows] = 2 * node + 1 + (x[rows, feature[k, node]] > threshold[k, node])
        at -= inner
        leaf[k] = -rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + l2)
        score = score + leaf[k][at]
    return Trees(depth, feature, threshold, leaf, start)


def decode(nodes: list[Node], odds: np.ndarray, own: np.ndarray) -> list[bool]:
    """Which nodes are inside: the best of all labellings that no ancestor contradicts."""
    n = len(nodes)
    inside, outside = (np.clip(odds, -6, 6) * (np.minimum(own, 400) / 100 + 0.25)).tolist(), [0.0] * n
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        if x.hidden:
            inside[i], outside[i] = -1e9, 0.0
        if x.parent is not None:
            j, a, b = x.parent.order, inside[i], outside[i]
            if a > 0:
                inside[j] += a
                outside[j] += a if a > b else b
            elif b > 0:
                outside[j] += b
    state = [0] * n  # 0 outside, 1 inside, 2 removed
    for i, x in enumerate(nodes):
        above = state[x.parent.order] if x.parent is not None else 0
        if above == 2 or x.hidden:
            state[i] = 2
        elif above == 1:
            state[i] = 1 if inside[i] > 0 else 2
        elif inside[i] > max(outside[i], 0.0):
            state[i] = 1
    return [v == 1 for v in state]


def blocks(root: Node, keep: list[bool]) -> list[str]:
    """Text of the blocks inside, white space made single spaces."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if s := " ".join("".join(line).split()):
            out.append(s)
        line.clear()

    todo: list[tuple[Node, int]] = [(root, 0)]
    while todo:
        node, k = todo.pop()
        if k == 0 and node.tag in BLOCK:
            flush()
        if k < len(node.parts):
            todo.append((node, k + 1))
            part = node.parts[k]
            if type(part) is str:
                if keep[node.order]:
                    line.append(part)
            else:
                todo.append((part, 0))
        elif node.tag in BLOCK:
            flush()
    flush()
    return out


def extract(pages: list[str | None], trees: Trees | None) -> list[str]:
    """The main text of each page. Without trees, elements outside the boilerplate tags are kept."""
    roots, nodes = [parse(p or "") for p in pages], []
    for r in roots:
        nodes += _walk(r, len(nodes))
    if not nodes:
        return []
    x, own = node_features(nodes)
    odds = trees.odds(x) if trees is not None else np.array([-6.0 if n.tag in BOILERPLATE else 1.0 for n in nodes])
    keep = decode(nodes, odds, own)
    return ["\n\n".join(blocks(r, keep)) for r in roots]


BOILERPLATE = frozenset("nav header footer aside form menu dialog button select head".split())


#: Words that mark a part of a page as no article wherever they stand.
APART = GROUPS["advert"] | GROUPS["comment"] | GROUPS["notice"] | GROUPS["menu"] | GROUPS["side"]
#: Of a page's plain text of its own, the share that the root of its article holds.
MOST = 0.75
OFTEN = 0.05


def _own_text(x: Node) -> str:
    return " ".join(" ".join(p for p in x.parts if type(p) is str).split())


def _is_bad(x: Node) -> bool:
    return x.hidden or x.tag in BOILERPLATE or not x.names.isdisjoint(APART)


def _densest(nodes: list[Node], shared: frozenset[str]) -> Node | None:
    """Of a page without telling tags the root of its article: the deepest node that holds MOST of the text that is plain (no link, nothing
    apart) and the page's own (``shared`` has texts that other pages have too); None without such text."""
    plain, apart = np.zeros(len(nodes)), [False] * len(nodes)
    for i, x in enumerate(nodes):
        apart[i] = _is_bad(x) or x.tag == "a" or x.parent is not None and apart[x.parent.order]
        text = _own_text(x)
        if not apart[i] and text not in shared:
            plain[i] = len(text)
    total = plain.sum()
    if not total:
        return None
    for x in reversed(nodes[1:]):  # children before parents
        plain[x.parent.order] += plain[x.order]
    return max((x for x in nodes if plain[x.order] >= MOST * total), key=lambda x: (x.depth, -x.order))


def _teach(page: str, shared: frozenset[str] = frozenset()) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Features, labels and weights of a page's nodes. Labels come from its markup, or where it has no telling tag from what its text
    shares with other pages (see ``_densest``); None where that tells nothing either."""
    nodes = _walk(parse(page))
    marked = any(x.tag in ("article", "main") or "data-in" in x.names for x in nodes)
    root = None if marked else _densest(nodes, shared)
    if not marked and root is None:
        return None
    label = np.zeros(len(nodes))
    for i, x in enumerate(nodes[1:], 1):
        above = label[x.parent.order]
        if not marked:
            label[i] = 0 if _is_bad(x) else 1 if x is root else above
            continue
        label[i] = 0 if _is_bad(x) else 1 if x.tag in ("article", "main") else above
        if above == 0 and x.parent.tag not in ("#page", "html", "body", "div", "section"):
            label[i] = 0 if x.tag not in ("article", "main") else label[i]
    x, own = node_features(nodes)
    return x, label, (own > 0) * (0.5 + np.minimum(own, 400) / 200) + 0.05


INSERTS = (
    '<aside class="sidebar"><h3>{0}</h3><ul><li><a href="/a">{1}</a></li><li><a href="/b">{2}</a></li></ul></aside>',
    '<section class="comments"><h2>{0}</h2><div class="comment"><p>{1}</p></div><div class="comment"><p>{2}</p></div></section>',
    '<form action="/s"><label>{0}</label><input name="q"><button>{1}</button></form>',
    '<div class="cookie-notice" role="dialog"><p>{1}</p><button>{0}</button></div>',
    '<div class="ad sponsored"><a href="/x">{0}</a> {1}</div>',
    '<header><a href="/">{0}</a><p>{1}</p></header>',
    '<div class="related"><a href="/1">{0}</a> <a href="/2">{1}</a></div>',
    '<div id="menu"><a href="/1">{0}</a><a href="/2">{1}</a><a href="/3">{2}</a></div>',
)


def _altered(page: str, seed: int, texts: list[str], shared: frozenset[str] = frozenset()) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The page's lesson with boilerplate put in, and (half the time) the article's own tag hidden from the features."""
    rng = np.random.default_rng(seed)
    for _ in range(int(rng.integers(1, 4))):
        piece = INSERTS[int(rng.integers(len(INSERTS)))].format(*(entities.escape(texts[int(rng.integers(len(texts)))][: int(rng.integers(8, 240))]) for _ in range(3)))
        spots = [m.start() for m in re.finditer(r"<article|</article>|<p>|<footer", page)]
        if spots:
            at = spots[int(rng.integers(len(spots)))]
            page = page[:at] + piece + page[at:]
    got = _teach(page, shared)
    if got is not None and rng.random() < 0.5:
        groups = list(GROUPS)
        a = FEATURES - 2 * len(GROUPS) + groups.index("article")
        got[0][:, [a, a + len(GROUPS)]] = 0
    return got


def _sample(pages: DataFrame, id_col: str, html_col: str, max_pages: int, max_chars: int) -> list[str]:
    """The first ``max_pages`` pages by a hash, as long as they have ``max_chars`` characters together (a longer page is passed over)."""
    named = pages.where(F.length(html_col) <= max_chars).select(F.xxhash64(F.col(id_col).cast("string"), F.col(html_col)).alias("_h"), F.col(html_col).alias("_html"))
    first = named.groupBy("_h").agg(F.max(F.length("_html")).cast("long").alias("_n")).orderBy("_h").limit(max_pages)
    so_far = F.sum("_n").over(Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, 0))  # over at most max_pages rows
    chosen = first.withColumn("_upto", so_far).where((F.col("_upto") <= max_chars) | (F.col("_upto") == F.col("_n"))).select("_h")
    rows = named.join(F.broadcast(chosen), "_h", "left_semi").select("_html").distinct().collect()
    return sorted(r["_html"] for r in rows)


def shared_texts(pages: list[str]) -> frozenset[str]:
    """Own texts of nodes that two pages or more have, and more than OFTEN of all: copies of an article are rarer than a menu."""
    seen = Counter(t for p in pages for t in {_own_text(x) for x in _walk(parse(p))})
    return frozenset(t for t, n in seen.items() if t and n > max(1, OFTEN * len(pages)))


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 200, max_chars: int = 4_000_000, forms: int = 3) -> Trees | None:
    """Fit on a bounded sample (``max_pages``, ``max_chars`` together) that comes to the driver, of pages with telling markup, or of all pages
    where no page has it; each page as it is and in ``forms`` altered forms. None where no page has text to learn from."""
    sample, shared = _sample(pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]")), id_col, html_col, max_pages, max_chars), frozenset()
    if not sample:
        sample = _sample(pages.where(F.col(html_col).isNotNull()), id_col, html_col, max_pages, max_chars)
        shared = shared_texts(sample)
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", m)).split()) or "x" for p in sample for m in re.findall(r"<p>(.*?)</p>", p, re.S)[:3]] or ["x"]
    lessons = [x for p in sample if (x := _teach(p, shared)) is not None]
    lessons += [x for p in sample for k in range(forms) if (x := _altered(p, xxhash.xxh32_intdigest(p, k), texts, shared)) is not None]
    return boost(*(np.concatenate(c) for c in zip(*lessons, strict=True))) if lessons else None


def extract_text(pages: DataFrame, trees: Trees | None, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``. Without trees (no page had text) every element outside the boilerplate tags is kept."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            pages_, texts = b.column(1).to_pylist(), []
            for at in range(0, len(pages_), GROUP):
                texts += extract(pages_[at : at + GROUP], own)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["_row", "_text"])

    others = [c for c in pages.columns if c not in (out_col, html_col)]
    given = pages.select(F.struct(*[pages[f"`{c}`"] for c in others]).alias("_row"), pages[html_col].alias("_html"))
    done = given.mapInArrow(run, StructType([given.schema["_row"], StructField("_text", StringType())]))
    return done.select(*[F.col("_row")[c].alias(c) for c in others], F.col("_text").alias(out_col))
