"""Main text of web pages by wrapper induction.

The pages of a host come from the same templates. Each page's DOM tree is aligned with that
of the host's sample page (its smallest page id) by simple tree matching: the largest
number of node pairs with equal tags that keeps parents and the order of siblings. Over all
pages of the host, a text node of the sample that carries the same text wherever it is
aligned is part of the template; nodes whose texts vary are slots. The main text of a page
is its slots inside the article region: the article or main element where a page has one,
else the body, without navigation, headers, footers, asides, notices, adverts, forms,
scripts, styles and comments.

A node counts as constant only with ``LEAST_PAGES`` aligned pages of which ``SAME_SHARE``
agree, and constants are not cut from a page that they make up for the most part (pages that
are copies of each other have no template to tell). Alignment is done page by page next to
the sample page; counts are added up per host and node, so a host with a third of all pages
is spread over tasks.

Defined cases: a null or empty html gives an empty text; a null or strange url is a host of
its own kind (the empty host); repeated rows are pages of their own; pages without an id are
returned; markup may be cut off, unbalanced anywhere and nested to any depth; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.skew import attach

LEAST_PAGES = 8
SAME_SHARE = 0.9
#: Characters of sample pages, and of templates, that are broadcast; more are joined by a shuffle.
BROADCAST_CHARS = 16 << 20
#: Parsed sample pages that a task keeps at hand.
KNOWN_SAMPLES = 256
#: Cells of a table of two child lists that is held at once.
TABLE_CELLS = 1 << 20

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg math iframe object canvas textarea title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
NOISE_TAGS = set("nav footer aside form button select dialog menu head".split())
NOISE_NAMES = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer\w*|header|masthead|"
    r"comments?|disqus\w*|replies|respond|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|sharing|social|related|"
    r"recommended|widget\w*|skip|toolbar|pagination|pager|login|signup)(?:$|[\s_-])"
)
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: Start tags that end an open element of the listed kinds.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
ENDS_PARAGRAPH = set(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)
SCOPES = {"html", "body", "table", "td", "th", "article", "section", "div", "main", "aside", "nav", "ul", "ol"}


class Node:
    __slots__ = ("tag", "zone", "kids", "text", "number", "shape", "weight")

    def __init__(self, tag: str, zone: int):
        self.tag, self.zone, self.kids, self.text, self.number = tag, zone, [], "", -1


PLAIN, MAIN, NOISE = 0, 1, 2


def _zone(tag: str, attributes: str, parent: Node) -> int:
    """Zone of an element: noise stays noise, a main region begins at an article or main element."""
    if parent.zone == NOISE or tag in NOISE_TAGS or (tag == "header" and parent.zone != MAIN):
        return NOISE
    found = {}
    if attributes and not attributes.isspace():
        found = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(attributes)}
    named = f"{found.get('class', '')} {found.get('id', '')}"
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    if hidden or role in NOISE_ROLES or (tag not in ("body", "html") and named != " " and NOISE_NAMES.search(named)):
        return NOISE
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
        return MAIN
    return parent.zone


def parse(markup: str) -> Node:
    """DOM tree of a page; text nodes have the tag ``#`` and their raw text."""
    root = Node("html", PLAIN)
    stack = [root]
    pos, n = 0, len(markup)

    def add_text(a: int, b: int):
        if b > a:
            node = Node("#", stack[-1].zone)
            node.text = markup[a:b]
            stack[-1].kids.append(node)

    while pos < n:
        m = _TOKEN.search(markup, pos)
        if m is None:
            add_text(pos, n)
            break
        add_text(pos, m.start())
        pos = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in ("html", "body") and tag != "body":
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s>/]|</{re.escape(tag)}\Z", re.I).search(markup, pos)
                pos = end.start() if end else n
            continue
        if tag in ENDS_PARAGRAPH:
            _close(stack, {"p"})
        if tag in CLOSES:
            _close(stack, CLOSES[tag])
        node = Node(tag, _zone(tag, m[3], stack[-1]))
        stack[-1].kids.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag not in INLINE:
            stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in SCOPES:
            return


def number(root: Node) -> list[Node]:
    """Number the nodes in document order; give each its shape (tags only) and size."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.number = len(order)
        order.append(node)
        todo.extend(reversed(node.kids))
    for node in reversed(order):
        node.weight = 1 + sum(k.weight for k in node.kids)
        node.shape = hash((node.tag, *(k.shape for k in node.kids)))
    return order


def align(a: Node, b: Node) -> dict[int, int]:
    """Simple tree matching of two numbered trees: number in ``a`` -> number in ``b``.

    The matching of two nodes depends on their shapes alone, so it is worked out once for each
    pair of shapes, children first and on a stack of its own: trees may be of any depth.
    """
    if a.tag != b.tag:
        return {}
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    todo = [(a, b)]
    while todo:
        x, y = todo[-1]
        if x.shape == y.shape or (x.shape, y.shape) in known:
            todo.pop()
            continue
        head, tail = _equal_ends(x.kids, y.kids)
        firsts = {k.shape: k for k in x.kids[head : len(x.kids) - tail]}
        seconds = {k.shape: k for k in y.kids[head : len(y.kids) - tail]}
        missing = [
            (i, j)
            for i in firsts.values()
            for j in seconds.values()
            if i.tag == j.tag and i.shape != j.shape and (i.shape, j.shape) not in known
        ]
        if missing:
            todo.extend(missing)
            continue
        known[x.shape, y.shape] = _children(x.kids, y.kids, head, tail, firsts, seconds, known)
        todo.pop()
    out: dict[int, int] = {}
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        out[x.number] = y.number
        if x.shape == y.shape:
            todo.extend(zip(x.kids, y.kids, strict=True))
        else:
            todo.extend((x.kids[i], y.kids[j]) for i, j in known[x.shape, y.shape][1])
    return out


def _equal_ends(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
    """Number of leading and of trailing children of equal shapes: they reach the largest weight either can have."""
    head, shorter = 0, min(len(xs), len(ys))
    while head < shorter and xs[head].shape == ys[head].shape:
        head += 1
    tail = 0
    while tail < shorter - head and xs[-1 - tail].shape == ys[-1 - tail].shape:
        tail += 1
    return head, tail


def _children(xs, ys, head: int, tail: int, firsts: dict, seconds: dict, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Weight of two nodes and the places of their children in the best order-keeping match."""
    pairs = [(i, i) for i in range(head)] + [(len(xs) - 1 - i, len(ys) - 1 - i) for i in range(tail)]
    total = 1 + sum(xs[i].weight for i, _ in pairs)
    if len(xs) == head + tail or len(ys) == head + tail:
        return total, pairs
    weight = np.zeros((len(firsts), len(seconds)), np.int64)
    for i, x in enumerate(firsts.values()):
        for j, y in enumerate(seconds.values()):
            if x.tag == y.tag:
                weight[i, j] = x.weight if x.shape == y.shape else known[x.shape, y.shape][0]
    of_x, of_y = ({shape: n for n, shape in enumerate(kinds)} for kinds in (firsts, seconds))
    left = np.array([of_x[k.shape] for k in xs[head : len(xs) - tail]])
    right = np.array([of_y[k.shape] for k in ys[head : len(ys) - tail]])
    best, middle = _best_order(weight, left, right)
    return total + best, pairs + [(head + i, head + j) for i, j in middle]


def _rows(weight: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Rows of the table of best weights of beginnings of ``left`` and ``right``, one for each length of ``left``."""
    row = np.zeros(len(right) + 1, np.int64)
    yield row
    for kind in left:
        own = weight[kind][right]
        both = np.where(own > 0, row[:-1] + own, 0)
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(row[1:], both))])
        yield row


def _best_order(weight: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """Largest weight and places of an order-keeping match; long lists are halved until a table has ``TABLE_CELLS``."""
    total, pairs = 0, []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if (b - a) * (d - c) > TABLE_CELLS and b - a > 1:
            half = (a + b) // 2
            for first in _rows(weight, left[a:half], right[c:d]):
                pass
            for second in _rows(weight, left[half:b][::-1], right[c:d][::-1]):
                pass
            cut = c + int(np.argmax(first + second[::-1]))
            todo += [(a, half, c, cut), (half, b, cut, d)]
            continue
        table = np.stack(list(_rows(weight, left[a:b], right[c:d])))
        total += int(table[-1, -1])
        i, j = b - a, d - c
        while i and j:
            if table[i, j] == table[i - 1, j]:
                i -= 1
            elif table[i, j] == table[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((a + i, c + j))
    return total, pairs


def text_blocks(root: Node) -> list[tuple[str, int, list[Node]]]:
    """(text, zone, text nodes) of the page's blocks in order: runs of inline content between block elements."""
    out: list[tuple[str, int, list[Node]]] = []
    parts: list[str] = []
    nodes: list[Node] = []
    zone = PLAIN

    def flush():
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append((text, zone, list(nodes)))
            parts.clear()
            nodes.clear()

    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        if node.tag == "#":
            if nodes and node.zone != zone:
                flush()
            zone = node.zone
            parts.append(node.text)
            nodes.append(node)
            continue
        if node.tag not in INLINE:
            flush()
        elif node.tag in ("br", "wbr") and not leaving:
            parts.append(" ") if node.tag == "br" and parts else None
        if leaving:
            continue
        todo.append((node, True))
        todo.extend((k, False) for k in reversed(node.kids))
    flush()
    return out


def _plain(node: Node) -> str:
    return _SPACE.sub(" ", entities.unescape(node.text)).strip()


PAGE = "page_id bigint, url string, host string, self boolean, blocks array<struct<text:string,zone:int,node:int,same:boolean>>"
_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("zone", pa.int32()), ("node", pa.int32()), ("same", pa.bool_())]))


def page_blocks(root: Node, sample: list[Node] | None) -> list[dict]:
    """Blocks of a page; ``node`` is the aligned text node of the sample page, -1 without one."""
    number(root)
    partner = align(root, sample[0]) if sample else {}
    out = []
    for text, zone, nodes in text_blocks(root):
        first = next((partner[n.number] for n in nodes if n.number in partner and _plain(n)), -1)
        # a text without a partner is nowhere in the sample's block: the block is not the template's
        same = first >= 0 and all(_plain(sample[partner[n.number]]) == _plain(n) if n.number in partner else not _plain(n) for n in nodes)
        out.append({"text": text, "zone": zone, "node": first, "same": same})
    return out


def _aligner(batches):
    samples: dict[str, list[Node]] = {}
    for batch in batches:
        for at in range(0, len(batch), 500):
            rows, piece = [], batch.slice(at, 500)
            names = ("page_id", "host", "html", "sample_id", "sample")
            for page_id, name, html, sample_id, first in zip(*(piece.column(c).to_pylist() for c in names), strict=True):
                if name not in samples:
                    if len(samples) >= KNOWN_SAMPLES:
                        samples.clear()
                    samples[name] = number(parse(first or ""))
                own = page_id is not None and page_id == sample_id
                rows.append((own, page_blocks(parse(html or ""), samples[name])))
            own, found = zip(*rows, strict=True)
            arrays = [piece.column("page_id").cast(pa.int64()), piece.column("url"), piece.column("host")]
            arrays += [pa.array(own, pa.bool_()), pa.array(found, _BLOCKS)]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "host", "self", "blocks"])


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def aligned(pages: DataFrame) -> DataFrame:
    """Blocks of each page next to the sample page of its host."""
    rows = pages.select(F.col("page_id").cast("bigint"), "url", host_of().alias("host"), "html")
    sample = rows.groupBy("host").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("s"))
    sample = stored(sample.select("host", F.col("s.page_id").alias("sample_id"), F.col("s.html").alias("sample")), "samples")
    size = sample.agg(F.coalesce(F.sum(F.length("sample") + F.length("host") + 64), F.lit(0)).alias("n")).first().n
    both = rows.join(F.broadcast(sample), "host", "left") if size <= BROADCAST_CHARS else attach(rows, sample, ["host"])
    return stored(both.mapInArrow(_aligner, PAGE), "page-blocks")


def templates(blocks: DataFrame, least_pages: int = LEAST_PAGES, share: float = SAME_SHARE) -> DataFrame:
    """``host`` and ``constant``, the numbers of the sample page's text nodes that are template."""
    seen = blocks.where("not self").select("host", F.explode("blocks").alias("b")).where("b.node >= 0")
    seen = seen.groupBy("host", "b.node").agg(F.count("*").alias("n"), F.avg(F.col("b.same").cast("double")).alias("same"))
    kept = seen.where((F.col("n") >= least_pages) & (F.col("same") >= share))
    return kept.groupBy("host").agg(F.collect_list("node").alias("constant"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, the main ``text`` and its number of characters for each of ``pages`` (page_id, url, html)."""
    blocks = aligned(pages)
    known = stored(templates(blocks), "templates")
    size = known.agg(F.coalesce(F.sum(F.size("constant") + F.length("host") + 16), F.lit(0)).alias("n")).first().n
    rows = blocks.join(F.broadcast(known), "host", "left") if size <= BROADCAST_CHARS else attach(blocks, known, ["host"])
    constant = F.coalesce("constant", F.array().cast("array<int>"))
    region = F.filter("blocks", lambda b: b.zone == MAIN)
    body = F.filter("blocks", lambda b: b.zone != NOISE)
    rows = rows.select("page_id", "url", constant.alias("constant"), F.when(F.size(region) > 0, region).otherwise(body).alias("blocks"))
    varying = F.filter("blocks", lambda b: ~(b.same & F.array_contains("constant", b.node)))
    chars = lambda c: F.aggregate(c, F.lit(0), lambda s, b: s + F.length(b.text))
    rows = rows.withColumn("slots", varying)
    most = 2 * chars("slots") >= chars("blocks")
    text = F.array_join(F.transform(F.when(most, F.col("slots")).otherwise(F.col("blocks")), lambda b: b.text), "\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
