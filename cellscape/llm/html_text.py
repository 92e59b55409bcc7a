"""Main text of web pages by wrapper induction.

Pages of a host are aligned two by two, each with its neighbour before and after: simple tree matching pairs
nodes of equal tags in order, top down, so that the number of pairs is largest.  Paired nodes with equal text
are the host's template, paired nodes with other text are its slots.  The main text of a page is its article
(or main) element, or the body without either, less the template and less the parts that HTML itself names as
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.

Hosts are dealt out whole up to a size; larger ones are split by a hash of the page.  A page is only ever
compared with its neighbours, so that work and memory do not grow with the host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm.stage import small_batches

#: At most so many hosts are split, so that their list is small.
MOST_HOSTS = 10_000
LEAST_SPLIT = 256
#: Sibling lists of up to so many pairs are matched in one table, longer ones by rows of it that are halved
#: until a part is that small.  Both are exact.
MOST_PAIRS = 2_500

# Roles that HTML gives to elements.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object|canvas|audio|video)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.I | re.S)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
NOISE_TAGS = set("head title nav header footer aside form button menu dialog".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NOISE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|header|masthead|topbar"
    r"|cookies?|consent|gdpr|notices?|notification\w*|popup|modal|newsletter|subscribe|signup|login|share|sharing|social"
    r"|comments?|commentlist|replies|reply|disqus|respond|related|recommend\w*|widget\w*|toolbar|pagination|pager|skip)(?:$|[\s_-])", re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# prose of an article is main text even where the next page happens to have the same line
PROSE = set("root article main p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th".split())
ARTICLE_SAFE = {"article", "main", "body", "html"}


class Node:
    __slots__ = ("tag", "noise", "children", "constant", "slot", "text")

    def __init__(self, tag: str, noise: bool = False):
        self.tag, self.noise = tag, noise
        self.children: list = []  # nodes and strings
        self.constant = self.slot = 0
        self.text = ""


def _is_noise(tag: str, attributes: str) -> bool:
    if tag in NOISE_TAGS:
        return True
    if not attributes or tag in ARTICLE_SAFE:
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in NOISE_ROLES:
            return True
        if name in ("class", "id") and NOISE_WORDS.search(value):
            return True
    return False


def parse(page: str) -> Node:
    """The page's tree; unclosed elements end where HTML ends them, stray end tags are ignored."""
    root = Node("root")
    stack, at = [root], 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            stack[-1].children.append(page[at: m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if page.startswith("<![CDATA[", m.start()):
                stack[-1].children.append(page[m.start() + 9: m.end()].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        elif tag in SAME:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SCOPE[tag]:
                    break
                if stack[k].tag in SAME[tag]:
                    del stack[k:]
                    break
        node = Node(tag, _is_noise(tag, m[4]))
        stack[-1].children.append(node)
        if tag not in VOID and not m[4].endswith("/"):
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def blocks(root: Node) -> list[tuple[str, Node]]:
    """Text blocks in page order with the block element that holds each; noise is left out."""
    out: list[tuple[str, Node]] = []
    held: list[str] = []

    def close(owner: Node) -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, owner))

    todo: list = [(root, root, False)]
    while todo:
        node, owner, leaving = todo.pop()
        if leaving:
            close(owner)
        elif isinstance(node, str):
            held.append(node)
        elif node.tag == "br" or node.tag == "wbr":
            held.append(" " if node.tag == "br" else "")
        elif not node.noise:
            inline = node.tag in INLINE
            if not inline:
                close(owner)
                todo.append((node, node, True))
                owner = node
            todo.extend((c, owner, False) for c in reversed(node.children))
        elif node.tag not in INLINE:
            close(owner)
    close(root)
    return out


def _elements(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str) and c.tag not in INLINE and not c.noise]


def _size(node: Node) -> int:
    todo, n = [node], 0
    while todo:
        n += 1
        todo.extend(_elements(todo.pop()))
    return n


def _pairs(a: list[Node], b: list[Node]) -> list[tuple[Node, Node]]:
    """Siblings paired in order, the most of them; equal leaves at both ends pair without a search."""
    lo, out = 0, []
    leaf = lambda n: not _elements(n)
    while lo < min(len(a), len(b)) and a[lo].tag == b[lo].tag and leaf(a[lo]) == leaf(b[lo]):
        out.append((a[lo], b[lo]))
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi].tag == b[-1 - hi].tag and leaf(a[-1 - hi]) == leaf(b[-1 - hi]):
        out.append((a[-1 - hi], b[-1 - hi]))
        hi += 1
    a, b = a[lo: len(a) - hi], b[lo: len(b) - hi]
    if not a or not b:
        return out
    sizes = [_size(x) for x in a], [_size(y) for y in b]
    names = {tag: k for k, tag in enumerate({n.tag for n in (*a, *b)})}
    tags = [np.array([names[n.tag] for n in nodes]) for nodes in (a, b)]
    return out + [(a[i], b[j]) for i, j in _match(tags[0], np.array(sizes[0]), tags[1], np.array(sizes[1]))]


def _gain_row(tag: int, size: int, tags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What pairing one node with each of the others adds, 0 where the tags differ."""
    return np.where(tags == tag, np.minimum(sizes, size), 0)


def _best_row(tags_a: np.ndarray, sizes_a: np.ndarray, tags_b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """The largest gain of all of ``a`` with every tail of ``b``, by rows of the table."""
    best = np.zeros(len(tags_b) + 1, dtype=np.int64)
    for i in range(len(tags_a) - 1, -1, -1):
        gain = _gain_row(tags_a[i], sizes_a[i], tags_b, sizes_b)
        best[:-1] = np.maximum(best[:-1], np.where(gain > 0, gain + best[1:], 0))
        best = np.maximum.accumulate(best[::-1])[::-1]
    return best


def _match(tags_a: np.ndarray, sizes_a: np.ndarray, tags_b: np.ndarray, sizes_b: np.ndarray) -> list[tuple[int, int]]:
    """Places paired in order with the largest gain.  Space follows the longer list, not the number of pairs."""
    out, todo = [], [(0, len(tags_a), 0, len(tags_b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) <= MOST_PAIRS:
            out += _match_table(a0, a1, b0, b1, tags_a, sizes_a, tags_b, sizes_b)
        elif a1 - a0 == 1:
            gain = _gain_row(tags_a[a0], sizes_a[a0], tags_b[b0:b1], sizes_b[b0:b1])
            if gain.any():
                out.append((a0, b0 + int(gain.argmax())))
        else:
            # the best way passes the middle row where what comes before and what comes after add up to most
            middle = (a0 + a1) // 2
            after = _best_row(tags_a[middle:a1], sizes_a[middle:a1], tags_b[b0:b1], sizes_b[b0:b1])
            turned = [x[lo:hi][::-1] for x, lo, hi in ((tags_a, a0, middle), (sizes_a, a0, middle), (tags_b, b0, b1), (sizes_b, b0, b1))]
            cut = b0 + int((_best_row(*turned)[::-1] + after).argmax())
            todo += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
    return sorted(out)


def _match_table(a0: int, a1: int, b0: int, b1: int, tags_a, sizes_a, tags_b, sizes_b) -> list[tuple[int, int]]:
    gain = [_gain_row(tags_a[i], sizes_a[i], tags_b[b0:b1], sizes_b[b0:b1]).tolist() for i in range(a0, a1)]
    n, m, out = a1 - a0, b1 - b0, []
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], gain[i][j] + best[i + 1][j + 1] if gain[i][j] else 0)
    i = j = 0
    while i < n and j < m:
        if gain[i][j] and best[i][j] == gain[i][j] + best[i + 1][j + 1]:
            out.append((a0 + i, b0 + j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def align(a: Node, b: Node) -> None:
    """Mark paired nodes of two pages as constant or slot, unless the pages are copies of each other."""
    todo, pairs = [(a, b)], []
    while todo:
        x, y = todo.pop()
        if x.text or y.text:
            pairs.append((x, y))
        todo.extend(_pairs(_elements(x), _elements(y)))
    equal = sum(len(x.text) for x, y in pairs if x.text == y.text)
    if 2 * equal >= max(sum(len(x.text) for x, _ in pairs), 1):
        return
    for x, y in pairs:
        if x.text == y.text:
            x.constant += 1
            y.constant += 1
        else:
            x.slot += 1
            y.slot += 1


class Page:
    def __init__(self, source: str):
        tree = parse(source)
        self.root = _article(tree)
        self.article = self.root is not tree
        self.blocks = blocks(self.root)
        for text, owner in self.blocks:
            owner.text = f"{owner.text}\n{text}" if owner.text else text

    def content(self) -> str:
        return "\n".join(text for text, owner in self.blocks
                         if not owner.constant or owner.slot or (self.article and owner.tag in PROSE))


def _article(tree: Node) -> Node:
    """The part of the tree that can hold main text: all articles outside others, else main, else the page."""
    for tag in ("article", "main"):
        found, todo = [], [tree]
        while todo:
            node = todo.pop()
            if node.tag == tag:
                found.append(node)
            elif not node.noise:
                todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
        if found:
            root = Node("root")
            root.children = found
            return root
    return tree


def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of pages sorted by host and part; each is aligned with the one before and the one after."""
    held: tuple | None = None
    for batch in batches:
        out: list[tuple] = []
        for page, url, host, part, source in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "part", "html"))):
            now = (page, url, (host, part), Page(source or ""))
            if held is not None:
                if host is not None and held[2] == now[2]:
                    align(held[3].root, now[3].root)
                out.append((held[0], held[1], held[3].content()))
            held = now
        yield _rows(out)
    if held is not None:
        yield _rows([(held[0], held[1], held[3].content())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                                      ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)``, one row for each row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block is one space, blocks are joined by line
    breaks.  Null or empty html: empty text.  A null url or one without a host: the page is aligned with no
    other.  Repeated rows: each is a page; copies are no evidence for a template.  Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                         F.lower(F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]+)", 1), F.lit(""))).alias("host"), "html")
    number = plain.select("host").groupBy("host").count()
    # so many hosts at most have more than total / MOST_HOSTS pages
    large = (number.groupBy().agg(F.greatest(F.lit(float(LEAST_SPLIT)), F.sum("count") / MOST_HOSTS).alias("most")).first()["most"]) or LEAST_SPLIT
    split = number.where((F.col("count") > large) & F.col("host").isNotNull()).select("host", F.ceil(F.col("count") / large).cast("int").alias("parts"))
    dealt = (plain.join(F.broadcast(split), "host", "left")
             .withColumn("part", F.when(F.col("host").isNull(), F.pmod(F.xxhash64("page_id"), F.lit(1024)))
                         .otherwise(F.pmod(F.xxhash64("page_id"), F.coalesce("parts", F.lit(1)))).cast("int")))
    return (dealt.select("page_id", "url", "host", "part", "html").repartition("host", "part")
            .sortWithinPartitions("host", "part", "page_id", "url").mapInArrow(extract, "page_id long, url string, text string"))
