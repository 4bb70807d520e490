"""HTML extraction by wrapper induction: pages of one host are aligned, what is constant is the template."""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import apart, importable, stage, whole

#: A node is template where its text is the same in this share of the other pages, of which there must be so many.
CONSTANT_SHARE, CONSTANT_PAGES = 0.8, 4
#: The layout of a page: the containers outside the main part, down to this depth.
LAYOUT_DEPTH = 4
CONTAINERS = frozenset("body div section main article header nav aside footer table form center".split())
#: A page without an article or main element that has more of its text in common with another is its copy.
COPY_SHARE = 0.8
#: Trees deeper than this are not aligned by `induce`.
ALIGN_DEPTH = 150

#: Elements whose text is never content (fixed values).
DROPPED = frozenset(
    "head nav header footer aside form button select option textarea label input fieldset dialog menu "
    "script style noscript template iframe object svg canvas video audio map title".split()
)
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul "
    "caption center".split()
)
#: Opening one of these ends an open one of those.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody"},
}
#: Words of a class, id or role that mark what is not the article (fixed values).
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar side rail widget menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer header masthead topbar toolbar comment comments commentlist respond reply replies "
    "disqus share sharing social related recommended recommendations newsletter subscribe subscription signup login "
    "search copyright disclaimer skip complementary contentinfo dialog".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


class Page:
    """The elements and text blocks of a page, in page order.

    An element is (parent, label, tag); a block is (element, text); dropped elements are listed without text.
    """

    def __init__(self, html: str):
        self.parent, self.label, self.tag, self.region = [-1], ["#"], ["#"], [0]
        #: How an element is marked by its class or id: not at all, by a part of a word (with-header), by a word (header).
        self.marked = [0]
        self.blocks: list[tuple[int, str]] = []
        self._read(html)
        self._drop_marked()

    def _read(self, html: str) -> None:
        stack, dropped, text, owner = [0], 0, [], 0
        depth_dropped: list[int] = []

        def flush():
            if text:
                line = " ".join(unescape("".join(text)).split())
                text.clear()
                if line:
                    self.blocks.append((owner, line))

        def close(upto: int):
            nonlocal dropped
            while len(stack) > upto:
                gone = stack.pop()
                if self.tag[gone] in BLOCKS or self.marked[gone]:
                    flush()
                if depth_dropped and depth_dropped[-1] == gone:
                    depth_dropped.pop()

        at, size = 0, len(html)
        while at < size:
            m = _TOKEN.search(html, at)
            upto = m.start() if m else size
            if upto > at and not depth_dropped:
                if not text:
                    owner = self._block_of(stack)
                text.append(html[at:upto])
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] == tag:
                        close(i)
                        break
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else size
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in BLOCKS:
                flush()
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] == "p":
                        close(i)
                        break
                    if self.tag[stack[i]] in BLOCKS:
                        break
            if tag in ENDS:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in ENDS[tag]:
                        close(i)
                    elif self.tag[stack[i]] in BLOCKS:
                        break
            if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
                continue
            names, main, off, marked = self._attributes(m[3], tag) if m[3] else ("", False, False, 0)
            element = len(self.parent)
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.label.append(f"{tag}{names}")
            inside = self.region[stack[-1]]
            self.region.append(inside or (element if tag in ("article", "main") or main else 0))
            if marked:
                flush()
            self.marked.append(marked)
            stack.append(element)
            if tag in DROPPED or off:
                flush()
                depth_dropped.append(element)
        close(0)
        flush()

    def _drop_marked(self) -> None:
        """Drop the text below marked elements, but for those that hold the main part.

        That is the heaviest article or main element that lies below no mark, or below one that is part of a word
        where it has more than twice the text, or below any where there is no other. On a page without such elements
        it is what has most of the text, unless it is marked by a word and leaves text outside.
        """
        if not any(self.marked):
            return
        count, size, under = len(self.parent), [0] * len(self.parent), self.marked[:]
        for e, line in self.blocks:
            size[e] += len(line)
        for e in range(count - 1, 0, -1):
            size[self.parent[e]] += size[e]
        for e in range(1, count):
            under[e] = max(under[e], under[self.parent[e]])
        best = [0, 0, 0]
        for e in range(1, count):
            if self.region[e] == e and size[e] > size[best[under[e]]] * bool(best[under[e]]):
                best[under[e]] = e
        clear, part, word = best
        held = part if part and size[part] > 2 * size[clear] * bool(clear) else clear or word
        if held:
            while held:
                self.marked[held] = 0
                held = self.parent[held]
        else:
            outside = any(not under[e] for e, _ in self.blocks)
            for e in range(1, count):
                if self.marked[e] and 2 * size[e] > size[0] and not (self.marked[e] == 2 and outside):
                    self.marked[e] = 0
        below = self.marked[:]
        for e in range(1, count):
            below[e] = below[e] or below[self.parent[e]]
        self.blocks = [b for b in self.blocks if not below[b[0]]]

    def _block_of(self, stack: list[int]) -> int:
        for e in reversed(stack):
            if self.tag[e] in BLOCKS or self.marked[e]:
                return e
        return 0

    @staticmethod
    def _attributes(raw: str, tag: str) -> tuple[str, bool, bool, int]:
        """(classes for the label, whether it marks the main part, whether it is not content, how it is marked).

        Nothing marks html, body and main; an article is marked by a whole word only.
        """
        names, main, off, marked = "", False, False, 0
        for name, value in _ATTR.findall(raw):
            name = name.lower()
            if name not in ("class", "id", "role", "itemprop", "hidden", "style"):
                continue
            value = unescape(value.strip("\"'")).lower()
            if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
                off = True
            elif name == "itemprop" or name == "role":
                main |= value in ("articlebody", "main")
                off |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
            elif name in ("class", "id"):
                if any(x in MARKS for x in value.split()):
                    marked = 2
                elif any(x in MARKS for x in _SPLIT.split(value)):
                    marked = max(marked, 1)
                if name == "class" and value:
                    names = "." + ".".join(sorted(value.split()))
        if main or tag in ("html", "body", "main") or tag == "article" and marked == 1:
            marked = 0
        return names, main, off and not main, marked

    def path(self, element: int) -> str:
        out = []
        while element > 0:
            out.append(self.label[element])
            element = self.parent[element]
        return "/".join(reversed(out))


class Node:
    __slots__ = ("label", "text", "children", "path", "up", "size")

    def __init__(self, label: str, path: str, up: int):
        self.label, self.path, self.up, self.text, self.children, self.size = label, path, up, "", [], 1


def tree(page: Page) -> Node | None:
    """The page's element tree with the text of each block's element; None if it is too deep to align."""
    keys = path_keys(page)
    nodes, depth = [Node("#", "", keys[0])], [0]
    for e in range(1, len(page.parent)):
        up = page.parent[e]
        depth.append(depth[up] + 1)
        if depth[e] > ALIGN_DEPTH:
            return None
        node = Node(page.label[e], f"{nodes[up].path}/{page.label[e]}".lstrip("/"), keys[up])
        nodes.append(node)
        nodes[up].children.append(node)
    for e, line in page.blocks:
        nodes[e].text = f"{nodes[e].text}\n{line}" if nodes[e].text else line
    return nodes[0]


def match_trees(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the largest number of nodes aligned under equal labels and in order, and the pairs.

    Equal texts count once more, so that constant nodes are aligned with each other.
    """
    if a.label != b.label:
        return 0, []
    m, n = len(a.children), len(b.children)
    score = [[0] * (n + 1) for _ in range(m + 1)]
    below = {}
    for i in range(m):
        for j in range(n):
            w, pairs = match_trees(a.children[i], b.children[j])
            if w:
                below[i, j] = w, pairs
            score[i + 1][j + 1] = max(score[i][j + 1], score[i + 1][j], score[i][j] + w)
    out, i, j = [(a, b)], m, n
    while i and j:
        w, pairs = below.get((i - 1, j - 1), (0, []))
        if w and score[i][j] == score[i - 1][j - 1] + w:
            out += pairs
            i, j = i - 1, j - 1
        elif score[i][j] == score[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return score[m][n] + 1 + (bool(a.text) and a.text == b.text), out


def induce(htmls: list[str]) -> dict:
    """The wrapper of a few pages of a host: the constant nodes (path and text), and the key of the path below which
    texts vary most. The pages of a table go through `wrappers`.

    Each page is aligned with the page of middle size. Pages that agree with it in most of their text are its
    copies and say nothing about the template, so they don't count.
    """
    trees = [t for t in (tree(Page(h)) for h in dict.fromkeys(htmls)) if t]
    if len(trees) < 2:
        return {"constant": [], "root": 0}
    chars = lambda t: sum(len(x.text) for x in _walk(t))
    trees.sort(key=lambda t: (chars(t), t.path))
    base = trees.pop(len(trees) // 2)
    same, aligned, varied = Counter(), 0, Counter()
    total = max(1, chars(base))
    for other in trees:
        _, pairs = match_trees(base, other)
        equal = [x for x, y in pairs if x.text and x.text == y.text]
        if sum(len(x.text) for x in equal) > COPY_SHARE * min(total, max(1, chars(other))):
            continue
        aligned += 1
        same.update({id(x): 1 for x in equal})
        for x, y in pairs:
            if x.text and x.text != y.text:
                varied[x.up] += len(x.text)
    constant = [
        [x.path, x.text]
        for x in _walk(base)
        if aligned >= CONSTANT_PAGES and same[id(x)] >= CONSTANT_SHARE * aligned
    ]
    return {"constant": constant, "root": max(sorted(varied), key=varied.get, default=0)}


def _walk(node: Node):
    todo = [node]
    while todo:
        x = todo.pop()
        yield x
        todo += reversed(x.children)


def _hash(*parts: int | str) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def path_keys(page: Page) -> list[int]:
    """A hash of each element's path."""
    keys = [_hash("")]
    for e in range(1, len(page.parent)):
        keys.append(_hash(keys[page.parent[e]], page.label[e]))
    return keys


def main_part(page: Page) -> int:
    """The article or main element with the most text; 0 if there is none."""
    weight = Counter()
    for e, line in page.blocks:
        if page.region[e]:
            weight[page.region[e]] += len(line)
    return max(weight, key=lambda r: (weight[r], -r), default=0)


def nodes(page: Page) -> tuple[int, int, list[tuple[int, int, int, int]]]:
    """(layout, article, blocks): hashes of the page's layout and of the text of its article part, and of each block
    (key, path, up, chars): hashes of its path and text, of its path and of the path above, and the length of its text.
    The article part is the main part; without one, the longest blocks that make up COPY_SHARE of the text.
    """
    paths, depth = path_keys(page), [0]
    shape = set()
    for e in range(1, len(page.parent)):
        depth.append(depth[page.parent[e]] + 1)
        if depth[e] <= LAYOUT_DEPTH and page.tag[e] in CONTAINERS and page.region[e] in (0, e):
            shape.add(paths[e])
    chosen = main_part(page)
    if chosen:
        part = [line for e, line in page.blocks if page.region[e] == chosen]
    else:
        part, left = [], COPY_SHARE * sum(len(line) for _, line in page.blocks)
        for line in sorted((line for _, line in page.blocks), key=lambda x: (-len(x), x)):
            if left < 0:
                break
            part.append(line)
            left -= len(line)
    blocks = [(_hash(paths[e], line), paths[e], paths[max(page.parent[e], 0)], len(line)) for e, line in page.blocks]
    return _hash(*sorted(shape)), _hash(*part), blocks


def _below(page: Page, path: int) -> list[bool]:
    """Whether each element has this path or lies below one that has."""
    below = []
    for e, key in enumerate(path_keys(page)):
        below.append(key == path or e > 0 and below[page.parent[e]])
    return below


def main_text(html: str, wrapper: dict) -> str:
    """The varying blocks of the main part: an article or main element, else the wrapper's root, else all content."""
    page = Page(html)
    if layouts := wrapper.get("layouts"):
        layout, _, found = nodes(page)
        fixed = layouts.get("", frozenset()) | layouts.get(str(layout), frozenset())
        page.blocks = [b for b, (key, *_) in zip(page.blocks, found) if key not in fixed]
    chosen = main_part(page)
    blocks = [b for b in page.blocks if page.region[b[0]] == chosen] if chosen else page.blocks
    constant, root = wrapper["constant"], wrapper["root"]
    if not chosen and root:
        below = _below(page, root)
        blocks = [b for b in blocks if below[b[0]]] or blocks
    paths = {e: page.path(e) for e in {e for e, _ in blocks}} if constant else {}
    return "\n".join(line for e, line in blocks if not constant or (paths[e], line) not in constant)


@lru_cache(512)
def _wrapper(text: str | None) -> dict:
    got = json.loads(text) if text else {}
    lines = {(path, line) for path, node in got.get("constant", ()) for line in node.split("\n")}
    layouts = {layout: frozenset(keys) for layout, keys in (got.get("layouts") or {}).items()}
    return {"constant": lines, "root": got.get("root", 0), "layouts": layouts}


_BLOCK = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("path", T.LongType()),
        T.StructField("up", T.LongType()),
        T.StructField("chars", T.LongType()),
        #: Whether it is the page's first block of its path.
        T.StructField("first", T.BooleanType()),
    ]
)
_NODES = T.StructType(
    [
        T.StructField("layout", T.LongType()),
        T.StructField("article", T.LongType()),
        T.StructField("blocks", T.ArrayType(_BLOCK)),
    ]
)
_ARROW_BLOCK = pa.struct(
    [("key", pa.int64()), ("path", pa.int64()), ("up", pa.int64()), ("chars", pa.int64()), ("first", pa.bool_())]
)
_ARROW_NODES = pa.struct([("layout", pa.int64()), ("article", pa.int64()), ("blocks", pa.list_(_ARROW_BLOCK))])


def _node_row(html: str) -> dict:
    """The page's nodes as one row; a text that its path holds more than once counts as one block."""
    layout, article, blocks = nodes(Page(html))
    paths, rows = set(), []
    for key, path, up, chars in dict.fromkeys(blocks):
        rows.append({"key": key, "path": path, "up": up, "chars": chars, "first": path not in paths})
        paths.add(path)
    return {"layout": layout, "article": article, "blocks": rows}


@F.arrow_udf(_NODES)
def _nodes(htmls: pa.Array) -> pa.Array:
    return pa.array([_node_row(h.as_py() or "") for h in htmls], _ARROW_NODES)


@F.arrow_udf(T.StringType())
def _extract(htmls: pa.Array, wrappers: pa.Array) -> pa.Array:
    return pa.array([main_text(h.as_py() or "", _wrapper(w.as_py())) for h, w in zip(htmls, wrappers)], pa.string())


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def distinct_pages(rows: DataFrame) -> DataFrame:
    """(host, layout, blocks), staged: pages of a layout with the same article part are copies and count as one."""
    found = rows.select("host", F.xxhash64("html").alias("draw"), _nodes("html").alias("n"))
    found = found.select("host", "n.layout", "n.article", F.struct("draw", "n.blocks").alias("page"))
    distinct = found.groupBy("host", "layout", "article").agg(F.min("page").alias("page"))
    return stage(distinct.select("host", "layout", "page.blocks"), "page-nodes")


def constants(distinct: DataFrame) -> DataFrame:
    """(host, layouts): for each layout, and under an empty name for the host as a whole, the keys of its constant nodes.

    Counted over all distinct pages.
    """
    keys = distinct.select("host", "layout", F.explode("blocks.key").alias("key"))
    counts = keys.groupBy("host", "layout", "key").agg(F.count(F.lit(1)).alias("n"))
    sizes = distinct.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("pages"))
    of_all = lambda x, *key: x.groupBy("host", *key).agg(F.sum(x.columns[-1]).alias(x.columns[-1]))

    def fixed(counts: DataFrame, sizes: DataFrame, on: list[str]) -> DataFrame:
        # a page is compared with the others, so it is not among those that must agree
        sizes = sizes.where(F.col("pages") > CONSTANT_PAGES)
        return counts.join(sizes, on).where(F.col("n") - 1 >= CONSTANT_SHARE * (F.col("pages") - 1))

    by_layout = fixed(counts, sizes, ["host", "layout"]).select("host", F.col("layout").cast("string"), "key")
    by_host = fixed(of_all(counts, "key"), of_all(sizes), ["host"]).select("host", F.lit("").alias("layout"), "key")
    each = by_layout.union(by_host).groupBy("host", "layout").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    return each.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("layout", "keys"))).alias("layouts"))


def roots(distinct: DataFrame) -> DataFrame:
    """(host, root): the key of the path below which texts vary most, over all distinct pages of the host.

    Every page is compared with every other page that has text at the same path: the texts of the one that the other
    lacks there vary, by their length. No pair is formed: of P pages with a path, n with a text, that is n * (P - n)
    times its length. Hosts whose texts don't vary have no row; of equal paths the smallest key wins.
    """
    blocks = distinct.select("host", F.explode("blocks").alias("b")).select("host", "b.*")
    texts = blocks.groupBy("host", "key").agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("n"),
        F.count_if("first").alias("firsts"),
        *[F.min(c).alias(c) for c in ("path", "up", "chars")],
    )
    held = F.col("n") * F.col("chars")
    paths = texts.groupBy("host", "path").agg(
        F.min("up").alias("up"),
        (F.sum("firsts") * F.sum(held) - F.sum(F.col("n") * held)).alias("varied"),
    )
    below = paths.groupBy("host", "up").agg(F.sum("varied").alias("varied")).where(F.col("varied") > 0)
    most = below.groupBy("host").agg(F.min(F.struct((-F.col("varied")).alias("less"), "up")).alias("most"))
    return most.select("host", F.col("most.up").alias("root"))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): one row per host, its constant nodes and its root, both counted over all pages."""
    rows = pages.select(host(F.col(url_col)).alias("host"), whole(html_col).alias("html"))
    distinct = distinct_pages(rows)
    both = roots(distinct).join(constants(distinct), "host", "full_outer")
    return both.select("host", F.to_json(F.struct(F.coalesce("root", F.lit(0)).alias("root"), "layouts")).alias("wrapper"))


def with_text(pages: DataFrame, out: str = "text", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The pages with their main text; null, empty and contentless pages get an empty text.

    Blocks are in page order, one a line; character references are decoded, white space in a block is one space.
    Pages of a host that has too few others to align, or no host, are cut by their own structure alone. Repeated
    rows get the same text. Wrappers are staged, so that Spark joins them without moving pages while they are small.
    """
    name, wrapper = apart(pages.columns, "host", "wrapper")
    known = stage(wrappers(importable(pages), url_col, html_col).toDF(name, wrapper), "wrappers")
    found = pages.join(known, host(pages[url_col]) == known[name], "left")
    return found.withColumn(out, _extract(whole(html_col), F.coalesce(wrapper, F.lit("")))).drop(name, wrapper)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    return with_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
