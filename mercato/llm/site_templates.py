"""Main text of web pages with site template removal (operator 4).

Pages are read by a small tag scanner that builds the tree of block elements.
Three things are left out of a page's text:

* elements that are never article text: head, nav, footer, aside, form, script,
  style and the like, and elements whose class, id or role names such a part
  (menu, sidebar, advert, cookie notice, comments, ...);
* everything outside the article, where a page marks one (article, main);
* site templates: every element subtree that the first two rules leave is hashed
  (tags and text), Spark counts for each host on how many different pages it
  stands, and a subtree that recurs on at least MIN_PAGES pages and MIN_SHARE of
  the host's pages, on SECTION_PAGES and MIN_SHARE of a section's (first folder of
  the path), or on MANY_PAGES whatever their share is deleted.  Pages with the same
  html count once, so copies of a page do not make its article a template;
* paragraphs, headings and the like inside a marked article, under a stricter rule:
  one of the EDGE first or last, counted by its place there, that recurs in the same
  place on SECTION_PAGES pages and MIN_SHARE of the host's or section's.  Passages
  that articles share stand in changing places or on a smaller share, and stay.

A fixed-size bit filter of the recurring (host, subtree) hashes is tested while a
page is read.  Pages that hit it are joined with the exact list by host and
subtree; the others need no join.

Text: character references decoded, white space inside a block made one space,
blocks in page order joined by one line feed.

Defined results.  Null or empty html: empty text.  Null url: host "" (all such
pages are one site).  Repeated rows are handled one by one.  A very long page is
read whole.  Unclosed and stray tags are closed as browsers do in the plain cases.
Null ids are kept.  An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.shared import BitFilter, written

MIN_PAGES = 5
MIN_SHARE = 0.3
SECTION_PAGES = 20
MANY_PAGES = 1000
EDGE = 3
FILTER_LOG_BITS = 24

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes")
#: Elements that break a line of text.
BLOCK = frozenset(("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
                   "th thead tr ul").split())
#: Elements whose content is no article text.
DROPPED = frozenset(("head nav footer aside form script style noscript template iframe svg math button select option textarea input "
                     "dialog menu object embed audio video canvas title xmp noembed noframes").split())
#: Names of parts, as whole words of a class, id or role.
PARTS = frozenset(("ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments cookie cookies "
                   "consent disqus footer masthead menu menus nav navbar navigation newsletter notice notices pagination popup promo "
                   "related share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar widget "
                   "contentinfo complementary respond").split())
ARTICLE = frozenset(("article", "main"))
#: Inside an article these are its text.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
#: An open paragraph ends where one of these begins.
ENDS_P = BLOCK - frozenset(("br", "option", "summary", "legend", "html", "body"))
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",)}
_LIMIT = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
          "option": ("select",)}

_MARK = re.compile(r"<(?:(!--)|([!?])|(/)?([a-zA-Z][^\s/>]*+))")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


class Node:
    __slots__ = ("tag", "gone", "inside", "parts", "parent")

    def __init__(self, tag: str, parent: Node | None, gone: bool, inside: bool):
        self.tag, self.parent, self.gone, self.inside = tag, parent, gone, inside
        self.parts: list[Node | str] = []


def _names_a_part(attrs: str) -> bool:
    for _, value in _ATTR.findall(attrs):
        if not PARTS.isdisjoint(_NAME.findall(value.lower())):
            return True
    return False


class _Ends:
    """Where the start tags of a page end: at the first ``>`` outside quotes, or, where the quotes do
    not close, at the first ``>``.  Every place of the page is looked at a fixed number of times."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()      # stops from which no open ``>`` is reached

    def after(self, at: int) -> int:
        """The place of the ``>``, -1 if there is none."""
        if at > self.last[">"]:
            return -1
        seen, place = [], at
        while stop := _STOP.search(self.page, place):
            where, mark = stop.start(), stop.group()
            if where in self.dead:
                break
            if mark == ">":
                return where
            seen.append(where)
            if where >= self.last[mark]:
                break
            place = self.page.find(mark, where + 1) + 1
        self.dead.update(seen)
        return self.page.find(">", at)


class _Open:
    """The elements that are open, with the depths of each tag, so that no close looks through them all."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks = [root], defaultdict(list), []

    def add(self, node: Node) -> None:
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.at[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """Closes the element at ``depth`` and all in it."""
        while len(self.nodes) > depth:
            self.at[self.nodes.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def deepest(self, tags: tuple[str, ...]) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def end_what(self, tag: str) -> None:
        """Closes what the start of ``tag`` ends: an open paragraph, or the item before."""
        if tag in ENDS_P and self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            self.cut(self.blocks[-1])
        if tag in _SAME:
            item = self.deepest(_SAME[tag])
            if item > self.deepest(_LIMIT[tag]):
                self.cut(item)


def parse(page: str) -> tuple[Node, bool]:
    """The page's tree, and whether it marks an article."""
    root = Node("#", None, False, False)
    here, marked, pos, end = root, False, 0, len(page)
    ends, opened = _Ends(page), _Open(root)

    def text(upto: int) -> None:
        if upto > pos:
            here.parts.append(page[pos:upto])

    look = 0
    while m := _MARK.search(page, look):
        comment, other, close, tag = m.groups()
        if comment or other:
            text(m.start())
            stop = page.find("-->" if comment else ">", m.end())
            pos = look = end if stop < 0 else stop + (3 if comment else 1)
            continue
        stop = page.find(">", m.end()) if close and m.end() <= ends.last[">"] else -1 if close else ends.after(m.end())
        if stop < 0 and not close:
            look = m.end()               # never closed: text
            continue
        text(m.start())
        pos = look = end if stop < 0 else stop + 1
        tag = tag.lower()
        if close:
            if opened.at[tag]:
                opened.cut(opened.at[tag][-1])
                here = opened.nodes[-1]
            elif tag == "br":
                here.parts.append(Node("br", here, here.gone, here.inside))
            continue
        attrs = page[m.end():stop]
        opened.end_what(tag)
        here = opened.nodes[-1]
        gone = here.gone or tag in DROPPED or (tag == "header" and not here.inside) or (
            "=" in attrs and tag not in ("html", "body") and tag not in ARTICLE and _names_a_part(attrs))
        own = tag in ARTICLE and not gone
        marked |= own
        node = Node(tag, here, gone, here.inside or own)
        here.parts.append(node)
        if tag in RAW:
            raw = _CLOSE[tag].search(page, pos)
            node.parts.append(page[pos:raw.start() if raw else end])
            pos = look = raw.end() if raw else end
        elif tag not in VOID and (not attrs.endswith("/") or tag in BLOCK):
            opened.add(node)             # a stray slash does not close a block
            here = node
    text(end)
    return root, marked


def _named(host: str, what: str, text: bool) -> int:
    """A signed hash whose last bit tells text blocks of an article."""
    whole = xxhash.xxh3_64_intdigest(host + "\0" + what) & ~1 | text
    return whole - (1 << 64) if whole >= 1 << 63 else whole


def subtree_hashes(root: Node, marked: bool, host: str) -> dict[int, tuple[int, ...]]:
    """id of each node that a template may be -> hashes of host, tags, text and, for a
    text block of an article, its place from either end."""
    out: dict[int, tuple[int, ...]] = {}
    texts: list[Node] = []
    done: dict[int, int] = {}
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.parts if not isinstance(c, str) and not c.gone]
    for node in reversed(order):
        h = xxhash.xxh3_64(node.tag)
        text = False
        for c in node.parts:
            if isinstance(c, str):
                c = " ".join(c.split())
                if c:
                    h.update("\1" + c)
                    text = True
            elif id(c) in done:
                h.update(done[id(c)].to_bytes(8, "little"))
                text = True
        if not text:
            continue
        done[id(node)] = h.intdigest()
        if (node.tag in BLOCK and node.tag not in ("html", "body", "br") and node.tag not in ARTICLE
                and (node.inside or not marked) and not (node.inside and node.tag in TEXT_BLOCKS)):
            out[id(node)] = (_named(host, str(done[id(node)]), False),)
    within: set[int] = set()
    for node in order:
        if node.inside and (id(node.parent) in within or node.tag in TEXT_BLOCKS):
            if id(node.parent) not in within and id(node) in done:
                texts.append(node)
            within.add(id(node))
    # ``order`` takes the last child first.
    for places, side in ((texts[:EDGE], "end"), (texts[::-1][:EDGE], "start")):
        for i, node in enumerate(places):
            out[id(node)] = out.get(id(node), ()) + (_named(host, f"{done[id(node)]} {side} {i}", True),)
    return out


def text_of(root: Node, marked: bool, gone: dict[int, tuple[int, ...]] | None = None, recurring: set[int] | None = None) -> str:
    """Blocks of the article, or of the page where none is marked."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = " ".join(_html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list[tuple[Node | None, bool]] = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        if isinstance(node, str):
            line.append(node)
            continue
        if leaving:
            close()
            continue
        if node.gone or (gone and recurring and not recurring.isdisjoint(gone.get(id(node), ()))):
            if node.tag in BLOCK:
                close()
            continue
        if node.tag in BLOCK:
            close()
            stack.append((node, True))
        for c in reversed(node.parts):
            if isinstance(c, str):
                if not marked or node.inside:
                    stack.append((c, False))
            else:
                stack.append((c, False))
    close()
    return "\n".join(blocks)


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def section_of(url: str | None) -> str:
    """The first folder of the path, or "" """
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)/", url or "")
    return m.group(1) if m else ""


def _all_hashes(hashes: dict[int, tuple[int, ...]]) -> set[int]:
    return {h for own in hashes.values() for h in own}


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html"))


def page_subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, section, page, subtree): the distinct candidate hashes of every page, page being
    the hash of its html; a page without candidates gives one row with a null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, sections, names, trees = [], [], [], []
            for url, page in zip(b.column("_url").to_pylist(), b.column("_html").to_pylist(), strict=True):
                page, host = page or "", host_of(url)
                root, marked = parse(page)
                name = xxhash.xxh3_64_intdigest(page)
                name -= (1 << 64) * (name >= 1 << 63)
                for t in _all_hashes(subtree_hashes(root, marked, host)) or {None}:
                    hosts.append(host)
                    sections.append(section_of(url))
                    names.append(name)
                    trees.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(sections, pa.string()), pa.array(names, pa.int64()),
                                              pa.array(trees, pa.int64())], names=["host", "section", "page", "subtree"])

    rows = pages.select(F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html"))
    return rows.mapInArrow(run, "host string, section string, page long, subtree long")


def recurring_subtrees(subtrees: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
                       section_pages: int = SECTION_PAGES, many_pages: int = MANY_PAGES) -> DataFrame:
    """(subtree) hashes that recur on many different pages of their host or section."""
    text = F.col("subtree").bitwiseAND(1) == 1

    def counted(by: list[str], least: int) -> DataFrame:
        distinct = subtrees.select(*by, "page", "subtree").distinct()
        pages = subtrees.select(*by, "page").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("pages"))
        counts = distinct.filter("subtree IS NOT NULL").groupBy(*by, "subtree").agg(F.count(F.lit(1)).alias("n"))
        return (counts.filter(F.col("n") >= F.when(text, max(least, section_pages)).otherwise(least)).join(pages, by)
                .filter((F.col("n") >= F.lit(min_share) * F.col("pages")) | (~text & (F.col("n") >= many_pages))).select("subtree"))

    return counted(["host"], min_pages).unionByName(counted(["host", "section"], max(min_pages, section_pages))).distinct()


def article_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(id, url, text) of every page."""
    recurring = written(recurring_subtrees(written(page_subtrees(pages, url_col, html_col), "subtrees"), min_pages, min_share), "recurring")
    bits = BitFilter(recurring, "subtree", FILTER_LOG_BITS)
    fields = [T.StructField("_id", pages.schema[id_col].dataType), T.StructField("_url", T.StringType())]
    rows = _rows(pages, id_col, url_col, html_col)
    plain = T.StructType([*fields, T.StructField("text", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages that miss the filter get their text; the others pass with their hits."""
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                text, left, hits = [], [], []
                for url, page in zip(b.column("_url").to_pylist(), b.column("_html").to_pylist(), strict=True):
                    root, marked = parse(page or "")
                    own = np.array(sorted(_all_hashes(subtree_hashes(root, marked, host_of(url)))), np.int64) if not bits.empty else []
                    hit = own[bits.may_hold(own)].tolist() if len(own) else []
                    text.append(None if hit else text_of(root, marked))
                    left.append(page if hit else None)
                    hits.append(hit or None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), b.column("_url"), pa.array(text, pa.string()), pa.array(left, pa.string()),
                     pa.array(hits, pa.list_(pa.int64()))], names=["_id", "_url", "text", "_html", "hits"])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for url, page, gone in zip(*(b.column(c).to_pylist() for c in ("_url", "_html", "gone")), strict=True):
                root, marked = parse(page)
                out.append(text_of(root, marked, subtree_hashes(root, marked, host_of(url)), set(gone or ())))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_url"), pa.array(out, pa.string())], names=["_id", "_url", "text"])

    done = rows.mapInArrow(read, T.StructType([*plain.fields, T.StructField("_html", T.StringType()),
                                              T.StructField("hits", T.ArrayType(T.LongType()))]))
    if not bits.empty:
        # Which hits are exact: found on (page, hit) pairs without html, then joined back.
        done = written(done, "read")
        exact = (done.filter("hits IS NOT NULL").select(F.xxhash64("_url", "_html").alias("_k"), F.explode("hits").alias("subtree")).distinct()
                 .join(recurring, "subtree").groupBy("_k").agg(F.collect_set("subtree").alias("gone")))
        unsure = done.filter("hits IS NOT NULL").withColumn("_k", F.xxhash64("_url", "_html")).join(exact, "_k", "left")
        done = done.filter("hits IS NULL").select("_id", "_url", "text").unionByName(
            unsure.select("_id", "_url", "_html", "gone").mapInArrow(prune, plain))
    return done.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text")
