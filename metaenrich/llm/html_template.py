"""Main text of web pages by removal of site templates.

Method: each page is parsed once into text blocks. Every block-level element gets a hash of its subtree (host, tag, class
and id, text and child hashes). Spark counts on how many different main contents each hash stands, so that copies of a
page are one and are no evidence; a subtree that recurs on RECUR_PAGES of them, however large the host is, is template
and is deleted with all blocks inside it. Inside the article element, and on pages without article and main element, only
containers can be template: a paragraph that pages share stays. What stands around the article never takes it along.

Of what templates and lists leave, the main content is chosen by its mass, the characters outside links: the article
elements; what else a main element holds comes with them if it is more than they are (so an article inside it was only
a teaser, or a part), and all the page does if it is more than twice as much. Several articles count as one.

Counts can't see what doesn't recur: a menu on a host with few pages, an advert that is on one page only. So lists
decide about the blocks that no template holds: what stands in an element that is never main text by tag, role, class or
id (menus, headers, footers, sidebars, notices, adverts, forms and reader comments) goes. Class and id count as whole
words only (`ad`, not `ad-free`), and in an article or main element nearly only for containers: a paragraph or heading goes
by the few names that say advert in full. n_template tells how many blocks went by counts, n_listed how many others.

Character references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined in page
order by a line feed; an inline element that goes (hidden, a button) cuts no block; nothing else is dropped or capped. Parsing and cutting take time linear in the page, however
deeply it is nested: an element holds the interval of its blocks, and every look for an open element takes one step.

Null and empty html give an empty text. A null or odd url counts as a host of its own (''). Repeated rows each give
their row, an empty table gives an empty result. Columns other than page_id, url and html are
ignored. Unclosed tags, stray end tags and broken references are read as browsers read them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, rows_of

RECUR_PAGES = 5
#: Templates (8 bytes each) that are broadcast at most; more are joined to the pages.
MAX_BROADCAST = 4_000_000

_TAG = re.compile(r"""<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>|[!?/][^>]*+>)""")
_ATTR = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {n: re.compile(rf"</{n}[\s/>]", re.I) for n in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_CONTAINER = frozenset("aside details div dl fieldset figure footer form header menu nav ol section table ul".split())
_DROP = frozenset("nav header footer aside form script style noscript template iframe button select textarea svg dialog menu object canvas audio video head title".split())
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Whole class or id words of what is never main text.
_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising adsense ad-slot ad-container ad-wrapper ad-banner sponsor sponsored promo promotion banner cookie cookies cookie-banner"
    " cookie-notice consent gdpr notice notices alert newsletter subscribe subscription signup login share sharing social social-share share-buttons sidebar menu nav navbar"
    " navigation site-nav main-nav breadcrumb breadcrumbs footer site-footer header site-header masthead comment comments comment-list comments-area commentlist respond disqus"
    " replies related related-posts recommended recommendations widget popup modal overlay hidden pagination pager toolbar topbar search copyright disclaimer skip skip-link".split()
)
#: Of these, the ones that also drop an article inside, or a container in an article; the others may name a layout.
_FIRM = frozenset(
    "ad ads advert adverts advertisement advertising ad-slot ad-container ad-wrapper ad-banner sponsor sponsored comment comments comment-list comments-area commentlist respond"
    " disqus replies related related-posts recommended recommendations hidden".split()
)
#: Further ones that drop a container in an article.
_INNER = _FIRM | frozenset(
    "cookie cookies cookie-banner cookie-notice consent gdpr newsletter subscribe subscription signup share sharing social-share share-buttons widget popup modal overlay".split()
)
#: The ones that drop any element in an article.
_PLAIN = frozenset("advert adverts advertisement advertising sponsored".split())
#: A start tag closes an open element of its group, up to the nearest element of the group's scope.
_SCOPE = frozenset("article aside body div dl main nav ol section table td th ul".split())
_CELLS = frozenset("td th".split())
_GROUPS = (
    (frozenset(["p"]), frozenset("td th table".split())),
    (frozenset(["li"]), _SCOPE),
    (frozenset("dt dd".split()), _SCOPE),
    (frozenset("tr td th".split()), _SCOPE - _CELLS),
    (_CELLS, _SCOPE - _CELLS),
    (frozenset(["option"]), _SCOPE),
)
_CLOSES = {"li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4, "option": 5}
_TOUCHES = {name: tuple(g for g, (names, scope) in enumerate(_GROUPS) if name in names or name in scope) for name in _SCOPE | frozenset("p li dt dd tr option".split())}


@dataclass(slots=True)
class _Element:
    name: str
    label: str
    dropped: bool
    level: int  # 2: is or is inside an article element, 1: of a main element, 0: neither
    soft: bool  # dropped by names only that an article inside overrules
    parts: list[bytes]
    first: int  # blocks from here on are inside
    near: tuple[int, ...]  # of each group, depth of the open element that a start tag would close, or 0
    held: tuple[list[str], int] | None = None  # begun text around an inline element that is dropped


@dataclass(slots=True)
class Block:
    text: str
    level: int
    listed: bool
    mass: int  # characters outside links


def _label(attrs: str) -> tuple[str, bool, set[str]]:
    """Class and id of a start tag, whether role or style mark it as no main text, and its words from the list."""
    if "=" not in attrs and "hidden" not in attrs:
        return "", False, set()
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    label = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
    marked = "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in _ROLES or "display:none" in found.get("style", "").replace(" ", "").lower()
    return label, marked, _CLASSES.intersection(label.split())


class Page:
    """Blocks of one page, in order, and its countable elements: (subtree hash, first block, end, level)."""

    def __init__(self, source: str, host: str = ""):
        self.blocks: list[Block] = []
        self.elements: list[tuple[int, int, int, int]] = []
        self.host = host.encode("utf-8", "surrogatepass")
        self.stack = [_Element("", "", False, 0, False, [], 0, (0,) * len(_GROUPS))]
        self.open: Counter[str] = Counter()
        self.text: list[str] = []
        self.linked = 0
        self.loose: list[tuple[int, int, int, int]] = []
        self._read(source)
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        if any(b.level for b in self.blocks):
            self.elements += self.loose

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">")
        while True:
            tag = _TAG.search(source, at) if at <= last else None
            if tag is None:
                self._add(source[at:])
                return
            if tag.start() > at:
                self._add(source[at : tag.start()])
            at = tag.end()
            if tag["comment"] is not None:
                end = source.find("-->", at)
                at = len(source) if end < 0 else end + 3
            elif tag["name"] is not None:
                name = tag["name"].lower()
                if tag["close"]:
                    self._end(name)
                elif name in _RAW_END:
                    end = _RAW_END[name].search(source, at)
                    stop = source.find(">", end.start()) if end else -1
                    at = len(source) if stop < 0 else stop + 1
                else:
                    self._start(name, tag["attrs"])

    def _add(self, text: str) -> None:
        self.text.append(text)
        if self.open["a"]:
            self.linked += len(text)

    def _flush(self) -> None:
        if not self.text:
            return
        text, linked = " ".join(html.unescape("".join(self.text)).split()), self.linked
        self.text, self.linked = [], 0
        if text:
            top = self.stack[-1]
            self.blocks.append(Block(text, top.level, top.dropped, max(0, len(text) - linked)))
            top.parts.append(text.encode("utf-8", "surrogatepass"))

    def _start(self, name: str, attrs: str) -> None:
        if name in _VOID:
            if self.stack[-1].name == "head" and name not in _IN_HEAD:
                self._pop()
            if name == "br":
                self.text.append(" ")
            elif name == "hr":
                self._flush()
            return
        if self.stack[-1].name == "head" and name not in _IN_HEAD:
            self._pop()  # anything else ends an unclosed head
        if name in ("html", "body"):
            return
        block = name in _BLOCK
        if block:
            self._close_implied(0)
        if name in _CLOSES:
            self._close_implied(_CLOSES[name])
        if block:
            self._flush()
        elif name in ("td", "th"):
            self.text.append(" ")
        top = self.stack[-1]
        label, marked, words = _label(attrs) if attrs else ("", False, set())
        if top.level:  # inside the article, names hardly delete a paragraph or heading
            words &= _INNER if name in _CONTAINER else _FIRM if name in ("article", "main") else _PLAIN
        own = name in _DROP or marked or bool(words)
        above = top.dropped and not (top.soft and name in ("article", "main"))
        dropped = above or own
        held = None
        if dropped and not top.dropped and not block:
            held, self.text, self.linked = (self.text, self.linked), [], 0
        elif dropped != top.dropped:
            self._flush()
        soft = dropped and (top.soft if above else True) and (not own or bool(words) and not marked and name not in _DROP and words.isdisjoint(_FIRM))
        level = top.level if dropped else max(top.level, {"article": 2, "main": 1}.get(name, 0))
        near, depth = top.near, len(self.stack)
        if name in _TOUCHES:
            changed = list(near)
            for g in _TOUCHES[name]:
                changed[g] = depth if name in _GROUPS[g][0] else 0
            near = tuple(changed)
        self.open[name] += 1
        self.stack.append(_Element(name, label, dropped, level, soft, [] if block else top.parts, len(self.blocks), near, held))

    def _close_implied(self, group: int) -> None:
        depth = self.stack[-1].near[group]
        while depth and len(self.stack) > depth:
            self._pop()

    def _end(self, name: str) -> None:
        if name == "p":
            if self.stack[-1].near[0]:
                self._close_implied(0)
            else:
                self._flush()  # a stray </p> is an empty paragraph
        elif self.open[name]:
            while self._pop() != name:
                pass

    def _pop(self) -> str:
        top = self.stack[-1]
        block = top.name in _BLOCK
        if block or top.dropped != self.stack[-2].dropped:
            self._flush()
        if top.held:
            self.text, self.linked = top.held
        self.stack.pop()
        self.open[top.name] -= 1
        if not block:
            return top.name
        key = xxhash.xxh3_64_intdigest(b"\0".join([self.host, top.name.encode(), top.label.encode("utf-8", "surrogatepass"), *top.parts])) - (1 << 63)
        self.stack[-1].parts.append(key.to_bytes(8, "little", signed=True))
        main = top.level > self.stack[-1].level  # the article itself is no template
        if top.first < len(self.blocks) and not main:
            if top.name in _CONTAINER:
                self.elements.append((key, top.first, len(self.blocks), top.level))
            elif not top.level:
                self.loose.append((key, top.first, len(self.blocks), 0))
        return top.name

    def free(self) -> list[int]:
        """Numbers of the blocks that no list drops."""
        return [i for i, b in enumerate(self.blocks) if not b.listed]

    def chosen(self, gone: Container[int] = ()) -> list[int]:
        """Numbers of the main content's blocks, when those in `gone` are template."""
        left = [i for i in self.free() if i not in gone]
        least = choose([self.blocks[i].level for i in left], [self.blocks[i].mass for i in left])
        return [i for i in left if self.blocks[i].level >= least]

    def main_blocks(self) -> list[Block]:
        return [self.blocks[i] for i in self.chosen()]


def choose(levels: list[int], masses: list[int]) -> int:
    """The least level of main content, for blocks of these levels and masses."""
    least, mass = max(levels, default=0), [0, 0, 0]
    for level, m in zip(levels, masses, strict=True):
        mass[level] += m
    if least == 2 and mass[1] > mass[2]:
        least = 1
    return 0 if mass[0] > 2 * (mass[1] + mass[2]) else least


def covered(levels: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """Which blocks (of these levels) the elements (first, end, level) delete: those inside, unless of a higher level."""
    gone = np.zeros(len(levels), bool)
    for level in (0, 1, 2):
        change = np.zeros(len(levels) + 1, np.int64)
        reach = elements[elements[:, 2] >= level]
        np.add.at(change, reach[:, 0], 1)
        np.add.at(change, reach[:, 1], -1)
        gone |= (levels == level) & (np.cumsum(change[:-1]) > 0)
    return gone


def content_of(texts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url: str | None) -> str:
    found = re.match(r"\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", url or "")
    return found[1].rpartition("@")[2].partition(":")[0].lower().rstrip(".") if found else ""


_PARSED = "page_id, url, texts, at, masses, blocks, keys, spans, content".split(", ")


def _parse(pages: DataFrame) -> DataFrame:
    """page_id, url, texts, numbers (at) and masses of the blocks that lists leave, level of every block, keys and spans (first, end, level each) of the elements, hash of the main content."""
    id_type = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns: list[list] = [[] for _ in _PARSED[2:]]
                for url, source in rows_of([part], "url", "html"):
                    page = Page(source or "", host_of(url))
                    at = page.free()
                    texts, masses = [page.blocks[i].text for i in at], [page.blocks[i].mass for i in at]
                    content = content_of([b.text for b in page.main_blocks()])
                    row = texts, at, masses, bytes(b.level for b in page.blocks), [e[0] for e in page.elements], [x for e in page.elements for x in e[1:]], content
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], _PARSED)

    return pages.mapInArrow(run, f"page_id {id_type}, url string, texts array<string>, at array<int>, masses array<int>, blocks binary, keys array<bigint>, spans array<int>, content bigint")


def templates(parsed: DataFrame, pages: int = RECUR_PAGES) -> DataFrame:
    """Keys (host and subtree) that recur on many main contents. Copies and counts combine before each shuffle."""
    each = parsed.select("content", F.explode("keys").alias("key")).groupBy("key", "content").agg(F.lit(1))
    return each.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= pages).select("key")


def _cut(parsed: DataFrame, recurring: np.ndarray | None) -> DataFrame:
    """The result rows: blocks inside elements whose key is in `recurring` (sorted), or else in the row's column gone, go."""
    id_type = dict(parsed.dtypes)["page_id"]
    names = ["page_id", "url", "text", "n_chars", "n_template", "n_listed"]
    shipped = None if recurring is None else parsed.sparkSession.sparkContext.broadcast(recurring)
    used = [c for c in (*_PARSED[:-1], "gone") if c in parsed.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shipped is None else shipped.value
        for batch in batches:
            columns: list[list] = [[] for _ in names[2:]]
            for texts, at, masses, levels, keys, spans, *rest in rows_of([batch], *used[2:]):
                gone_keys = known if known is not None else np.sort(np.array(rest[0] or [], np.int64))
                levels, keys = np.frombuffer(levels, np.uint8), np.array(keys, np.int64)
                place = np.searchsorted(gone_keys, keys)
                hit = place < len(gone_keys)
                hit[hit] = gone_keys[place[hit]] == keys[hit]
                gone = covered(levels, np.array(spans, np.int64).reshape(-1, 3)[hit])
                left = [(t, int(levels[i]), m) for t, i, m in zip(texts, at, masses, strict=True) if not gone[i]]
                least = choose([level for _, level, _ in left], [m for _, _, m in left])
                kept = [t for t, level, _ in left if level >= least]
                text = "\n".join(kept)
                n = int(gone.sum())
                for column, value in zip(columns, (text, len(text), n, len(levels) - n - len(kept)), strict=True):
                    column.append(value)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)

    return parsed.select(*used).mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint, n_template bigint, n_listed bigint")


def extract(pages: DataFrame, recur: int = RECUR_PAGES, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """page_id, url, text, n_chars, n_template, n_listed for each row of pages."""
    scratch = Scratch(pages.sparkSession, "pages")
    parsed = scratch.save(_parse(pages.select("page_id", "url", "html")), "parsed")
    recurring = scratch.save(templates(parsed, recur), "templates")
    if recurring.count() <= max_broadcast:
        return _cut(parsed, np.sort(recurring.toArrow().column(0).to_numpy()))
    # Too many for a broadcast: the pages get theirs by a join, in which only their keys move, and then one by row.
    rows = parsed.withColumn("row", F.monotonically_increasing_id())
    rows = scratch.save(rows, "rows")
    gone = rows.select("row", F.explode("keys").alias("key")).join(recurring, "key", "left_semi").groupBy("row").agg(F.collect_set("key").alias("gone"))
    return _cut(rows.join(gone, "row", "left"), None)
