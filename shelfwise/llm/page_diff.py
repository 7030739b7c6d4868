"""Main text of pages: markup first, then the difference to the nearest page of the host.

A page is cut into blocks of text, each with the kind of place it stands in. Menus, headers,
footers, sidebars, notices, adverts, forms and comments go by their tags, roles, classes and ids; an
article or main element vouches for what is left inside of it. Then every page is compared: pages of a host are
ordered by the path of their url, each page is paired with the one before it (the first with the one after it), their
blocks are aligned by the longest common subsequence, and the difference decides. Of blocks that the markup says nothing
of, the shared ones are deleted. Of articles, those that the partner repeats whole are deleted where the page has another one
with a block of its own (a teaser beside the article); else all stay. Blocks within an article are not parted, since
copied articles share all of theirs. Pages with an article are compared with each other, and so are those without.

Neighbours with the same lines are copies of each other: they are one run with one partner, the nearest
page that differs. Pages are dealt out by ranges of (host, path), so a large host is cut into many ranges, and
each range is told the pages that differ before and after it: the result does not depend on the ranges.

Defined results: a null page has no text, a page without blocks an empty one; a page alone on its
host, or whose url is null or without a host, keeps the blocks the markup does not reject; pages without such blocks are
no partners; repeated rows are each reported; unclosed elements end where their parents end, or where an element of their kind
begins; a very long page takes time in proportion to its length, and one task its memory; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm.scratch import cut, stored
from shelfwise.llm.tasks import add_columns
from shelfwise.llm.url_filters import split_url

#: Elements by what they are. The names are those of the HTML standard.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BOILERPLATE = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "fieldset",
               "svg", "canvas", "object", "audio", "video", "map", "datalist", "label", "head")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
CLOSES_P = ("address", "article", "aside", "blockquote", "center", "details", "dir", "div", "dl", "fieldset", "figure",
            "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
            "pre", "section", "table", "ul")
#: Words in classes, ids and roles that mark what is no main text.
REJECTED = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb",
            "breadcrumbs", "comment", "comments", "commentlist", "disqus", "replies", "reply", "complementary",
            "contentinfo", "consent", "cookie", "cookies", "gdpr", "dialog", "footer", "header", "masthead", "menu",
            "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
            "overlay", "pager", "pagination", "popup", "privacy", "promo", "promotion", "promoted", "related",
            "search", "share", "sharing", "sidebar", "sidenav", "social", "sponsor", "sponsored", "subscribe", "toolbar",
            "widget", "alert", "disclaimer", "login", "signup", "tracking")

_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
           "th": ("table", "tr"), "option": ("select", "datalist")}
_START = re.compile(r"<(?:(!--|!\[CDATA\[|[!?])|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"[>\"']")
_MARK = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"\s+")
_raw, _void, _boiler = frozenset(RAW), frozenset(VOID), frozenset(BOILERPLATE)
_inline, _closes_p, _rejected = frozenset(INLINE), frozenset(CLOSES_P), frozenset(REJECTED)

MAIN, OPEN, DROPPED = 2, 1, 0


def rejects(attributes: str) -> bool:
    """Whether class, id, role or hiding says that an element is no main text."""
    for name, a, b, c in _MARK.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return True
        elif any(p.lower() in _rejected for p in _PART.findall(value)):
            return True
    return False


class Tags:
    """Reads a page's tags from left to right, in time linear in the page.

    A ``>`` inside quotes does not end a tag. Where a tag has no end outside quotes, quotes mean nothing from there on,
    so that no part of the page is searched again and again.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.quotes = True
        self.next: dict[str, int] = {}
        self.stops: dict[str, re.Pattern] = {}

    def find(self, what: str, at: int) -> int:
        """Like str.find; places must not go back between calls."""
        found = self.next.get(what, -2)
        if found != -1 and found < at:
            found = self.next[what] = self.page.find(what, at)
        return found

    def end(self, at: int) -> int:
        """The ``>`` that ends the tag which goes on at a place, or -1."""
        i = at
        while self.quotes:
            stop = _STOP.search(self.page, i)
            if not stop:
                self.quotes = False
            elif stop[0] == ">":
                return stop.start()
            else:
                # a quote that nothing closes is a character like others
                i = max(self.find(stop[0], stop.end()), stop.start()) + 1
        return self.page.find(">", at)

    def raw_end(self, name: str, at: int) -> int:
        """Behind the end tag of an element whose content is no markup."""
        if name not in self.stops:
            self.stops[name] = re.compile(rf"</{re.escape(name)}\b", re.I)
        stop = self.stops[name].search(self.page, at)
        last = self.page.find(">", stop.end()) if stop else -1
        return last + 1 if last >= 0 else len(self.page)


class Stack:
    """Open elements, where each name stands, and how many that are not inline lie below each place."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.states: list[int] = []
        self.where: dict[str, list[int]] = {}
        self.solid: list[int] = [0]  # not inline
        self.walls: list[int] = [0]  # neither inline nor p

    def push(self, name: str, state: int) -> None:
        self.where.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.states.append(state)
        own = name not in _inline
        self.solid.append(self.solid[-1] + own)
        self.walls.append(self.walls[-1] + (own and name != "p"))

    def last(self, *names: str) -> int:
        """The place of the innermost of some elements, or -1."""
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=-1)

    def cut(self, depth: int) -> bool:
        """Close everything from a place on; whether that ends a block."""
        ends = self.solid[-1] > self.solid[depth]
        while len(self.names) > depth:
            self.where[self.names.pop()].pop()
            self.states.pop()
            self.solid.pop()
            self.walls.pop()
        return ends


def pieces(page: str) -> list[tuple[str, int]]:
    """The texts of a page's blocks in order, each OPEN, DROPPED, or MAIN plus the number of its innermost article."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack, tags = Stack(), Tags(page)
    state, at, end, articles = OPEN, 0, len(page), 0

    def flush() -> None:
        if parts:
            text = _BLANK.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, state))

    def close(depth: int) -> None:
        nonlocal state
        if stack.solid[-1] > stack.solid[depth]:
            flush()
        stack.cut(depth)
        state = stack.states[-1] if stack.states else OPEN

    while at < end:
        match = _START.search(page, at)
        if not match:
            parts.append(page[at:])
            break
        if match.start() > at:
            parts.append(page[at:match.start()])
        if match[1]:
            mark = {"!--": "-->", "![CDATA[": "]]>"}.get(match[1], ">")
            stop = page.find(mark, match.end())
            at = stop + len(mark) if stop >= 0 else end
            continue
        stop = tags.end(match.end())
        if stop < 0:  # nothing that follows is a tag
            parts.append(page[match.start():])
            break
        name, attributes, at = match[3].lower(), page[match.end():stop], stop + 1
        if match[2]:
            depth = stack.last(name)
            if depth >= 0 and not (name in _inline and stack.solid[-1] > stack.solid[depth]):
                close(depth)
            elif name not in _inline:
                flush()
            continue
        if name in _raw:
            at = tags.raw_end(name, at)
            continue
        if name in _closes_p:
            depth = stack.last("p")
            if depth >= 0 and stack.walls[-1] == stack.walls[depth]:
                close(depth)
        if name in _SAME:
            depth = stack.last(*_SAME[name])
            if depth > stack.last(*_SCOPES[name]):
                close(depth)
        if name not in _inline:
            flush()
        elif name == "br":
            parts.append(" ")
        if name in _void or attributes.endswith("/"):
            continue
        inside = state
        # an article's own header holds its headline
        boiler = name in _boiler and not (name == "header" and state >= MAIN)
        if boiler or (name not in ("html", "body") and attributes and rejects(attributes)):
            inside = DROPPED
        elif name in ("article", "main") and state != DROPPED:
            inside = MAIN + articles
            articles += 1
        if inside != state:
            flush()
        stack.push(name, inside)
        state = inside
    flush()
    return out


def blocks(page: str) -> list[tuple[str, int]]:
    """The texts of a page's blocks in order, each MAIN, OPEN or DROPPED."""
    return [(t, min(s, MAIN)) for t, s in pieces(page)]


def vouched(page: str | None) -> list[tuple[str, int]]:
    """Blocks that the markup does not reject, each with the number of its article (from 1), or 0 on a page without.

    A page with an article keeps that alone, if it has text.
    """
    found = pieces(page) if page else []
    main = [(t, s - MAIN + 1) for t, s in found if s >= MAIN]
    return main or [(t, 0) for t, s in found if s == OPEN]


def candidates(page: str | None) -> list[tuple[str, bool]]:
    """Blocks that the markup does not reject, and whether it vouches for them."""
    return [(t, article > 0) for t, article in vouched(page)]


def shared(own: list, other: list) -> list[bool]:
    """Lines of ``own`` on a longest common subsequence with ``other`` (the earliest such)."""
    out = [False] * len(own)
    low = 0
    while low < min(len(own), len(other)) and own[low] == other[low]:
        out[low] = True
        low += 1
    high = 0
    while high < min(len(own), len(other)) - low and own[-1 - high] == other[-1 - high]:
        out[-1 - high] = True
        high += 1
    both = set(own[low:len(own) - high]) & set(other[low:len(other) - high])
    a = [i for i in range(low, len(own) - high) if own[i] in both]
    b = [x for x in other[low:len(other) - high] if x in both]
    # rows of lengths as bits: a set bit where the length grows (bit-parallel, one integer per line)
    places: dict = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(b)) - 1
    rows, row = [], full
    for i in a:
        hit = row & places[own[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    j = len(b)
    for k in range(len(a) - 1, -1, -1):
        before = rows[k - 1] if k else full
        here = j - (rows[k] & ((1 << j) - 1)).bit_count()
        above = j - (before & ((1 << j) - 1)).bit_count()
        if here == above:
            continue
        while j and (j - 1) - (rows[k] & ((1 << (j - 1)) - 1)).bit_count() == here:
            j -= 1
        out[a[k]] = True
        j -= 1
    return out


class Edge(NamedTuple):
    """What other ranges must know of one range of pages, in the order of host and path. Runs are equal neighbours."""
    part: int
    host: str  # of the first page
    lines: str
    page: int
    second: int | None  # first page of the host's next run in the range
    last_host: str
    last_lines: str
    last_page: int
    before: int | None  # last page of the run before the last run, on the same host
    single: bool  # one run fills the range


def edge(rows: Iterator[tuple]) -> Edge | None:
    """The edge of one range, of its rows (part, number of the page, host, hash of the lines)."""
    part = first = last = second = before = None
    runs = 0
    for part, page, host, lines in rows:
        if last is None or (host, lines) != last[:2]:
            before = last[2] if last is not None and host == last[0] else None
            if runs == 1 and host == first[0]:
                second = page
            runs += 1
        first = first or (host, lines, page)
        last = (host, lines, page)
    return Edge(part, *first, second, *last, before, runs == 1) if runs else None


class Around(NamedTuple):
    back: int | None  # the different page before a range's first run, on its host
    ahead: int | None  # the different page after its last run


def neighbours(edges: list[Edge]) -> dict[int, Around]:
    """What lies around each range."""
    edges = sorted(edges, key=lambda e: e.part)
    ahead: dict[int, int | None] = {}
    for e, after in reversed(list(zip(edges, [*edges[1:], None], strict=False))):
        if after is None or after.host != e.last_host:
            ahead[e.part] = None
        elif after.lines != e.last_lines:
            ahead[e.part] = after.page
        else:
            ahead[e.part] = ahead[after.part] if after.single else after.second
    out, state = {}, None  # host, lines, last page and page before, of the last run so far
    for e in edges:
        back = None
        if state and state[0] == e.host:
            back = state[3] if state[1] == e.lines else state[2]
        out[e.part] = Around(back, ahead[e.part])
        state = (e.last_host, e.last_lines, e.last_page, back if e.single else e.before)
    return out


def partners(rows: Iterator[tuple], around: dict[int, Around]) -> Iterator[tuple]:
    """(page, first page of its run in the range, None) per page, and (None, first page, its partner) per run.

    The partner is the nearest different page before the run on its host, or else the nearest after it.
    """
    head = host = lines = last = back = None
    part = None
    for part, page, new_host, new_lines in rows:
        if head is None:
            back = around[part].back
        elif (new_host, new_lines) != (host, lines):
            yield None, head, back if back is not None else page if new_host == host else None
            back = last if new_host == host else None
        if head is None or (new_host, new_lines) != (host, lines):
            head, host, lines = page, new_host, new_lines
        last = page
        yield page, head, None
    if head is not None:
        yield None, head, back if back is not None else around[part].ahead


def kept(own: list[int], articles: list[int], other: list[int]) -> list[bool]:
    """Which blocks of a page are its text, beside those of its partner."""
    gone = shared(own, other)
    if not all(articles):
        return [not g for g in gone]
    new = {a for a, g in zip(articles, gone, strict=True) if not g}
    return [not new or a in new for a in articles]


def marks(page: str | None) -> tuple[list[str], list[int], list[int], bytes]:
    """The blocks that may be text, a hash of each, their articles, and a hash of all."""
    found = vouched(page)
    hashes = [blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t, _ in found]
    of = [a for _, a in found]
    return ([t for t, _ in found], np.frombuffer(b"".join(h[:8] for h in hashes), "<i8").tolist(), of,
            blake2b(b"".join(hashes), digest_size=16).digest())


def _per_range(ordered: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over the rows of each range, in their order."""
    names = [f.split()[0] for f in schema.split(", ")]

    def each(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch[c].tolist() for c in ("part", "number", "host", "hash")), strict=True)

        out = run(rows())
        while kept := list(islice(out, 10_000)):
            yield pd.DataFrame(kept, columns=names, dtype=object)

    return ordered.mapInPandas(each, schema)


def compared(pages: DataFrame) -> DataFrame:
    """name, hash and ``kept`` of pages: which blocks are their text, by the difference to their partner.

    ``pages`` is stored and has number, name, page, host, path, marks, articles and hash; a host may be any text that
    parts pages which are not to be compared. The pages are put in order as small rows, in ranges; what ranges know of
    each other is one small row per range. Blocks are compared by 64-bit hashes, once per run and range.
    """
    light = pages.select("number", "host", "path", "page", "hash")
    order = ("host", "path", "page", "hash", "number")
    ordered = cut(light.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select(F.spark_partition_id().alias("part"), "number", "host", "hash"))
    fields = ("part int, host string, lines string, page long, second long, last_host string, last_lines string, "
              "last_page long, before long, single boolean")
    edges = _per_range(ordered, lambda rows: iter([e] if (e := edge(rows)) else []), fields).collect()
    around = neighbours([Edge(*r) for r in edges])
    found = cut(_per_range(ordered, lambda rows: partners(rows, around), "number long, head long, partner long"))
    own = found.where("number IS NULL AND partner IS NOT NULL").select("head", "partner").join(
        pages.select(F.col("number").alias("head"), "marks", "articles"), "head")
    both = own.join(pages.select(F.col("number").alias("partner"), F.col("marks").alias("other")), "partner").select(
        "head", F.struct("marks", "articles", "other").alias("both"))

    def run(pairs: pa.Array) -> list[pa.Array]:
        return [pa.array([kept(p["marks"], p["articles"], p["other"]) for p in pairs.to_pylist()], pa.list_(pa.bool_()))]

    decided = add_columns(both, "both", {"kept": T.ArrayType(T.BooleanType())}, run).drop("both")
    of = found.where("number IS NOT NULL").select("number", "head").join(decided, "head").drop("head")
    # equal rows lie side by side and have the same partner
    return pages.select("number", "name", "hash").join(of, "number").drop("number").dropDuplicates(["name", "hash"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and main text of every page.

    Pages are parsed twice: first for the hashes of their blocks, which are stored and compared, then for the
    texts that the comparison has decided about; so a text is shuffled once and stored nowhere.
    """
    host, path = split_url(F.col(url_col))
    page, url = F.col(id_col).cast("string"), F.col(url_col)
    name = F.concat(*(F.hex(F.xxhash64(F.lit(k), page.isNull(), page, url)) for k in range(2)))
    source = pages.select(page.alias("page"), url.alias("url"), name.alias("name"), host.alias("host"), path.alias("path"),
                          F.col(html_col).alias("html"))

    def parse(texts: pa.Array, text: bool) -> list[pa.Array]:
        found = [marks(x) for x in texts.to_pylist()]
        single = pa.array([f[3].hex() for f in found], pa.string())
        if text:
            return [pa.array([f[0] for f in found], pa.list_(pa.string())), single]
        return [pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int32())), single]

    new = {"marks": T.ArrayType(T.LongType()), "articles": T.ArrayType(T.IntegerType()), "hash": T.StringType()}
    some = add_columns(source.where(host != "").drop("url"), "html", new, lambda x: parse(x, False)).drop("html")
    kind = F.when(F.col("articles")[0] > 0, "main:").otherwise("open:")
    decided = compared(stored(some.where(F.size("marks") > 0).withColumn("host", F.concat(kind, "host")).withColumn(
        "number", F.monotonically_increasing_id())))
    texts = add_columns(source.select("page", "url", "name", "html"), "html",
                        {"lines": T.ArrayType(T.StringType()), "hash": T.StringType()}, lambda x: parse(x, True)).drop("html")
    whole = texts.join(decided, ["name", "hash"], "left")
    lines = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda _, i: F.get("kept", i)))
    return whole.select(F.col("page").cast(pages.schema[id_col].dataType).alias(id_col), F.col("url").alias(url_col),
                        F.array_join(lines, "\n").alias("text"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
