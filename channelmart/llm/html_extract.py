"""Main text of web pages by differencing each page with the one nearest to it by URL.

A page is read into text lines, one for each block. Pages of a host are sorted by path; a page is paired with the
neighbour that shares more of its path with it (ties: the one before). The lines of both are aligned by their longest
common subsequence, and shared lines, the site's template, are deleted, inside a declared article and outside. What a
template varies from page to page is known by its markup: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments are not kept even where they differ, nor is an article within one that is closed.
The reverse check restores sentences inside the page's own declared article: a sentence that two articles of a host both
quote is content. A neighbour that repeats COPIED of the article's characters is a copy: the article is taken by its markup.

The order of host, path, id and contents is found on these keys alone and cut into as many ranges as there are shuffle
partitions, so a large host is many ranges. Pages are parsed once; their compressed lines go to their range, and the first
and last page of a range also to its neighbour, as a partner. The driver holds two keys for each range. The
common subsequence is found by bit rows, in halves where the rows would be large.

Cases: a null or empty page has the empty text; a page without a URL or alone on its host has no partner and nothing is
deleted, nor where the page is a copy that would lose all its lines; unclosed and misnested markup is read as far
as it goes; equal rows are handled each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import configure, shards_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(("address article aside blockquote body br-block caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody tfoot thead title tr ul").split())
BODY = frozenset(("article", "main"))
NEVER_TEXT = frozenset("script style noscript template iframe object svg math canvas audio video head title select option textarea button".split())
ASIDE = frozenset("nav aside footer form menu dialog".split())
# Parts of class, id and role values that name what is not the page's own text.
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|side-?bar|"
    r"complementary|navigation|nav|navbar|menu|breadcrumbs?|pagination|pager|masthead|topbar|contentinfo|footer|site-?header|page-?header|comments?|"
    r"replies|respond|disqus|share|sharing|social|related|recommended|newsletter|subscribe|subscription|signup|login|search|widget)(?:$|[\s_-])", re.I)
# The end of a sentence, which an article may quote, and of no label or button.
SENTENCE = re.compile(r"\w\W*[.!?…。！？][\W_]*\Z")
COPIED = 0.9
SMALL_BITS = 1 << 25


class Lines(HTMLParser):
    """Blocks of text in page order: (text, inside an article, kept by its markup)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, bool, bool]] = []
        self.text: list[str] = []
        self.open: list[tuple[str, bool, bool, bool]] = []      # tag, inside an article, kept, text
        self.aside: list[int | None] = []                       # first line of each open block that is not the page's own
        self.feed(html)
        self.close()
        self._end()

    def _state(self) -> tuple[bool, bool, bool]:
        return self.open[-1][1:] if self.open else (False, True, True)

    def _end(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                self.found.append((text, *self._state()[:2]))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self._end()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag in BLOCKS:
            self._end()
        elif tag in ("td", "th"):
            self.text.append(" ")
        inside, kept, shown = self._state()
        aside = None
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        if tag in BODY and not any(t in ASIDE for t, *_ in self.open) and not ASIDE_NAMES.search(names):
            inside, kept = True, True                           # also out of an unclosed advert; of a closed one its end tag says so
        elif tag in ASIDE or tag == "header" and not inside or names and tag not in ("html", "body") and ASIDE_NAMES.search(names):
            kept, aside = False, len(self.found) if tag in BLOCKS else None
        self.aside.append(aside)
        self.open.append((tag, inside, kept, shown and tag not in NEVER_TEXT))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if self.aside[k] is not None:
                    self.found[self.aside[k]:] = [(text, inside, False) for text, inside, _ in self.found[self.aside[k]:]]
                del self.open[k:], self.aside[k:]
                break
            if self.open[k][0] in ("article", "main", "nav", "aside", "footer", "form", "table") and tag in ("p", "b", "i", "em", "strong", "a", "span"):
                break                                           # a stray end tag does not close what holds it

    def handle_data(self, data):
        if self._state()[2]:
            self.text.append(data)


def lines_of(html: str | None) -> list[tuple[str, bool, bool]]:
    return Lines(html).found if html else []


def _ranks(a: list, b: list) -> tuple[list[int], list[int]]:
    known: dict = {}
    return [known.setdefault(x, len(known)) for x in a], [known.setdefault(x, len(known)) for x in b]


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each item of a: bits that are 0 where the common subsequence with b grows."""
    where: dict[int, int] = {}
    for k, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def common_lines(a: list, b: list) -> list[int]:
    """The places in a of a longest common subsequence of a and b."""
    a, b = _ranks(a, b)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner = _common(a[head:len(a) - tail], b[head:len(b) - tail])
    return [*range(head), *(head + k for k in inner), *range(len(a) - tail, len(a))]


def _common(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > SMALL_BITS:             # halve a, and b where both halves together gain most
        middle = len(a) // 2
        *_, left = _rows(a[:middle], b)
        *_, right = _rows(a[:middle - 1:-1] if middle else a[::-1], b[::-1])
        grows = lambda bits, n: np.concatenate(([0], np.cumsum([c == "0" for c in f"{bits:0{n}b}"[::-1]])))
        both = grows(left, len(b)) + grows(right, len(b))[::-1]
        cut = int(both.argmax())
        return _common(a[:middle], b[:cut]) + [middle + k for k in _common(a[middle:], b[cut:])]
    rows = [(1 << len(b)) - 1, *_rows(a, b)]
    out, j = [], len(b)
    for i in range(len(a), 0, -1):
        # steps back to the last place where row i grows; the item is common if row i - 1 does not grow there
        now, before = ~rows[i] & ((1 << j) - 1), ~rows[i - 1] & ((1 << j) - 1)
        if now.bit_count() > before.bit_count():
            places = [k for k in range(j) if b[k] == a[i - 1]]
            for k in reversed(places):
                if (~rows[i - 1] & ((1 << k) - 1)).bit_count() + 1 == now.bit_count():
                    out.append(i - 1)
                    j = k
                    break
    return out[::-1]


KEY = ("host", "path", "id", "contents")


def _keys() -> list[Column]:
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host, path = F.lower(F.regexp_extract(bare, "^([^/?#]*)", 1)), F.regexp_extract(bare, "^[^/?#]*(.*)$", 1)
    return [host.alias("host"), path.alias("path"), F.coalesce(F.col("page_id").cast("long"), F.lit(-1 << 63)).alias("id"), F.xxhash64("url", "html").alias("contents")]


def ranges(pages: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """First and last keys of the ranges that the pages' order is cut into."""
    keys = pages.select(*_keys()).repartitionByRange(shards_of(pages.sparkSession), *KEY)
    key = F.struct(*KEY)
    found = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    found = sorted((tuple(r["first"]), tuple(r["last"])) for r in found)
    return [f for f, _ in found], [last for _, last in found]


def keep_lines(lines: list[str], marks: bytes, shared: list[int]) -> list[str]:
    """The page's own lines. marks: bit 0 inside an article, bit 1 kept by the markup; shared: lines of the template."""
    kept = [k for k, m in enumerate(marks) if m & 2] or [k for k, m in enumerate(marks) if m & 1]
    article, shared = [k for k in kept if marks[k] & 1], set(shared)
    size = lambda which: sum(len(lines[k]) for k in which)
    if article and size(shared.intersection(article)) >= COPIED * size(article):
        return [lines[k] for k in article]                      # the other page is a copy and tells no template
    own = [k for k in kept if k not in shared or marks[k] & 1 and SENTENCE.search(lines[k])]
    return [lines[k] for k in own or kept]


def partner(own: dict, others: list[dict]) -> dict | None:
    """The page of the same host that shares most of the path, the first of equals."""
    best, found, path = -1, None, own["path"].split("/")
    for other in others:
        if own["host"] and other["host"] == own["host"]:
            theirs = other["path"].split("/")
            alike = next((k for k, (x, y) in enumerate(zip(path, theirs)) if x != y), min(len(path), len(theirs)))
            if alike > best:
                best, found = alike, other
    return found


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    configure(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    id_type = dict(pages.dtypes)["page_id"]
    first, last = ranges(pages)
    names = ["range", "guest", *KEY, "page_id", "url", "marks", "lines"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each page's row for its range and, of a first or last page, one for the range beside it."""
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            take, to, marks, blobs = [], [], [], []
            for k, (html, *key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("html", *KEY)))):
                lines, key = lines_of(html), tuple(key)
                here = bisect_right(first, key) - 1
                targets = [here] + [here - 1] * (here > 0 and key == first[here]) + [here + 1] * (here + 1 < len(first) and key == last[here])
                take += [k] * len(targets)
                to += targets
                marks += [bytes(inside + 2 * kept for _, inside, kept in lines)] * len(targets)
                blobs += [compress("\n".join(t for t, _, _ in lines).encode())] * len(targets)
            index = pa.array(take, pa.int64())
            guest = [k > 0 and take[k] == take[k - 1] for k in range(len(take))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(guest, pa.bool_()), *(batch.column(c).take(index) for c in (*KEY, "page_id", "url")),
                 pa.array(marks, pa.binary()), pa.array(blobs, pa.binary())], names=names)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                lines = decompress(row["lines"]).decode()
                yield row | {"lines": lines.split("\n") if row["marks"] else []}

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a range in order; each is looked at with the ones before and after it."""
        out: list[tuple] = []

        def look(before: dict | None, row: dict | None, after: dict | None) -> None:
            if row is not None and not row["guest"]:
                other = partner(row, [r for r in (before, after) if r])
                shared = common_lines(row["lines"], other["lines"]) if other else []
                text = "\n".join(keep_lines(row["lines"], row["marks"], shared))
                out.append((row["page_id"], row["url"], text, len(text)))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (page_id_type, pa.string(), pa.string(), pa.int64()))],
                                              names=["page_id", "url", "text", "n_chars"])

        before = row = page_id_type = None
        for batch in batches:
            page_id_type = batch.schema.field("page_id").type
            for after in rows_of([batch]):
                look(before, row, after)
                before, row = row, after
            yield flushed()
            out = []
        if row is not None:
            look(before, row, None)
            yield flushed()

    keyed = pages.select(*_keys(), "page_id", "url", "html")
    parsed = keyed.mapInArrow(parse, f"range int, guest boolean, host string, path string, id long, contents long, page_id {id_type}, url string, marks binary, lines binary")
    dealt = parsed.repartitionById(max(1, len(first)), "range").sortWithinPartitions(*KEY, "guest")
    return dealt.mapInArrow(align, f"page_id {id_type}, url string, text string, n_chars long")
