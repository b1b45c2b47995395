"""Main text of web pages by differencing against the page with the nearest URL.

A page becomes lines, one for each block of text in page order; scripts, styles,
comments and other raw elements never give lines.  Pages are sorted by host and
URL path, each is paired with the neighbour in that order whose path agrees
furthest, the two lists of lines are aligned by longest common subsequence, and shared
lines are deleted as the site's furniture.

Two checks on the markup follow.  Blocks inside elements that name themselves as
furniture (navigation, header, footer, aside, form, advertisement, sidebar, notice,
comments) go even if the neighbour has others.  Blocks inside an ``article`` stay
even if the neighbour shares them, since reprints share their text; a page with
such blocks has only those as its text.  A neighbour that shares nearly all
lines is a copy and tells nothing.

Sorting is by range with the page id as the last key, so that a host with a third of
all pages spreads over many tasks; a task holds three pages' line hashes.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_arrow, stage

#: Agreeing pairs of positions, for each line of both pages, up to which an alignment follows them singly (1 at least).
PAIRS_A_LINE = 32
#: A neighbour that shares this much of the lines outside furniture is a copy.
COPY_SHARE = 0.8
# Element names, and words of class, id and role attributes.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title "
                "xmp".split())
FURNITURE = frozenset("aside button dialog footer form header menu nav search select".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments complementary contentinfo cookie cookies consent dialog disqus footer form gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo related reply replies search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)"
                  r"((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_NAME_PART = re.compile(r"[a-z]+")
_NEGATED = ("has", "no", "with", "without", "is")


@dataclass
class Page:
    """Lines of a page: text, whether in named furniture, whether in an article."""

    lines: list[str] = field(default_factory=list)
    furniture: list[bool] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)


def _named_furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in ("html", "body", "main", "article") and not in_article:
        return False
    if name in FURNITURE and not (name == "header" and in_article):
        return True
    if not attributes:
        return False
    for attribute, a, b, c in _ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), (a or b or c).lower()
        if (attribute == "hidden" or attribute == "aria-hidden" and value == "true"
                or attribute == "style" and _NOT_SHOWN.search(value)):
            return True
        if attribute not in ("class", "id", "role"):
            continue
        words = FURNITURE_WORDS - ({"header"} if in_article else set())
        for one in value.split():
            parts = _NAME_PART.findall(one)
            if not parts or parts[0] in _NEGATED:
                continue
            # an id inside an article may be the anchor of a heading, as in related-work
            named = parts if in_article and attribute == "id" else {parts[0], parts[-1]} & words
            if named and words.issuperset(named):
                return True
    return False


def parse(source: str | None) -> Page:
    """The lines of a page.  Unclosed and stray tags are taken as browsers roughly do."""
    page, source = Page(), source or ""
    stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, article, comments
    buffer: list[str] = []
    furniture = article = False

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                page.lines.append(text)
                page.furniture.append(furniture)
                page.article.append(article)

    def add(text: str):
        if text:
            buffer.append(html.unescape(text) if "&" in text else text)

    def state():
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    at = 0
    while True:
        tag = _TAG.search(source, at)
        if tag is None:
            add(source[at:])
            break
        add(source[at:tag.start()])
        at = max(tag.end(), tag.start() + 1)
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:  # an end tag: back to the element it closes, if one is open
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if any(s[0] in BLOCKS for s in stack[depth:]):
                        flush()
                    del stack[depth:]
                    break
            furniture, article = state()
            continue
        if name in RAW:
            if tag[3].endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in BLOCKS:
            flush()
            if name in _CLOSES:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in _CLOSES[name]:
                        del stack[depth:]
                        break
                    if stack[depth][0] in BLOCKS:
                        break
        if name in VOID or tag[3].endswith("/"):
            furniture, article = state()
            continue
        furniture, article = state()
        named = _named_furniture(name, tag[3], article)
        comments = bool(stack and stack[-1][3]) or (named and "comment" in tag[3].lower())
        if name in ("article", "main") and not named and not article and not comments:
            furniture = False  # an element left open before the text doesn't swallow it
        furniture = furniture or named
        article = article or (name == "article" and not furniture)
        stack.append((name, furniture, article, comments))
    flush()
    return page


def line_hashes(lines: list[str]) -> bytes:
    """A 64-bit hash of each line."""
    return b"".join(hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).digest()
                    for x in lines)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``, in order.

    Lines that both begin or end with are part of one.  Where few pairs of positions agree, these
    are followed one by one (Hunt and Szymanski); where lines repeat so that many do, ``a`` is halved
    and ``b`` cut where the two halves' lengths add up to most (Hirschberg), lengths being
    counted a machine word of positions at a time (Hyyro).  Time is near the product of
    both lengths over 64 at worst, memory near their sum.
    """
    known = set(b)
    places = [i for i, x in enumerate(a) if x in known]
    known = {a[i] for i in places}
    todo = [(0, [a[i] for i in places], [x for x in b if x in known])]
    out: list[int] = []
    while todo:
        at, a, b = todo.pop()
        n, most = 0, min(len(a), len(b))
        while n < most and a[n] == b[n]:
            n += 1
        m = 0
        while m < most - n and a[-1 - m] == b[-1 - m]:
            m += 1
        out += [*range(at, at + n), *range(at + len(a) - m, at + len(a))]
        at, a, b = at + n, a[n:len(a) - m], b[n:len(b) - m]
        where: dict[int, list[int]] = {}
        for j in range(len(b) - 1, -1, -1):
            where.setdefault(b[j], []).append(j)
        if sum(len(where.get(x, ())) for x in a) <= PAIRS_A_LINE * (len(a) + len(b)):
            out += [at + i for i in _follow(a, where)]
            continue
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[:half - 1:-1], b[::-1])[::-1]))
        todo += [(at, a[:half], b[:cut]), (at + half, a[half:], b[cut:])]
    return [places[i] for i in sorted(out)]


def _follow(a: list[int], where: dict[int, list[int]]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence; ``where`` has each line's places, last first."""
    ends: list[int] = []  # least end in b of a common subsequence of each length
    chains: list[tuple] = []
    for i, x in enumerate(a):
        for j in where.get(x, ()):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k] = j
                chains[k] = link
    out, link = [], chains[-1] if chains else None
    while link:
        out.append(link[0])
        link = link[1]
    return out


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """For j = 0 to len(b) the length of a longest common subsequence of ``a`` and ``b[:j]``."""
    lines, at = np.unique(np.array(b, np.int64), return_inverse=True)
    order, counts = np.argsort(at, kind="stable"), np.bincount(at)
    places = dict(zip(lines.tolist(), np.split(order, np.cumsum(counts)[:-1]), strict=True))
    kept: dict[int, int] = {}
    every = row = (1 << len(b)) - 1  # a bit is 0 where the length rises

    def mask(x: int) -> int:
        bits = np.zeros(len(b), np.uint8)
        bits[places[x]] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    for x in a:
        if x not in places:
            continue
        # masks of lines that repeat a lot are few
        same = kept.get(x) or mask(x)
        if places[x].size > PAIRS_A_LINE:
            kept[x] = same
        hit = row & same
        row = ((row + hit) | (row - hit)) & every
    raw = np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8)
    rises = np.unpackbits(raw, bitorder="little", count=len(b)) == 0
    return np.concatenate(([0], np.cumsum(rises)))


def _nearness(a: dict, b: dict | None) -> int:
    """How far two URL paths of one host agree, in segments; -1 for none or another host."""
    if b is None or a["host"] != b["host"]:
        return -1
    n = 0
    for x, y in zip(a["path"].split("/"), b["path"].split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


def _shared(page: dict, before: dict | None, after: dict | None) -> list[int] | None:
    """Lines outside articles that the nearest neighbour shares; a copy gives way to the other."""
    sides = sorted(((_nearness(page, x), -n, x) for n, x in enumerate((before, after))
                    if x is not None), key=lambda s: s[:2], reverse=True)
    lines, loose = page["lines"], [n for n, x in enumerate(page["loose"]) if x]
    for near, _, other in sides:
        if near < 0 or not loose:
            continue
        common = set(common_lines(lines, other["lines"]))
        body = [n for n, x in enumerate(page["body"]) if x]
        if body and sum(n in common for n in body) >= COPY_SHARE * len(body):
            continue
        return [n for n in loose if n in common]
    return []


_PAIRED = "key long, gone array<int>, edge int, place int, host string, path string, lines binary, " \
          "loose binary, body binary"
_PAIRED_ARROW = pa.schema([
    ("key", pa.int64()), ("gone", pa.list_(pa.int32())), ("edge", pa.int32()), ("place", pa.int32()),
    ("host", pa.string()), ("path", pa.string()), ("lines", pa.binary()), ("loose", pa.binary()),
    ("body", pa.binary())])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line hashes of each page and two flags of each line: outside articles, outside furniture."""
    for b in batches:
        out = []
        for source in b.column("html"):
            page = parse(source.as_py())
            out.append((line_hashes(page.lines),
                        bytes(not x for x in page.article),
                        bytes(not x for x in page.furniture)))
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [b.column("key"), b.column("host"), b.column("path"),
             *(pa.array(c, pa.binary()) for c in cols)],
            ["key", "host", "path", "lines", "loose", "body"])


def _opened(row: dict) -> dict:
    row["lines"] = np.frombuffer(row["lines"], np.int64).tolist()
    return row


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares sorted neighbours.  The first and last page of a partition, and one next to each,
    come out whole besides, for the comparison across partitions."""
    pid = TaskContext.get().partitionId()

    def row(page, gone, edge=None):
        whole = {k: page[k] for k in ("host", "path", "loose", "body")} | {
            "lines": np.array(page["lines"], np.int64).tobytes()} if edge is not None else {}
        return {"key": page["key"], "gone": gone, "edge": pid if edge is not None else None,
                "place": edge, **whole}

    before = page = None
    n = 0
    for b in batches:
        out = []
        for after in map(_opened, b.to_pylist()):
            if page is not None:
                if n == 1:
                    out += [row(page, None, 0), row(after, None, 1)]
                else:
                    out.append(row(page, _shared(page, before, after)))
            before, page, n = page, after, n + 1
        yield pa.RecordBatch.from_pylist(out, schema=_PAIRED_ARROW)
    if page is not None:
        ends = [row(page, None, 0 if n == 1 else 3)]
        if n > 2:
            ends.insert(0, row(before, None, 2))
        yield pa.RecordBatch.from_pylist(ends, schema=_PAIRED_ARROW)


def _compare_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The comparison across partitions, over at most four pages of each in order."""
    pages = [_opened(r) for b in batches for r in b.to_pylist()]
    out = []
    for n, page in enumerate(pages):
        if page["place"] in (0, 3):
            before = pages[n - 1] if n else None
            after = pages[n + 1] if n + 1 < len(pages) else None
            if after is not None and after["edge"] == page["edge"] and page["place"] == 3:
                after = None
            out.append({"key": page["key"], "gone": _shared(page, before, after)})
    yield pa.RecordBatch.from_pylist(
        out, schema=pa.schema([("key", pa.int64()), ("gone", pa.list_(pa.int32()))]))


def _keyed(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Adds key (of the row's content), host and path.

    The path loses query, fragment, file ending and trailing slash.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
                            r"(\.[A-Za-z0-9]{1,5})?/*$", "")
    return pages.withColumns({
        "__key": F.xxhash64(url_col, html_col),
        "__host": F.lower(F.regexp_extract(rest, r"^(?:www\.|m\.)?([^/?#]*)", 1)),
        "__path": path})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text and n_chars (code points) of every row of ``pages``.

    Null or empty html, and pages without text, give an empty text; pages without a
    URL, and pages alone on their host, have no neighbour and are judged by markup
    alone.  Rows that repeat a URL and html get the same text.  Only the three named
    columns are read.
    """
    keyed = _keyed(pages.select(id_col, url_col, html_col), url_col, html_col)
    facts = map_arrow(
        keyed.select(F.col("__key").alias("key"), F.col("__host").alias("host"),
                     F.col("__path").alias("path"), F.col(html_col).alias("html")),
        _facts, "key long, host string, path string, lines binary, loose binary, body binary")
    order = ["host", "path", "key"]
    ranged = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    paired = stage(map_arrow(ranged, _compare, _PAIRED), "page-pairs")
    edges = (paired.where("edge is not null").repartition(1).sortWithinPartitions("edge", "place"))
    across = map_arrow(edges, _compare_edges, "key long, gone array<int>")
    gone = stage(paired.where("edge is null").select("key", "gone").unionByName(across)
                 .where("size(gone) > 0").dropDuplicates(["key"]), "page-gone")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for source, dropped in zip(b.column("html"), b.column("gone").to_pylist(), strict=True):
                page, dropped = parse(source.as_py()), set(dropped or ())
                keep = [n for n in range(len(page.lines))
                        if n not in dropped and not page.furniture[n]]
                if any(page.article[n] for n in keep):
                    keep = [n for n in keep if page.article[n]]
                texts.append("\n".join(page.lines[n] for n in keep))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    id_type = pages.schema[id_col].dataType.simpleString()
    joined = (keyed.join(gone.withColumnsRenamed({"key": "__key"}), "__key", "left")
              .select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                      F.col(html_col).alias("html"), "gone"))
    out = map_arrow(joined, write, f"id {id_type}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
