"""Main text of web pages: markup first, then differencing with the nearest page.

A page becomes a list of blocks, each inside the article, outside of it, or inside an
element that is never main text. Where articles hold most of the text, only they and what
stands between them are looked at; a teaser leaves the rest of its page alone. Pages are sorted by
host and URL path; each is aligned with the nearest of its neighbours by a longest common
subsequence of lines, and lines outside articles that both share go. Lines inside an article
stay: two pages of a host that carry the same article share its lines as well.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sessionloom.config import default_parallelism
from sessionloom.llm.words import text_slices

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
BLANK = re.compile(r"\s+")

VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math object select xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
MAIN = {"article", "main"}
NEVER = set("nav header footer aside form button dialog menu head".split())
NEVER_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of a class or id that tell an element is no main text, whatever stands beside them.
NEVER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comments consent masthead navbar newsletter "
    "sidebar sidebars sponsored toolbar".split()
)
#: Words that tell so only where nothing but words of these three lists stands beside them.
NEVER_ALONE = set(
    "banner banners comment cookie cookies disclaimer footer header menu menus modal nav navigation notice notices overlay popup promo "
    "promos promotion related reply replies share sharing social sponsor sponsors subscribe subscription widget widgets".split()
)
#: Words about an element's place or form.
FORM_NAMES = set(
    "accept alert area article bar block body bottom box btn button buttons center clearfix close col column container content count entry "
    "fixed flex fluid footer full global grid group head hidden icon icons inner item items large left legal level link links list main media "
    "mobile nested outer page panel pane post primary right row secondary section site slot small sticky story text thread threaded title "
    "toggle top unit user visible wide wrap wrapper".split()
)
COMMENT_NAMES = set("comment comments reply replies".split())
#: Words that make a name one about the page's layout: no-sidebar, has-ads.
LAYOUT = set("has no not show with without".split())
NAME_BREAK = re.compile(r"[_-]+|(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _parts(names: str) -> list[str]:
    """The words of a class or id, but for names about layout and words with figures."""
    out: list[str] = []
    for name in names.split():
        words = [w.lower() for w in NAME_BREAK.split(name) if w]
        if LAYOUT.isdisjoint(words):
            out += [w for w in words if len(w) > 1 and not any(c.isdigit() for c in w)]
    return out


def _never_named(names: str, article: bool) -> bool:
    """Does a class or id tell that an element is no main text? Articles may be reader comments only."""
    words = _parts(names)
    if not article and not NEVER_NAMES.isdisjoint(words):
        return True
    telling = COMMENT_NAMES if article else NEVER_ALONE
    return not telling.isdisjoint(words) and all(w in NEVER_NAMES or w in NEVER_ALONE or w in FORM_NAMES for w in words)


def _never(name: str, attributes: str) -> bool:
    """Is an element of this name and these attributes never main text?"""
    if name in NEVER:
        return True
    if name in ("html", "body", "main") or not attributes.strip(" /"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(value.strip("\"'"))
        if key in ("class", "id") and _never_named(value, name == "article"):
            return True
        value = value.strip().lower()
        if key == "role" and value in NEVER_ROLES and name != "article":
            return True
        if (key == "itemprop" and value == "comment") or (key == "itemtype" and value.endswith(("/comment", "/usercomments"))):
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and HIDDEN.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, inside an article) of every block that may be main text, in page order.

    Character references are decoded and white space is one space. Elements left open
    end with the element around them, or with the page; a torn tag at the end goes.
    """
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    stack: list[str] = []
    never = main = 0  # depth of the outermost such element, or 0
    at = 0

    def close_block() -> None:
        if text:
            line = BLANK.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                out.append((line, main > 0))

    while True:
        tag = TAG.search(page, at)
        if tag is None:
            break
        if not never and tag.start() > at:
            text.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        attributes = tag[3] or tag[6] or ""
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if end is None:
                at = len(page)
                break
            at = end.start()
            tag = TAG.search(page, at)
            at = tag.end()
            if not never:
                text.append(" ")
            continue
        if name not in INLINE:
            if not never:
                close_block()
        elif name in ("br", "img", "wbr"):
            if not never and name == "br":
                text.append(" ")
            continue
        if name in VOID:
            continue
        if not closing:
            if name in MAIN and never and not main and not any(x.startswith("!") for x in stack):
                # An article begins inside an element that was left open.
                never = 0
            stack.append(name)
            if not never and _never(name, attributes):
                close_block()
                never = len(stack)
                if "comment" in attributes.lower():
                    stack[-1] = "!" + name
            elif name in MAIN and not main and not never:
                main = len(stack)
        else:
            for depth in range(len(stack), 0, -1):
                if stack[depth - 1].lstrip("!") == name:
                    del stack[depth - 1 :]
                    if never and len(stack) < never:
                        never = 0
                    if main and len(stack) < main:
                        main = 0
                    break
    if not never and at < len(page):
        text.append(page[at:])
    close_block()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """The places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Hunt and Szymanski: a longest increasing sequence of matching places.
    """
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    out: set[int] = set()
    chain = chains[-1] if chains else None
    while chain:
        out.add(chain[0])
        chain = chain[1]
    return out


@dataclass
class Page:
    row: tuple
    host: str | None
    path: str
    lines: list[tuple[str, bool]]


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def candidates(lines: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    """The lines that may be main text: from the first line of an article to the last, if
    articles hold at least half of the characters, else all."""
    inside = [k for k, (_, main) in enumerate(lines) if main]
    held = sum(len(lines[k][0]) for k in inside)
    if not inside or 2 * held < sum(len(text) for text, _ in lines):
        return lines
    return lines[inside[0] : inside[-1] + 1]


def main_text(page: Page, before: Page | None, after: Page | None) -> str:
    """The lines that may be main text, without those outside articles that the nearest page shares."""
    lines = candidates(page.lines)
    near = [p for p in (before, after) if p and page.host is not None and p.host == page.host and p.lines != page.lines]
    if near:
        other = max(near, key=lambda p: _alike(p.path, page.path))
        # An article's lines stay, so only the others are aligned.
        own = [k for k, (_, inside) in enumerate(lines) if not inside]
        shared = common_lines([lines[k][0] for k in own], [t for t, _ in other.lines])
        gone = {own[k] for k in shared}
        lines = [line for k, line in enumerate(lines) if k not in gone]
    return "\n".join(text for text, _ in lines)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
    for batch in batches:
        for part in text_slices(batch, "html"):
            for page_id, url, source, host, path in zip(*(c.to_pylist() for c in part.columns), strict=True):
                yield Page((page_id, url), host, path or "", blocks(source or ""))


def _extract(kind: pa.DataType):
    schema = pa.schema([("page_id", kind), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        before = page = None
        for after in _with_end(_pages(batches)):
            if page is not None:
                text = main_text(page, before, after)
                rows.append((*page.row, text))
                size += len(text)
                if size > 1 << 21:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            # An exact copy of a page is no neighbour; the one before it is.
            if page is not None and not (after and after.lines == page.lines):
                before = page
            page = after
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _with_end(pages: Iterator[Page]) -> Iterator[Page | None]:
    yield from pages
    yield None


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    A null or empty page has an empty text. A page without a host has no neighbour;
    neither has one whose neighbours are exact copies of it. Of two neighbours equally near
    the one before it counts. Repeated rows are extracted each by itself; texts of any
    length are read whole. Other columns are not read, whatever they are called; an empty
    table stays empty.
    """
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*?)/?(?:[?#].*)?$", 1)
    rows = pages.select("page_id", "url", "html", F.when(host != "", host).alias("host"), path.alias("path"))
    n = default_parallelism(pages.sparkSession)
    ordered = rows.repartitionByRange(n, "host", "path", "page_id").sortWithinPartitions("host", "path", "page_id")
    field = pages.schema["page_id"]
    found = ordered.mapInArrow(_extract(to_arrow_type(field.dataType)), f"page_id {field.dataType.simpleString()}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
