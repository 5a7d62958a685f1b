"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines: every block element starts a line, white space
inside it becomes one space.  Navigation, headers outside the article, footers,
asides, forms, adverts, notices and comments leave one empty line.  Link text counts
as length 0; on pages with text in article and main elements (not those marked as
comments, related texts and the like) the text of these counts whole, links too, and
every line elsewhere counts as length 0 and is no main text.

On every page the main text is then read from the distribution of the counted lengths
over blocks of ``WINDOW`` lines: text surges in the first block of at least ``SURGE``, and
dives where a block is below it again; the region from the first counted line of the
surge to the dive is text.  On pages with such elements every region is main text.  On
others it is the region with the most text, the one with the longest block, and every
other with at least ``SHARE`` of the text of the one or of the block of the other.

Defined results.  Null html and pages without text: the empty text.  Text outside
any element counts as a line.  Unclosed elements end with their parent; an unclosed
skipped element ends where the article or main element starts.  A tag cut off by
the end of the page is dropped; a quote that nothing closes is part of its tag up to the next ``>``.  Repeated rows each get their result; other columns
stay as they are, columns named ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 1
SHARE = 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|textarea|select|svg|math|iframe|object|title)\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?:[\"'][^>]*)?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
# Names of elements and of classes that hold no main text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
SKIPPED = frozenset("head nav footer aside form menu button dialog".split())
MARKS = frozenset("ad ads advert advertisement advertising banner promo sponsor sponsored nav navbar navigation menu breadcrumb "
                  "breadcrumbs sidebar footer masthead comment comments reply replies cookie cookies consent notice popup "
                  "newsletter subscribe share social related widget".split())
#: Words that a class name may have beside marks: ``sidebar-left``, but not ``no-sidebar`` or ``share-price``.
_PLACES = frozenset("area bar block body bottom box buttons column container content footer form global header inner item items left "
                    "links list main outer page panel posts primary right secondary section site slot top unit wrap wrapper".split())
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[-_\d]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SPACE = re.compile(r"\s+")


def _marked(attributes: str) -> bool:
    """Does a name in class, id or role say that the element holds no main text?  Names
    count as a whole: each of their parts is a mark or a place, and one is a mark."""
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                parts = [p for p in _PARTS.split(name) if p]
                if name == "site-header" or not MARKS.isdisjoint(parts) and all(p in MARKS or p in _PLACES for p in parts):
                    return True
    return False


def lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """(line, counted length, may be main text, stands in an article) in page order."""
    out: list[tuple[str, int, bool, bool]] = []
    text: list[str] = []
    linked = 0
    skip, depth = "", 0       # open skipped element and how often its name is open
    in_article = in_link = 0
    plain: list[bool] = []    # open articles: not marked as something else

    def close() -> None:
        nonlocal linked
        line = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if line and not skip:
            inside = bool(plain) and all(plain)
            out.append((line, len(line) if inside else max(0, len(line) - linked), True, inside))
        text.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        name = (m[3] or "").lower()
        if not name:
            if m[1]:
                if m[1].lower() not in ("svg", "math"):
                    close()
            elif not m[0].startswith("<") or m[0] == "<":
                text.append(m[0])
                if in_link:
                    linked += len(m[0].strip())
            continue
        end = bool(m[2])
        if not m[0].endswith(">"):
            continue
        if name == "a":
            in_link = 0 if end else 1
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        close()
        if skip:
            if name in ("article", "main") and not end:
                skip = ""
            elif name == skip:
                depth += -1 if end else 1
                if not depth:
                    skip = ""
        elif not end and name not in _VOID and name not in ("article", "main", "body", "html") and (
                name in SKIPPED or name == "header" and not in_article or _marked(m[4] or "")):
            if out and out[-1][0]:  # what is skipped leaves one empty line
                out.append(("", 0, False, False))
            skip, depth = name, 1
        if name in ("article", "main"):
            in_article = max(0, in_article + (-1 if end else 1))
            if not end:
                plain.append(not _marked(m[4] or ""))
            elif plain:
                plain.pop()
    close()
    return out


def regions(lengths: list[int]) -> list[tuple[int, int, int, int]]:
    """(start, end, text, longest block) of each region between a surge and a dive."""
    n = len(lengths)
    blocks, total = [0] * n, 0
    for i in range(n - 1, -1, -1):  # blocks[i]: length of lines i .. i + WINDOW - 1
        total += lengths[i] - (lengths[i + WINDOW] if i + WINDOW < n else 0)
        blocks[i] = total
    out, i = [], 0
    while i < n:
        if blocks[i] < SURGE:
            i += 1
            continue
        while not lengths[i]:                     # surge: the lines before the first text of its block are none
            i += 1
        j = i
        while j < n and blocks[j] >= SURGE:       # dive: a whole block without text
            j += 1
        out.append((i, j, sum(lengths[i:j]), max(blocks[i:j])))
        i = j
    return out


def main_text(page: str | None) -> str:
    """The lines between surge and dive points, joined by line breaks."""
    rows = lines(page or "")
    if marked := any(r[3] for r in rows):
        rows = [r if r[3] else ("", 0, False, False) for r in rows]
    found = regions([r[1] for r in rows])
    most, highest = (max((r[k] for r in found), default=0) for k in (2, 3))
    return "\n".join(line for i, j, mass, block in found if marked or mass >= SHARE * most or block >= SHARE * highest
                     for line, _, text, _ in rows[i:j] if text)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, plus text and n_chars (code points)."""

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return page.map(main_text)

    return pages.withColumn("text", text_of(F.col(html).cast("string"))) \
        .withColumn("n_chars", F.length("text").cast("long")).drop(html)
