"""Main text of web pages by the distribution of text over lines.

Markup is stripped, each block of text becomes a line, and text lengths are summed over a sliding
window of lines.  Where the sum surges an article begins, where it dives to nothing it ends; the
lines between are kept, and the short ones that adjoin.  A line that stands in a menu, header, footer, sidebar, notice, advert, form
or comment section is left out before that; a short one that is all link has no weight, so that a list of links makes a dive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML.
_RAW = frozenset("script style noscript template textarea svg math iframe object title xmp noembed noframes".split())
_ASIDE = frozenset("nav header footer aside form menu dialog select button fieldset datalist".split())
_MAIN = frozenset("article main".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q ruby rb rt rp rtc s samp small span strike strong sub sup time tt u var".split()
)
# Words of class names, ids and roles that say what a part of a page is for.
_HINT = re.compile(
    r"(?:^|[\s_-])(?<!has[_-])(?<!with[_-])(?<!no[_-])(?<!without[_-])(ad|ads|adv|advert|adverts|advertisement|banner|promo|promoted|promotion|sponsor|sponsored|sponsors|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|aside|widget|header|masthead|footer|foot|"
    r"comment|comments|commentlist|disqus|respond|replies|reply|discussion|"
    r"cookie|cookies|consent|gdpr|notice|notification|alert|popup|modal|overlay|toast|"
    r"share|sharing|social|related|recommended|recommendations|subscribe|subscription|newsletter|signup|login|search|pagination|pager|"
    r"complementary|contentinfo|dialog|skip)(?=$|[\s_-]|\d)",
    re.I,
)
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_PLAIN, _QUOTE = re.compile(r"[^>\"']*"), re.compile(r"[>\"']")
_NOTICE = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.I)
_NAMES = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


def _aside(name: str, attributes: str, within: bool) -> int:
    """Whether an element holds something else than the article: 2 for certain, 1 by a hint, 0 not.

    Within an article a header is its heading, and no hint makes a heading something else.
    """
    if name in _ASIDE:
        return 0 if name == "header" and within else 2
    if not attributes or name in _MAIN or name in ("body", "html"):
        return 0
    if _HIDDEN.search(attributes):
        return 2
    if name in _HEADING:
        return 0
    words = {w.lower() for a, b, c in _NAMES.findall(attributes) for w in _HINT.findall(a or b or c)}
    return int(bool(words - {"header", "masthead"} if within else words))


def tags(html: str) -> Iterator[tuple[str, bool, str, str]]:
    """The page's parts, in order: ("", False, "", text), or a tag's name, whether it closes, its attributes and "".

    Comments and declarations are left out.  Quotes in a tag may hold ">".  Where one never ends, the tags after it end at the
    first ">", and a tag without ">" takes the rest, so every character is read a few times at most.
    """
    at, end, quotes = 0, len(html), True
    while at < end:
        start = html.find("<", at)
        if start < 0:
            yield "", False, "", html[at:]
            return
        m = _TAG.match(html, start + 1)
        mark = html.startswith(("<!", "<?"), start)
        if not m and not mark:
            yield "", False, "", html[at : start + 1]
            at = start + 1
            continue
        if start > at:
            yield "", False, "", html[at:start]
        if mark:
            comment = html.startswith("<!--", start)
            stop = html.find("-->" if comment else ">", start + 2)
            at = end if stop < 0 else stop + (3 if comment else 1)
            continue
        stop = m.end()
        while quotes:
            stop = _PLAIN.match(html, stop).end()
            if stop >= end or html[stop] == ">":
                quotes = stop < end
                break
            stop = html.find(html[stop], stop + 1) + 1
            quotes = stop > 0
        if not quotes:
            stop = html.find(">", m.end())
        at = end if stop < 0 else stop + 1
        yield m[2].lower(), m[1] == "/", html[m.end() : end if stop < 0 else stop], ""
        if m[2].lower() in _RAW and not m[1] and not html.startswith("/>", at - 2):
            close = re.compile(rf"</{re.escape(m[2])}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            yield m[2].lower(), True, "", ""


def blocks(html: str) -> list[tuple[str, int, bool, bool]]:
    """The page's lines, in order: text, whether it is beside the article, whether it is within an article element, whether links make up most of it.

    Beside is 2 for certain, and 1 if only a hint around the article element says so.
    """
    out: list[tuple[str, int, bool, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # of elements that are not closed: name, beside, within
    open_names: Counter[str] = Counter()
    beside, within, link = 0, False, False
    chars = [0, 0]  # of the held text, outside links and in links

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, beside, within, chars[1] > chars[0]))
        chars[:] = 0, 0

    def close(name: str) -> None:
        nonlocal beside, within
        while open_names[name]:
            last, beside, within = stack.pop()
            open_names[last] -= 1
            if last == name:
                return

    for name, closes, attributes, text in tags(html):
        if not name:
            held.append(text)
            chars[link] += len(text.strip())
        elif name in _RAW or name in _VOID or name in ("td", "th"):
            held.append(" ")
            if name == "hr":
                flush()
        elif name in _INLINE:
            # An inline element can be an advert too, but then it stands for itself.
            if name == "a":
                link = not closes
        else:
            flush()
            if closes:
                close(name)
            elif not attributes.endswith("/"):
                if stack and stack[-1][0] == "p":  # a paragraph may lack its end: it never holds blocks
                    close("p")
                stack.append((name, beside, within))
                open_names[name] += 1
                aside = _aside(name, attributes, within)
                beside = max(beside, 2 * (aside > 0) if within else aside)
                if name == "main" and beside == 1:
                    beside = 0  # a page has one
                within = within or name in _MAIN
    flush()
    return out


def window_sums(weights: list[int], window: int) -> list[int]:
    """Of each line's weight and those of the lines after it, ``window`` in all."""
    total = np.concatenate([[0], np.cumsum(np.array(weights, np.int64))])
    at = np.arange(len(weights))
    return (total[np.minimum(at + window, len(weights))] - total[at]).tolist()


def stretches(weights: list[int], window: int = 3, surge: int = 80) -> list[bool]:
    """Which lines stand between a surge and a dive.

    A stretch begins at a line of some weight where the sum over a window is above ``surge``, or before that at the lines of some weight
    that adjoin, and ends where the sum is nothing.
    """
    kept, inside = [False] * len(weights), False
    for i, total in enumerate(window_sums(weights, window)):
        if not inside and total > surge and weights[i]:
            inside, k = True, i
            while k and weights[k - 1] and not kept[k - 1]:
                k -= 1
            kept[k:i] = [True] * (i - k)
        elif inside and not total:
            inside = False
        kept[i] |= inside
    return kept


def main_text(html: str, window: int = 3, surge: int = 80) -> str:
    """The lines of the article, joined by "\n".

    Lines of menus, adverts and the like are left out first, by elements for certain, and for want of better by class names and, in pages
    with article or main elements, by standing outside them.  Lines outside come back if what is within is no more than
    ``surge`` characters and a third of theirs, and all that is not certain if nothing else is left.  A short line that is mostly link weighs nothing, any other its length; what stands
    between surge and dive of the sums over ``window`` lines stays.  If nothing surges, every line that was not left out stays.
    """
    lines = [x for x in blocks(html) if x[1] < 2]
    least = min((b for _, b, w, _ in lines if w), default=0)
    inner = any(w for _, _, w, _ in lines)

    def doubtful(text: str, beside: int, within: bool) -> bool:
        return beside > least if within else inner or beside > 0 or bool(_NOTICE.search(text))

    sure = [not doubtful(t, b, w) for t, b, w, _ in lines]
    plain = [x or not (w or b or _NOTICE.search(t)) for x, (t, b, w, _) in zip(sure, lines, strict=True)]
    mass, more = (sum(len(x[0]) for x, of in zip(lines, which, strict=True) if of) for which in (sure, plain))
    which = plain if mass <= surge and more > 4 * mass else sure
    sure = [(t, link) for (t, _, _, link), of in zip(lines, which, strict=True) if of or not any(which)]
    kept = stretches([0 if link and len(t) <= surge else len(t) for t, link in sure], window, surge)
    return "\n".join([t for (t, _), x in zip(sure, kept, strict=True) if x] or [t for t, _ in sure])


def extract(pages: DataFrame, name: str = "main_text", window: int = 3, surge: int = 80) -> DataFrame:
    """``pages`` with the text of column ``html`` in column ``name`` ("" for a null or empty page)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, window, surge) for x in batch], dtype=object)

    return pages.withColumn(name, F.pandas_udf(run, "string")(F.coalesce("html", F.lit(""))))
