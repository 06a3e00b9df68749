"""Main text of web pages by composite text density.

Each node of a page gets its characters per tag, lowered by the share of link text (the composite
density of Sun, Song and Liao, 2011). The node whose children's densities sum highest is the core
of the page. Its ancestors belong to the content as long as they are as dense as the body-path
threshold asks; what is left of menus, notices and the like inside is then dropped by its markup.
Marked nodes that hold nearly all text of a page are its wrappers and are not dropped.
"""

from __future__ import annotations

import heapq
import html
import math
import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/><]*+)([^<>]*+)(?:>|$)"
    r"|<[!?/][^<>]*+(?:>|$)",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z0-9]+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)", re.I)

RAW = frozenset({"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg"})
UNSEEN = RAW | {"head", "object", "canvas", "audio", "video", "math"}
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BOILERPLATE_TAGS = frozenset(
    "nav header footer aside form button select menu dialog fieldset label option".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended widget toolbar comment comments "
    "disqus replies reply respond pagination pager "
    "contentinfo complementary search".split()
)
CONTENT_ROOTS = frozenset({"article", "main"})
# tags that also stand around a whole page
WRAPPER_TAGS = frozenset({"form", "fieldset"})
# what readers wrote, however long it is
TALK_WORDS = frozenset("comment comments disqus replies reply respond".split())
MODIFIERS = frozenset("has no with without".split())
# marks: a name that holds a boilerplate word may be a wrapper's, one that is such a word hardly
LOOSE, NAMED, NEVER = 1, 2, 3
WRAPPED = 9
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "option", "td", "th", "tr", "caption", "legend"}
# blocks that are a part of a text and never all of it
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd br hr pre blockquote td th tr".split())
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table tbody thead tfoot select article section div body html".split())


def _mark_of(name: str) -> int:
    own = WORD.findall(name)
    if BOILERPLATE_WORDS.isdisjoint(own):
        return 0
    talk = own[0] not in MODIFIERS and not TALK_WORDS.isdisjoint(own)
    return NAMED if name in BOILERPLATE_WORDS or talk else LOOSE


class Page:
    """The nodes of a page in page order, a parent before its children, and its pieces of text."""

    def __init__(self, source: str) -> None:
        self.parent, self.tag, self.mark = [-1], ["html"], [0]
        self.texts: list[tuple[int, str]] = []
        self._parse(source)

    def _add(self, parent: int, tag: str, attributes: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        mark = 0
        if tag in BOILERPLATE_TAGS:
            mark = LOOSE if tag in WRAPPER_TAGS else NEVER
        if mark < NEVER and attributes and tag not in CONTENT_ROOTS and tag != "body":
            for _, *value in NAMES.findall(attributes):
                for name in "".join(value).lower().split():
                    mark = max(mark, _mark_of(name))
            if HIDDEN.search(attributes):
                mark = NEVER
        self.mark.append(mark)
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack, at, ends = [0], 0, len(source)
        low = None
        while at < ends:
            m = TOKEN.search(source, at)
            start = m.start() if m else ends
            if start > at:
                self.texts.append((stack[-1], source[at:start]))
            if not m:
                return
            at = m.end()
            closing, tag, attributes = m[1] or m[4], m[2] or m[5], m[3] or m[6] or ""
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._close(stack, tag)
                continue
            if tag in CLOSES_P:
                self._close(stack, "p", SCOPES)
            for sibling in SIBLINGS.get(tag, ()):
                self._close(stack, sibling, SCOPES - {sibling})
            if tag == "html":
                continue
            if tag in BLOCKS:
                self.texts.append((stack[-1], " "))
            node = self._add(stack[-1], tag, attributes)
            if tag in RAW:
                low = source.lower() if low is None else low
                end = low.find(f"</{tag}", at)
                at = ends if end < 0 else end
            if tag not in VOID:
                stack.append(node)

    def _close(self, stack: list[int], tag: str, scopes: frozenset = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name == tag:
                del stack[k:]
                if tag in BLOCKS:
                    self.texts.append((stack[-1], " "))
                return
            if name in scopes:
                return


def _densities(page: Page, own: list[int]) -> list[float]:
    """Composite text density of each node; ``own``: characters directly inside it."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = own[:], [0] * n, [0] * n, [0] * n
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        if page.tag[k] in UNSEEN:
            continue
        if page.tag[k] == "a":
            link_chars[k], link_tags[k] = chars[k], link_tags[k] + 1
        chars[up] += chars[k]
        tags[up] += tags[k] + 1
        link_chars[up] += link_chars[k]
        link_tags[up] += link_tags[k]
    density = [0.0] * n
    linked = link_chars[0] / max(chars[0], 1)
    for k in range(n):
        c, t, lc, lt = chars[k], max(tags[k], 1), link_chars[k], max(link_tags[k], 1)
        if not c:
            continue
        density[k] = c / t
        if linked:
            base = math.log(c / max(c - lc, 1) * lc + linked * c + math.e)
            density[k] *= math.log(max(c / max(lc, 1) * t / lt, 1.0)) / math.log(base)
    return density


def _unwrap(page: Page, mark: list[int], own: list[int]) -> None:
    """Takes the marks off the nodes that are wrappers.

    These are ``LOOSE`` ones that hold ``WRAPPED`` times the text left outside of marked nodes, and
    ``NAMED`` ones if no text is left at all; text of links does not count.
    """
    n = len(page.tag)
    owner, unseen, plain = [0] * n, [False] * n, [0] * n
    inner: dict[int, list[int]] = {}
    for k in range(n):
        up = page.parent[k]
        if k:
            skipped = page.tag[k] == "a" or page.tag[k] in UNSEEN or mark[k] == NEVER
            unseen[k], owner[k] = unseen[up] or skipped, owner[up]
            if mark[k]:
                inner.setdefault(owner[up], []).append(k)
                owner[k] = k
        if not unseen[k]:
            plain[owner[k]] += own[k]
    whole = plain[:]
    for k in range(n - 1, 0, -1):
        if mark[k]:
            whole[owner[page.parent[k]]] += whole[k]
    left = plain[0]
    todo = [(mark[k], -whole[k], k) for k in inner.get(0, ())]
    heapq.heapify(todo)
    while todo:
        kind, size, k = heapq.heappop(todo)
        if -size > left * WRAPPED and (kind == LOOSE or kind == NAMED and not left):
            mark[k] = 0
            left += plain[k]
            for inside in inner.get(k, ()):
                heapq.heappush(todo, (mark[inside], -whole[inside], inside))


def main_text(source: str | None) -> str:
    """The blocks of the main text of an HTML page, joined by spaces; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    n = len(page.tag)
    holds_content = [False] * n
    for k in range(n - 1, 0, -1):
        holds_content[k] |= page.tag[k] in CONTENT_ROOTS
        holds_content[page.parent[k]] |= holds_content[k]
    own = [0] * n
    for node, text in page.texts:
        if page.tag[node] not in UNSEEN:
            own[node] += len(text.strip())
    fixed = BOILERPLATE_TAGS - WRAPPER_TAGS
    mark = [
        0 if holds and tag not in fixed else m
        for m, holds, tag in zip(page.mark, holds_content, page.tag, strict=True)
    ]
    if any(mark):
        _unwrap(page, mark, own)
    dropped = [False] * n
    for k in range(1, n):
        dropped[k] = dropped[page.parent[k]] or mark[k] > 0 or page.tag[k] in UNSEEN
    density = _densities(page, own)
    sums = [0.0] * n
    for k in range(1, n):
        if not dropped[k]:
            sums[page.parent[k]] += density[k]
    # text of its own counts like a child without tags
    best = max(
        (k for k in range(n) if not dropped[k]),
        key=lambda k: sums[k] + own[k], default=0,
    )
    while page.parent[best] >= 0 and (page.tag[best] in PARTS or page.tag[best] not in BLOCKS):
        best = page.parent[best]
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    outer = [k for k in path if page.tag[k] in CONTENT_ROOTS]
    if outer:
        root = outer[-1]
    else:
        above = [k for k in path if page.tag[k] in ("body", "html")]
        threshold = density[above[0]] if above else 0.0
        root = best
        for k in path[1:]:
            if page.tag[k] in ("body", "html") or density[k] < threshold:
                break
            root = k
    inside = [False] * n
    inside[root] = True
    for k in range(root + 1, n):
        inside[k] = inside[page.parent[k]]
    return _joined(page, inside, dropped)


def _joined(page: Page, inside: list[bool], dropped: list[bool]) -> str:
    """Text of the nodes kept, decoded; where blocks meet, the parser has left a space."""
    kept = (html.unescape(text) for node, text in page.texts if inside[node] and not dropped[node])
    return " ".join("".join(kept).split())


@F.pandas_udf(StringType())
def _main_text(source: pd.Series) -> pd.Series:
    return source.map(main_text)


def extract(source: Column) -> Column:
    """Main text of a column of HTML.

    NULL, empty and text-free pages give an empty text; a page without any tag is all text.
    References are decoded, white space becomes single spaces, nothing is cut. Equal pages give
    equal texts, so neither ties nor repeated rows matter.
    """
    return _main_text(F.coalesce(source, F.lit("")))
