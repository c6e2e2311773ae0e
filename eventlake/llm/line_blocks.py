"""Main text of a page by the distribution of text over its lines.

Markup is stripped to lines: one per block element, with the length of its text outside links. Lines
inside menus, headers, footers, sidebars, notices, adverts, forms and comments stay as empty lines.
Lengths are summed over a sliding window; the text starts where a sum surges and ends where it dives
to nothing. Elements that hold such lines give their other lines with text too. A page that names its
article limits the lines to it, unless the rest of the page has several times the article's text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import beside, on_texts, prepare_python

WINDOW = 3
SURGE = 80        # characters in a window that make a surge, on a page of lines that reach them
LITTLE = 0.25     # of the text found otherwise; less is not taken for the main text

# Fixed values of HTML: elements without text, elements without an end tag, elements inside a line.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "head", "title", "iframe", "object", "canvas",
          "select", "textarea", "button", "audio", "video"}
RAW = {"script", "style", "textarea", "title"}     # without an end tag they run to the end of the page
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "ruby", "rt", "rp"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
# Parts of class names and ids: those of noise, those that are noise unless the name also speaks of
# content, those of content, and first or last parts of names that only tell a state.
NOISE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "cookie", "cookies",
         "consent", "gdpr", "comment", "comments", "commentlist", "respond", "replies", "disqus", "sidebar", "nav", "navbar",
         "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "newsletter", "popup", "modal", "banner", "masthead",
         "pagination", "topbar"}
WHOLE_NAMES = {"widget", "widgets", "widget-area"}     # page builders have the part in the name of every block
PERHAPS = {"header", "head", "foot", "side", "aside", "notice", "promo", "subscribe", "signup", "share", "sharing", "social",
           "related", "recommended", "toolbar", "pager", "login", "search", "form"}
CONTENT = {"article", "content", "story", "post", "entry", "main", "body", "text"}
STATES = {"has", "no", "with", "without", "not", "is", "open", "closed", "enabled", "disabled"}
# elements that end when another of their kind begins or their parent ends
SELF_ENDING = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SINGLE = HEADINGS | {"p", "li", "dt", "dd", "td", "th"}     # hold the lines of one paragraph

QUOTES = {"blockquote", "figcaption"}
# The tag form stops at the next "<", so that broken tags cost no more than their length; ``Tags`` reads
# those that have one in a quoted value.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|"
                   r"</?[A-Za-z][^<>\"']*(?:\"[^<>\"]*\"[^<>\"']*|'[^<>']*'[^<>\"']*)*>|[^<]+|<", re.S)
BROKEN_OFF = re.compile(r"</?[A-Za-z][^<>]*\Z")     # a tag that the page breaks off is no text
TAG_BEGINS = re.compile(r"</?[A-Za-z]")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
NAMED = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
SPACE = re.compile(r"\s+")


# What tells that an element is aside: its kind, also its role or being hidden, also its class and id.
BY_KIND, BY_STATE, BY_NAMES = range(3)


def _is_aside(name: str, tag: str, in_article: bool, by: int) -> bool:
    if name in ASIDE or name == "header" and not in_article:
        return True
    if by == BY_KIND or name in ("html", "body") or name in ARTICLE or " " not in tag and "\n" not in tag and "\t" not in tag:
        return False
    given = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in NAMED.finditer(tag)}
    if given.get("role", "").lower() in ROLES or "hidden" in given and given["hidden"] in ("", "hidden") \
            or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
        return True
    if by < BY_NAMES:
        return False
    names = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
    parts = {p for n in names for q in [re.split("[-_]", n)] if not {q[0], q[-1]} & STATES for p in q}
    return bool(parts & NOISE or WHOLE_NAMES & set(names)) or bool(parts & PERHAPS and not parts & CONTENT)


class Tags:
    """Ends of tags with "<" or ">" in quoted values, found in time linear in the page.

    Whether a tag ends depends on the next quote or ">" outside quotes alone. Those from which no end is
    reached are remembered, and no later tag goes on from them.
    """

    def __init__(self, html: str):
        self.html, self.dead = html, set()
        self.places: dict[str, list[int]] | None = None

    def end(self, at: int) -> int | None:
        """The place behind the tag that begins at ``at``, None if it has no end."""
        if self.places is None:
            self.places = {c: [] for c in ">\"'"}
            for found in re.finditer("[>\"']", self.html):
                self.places[found.group()].append(found.start())
            self.signs = sorted(p for places in self.places.values() for p in places)
        place, seen = at + 2, []
        while (k := bisect_left(self.signs, place)) < len(self.signs) and (sign := self.signs[k]) not in self.dead:
            if self.html[sign] == ">":
                return sign + 1
            seen.append(sign)
            same = self.places[self.html[sign]]
            k = bisect_left(same, sign + 1)
            if k == len(same):
                break
            place = same[k] + 1
        self.dead.update(seen)
        return None


class Line(NamedTuple):
    """``length`` is that outside links, ``spoken`` also that of linked headings and quotes; ``element`` and
    ``parent`` are numbers of elements as they open, ``ends`` has the number of the last element that opens
    in the parent, ``quoted`` is the element that holds the quote a line is in, or -1."""
    text: str
    length: int
    spoken: int
    quoted: int
    article: bool
    element: int
    parent: int
    ends: list[int]
    name: str


def holders_of(lines: list[Line]) -> list[int]:
    """The element that holds a line and its like: the parent of a paragraph, heading, item or cell,
    and of any other element with this one line; else the element itself."""
    own, parents = Counter(line.element for line in lines if line.text), {line.parent for line in lines if line.text}
    return [line.parent if line.name in SINGLE or own[line.element] < 2 and line.element not in parents else line.element
            for line in lines]


def lines_of(html: str, by: int = BY_NAMES) -> tuple[list[Line], list[int], int]:
    """Every line, the element that holds it, and the length of aside text; aside lines have no text."""
    lines, words, linked, unseen = [], [], 0, 0
    endless: set[str] = set()     # names without an end tag in the rest of the page
    stack: list[tuple[str, bool, bool, int, list[int]]] = []     # name, aside, article, number, last number in it
    opened, page_ends, tags, named = 0, [0], Tags(html), Counter()     # open elements by name
    quotes: list[int] = []     # elements that hold the open quotes
    aside = articles = links = 0

    def end_line() -> None:
        nonlocal words, linked, unseen
        if words:
            text = SPACE.sub(" ", "".join(words)).strip()
            if aside:
                unseen += len(text)
                text, linked = "", 0
            if text or aside:
                name, number = (stack[-1][0], stack[-1][3]) if stack else ("", 0)
                parent, ends = stack[-2][3:] if len(stack) > 1 else (0, page_ends)
                outside = max(0, len(text) - linked)
                lines.append(Line(text, outside, len(text) if name in HEADINGS or quotes else outside,
                                  quotes[0] if quotes else -1, articles > 0, number, parent, ends, name))
        words, linked = [], 0

    def leave(depth: int) -> None:
        nonlocal aside, articles
        while len(stack) > depth:
            left, was_aside, was_article, _, ends = stack.pop()
            named[left] -= 1
            if left in QUOTES:
                quotes.pop()
            ends[0] = opened
            aside -= was_aside
            articles -= was_article

    at, size = 0, len(html)
    while at < size:
        token = TOKEN.match(html, at)
        part = token.group()
        if part == "<" and TAG_BEGINS.match(html, at):
            end = tags.end(at) or (size if BROKEN_OFF.match(html, at) else None)
            part = html[at:end] if end else part
        at += len(part)
        if part[0] != "<" or part == "<":
            text = unescape(part)
            words.append(text)
            if links:
                linked += len(text.strip())
            continue
        found = TAG.match(part)
        if not found:
            if part.startswith("<![CDATA["):
                words.append(part[9:-3])
            continue
        closing, name = bool(found[1]), found[2].lower()
        if name in SILENT:
            if not closing and not part.endswith("/>"):
                end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                inner = re.compile(r"<body\b", re.I).search(html, at) if name == "head" and name not in endless else None
                if end or inner or name in RAW:
                    at = min(end.end() if end else size, inner.start() if inner else size)
                else:     # left open: read on behind the tag
                    endless.add(name)
            continue
        if name in INLINE and not (not closing and _is_aside(name, part, articles > 0, by)) and not (
                closing and any(s[0] == name for s in stack[-1:])):
            if name == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        end_line()
        if name in VOID:
            continue
        if closing:
            if named[name]:
                leave(next(depth for depth in range(len(stack) - 1, -1, -1) if stack[depth][0] == name))
            links = 0
            continue
        if part.endswith("/>"):
            continue
        if stack and stack[-1][0] == name and name in SELF_ENDING:
            leave(len(stack) - 1)
        is_aside, is_article = _is_aside(name, part, articles > 0, by), name in ARTICLE
        if name in QUOTES:
            quotes.append(stack[-1][3] if stack else 0)
        opened += 1
        stack.append((name, is_aside, is_article, opened, [opened]))
        named[name] += 1
        aside += is_aside
        articles += is_article
    end_line()
    leave(0)
    page_ends[0] = opened
    return lines, holders_of(lines), unseen


def main_text(html: str | None) -> str:
    """The text between surges and dives, lines joined by one space.

    Class names and ids are not believed where they leave little of the page, a story may sit in one
    element of a misleading class, and neither are roles and hiding where nothing is left.
    """
    html = html or ""
    lines, holders, unseen = lines_of(html)
    text = _between(lines, holders)
    if not text or _is_little(len(text), len(text) + unseen):
        more = _between(*lines_of(html, BY_STATE)[:2])
        if not text or _is_little(len(text), len(more)):
            text = more
    return text or _between(*lines_of(html, BY_KIND)[:2])


def _between(lines: list[Line], holders: list[int]) -> str:
    """The main text: that of a named article, unless the page has far more outside it."""
    whole = _spans(lines, holders)
    inside = [line.article for line in lines]
    if any(inside):
        bound = _spans([line for line in lines if line.article], [h for h, i in zip(holders, inside) if i])
        if bound and not _is_little(len(bound), len(whole)):
            return bound
        return whole or " ".join(line.text for line in lines if line.article and line.text)
    return whole


def _is_little(some: int, more: int) -> bool:
    return more >= SURGE and some < LITTLE * more


def _spans(lines: list[Line], holders: list[int]) -> str:
    """The lines from surge to dive, and the other text lines of the elements that hold them.

    A surge is relative to the page: SURGE characters, or half of the sum that half of the text
    reaches where that is less. A span begins with the line that makes it surge, or with shorter
    paragraphs or lines of the same element right before it. Lines of links alone are kept only between a surge and its dive, unless
    they are headings or quotes.
    """
    lengths = [line.length for line in lines]
    sums = [sum(lengths[i:i + WINDOW]) for i in range(len(lengths))]
    if max(sums, default=0) < SURGE and not any(c.isalnum() for line in lines for c in line.text):
        return ""     # stray signs
    surge = min(SURGE, _middle(sums, lengths) / 2)
    kept, i, dived = [False] * len(lines), 0, 0
    while i < len(lines):
        if sums[i] < surge or not lengths[i]:
            i += 1
            continue
        near = range(i, min(i + WINDOW, len(lines)))
        makers = {holders[j] for j in near if lengths[j] * WINDOW >= surge}
        i = next(j for j in near if lengths[j] and (holders[j] in makers or lines[j].name == "p"))
        for j in range(_heading_above(lines, dived, i), i):
            kept[j] = lines[j].spoken > 0
        while i < len(lines) and sums[i]:  # to the dive: a window without text
            kept[i] = True
            i += 1
        dived = i
    holding = {h for h, k, n in zip(holders, kept, lengths) if k and n}
    return " ".join(line.text for line, h, k in zip(lines, holders, kept)
                    if line.text and (k or line.spoken and (h in holding or line.quoted in holding)))


def _heading_above(lines: list[Line], first: int, start: int) -> int:
    """The place of the heading above line ``start``, of headings above each other the highest.

    Between ``first`` and ``start``; its parent has to hold the line, with what is between them.
    """
    found, rank = start, "h7"
    for j in range(start - 1, first - 1, -1):
        line = lines[j]
        if line.name in HEADINGS and line.spoken and line.name < rank and line.parent <= lines[start].element <= line.ends[0]:
            found, rank = j, line.name
    return found


def _middle(sums: list[int], lengths: list[int]) -> int:
    """The window sum at or above which half of the text lies."""
    left = sum(lengths) / 2
    for total, length in sorted(zip(sums, lengths), reverse=True):
        left -= length
        if left <= 0:
            return total
    return 0


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) of the main text of ``html``.

    Null and empty pages, and pages without text outside links and asides, give the empty text.
    Broken markup is read as far as it goes: elements left open end with their parent or the page.
    Repeated rows get equal texts; columns named ``text`` or ``n_chars`` give way; an empty table
    gives an empty result.
    """
    prepare_python(pages.sparkSession)

    def rows(pages_: list) -> list[tuple]:
        texts = [main_text(p) for p in pages_]
        return [(t, len(t)) for t in texts]

    return beside(pages, on_texts(rows, "text string, n_chars long")(F.col("html")), ["text", "n_chars"])
