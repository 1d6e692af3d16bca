"""The blocks of an HTML page's text, each with what the mark-up around it says of its part in the page."""

from __future__ import annotations

import html
import re

NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# up to the > that ends a tag, which quoted values may hold too; nothing is tried twice
INSIDE = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# HTML's own element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
                   "output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav aside footer form button select menu dialog canvas audio video".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Parts of class and id names that announce furniture.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe signup sidebar comment comments respond disqus menu nav "
    "navbar navigation breadcrumb breadcrumbs pagination pager share sharing social related recommended footer masthead "
    "widget toolbar".split())
WORDS = re.compile(r"[a-z]+")

PLAIN, ARTICLE, FURNITURE_TEXT = 0, 1, 2  # the parts of a block


def _furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in FURNITURE or name == "header" and not in_article:
        return True
    if not attributes or attributes.isspace():
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in ROLES:
            return True
        if key in ("class", "id"):
            parts = set(WORDS.findall(value))
            if parts & NAMES or "header" in parts and not in_article and name not in ("body", "html", "main", "article"):
                return name not in ("body", "html", "main") or bool(parts & {"comments"}) and name != "body"
    return False


def tags(page: str):
    """(start, end, kind, name, attributes) of every tag and comment, in page order; kind is start, end or other.

    The time is in proportion to the page, whatever it holds. A quoted value that never closes is no value: up to
    where it was met, tags end at their first >. A tag that never closes is text, but at the page's end it is dropped."""
    at, last, unclosed = 0, page.rfind(">"), -1
    ends: dict[str, int] = {}  # the next place of an ending, found once

    def ending(mark: str, start: int) -> int:
        """Where ``mark`` next ends from ``start`` on, the page's end if nowhere."""
        found = ends.get(mark, -1)
        if found < start:
            found = page.find(mark, start)
            ends[mark] = found = len(page) if found < 0 else found
        return min(len(page), found + len(mark))

    while (at := page.find("<", at)) >= 0:
        sign = page[at + 1: at + 2]
        if sign == "!" and page.startswith("<!--", at):
            stop = ending("-->", at + 4)
            yield at, stop, "other", "", ""
        elif sign == "!" and page.startswith("<![CDATA[", at):
            stop = ending("]]>", at + 9)
            yield at, stop, "other", "", ""
        elif sign and sign in "!?/":
            name = NAME.match(page, at + 2) if sign == "/" else None
            stop = ending(">", name.end() if name else at + 2)
            yield at, stop, "end" if name and at < last else "other", name.group().lower() if name else "", ""
        elif not (sign.isascii() and sign.isalpha()):
            stop = at + 1
        elif at > last:  # nothing closes it
            stop = len(page) if page.find("<", at + 1) < 0 else at + 1
            if stop > at + 1:
                yield at, stop, "other", "", ""
        else:
            name, end = NAME.match(page, at + 1), -1
            if at > unclosed:
                end = INSIDE.match(page, name.end()).end()
                if page[end: end + 1] != ">":
                    unclosed, end = end, -1
            if end < 0:
                end = page.find(">", name.end())
            stop = end + 1 if end >= 0 else at + 1
            if end >= 0:
                started = name.group().lower()
                attributes = page[name.end(): end]
                if started in RAW:
                    close = re.compile(f"</{re.escape(started)}\\b[^>]*+>", re.IGNORECASE)
                    found = close.search(page, stop) if stop <= last else None
                    stop = found.end() if found else len(page)
                yield at, stop, "start", started, attributes
        at = max(stop, at + 1)


class OpenTags:
    """The tags open at a place, with the nearest of each name at hand."""

    def __init__(self):
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of those that are no inline elements

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name not in INLINE:
            self.blocks.append(len(self.names))
        self.names.append(name)

    def pop(self) -> str:
        name = self.names.pop()
        self.places[name].pop()
        if name not in INLINE:
            self.blocks.pop()
        return name

    def nearest(self, name: str) -> int:
        """The place of the innermost open tag of that name, -1 for none."""
        return self.places[name][-1] if self.places.get(name) else -1

    def block(self) -> int:
        return self.blocks[-1] if self.blocks else -1


def blocks(page: str | None) -> tuple[list[str], list[int]]:
    """(the blocks in page order, the part of each): in furniture, else in an article or main element, else neither."""
    page = page or ""
    lines: list[str] = []
    parts: list[int] = []
    text: list[str] = []
    opened = OpenTags()
    articles, skipped, at = 0, None, 0  # skipped: how many tags were open outside the furniture

    def flush():
        if text:
            line = " ".join("".join(text).split())
            text.clear()
            if line:
                lines.append(line)
                parts.append(FURNITURE_TEXT if skipped is not None else ARTICLE if articles > 0 else PLAIN)

    def close(down_to: int):
        nonlocal articles, skipped
        while len(opened.names) > down_to:
            if opened.pop() in ("article", "main") and skipped is None:
                articles -= 1
            if skipped is not None and len(opened.names) <= skipped:
                flush()
                skipped = None

    for start, stop, kind, name, attributes in tags(page):
        if start > at:
            text.append(html.unescape(page[at:start]))
        at = stop
        if kind == "start":
            if name in RAW:
                continue
            if name == "br":
                text.append(" ")
                continue
            if name not in INLINE:
                flush()
            if name in VOID or attributes.rstrip().endswith("/") and name in INLINE:
                continue
            if name not in INLINE and (k := opened.block()) >= 0:
                if opened.names[k] == "p" or opened.names[k] == name and name in CLOSES_ITSELF:
                    close(k)
            if skipped is None and _furniture(name, attributes, articles > 0):
                if name in INLINE:
                    flush()
                skipped = len(opened.names)
            opened.push(name)
            if name in ("article", "main") and skipped is None:
                articles += 1
        elif kind == "end":
            if name not in INLINE:
                flush()
            k = opened.nearest(name)
            # an inline end tag closes nothing beyond its own block
            if k >= 0 and (name not in INLINE or k > opened.block()):
                close(k)
    if at < len(page):
        text.append(html.unescape(page[at:]))
    flush()
    return lines, parts
