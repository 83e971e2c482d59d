"""A small document tree of HTML pages for the Arrow functions of ``web``.

Elements are kept in page order with the place where each ends, so "inside of" is a comparison of two numbers. An end tag closes the
nearest open element of its name and all inside it; one without such an element is ignored. A new paragraph closes an open one, unless
an element that can hold paragraphs of its own stands between. All else that is open ends with the page: elements, comments, and
tags, but a quote that is never closed ends with its word. Reading takes time in proportion to the page, however broken it is.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from html import unescape

# Elements without an end tag, elements whose text is not shown, elements that bound an open paragraph.
VOID = {"area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr"}
UNSEEN = {"script", "style", "template"}
BOUNDS = {"html", "body", "div", "article", "section", "main", "aside", "header", "footer", "nav", "td", "th", "caption", "table", "li", "blockquote", "button", "object", "marquee", "applet"}


class Element:
    __slots__ = ("tag", "attrs", "at", "end", "first", "last", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], at: int, first: int, parent: Element | None):
        self.tag, self.attrs, self.at, self.first, self.parent = tag, attrs, at, first, parent
        self.end = self.last = 0  # set when it is closed

    @property
    def classes(self) -> str:
        return " ".join(self.attrs.get("class", "").split())


_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*(?:([^\s/>][^\s/>=]*)(\s*=\s*)?)?")
_BARE = re.compile(r"[^\s>]*")


class Page:
    """The elements of a page in order, and its text nodes, trimmed, without those that are empty or not shown."""

    def __init__(self, html: str):
        self.root = Element("", {}, -1, 0, None)
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self.places: dict[str, list[int]] = {}
        self._open, self._names, self._paragraphs = [self.root], {}, [0]
        self._read(html)
        while self._open:
            self._pop()

    def _read(self, html: str) -> None:
        at, pieces, never = 0, [], set()
        while at < len(html):
            tag = html.find("<", at)
            tag = len(html) if tag < 0 else tag
            pieces.append(html[at:tag])
            kind = html[tag + 1 : tag + 2]
            if not (kind.isascii() and kind.isalpha()) and kind not in ("/", "!", "?"):
                pieces.append("<" * (tag < len(html)))
                at = tag + 1
                continue
            self._text("".join(pieces))
            pieces.clear()
            if kind.isalpha():
                at = self._start(html, tag + 1, never)
            else:
                at, end = (tag + 4, "-->") if html.startswith("!--", tag + 1) else (tag + 2, ">")
                close = html.find(end, at - 2 if end == "-->" else at)  # <!--> is a comment
                name = _NAME.match(html, at) if kind == "/" and close >= 0 else None
                if name:
                    self._close(name.group().lower())
                at = len(html) if close < 0 else max(at, close + len(end))
        self._text("".join(pieces))

    def _text(self, raw: str) -> None:
        text = unescape(raw).strip()
        if text and not any(self._names.get(tag) for tag in UNSEEN):
            self.texts.append(text)

    def _start(self, html: str, at: int, never: set[str]) -> int:
        """Read a start tag; ``never`` holds the quotes that do not occur again."""
        name = _NAME.match(html, at)
        at, tag, attrs, ended = name.end(), name.group().lower(), {}, False
        while at < len(html):
            found = _ATTRIBUTE.match(html, at)
            at, key, value = found.end(), found.group(1), ""
            if key is None:
                ended = html[at - 1] == "/"
                at += 1  # past the end of the tag
                break
            if found.group(2):
                quote = html[at : at + 1]
                close = html.find(quote, at + 1) if quote in ("'", '"') and quote not in never else -1
                if close >= 0:
                    value, at = html[at + 1 : close], close + 1
                else:
                    never.add(quote)
                    value = _BARE.match(html, at).group()
                    at += len(value)
            attrs[key.lower()] = unescape(value)
        if tag == "p" and self._paragraphs[-1]:
            self._close("p")
        e = Element(tag, attrs, len(self.elements), len(self.texts), self._open[-1])
        self.elements.append(e)
        self.places.setdefault(tag, []).append(e.at)
        self._open.append(e)
        self._names[tag] = self._names.get(tag, 0) + 1
        if tag in BOUNDS:
            self._paragraphs.append(0)
        self._paragraphs[-1] += tag == "p"
        if tag in VOID or ended:
            self._pop()
        elif tag in ("script", "style"):
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            return close.start() if close else len(html)
        return at

    def _close(self, tag: str) -> None:
        if self._names.get(tag):
            while self._pop() != tag:
                pass

    def _pop(self) -> str:
        e = self._open.pop()
        e.end, e.last = len(self.elements), len(self.texts)
        if e.at >= 0:
            self._names[e.tag] -= 1
        if e.tag in BOUNDS:
            self._paragraphs.pop()
        self._paragraphs[-1] -= e.tag == "p"
        return e.tag

    def text(self, e: Element) -> str:
        """The trimmed text nodes inside an element, joined without a gap."""
        return "".join(self.texts[e.first : e.last])

    def first(self, e: Element, tags: Iterable[str], holds: Callable[[Element], bool] = lambda e: True) -> Element | None:
        """The first element of some tags inside one."""
        best = e.end
        for places in (self.places.get(tag, []) for tag in tags):
            for i in range(bisect_right(places, e.at), len(places)):
                if places[i] >= best:
                    break
                if holds(self.elements[places[i]]):
                    best = places[i]
        return self.elements[best] if best < e.end else None

    def below(self, holds: Callable[[Element], bool], tag: str) -> Iterator[Element]:
        """Elements of a tag inside any element that holds, each once, in page order."""
        end = 0
        for e in self.elements:
            if e.at < end and e.tag == tag:
                yield e
            if e.end > end and holds(e):
                end = e.end
