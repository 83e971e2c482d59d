"""Text and links from raw web pages, read as document trees in Arrow functions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.dom import Element, Page

# Content containers by preference, least paragraph length, class hints (lower-case ones in any case),
# titles that are no news, least title length, block phrases, redirect prefix, abstract and preview lengths.
CONTAINER_CLASSES = ["article-content", "story-content", "post-content", "entry-content"]
PARAGRAPH_CHARACTERS = 30
HEADING_HINTS = ["title", "news"]
RESULT_HINTS = ["result", "news"]
ABSTRACT_HINTS = ["abstract", "content", "summary"]
ABSTRACT_CLASS = "c-span"
RESULT_ABSTRACT_HINTS = ["abstract", "content"]
NO_NEWS = ["官方网站", "百度百科", "移动官网"]
TITLE_CHARACTERS = 3
RESULTS = 10
BLOCK_PHRASES = ["百度安全验证", "安全验证"]
BLOCK_TITLE = "timeout"
REDIRECT = "/link?url="
ABSTRACT_CHARACTERS = 200
PREVIEW_CHARACTERS = 300


def _each(values: pd.Series, make) -> pd.Series:
    """``make(page)`` for every page; null stays null."""
    return values.map(lambda html: None if html is None else make(Page(html)))


def _hinted(e: Element, hints: Sequence[str]) -> bool:
    name = e.classes.lower()
    return any(hint in name for hint in hints)


def _paragraphs(page: Page) -> str:
    found: list[Element] = list(page.below(lambda e: e.tag == "article", "p"))
    for name in CONTAINER_CLASSES:
        found = found or list(page.below(lambda e: name in e.classes.split(), "p"))
    found = found or [e for e in page.elements if e.tag == "p"]
    return " ".join(text for text in map(page.text, found) if len(text) > PARAGRAPH_CHARACTERS)


def _headings(page: Page, tag: str) -> list[tuple[Element, Element]]:
    linked = [(e, page.first(e, ["a"])) for e in page.elements if e.tag == tag]
    linked = [(e, a) for e, a in linked if a]
    return [(e, a) for e, a in linked if _hinted(e, HEADING_HINTS)] or linked


def _abstract(page: Page, parent: Element, title: str) -> str:
    """Text of the first summary element, else all text without the title."""
    summary = page.first(parent, ["div", "span"], lambda e: _hinted(e, ABSTRACT_HINTS) or ABSTRACT_CLASS in e.classes)
    return page.text(summary) if summary else page.text(parent).replace(title, "", 1).strip()[:ABSTRACT_CHARACTERS]


def _target(link: str) -> str:
    found = re.search(r"url=([^&]+)", link) if link.startswith(REDIRECT) else None
    return unquote(found.group(1)) if found else link


def _results(page: Page, most: int) -> list[dict]:
    out = []

    def add(link: Element, way: int, make_abstract) -> None:
        title = page.text(link)
        if len(title) >= TITLE_CHARACTERS and not any(word in title for word in NO_NEWS) and (way == 1 or all(r["title"] != title for r in out)):
            out.append({"title": title, "link": _target(link.attrs.get("href", "")), "abstract": make_abstract(title), "way": way})

    for heading, link in _headings(page, "h3")[: 2 * most]:
        add(link, 1, lambda title, of=heading.parent: _abstract(page, of, title))
    if len(out) < most:
        boxes = [e for e in page.elements if e.tag in ("div", "article") and _hinted(e, RESULT_HINTS)]
        for box in boxes[: 2 * most]:
            heading = page.first(box, ["h3"])
            link = page.first(heading, ["a"]) if heading else None
            if link:
                summary = page.first(box, ["div", "span"], lambda e: _hinted(e, RESULT_ABSTRACT_HINTS))
                add(link, 2, lambda title, of=summary: page.text(of) if of else "")
            if len(out) >= most:
                break
    return out


def paragraphs(html: Column) -> Column:
    """Texts of paragraphs longer than thirty characters, joined by a space.

    Those inside article elements, else inside the first of the content classes that holds any, else all of the page. An unclosed
    paragraph ends at the next. A null page stays null.
    """
    return F.pandas_udf(lambda values: _each(values, _paragraphs), T.StringType())(html)


def headings(html: Column, tag: str = "h3") -> Column:
    """Array of (title, href) of headings that hold a link; those with a news-like class when there are any."""

    def found(page: Page) -> list[dict]:
        return [{"title": page.text(a), "href": a.attrs.get("href", "")} for _, a in _headings(page, tag)]

    return F.pandas_udf(lambda values: _each(values, found), "array<struct<title:string,href:string>>")(html)


def abstract(parent: Column, title: Column) -> Column:
    """Text of the summary element inside the heading's parent, else the first 200 characters of its text without the title."""

    def found(parents: pd.Series, titles: pd.Series) -> pd.Series:
        pages = [None if html is None else Page(html) for html in parents]
        return pd.Series([None if page is None else _abstract(page, page.root, name or "") for page, name in zip(pages, titles)], dtype=object)

    return F.pandas_udf(found, T.StringType())(parent, title)


def element_text(html: Column, tag: str) -> Column:
    """Text of the first element of a tag, empty if there is none."""

    def found(page: Page) -> str:
        e = page.first(page.root, [tag])
        return page.text(e) if e else ""

    return F.pandas_udf(lambda values: _each(values, found), T.StringType())(html)


def news_results(html: Column, most: int = RESULTS) -> Column:
    """Array of (title, link, abstract, way) from a page of search results.

    The first way takes linked headings with the summary beside them, twice ``most`` at most. If fewer than ``most`` remain without
    short titles and those of no news, the second way adds titles not seen yet from result containers. Redirects are decoded.
    """
    kind = "array<struct<title:string,link:string,abstract:string,way:int>>"
    return F.pandas_udf(lambda values: _each(values, lambda page: _results(page, most)), kind)(html)


def redirect_target(link: Column) -> Column:
    """The decoded target of a search redirect; any other link unchanged.

    Percent signs without two hex digits stay, and bytes that are no UTF-8 become the replacement character, so no link is an error. Only
    links that hold what the JVM's decoder refuses or may read otherwise go to Python.
    """
    target = F.regexp_extract(link, r"url=([^&]+)", 1)
    plain = F.try_url_decode(F.replace(target, F.lit("+"), F.lit("%2B")))
    odd = target.rlike(r"%(?![0-9A-Fa-f]{2})|%[89A-Fa-f][0-9A-Fa-f]")
    decoded = F.when(odd, F.pandas_udf(lambda v: v.map(lambda s: None if s is None else unquote(s)), T.StringType())(F.when(odd, target))).otherwise(plain)
    return F.when(link.startswith(REDIRECT) & (target != ""), decoded).otherwise(link)


def blocked(html: Column) -> Column:
    """A verification page, or one whose title speaks of a timeout."""
    title = F.lower(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    flag = title.contains(BLOCK_TITLE)
    for phrase in BLOCK_PHRASES:
        flag |= html.contains(phrase)
    return flag


def preview(text: Column, n: int = PREVIEW_CHARACTERS) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def strip_fences(text: Column, markers: Sequence[str] = ("```markdown", "```")) -> Column:
    for marker in markers:
        text = F.replace(text, F.lit(marker), F.lit(""))
    return F.regexp_replace(text, r"^\s+|\s+$", "")
