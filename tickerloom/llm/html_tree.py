"""Main-text extraction with a tree-structured graphical model over DOM nodes.

Each page becomes a tree: its block elements, and as leaves the runs of text between them. Every node has a hidden
binary state, content or not. Node potentials are linear in features of the node alone; a table of potentials ties a
node to its parent, one for leaves and one for elements. Sum-product messages upward and then downward give exact
marginals; both passes run over all pages of a batch at once, level by level. The weights maximise the
likelihood of labelled pages, whose gradient is observed less expected features. Text whose marginal is above one half is
content.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import bound_batches, small_batches

#: Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
HIDDEN = frozenset("script style title template noscript head iframe svg canvas object audio video select textarea button".split())
#: Elements that may stand in a head; any other ends it.
IN_HEAD = frozenset("base link meta title script style template noscript head html".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
) | frozenset(
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mspace mpadded mphantom semantics annotation".split()
)
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table div article section nav aside main header footer form body select blockquote".split())
#: Words in class, id and role that sites use for parts that are not the article, or are.
OUTER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header login menu nav navbar navigation "
    "newsletter notice pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe tags toolbar widget".split()
)
INNER_WORDS = frozenset("article body content entry main post story text".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_RAW_END = {name: re.compile(rf"</{name}[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*")
_SPACE = re.compile(r"\s+")

KINDS = "root article main section div p h li list table quote pre nav aside header footer form comment figure address other".split()
_KIND_OF = {
    **{k: k for k in KINDS}, "body": "root", "html": "root", **{f"h{i}": "h" for i in range(1, 7)}, "ul": "list", "ol": "list", "dl": "list", "menu": "list",
    "dt": "li", "dd": "li", "tr": "table", "td": "table", "th": "table", "tbody": "table", "thead": "table", "caption": "table", "blockquote": "quote",
    "details": "section", "fieldset": "form", "dialog": "form", "figcaption": "figure",
}


@dataclass
class Tree:
    """Nodes in document order: parent, whether a leaf, active features, and a leaf's text."""

    parent: list[int] = field(default_factory=list)
    leaf: list[bool] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)

    def add(self, parent: int, leaf: bool, features: list[int], text: str = "") -> int:
        self.parent.append(parent)
        self.leaf.append(leaf)
        self.features.append(features)
        self.text.append(text)
        return len(self.parent) - 1


_LENGTHS = (0, 15, 40, 80, 160, 400)
_N_KIND = len(KINDS)
OUTER, INNER, LINKY, HALF_LINKY, SENTENCE, BIAS_LEAF, BIAS_ELEMENT = range(_N_KIND, _N_KIND + 7)
_FIRST_LENGTH = _N_KIND + 7
FEATURES = _FIRST_LENGTH + len(_LENGTHS)


def _element_features(name: str, attributes: str) -> list[int]:
    out = [KINDS.index(_KIND_OF.get(name, "other")), BIAS_ELEMENT]
    words = set()
    for _, *values in _ATTRIBUTE.findall(attributes):
        for part in _PART.findall(" ".join(values)):
            words.add(part.lower())
    if words & OUTER_WORDS:
        out.append(OUTER)
    elif words & INNER_WORDS:
        out.append(INNER)
    return out


def _leaf_features(text: str, linked: int) -> list[int]:
    share = linked / max(1, len(text))
    out = [BIAS_LEAF, _FIRST_LENGTH + sum(len(text) > n for n in _LENGTHS[1:])]
    if share > 0.8:
        out.append(LINKY)
    elif share > 0.3:
        out.append(HALF_LINKY)
    if text.rstrip()[-1:] in (".", "!", "?", "…", "。", '"', "”"):
        out.append(SENTENCE)
    return out


@dataclass
class Tag:
    name: str
    end: bool
    attributes: str
    single: bool


class Tokens:
    """Texts and tags of a page in order, read once: no quote or bracket is looked for twice beyond the last one there is."""

    def __init__(self, source: str):
        self.source, self.at = source, 0
        self._last = {mark: source.rfind(mark) for mark in ">\"'"}

    def __iter__(self):
        source, size = self.source, len(self.source)
        heard = 0
        while (start := source.find("<", self.at)) >= 0:
            found = _NAME.match(source, start)
            if found:
                close = self._close(found.end())
                if close < 0:  # no tag, but text
                    self.at = start + 1
                    continue
                yield source[heard:start]
                self.at = close + 1
                attributes = source[found.end() : close]
                yield Tag(found.group(2).lower(), bool(found.group(1)), attributes, attributes.endswith("/"))
            elif source.startswith("<!--", start):
                yield source[heard:start]
                self._skip("-->", start + 4)
            elif source.startswith("<![CDATA[", start):
                yield source[heard:start]
                self._skip("]]>", start + 9)
                yield html.escape(source[start + 9 : self.at].removesuffix("]]>"))
            elif source.startswith(("<!", "<?"), start):
                yield source[heard:start]
                self._skip(">", start + 2)
            else:
                self.at = start + 1
                continue
            heard = self.at  # the caller may have moved on
        yield source[heard:size]

    def _skip(self, mark: str, start: int) -> None:
        end = self.source.find(mark, start)
        self.at = len(self.source) if end < 0 else end + len(mark)

    def skip_raw(self, name: str) -> None:
        """Move behind the end tag of an element whose content is no markup."""
        ended = _RAW_END[name].search(self.source, self.at)
        self.at = ended.end() if ended else len(self.source)

    def _close(self, at: int) -> int:
        """The bracket that ends a tag; those in quoted values do not, a quote opens a value only behind ``=``."""
        while at <= self._last[">"]:
            found = _STOP.search(self.source, at)
            if not found:
                return -1
            if found.group() == ">":
                return found.start()
            quote, at = found.group()[-1], found.end()
            if at <= self._last[quote]:
                at = self.source.index(quote, at) + 1
        return -1


class Hidden:
    """Elements whose text does not show, with what is open inside them."""

    def __init__(self):
        self.clear()

    def __bool__(self) -> bool:
        return bool(self.stack)

    def clear(self) -> None:
        self.stack: list[str] = []
        self.count: Counter[str] = Counter()  # of the stack
        self.inside: Counter[str] = Counter()

    def start(self, name: str) -> None:
        self.stack.append(name)
        self.count[name] += 1

    def end(self, name: str) -> None:
        if not self.count[name]:
            return
        while True:
            last = self.stack.pop()
            self.count[last] -= 1
            if last == name:
                break
        if not self.stack:
            self.clear()

    def passes(self, tag: Tag, open_: dict[str, list[int]]) -> bool:
        """Whether a tag ends what is hidden: one that no head may hold, or the end of an element around it."""
        if tag.name == "body" or (not tag.end and tag.name not in IN_HEAD and self.count["head"] and self.count["head"] + self.count["noscript"] == len(self.stack)):
            return True
        if tag.name in VOID or tag.single:
            return False
        if not tag.end:
            self.inside[tag.name] += 1
        elif self.inside[tag.name]:
            self.inside[tag.name] -= 1
        else:
            return bool(open_.get(tag.name))
        return False


def parse(source: str) -> Tree:
    """The tree of a page. Tags left open are closed as browsers do for paragraphs, list items and table cells.

    A head ends at the first element that none may hold, another hidden element at the end of an element around it.
    """
    tree = Tree()
    open_: list[tuple[str, int]] = [("html", tree.add(-1, False, _element_features("html", "")))]
    depths: dict[str, list[int]] = {"html": [0]}  # of the open elements by name
    scopes: list[int] = []  # depths of open elements that bound where list items and cells are closed
    run: list[str] = []
    hidden = Hidden()
    links, linked = 0, 0

    def end_run() -> None:
        nonlocal linked
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                tree.add(open_[-1][1], True, _leaf_features(text, linked), text)
            run.clear()
        linked = 0

    def close(depth: int) -> None:
        end_run()
        while len(open_) > depth:
            name, _ = open_.pop()
            depths[name].pop()
            if name in SCOPES:
                scopes.pop()

    tokens = Tokens(source)
    for token in tokens:
        if isinstance(token, str):
            if token and not hidden:
                run.append(token)
                if links:
                    linked += len(token.strip())
            continue
        name = token.name
        if name in HIDDEN:
            if token.end:
                hidden.end(name)
            elif name in RAW:
                tokens.skip_raw(name)
            elif not token.single:
                hidden.start(name)
            continue
        if hidden:
            if not hidden.passes(token, depths):
                continue
            hidden.clear()
        if name in INLINE:
            if name == "br":
                run.append(" ")
            elif name == "a":
                links = 0 if token.end else 1
            continue
        if name in VOID:
            if name == "hr":
                end_run()
            continue
        if token.end:
            if name != "html" and depths.get(name):
                close(depths[name][-1])
                links = 0
            continue
        if name in ("html", "body") and depths.get(name):
            continue
        if name in ENDS_P and depths.get("p"):
            close(depths["p"][-1])
            links = 0
        closed = max((depths[other][-1] for other in CLOSED_BY.get(name, ()) if depths.get(other)), default=0)
        if closed and closed >= (scopes[-1] if scopes else 0):
            close(closed)
        end_run()
        depths.setdefault(name, []).append(len(open_))
        if name in SCOPES:
            scopes.append(len(open_))
        open_.append((name, tree.add(open_[-1][1], False, _element_features(name, token.attributes))))
    end_run()
    return tree


@dataclass
class Model:
    """Weights of the content state per feature, and of (parent, child) states for elements and for leaves."""

    unary: np.ndarray
    pair: np.ndarray  # [leaf][parent state][child state]


class Forest:
    """Trees of a batch in one numbering, grouped by depth for message passing."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        self.start = np.cumsum([0, *sizes])
        shift = np.repeat(self.start[:-1], sizes)
        parent = np.array([p for t in trees for p in t.parent], np.int64)
        self.parent = np.where(parent < 0, -1, parent + shift)
        self.leaf = np.array([x for t in trees for x in t.leaf], np.int64)
        per = [f for t in trees for f in t.features]
        self.node = np.repeat(np.arange(len(per)), [len(f) for f in per])
        self.feature = np.array([x for f in per for x in f], np.int64)
        depth = np.zeros(len(parent), np.int64)
        for i, p in enumerate(self.parent.tolist()):  # parents come first
            if p >= 0:
                depth[i] = depth[p] + 1
        self.levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content per node, and of (parent, child) states per node (zero for roots)."""
        n = len(self.parent)
        score = np.zeros((n, 2))
        score[:, 1] = np.bincount(self.node, model.unary[self.feature], n)
        up, into = score.copy(), np.zeros((n, 2))  # into: what a child tells its parent
        pair = model.pair[self.leaf]
        for level in self.levels[:0:-1]:
            into[level] = np.logaddexp(pair[level][:, :, 0] + up[level][:, None, 0], pair[level][:, :, 1] + up[level][:, None, 1])
            np.add.at(up, self.parent[level], into[level])
        down, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            above = up[self.parent[level]] + down[self.parent[level]] - into[level]
            both = above[:, :, None] + pair[level]
            down[level] = np.logaddexp(both[:, 0], both[:, 1])
            both = both + up[level][:, None, :]
            joint[level] = np.exp(both - np.logaddexp.reduce(both.reshape(-1, 4), axis=1)[:, None, None])
        belief = up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), joint


def train(trees: list[Tree], labels: list[list[bool]], rounds: int = 120, step: float = 0.3, penalty: float = 1e-3) -> Model:
    """Maximum likelihood with known states: the gradient is observed less expected counts under the marginals."""
    forest = Forest(trees)
    state = np.array([x for page in labels for x in page], np.int64)
    child = np.nonzero(forest.parent >= 0)[0]
    seen = np.bincount(forest.feature, state[forest.node], FEATURES)
    seen_pair = np.zeros((2, 2, 2))
    np.add.at(seen_pair, (forest.leaf[child], state[forest.parent[child]], state[child]), 1)
    model = Model(np.zeros(FEATURES), np.zeros((2, 2, 2)))
    pages = len(trees)
    squares = [np.full(FEATURES, 1e-6), np.full((2, 2, 2), 1e-6)]
    for _ in range(rounds):
        content, joint = forest.marginals(model)
        expected_pair = np.zeros((2, 2, 2))
        np.add.at(expected_pair, forest.leaf[child], joint[child])
        grads = ((seen - np.bincount(forest.feature, content[forest.node], FEATURES)) / pages - penalty * model.unary, (seen_pair - expected_pair) / pages - penalty * model.pair)
        for i, grad in enumerate(grads):
            squares[i] += grad**2
        model = Model(model.unary + step * grads[0] / np.sqrt(squares[0]), model.pair + step * grads[1] / np.sqrt(squares[1]))
    return model


def labelled_pages(pages: int = 240, seed: int = 3) -> list[tuple[str, list[str]]]:
    """Pages written by rule with the texts of their articles: layouts with and without semantic elements.

    Parts that are not the article appear in random choice and order, by element name or by class alone, some of them inside
    the article's own element.
    """
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice(["ta", "ri", "no", "sel", "mu", "ke", "dor", "an", "é", "li"]) for _ in range(rng.randint(1, 4)))

    def words(a, b):
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence():
        return (words(4, 18).capitalize() + rng.choice(["."] * 6 + ["!", "?", ""])) if rng.random() < 0.9 else words(1, 3).capitalize() + "."

    def links(n):
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(n))

    def wrap(names, classes, inner):
        name = rng.choice(names)
        if name == "div" or rng.random() < 0.3:
            return f'<{name} {rng.choice(["class", "id"])}="{rng.choice(classes)}">{inner}</{name}>'
        return f"<{name}>{inner}</{name}>"

    outer = [
        lambda: wrap(["nav", "nav", "div"], ["menu", "main-nav", "navbar", "breadcrumbs"], f"<ul>{links(rng.randint(2, 7))}</ul>"),
        lambda: wrap(["header", "div"], ["header", "site-header banner"], f"<h1>{words(1, 4)}</h1><p>{words(2, 8)}</p>"),
        lambda: wrap(["footer", "footer", "div"], ["footer", "site-footer"], f"&copy; {words(1, 3)} &middot; {sentence()}"),
        lambda: wrap(["aside", "div"], ["sidebar", "widget related"], f"<h3>{words(1, 3)}</h3><ul>{links(rng.randint(2, 5))}</ul><p>{sentence()}</p>"),
        lambda: wrap(["div", "section"], ["cookie-notice", "notice", "consent popup"], f"<p>{sentence()} {sentence()}</p>"),
        lambda: wrap(["div", "aside", "div"], ["ad", "ads sponsored", "promo"], sentence() + " " + sentence()),
        lambda: wrap(["form", "div"], ["search form", "newsletter signup"], f"<label>{words(1, 4)}</label><input name=q><p>{sentence()}</p>"),
    ]
    comment = lambda: wrap(
        ["section", "div", "div"], ["comments", "comment-list replies"],
        f"<h3>{words(1, 2)}</h3>" + "".join(f"<div class=comment><p>{' '.join(sentence() for _ in range(rng.randint(1, 4)))}</p></div>" for _ in range(rng.randint(1, 4))),
    )
    made = []
    for _ in range(pages):
        texts, parts = [], []

        def block(name, text):
            texts.append(text)
            return f"<{name}>{html.escape(text)}</{name}>" if rng.random() < 0.9 else f"<{name}><b>{html.escape(text)}</b><br>"

        if rng.random() < 0.85:
            parts.append(block("h1", words(2, 9)))
        for _ in range(rng.randint(1, 8)):
            kind = rng.random()
            if kind < 0.75:
                parts.append(block("p", " ".join(sentence() for _ in range(rng.randint(1, 7)))))
            elif kind < 0.83:
                parts.append(block("h2", words(1, 5)))
            elif kind < 0.9:
                parts.append("<ul>" + "".join(block("li", sentence()) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.95:
                parts.append("<blockquote>" + block("p", sentence()) + "</blockquote>")
            else:
                parts.append("<table><tr>" + "".join(f"<td>{(texts.append(t), t)[1]}</td>" for t in (words(1, 3), words(1, 3))) + "</tr></table>")
        if rng.random() < 0.2:
            parts.insert(rng.randint(0, len(parts)), rng.choice(outer)())
        if rng.random() < 0.15:
            parts.append(comment())
        name = rng.choice(["article"] * 4 + ["main", "div", "div", "section"])
        body = f'<{name} class="{rng.choice(["content", "post", "story-body", "entry"])}">' if name in ("div", "section") or rng.random() < 0.3 else f"<{name}>"
        body += "".join(parts) + f"</{name}>"
        before = "".join(rng.choice(outer)() for _ in range(rng.randint(0, 3)))
        after = "".join(rng.choice([*outer, comment])() for _ in range(rng.randint(0, 3)))
        made.append((f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body>{before}{body}{after}</body></html>", texts))
    return made


def label_tree(tree: Tree, texts: list[str]) -> list[bool]:
    """States of a labelled page: leaves whose text is wanted, and elements that hold more content than other text."""
    wanted: dict[str, int] = {}
    for t in texts:
        wanted[t] = wanted.get(t, 0) + 1
    state, good, bad = [False] * len(tree.parent), [0] * len(tree.parent), [0] * len(tree.parent)
    for i, text in enumerate(tree.text):
        if tree.leaf[i] and wanted.get(text):
            wanted[text] -= 1
            state[i] = True
    for i in range(len(tree.parent) - 1, -1, -1):
        if tree.leaf[i]:
            (good if state[i] else bad)[i] = len(tree.text[i])
        else:
            state[i] = good[i] > bad[i]
        if tree.parent[i] >= 0:
            good[tree.parent[i]] += good[i]
            bad[tree.parent[i]] += bad[i]
    return state


@lru_cache(maxsize=1)
def default_model() -> Model:
    pages = [(parse(source), texts) for source, texts in labelled_pages()]
    return train([t for t, _ in pages], [label_tree(t, texts) for t, texts in pages])


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    """The main text of each page: content blocks in page order, joined by one blank."""
    trees = [parse(s or "") for s in sources]
    forest = Forest(trees)
    content, _ = forest.marginals(model)
    out = []
    for i, tree in enumerate(trees):
        own = content[forest.start[i] : forest.start[i + 1]]
        out.append(" ".join(t for t, leaf, p in zip(tree.text, tree.leaf, own) if leaf and p > 0.5))
    return out


def extract(pages: DataFrame, source: str = "html", out: str = "text", model: Model | None = None) -> DataFrame:
    """``pages`` without ``source``, plus ``out``. Null and empty pages give an empty text; all rows and columns stay.

    A column of ``pages`` that is named like ``out`` is replaced.
    """
    model = model or default_model()
    names = [c for c in pages.columns if c not in (source, out)]
    chosen = bound_batches(pages).select(*names, F.col(source).alias("_tl_html"))

    def read(batches):
        for batch in small_batches(batches, 64):
            texts = main_texts(batch.column(len(names)).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], [*names, out])

    return chosen.mapInArrow(read, T.StructType([*chosen.schema.fields[:-1], T.StructField(out, T.StringType())]))
