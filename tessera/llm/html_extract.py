"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every element and every text is a node with features of its tag, its attributes' tokens, its depth, its
siblings, its ancestors, and its subtree's text, link and tag density. The trees give each node the odds of
holding main text. Decoding takes the likeliest labelling of a page in which nothing below a dropped
node is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.html_pages import MARK, pages
from tessera.llm.shared import own_columns
from tessera.llm.trees import Forest, boost

TRAIN_PAGES = 700

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z)))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
_HIDDEN = frozenset("head script style title textarea xmp iframe noembed noframes noscript template select option button svg math canvas object audio video".split())
_BLOCK = frozenset(
    "html body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption"
    " table caption thead tbody tfoot tr td th form fieldset legend address hr details summary center dir menu hgroup search dialog option".split()
)
_ENDS_P = _BLOCK - {"html", "body", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "legend", "option"}
_SCOPE = frozenset("html table td th caption template object".split())
_HEADINGS = tuple(f"h{k}" for k in range(1, 7))
_OF_TABLES = frozenset("tr table tbody thead tfoot".split())
#: For an element, the open ones that its start ends, and where the search for them stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}

#: Tags that share a feature.
_KINDS = [
    "article main", "nav menu", "header hgroup", "footer", "aside", "form fieldset label legend input", "ul ol dl", "li dt dd", "p", "h1", "h2 h3 h4 h5 h6",
    "div center", "section", "a", "table tbody thead tfoot tr td th caption", "figure figcaption img", "blockquote pre", "html body", "#text",
]
_KIND = {t: k for k, group in enumerate(_KINDS) for t in group.split()}
_OTHER = len(_KINDS)
#: Attribute tokens that share a feature.
_WORDS = [
    "article content main body post entry story text page",
    "ad ads advert advertisement adsbygoogle banner sponsor sponsored promo promoted",
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer copyright",
    "sidebar side bar widget related trending newsletter recommended popular recent",
    "cookie cookies consent gdpr notice alert popup modal disclaimer hidden none",
    "comment comments commentlist discussion replies reply disqus respond",
    "share social tags tag byline meta search login form subscribe signup",
]
_WORD = {t: k for k, group in enumerate(_WORDS) for t in group.split()}
_NK, _NW = len(_KINDS) + 1, len(_WORDS)


class _Open:
    """The elements that are open, innermost last, and where those of each tag stand; every step takes a time of its own, not that of the depth."""

    __slots__ = ("stack", "places", "blocks")

    def __init__(self):
        self.stack: list[tuple[str | None, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.push("html", 0)

    def node(self) -> int:
        return self.stack[-1][1]

    def top(self) -> str | None:
        return self.stack[-1][0]

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node))

    def last(self, *tags: str) -> int:
        """Place of the innermost element of these tags, -1 if none is open."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def block(self) -> int:
        return self.blocks[-1] if self.blocks else -1

    def forget(self, k: int) -> None:
        """The k-th element, the innermost of its tag and no block, is no more open; what is in it still is."""
        tag, node = self.stack[k]
        self.places[tag].pop()
        self.stack[k] = (None, node)

    def cut(self, k: int) -> list[str]:
        """Ends all from the k-th on; their tags."""
        gone = []
        while len(self.stack) > k:
            tag, _ = self.stack.pop()
            if tag:
                gone.append(tag)
                self.places[tag].pop()
                if tag in _BLOCK:
                    self.blocks.pop()
        while self.stack[-1][0] is None:
            self.stack.pop()
        return gone


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I)


class Page:
    """Nodes in the order of the source (parents first), and the page's content as a stream.

    The stream holds pairs (node, text) of texts, (-1, " ") for white space and line breaks, and (-2, "") for a
    block's border.
    """

    __slots__ = ("parent", "depth", "kind", "words", "text", "stream")

    def __init__(self, source: str):
        self.parent, self.depth, self.kind, self.words, self.text = [-1], [0], [_KIND["html"]], [0], [""]
        self.stream: list[tuple[int, str]] = []
        self._read(source)

    def _node(self, parent: int, kind: int, words: int = 0, text: str = "") -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.kind.append(kind)
        self.words.append(words)
        self.text.append(text)
        return len(self.parent) - 1

    def _say(self, parent: int, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if text.strip():
            self.stream.append((self._node(parent, _KIND["#text"], 0, text), text))
        elif text:
            self.stream.append((-1, " "))

    def _read(self, source: str) -> None:
        open_, hidden, at = _Open(), 0, 0
        stream, size = self.stream, len(source)
        while at < size:
            m = _TAG.search(source, at)
            stop = m.start() if m else size
            if stop > at and not hidden:
                self._say(open_.node(), source[at:stop])
            if not m:
                break
            at, closed, opened = m.end(), m[1], m[2]
            if opened:
                tag = opened.lower()
                if tag == "br":
                    stream.append((-1, " "))
                if tag in _VOID:
                    if tag == "hr":
                        stream.append((-2, ""))
                    continue
                if tag in ("html", "body"):
                    while open_.top() == "head":
                        hidden -= self._close(open_, len(open_.stack) - 1, False)
                    stream.append((-2, ""))
                    continue
                if tag in _ENDS_P and (k := open_.last("p")) > open_.last(*_SCOPE):
                    hidden -= self._close(open_, k)
                if tag in _ENDS and (k := open_.last(*_ENDS[tag][0])) > open_.last(*_ENDS[tag][1]):
                    hidden -= self._close(open_, k)
                if tag in _RAW:
                    end = _raw_end(tag).search(source, at)
                    at = end.end() if end else size
                    continue
                if tag in _HIDDEN:
                    hidden += 1
                node = open_.node()
                if not hidden:
                    if tag in _BLOCK:
                        stream.append((-2, ""))
                    node = self._node(node, _KIND.get(tag, _OTHER), _tokens(m[3]))
                open_.push(tag, node)
            elif closed:
                hidden -= self._end(open_, closed.lower())

    def _close(self, open_: _Open, k: int, border: bool = True) -> int:
        """Ends all from the k-th on; how many of them were hidden."""
        gone = open_.cut(k)
        if border and any(t in _BLOCK for t in gone):
            self.stream.append((-2, ""))
        return sum(t in _HIDDEN for t in gone)

    def _end(self, open_: _Open, tag: str) -> int:
        if tag in ("html", "body"):
            return 0
        k = open_.last(*_HEADINGS) if tag in _HEADINGS else open_.last(tag)
        if k < 1 or tag not in _OF_TABLES and open_.last("td", "th", "caption") > k:
            return 0
        if tag not in _BLOCK and open_.block() > k:
            open_.forget(k)  # misnested formatting: the blocks inside stay open
            return int(tag in _HIDDEN)
        return self._close(open_, k)

    def blocks(self, kept) -> list[str]:
        """Texts of the kept nodes, one string for each block that holds any."""
        out, now = [], []
        for node, text in [*self.stream, (-2, "")]:
            if node == -2:
                if now and (joined := " ".join("".join(now).split())):
                    out.append(joined)
                now = []
            elif node == -1 or kept[node]:
                now.append(text)
        return out


def _tokens(attributes: str) -> int:
    """Bits for the groups of words found among the attributes' tokens."""
    if len(attributes) < 4:
        return 0
    out = 0
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or m[1]
        for token in _TOKEN.findall(value):
            k = _WORD.get(token.lower())
            if k is not None:
                out |= 1 << k
    return out


_STOPS = re.compile(r"[.!?;:]")


class Nodes:
    """The nodes of several pages as arrays, and their features."""

    def __init__(self, found: list[Page]):
        sizes = [len(p.parent) for p in found]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.page = np.repeat(np.arange(len(found)), sizes)
        parent = np.array([x for p in found for x in p.parent], np.int64)
        self.root = parent < 0
        self.parent = np.where(self.root, np.arange(len(parent)), parent + self.starts[self.page])
        self.depth = np.array([x for p in found for x in p.depth], np.int64)
        self.kind = np.array([x for p in found for x in p.kind], np.int64)
        self.words = np.array([x for p in found for x in p.words], np.int64)
        self.own = np.array([(len(t), t.count(" ") + 1, len(_STOPS.findall(t)), t.count(",")) if t else (0, 0, 0, 0) for p in found for t in p.text], float).reshape(-1, 4)
        order = np.argsort(self.depth, kind="stable")
        self.levels = [x for x in np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1) if len(x) and self.depth[x[0]] > 0]

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.copy()
        for level in reversed(self.levels):
            np.add.at(out, self.parent[level], out[level])
        return out

    def down(self, flags: np.ndarray) -> np.ndarray:
        """Flags of the node or any ancestor."""
        out = flags.copy()
        for level in self.levels:
            out[level] |= out[self.parent[level]]
        return out

    def features(self) -> np.ndarray:
        n = len(self.parent)
        kinds = np.zeros((n, _NK), bool)
        kinds[np.arange(n), self.kind] = True
        words = (self.words[:, None] >> np.arange(_NW)) & 1 > 0
        above = self.down(np.concatenate([kinds[:, :-2], words], axis=1))
        linked = self.own[:, :1] * above[:, [_KIND["a"]]]
        tags = (self.kind != _KIND["#text"]).astype(float)[:, None]
        paragraphs = kinds[:, [_KIND["p"]]] * 1.0
        below = self.up(np.concatenate([self.own, linked, tags, 1 - tags, paragraphs], axis=1))
        size, terms = below[:, 0], np.maximum(below[:, 1], 1)
        length, links = np.log1p(size), below[:, 4] / np.maximum(size, 1)
        shares = np.stack([links, below[:, 2] / terms, below[:, 3] / terms, size / terms, below[:, 5] / terms, below[:, 6], below[:, 7]], axis=1)
        # Siblings: nodes sorted by parent keep the order of the source.
        order = np.argsort(self.parent + self.root * n, kind="stable")
        same = self.parent[order][1:] == self.parent[order][:-1]
        same &= ~self.root[order][1:]
        place, near = np.zeros(n), np.zeros((n, 4))
        near[order[1:][same], 0], near[order[1:][same], 1] = length[order[:-1][same]], links[order[:-1][same]]
        near[order[:-1][same], 2], near[order[:-1][same], 3] = length[order[1:][same]], links[order[1:][same]]
        first = np.flatnonzero(np.append(True, ~same))
        place[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        count = np.bincount(self.parent, minlength=n)[self.parent]
        whole = size[self.starts[self.page]]
        family = np.stack([self.depth, place, count, place / np.maximum(count, 1), length, size / np.maximum(whole, 1), size / np.maximum(size[self.parent], 1), length[self.parent], links[self.parent], np.log1p(self.own[:, 0])], axis=1)
        parents = kinds[self.parent]
        return np.concatenate([kinds, parents, words, above, shares, family, near], axis=1).astype(float)

    def decode(self, margin: np.ndarray) -> np.ndarray:
        """Kept nodes in the likeliest labelling; below a dropped node all are dropped."""
        keep, drop = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
        lost = self.up(drop)
        best = keep.copy()
        for level in reversed(self.levels):
            np.add.at(best, self.parent[level], np.maximum(best[level], lost[level]))
        kept = np.zeros(len(margin), bool)
        kept[self.starts[:-1]] = True
        for level in self.levels:
            kept[level] = kept[self.parent[level]] & (best[level] >= lost[level])
        return kept


@lru_cache(maxsize=2)
def model(train_pages: int = TRAIN_PAGES, seed: int = 3) -> Forest:
    """Trees trained on synthetic pages; a node's label is whether main text lies in it."""
    found, labels = [Page(s) for s in pages(train_pages, seed)], []
    for p in found:
        marked = [MARK in t for t in p.text]
        for k in range(len(marked) - 1, 0, -1):
            marked[p.parent[k]] |= marked[k]
        labels += marked
        p.text = [t.replace(MARK, "") for t in p.text]
    return boost(Nodes(found).features(), np.array(labels, float))


def main_texts(sources: list[str], forest: Forest) -> list[str]:
    found = [Page(s) for s in sources]
    nodes = Nodes(found)
    kept = nodes.decode(forest.margin(nodes.features()))
    return ["\n".join(p.blocks(kept[a:b])) for p, a, b in zip(found, nodes.starts[:-1], nodes.starts[1:], strict=True)]


def extract(rows: DataFrame, forest: Forest | None = None, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text (empty if none), n_chars of each page's whole HTML; null counts as empty.

    The model is trained on the driver from synthetic pages (no page of the table) and sent along; it has a
    fixed size. Rows stay rows of their own, repeated ones and null keys too; an empty table has no rows; columns
    beyond the three are not read, nothing is shuffled. A page may have any length below 2 GB and any depth: time
    grows in proportion to its nodes, and a worker holds about a KB for each of them, 64 pages at a time.
    """
    own_columns(rows, key, url, source)
    forest = forest or model()
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (key, url)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                batch = whole.slice(lo, 64)
                texts = main_texts([s or "" for s in batch.column(2).to_pylist()], forest)
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, url, "text", "n_chars"])

    return rows.select(key, url, source).mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")
