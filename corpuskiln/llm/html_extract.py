"""Main text of web pages as a maximum-scoring subsequence.

A page is a row of words and tags with scores learned from labelled pages.  A
tag scores below zero: the log-odds of standing in an article.  A word scores
above zero, less what the elements around it say by their tags, classes, ids,
roles or being hidden; these weights come from a logistic regression on the
labelled pages, and where they outweigh the word it scores just below zero.  One
linear scan finds the best contiguous region, which is carried on to the ends
of its first and last block.  Its text, less what scores below
zero inside it (adverts and the like in the middle of an article), is joined by
blocks.

Scripts, styles, comments and other elements without text of their own never
count.  Character references are decoded, white space inside a block becomes
one space, blocks are trimmed, empty ones left out, and joined by one line feed;
a line break or a table cell begins a block.

Defined results: null html counts as empty; a page without a positive region
has an empty text.  Of equally good regions the first one wins.  Repeated rows
give repeated results; only the named columns are read.  Tags that never close,
close twice or cross are closed by the nearest enclosing element.  Where a
quote in a tag never ends, quotes don't count in the tags from there on; a ``<``
after the last ``>`` is text.  Work is linear in the length of a page, however
deep its elements nest.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.html_labels import OPEN, SHUT, labelled_pages

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN = re.compile(r"([^>]*)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"\S+")

#: Their content is no markup and ends at the closing tag.
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of the page.
NO_TEXT = frozenset("head script style textarea title xmp noembed noframes noscript template svg math canvas object iframe select option datalist button audio video map".split())
#: Elements that make up any text: their names say nothing of what they hold.
PLAIN = frozenset(
    "html body div span p ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 a b i u em strong small sub sup code pre kbd samp var mark q cite abbr time font center blockquote "
    "figure figcaption details summary ins del s big tt".split()
)
#: Their classes say how the page is laid out, not what they hold.
NO_CLASS = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag closes an open element of these names, up to the given bounds.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_ENDS_P = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body", "caption", "legend", "title", "option", "optgroup"}


@lru_cache(maxsize=4096)
def features(tag: str, attributes: str, inside: bool) -> tuple[str, ...]:
    """What an element says of its content, and what it says ``inside`` an article or main element besides."""
    found = set() if tag in PLAIN else {f"<{tag}>"}
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _UNSEEN.search(value):
                found.add("unseen")
            elif name == "role":
                found.add("role " + value.strip().lower())
            elif name in ("class", "id") and tag not in NO_CLASS:
                found.update(w.lower() for w in _SPLIT.split(value) if w)
    return tuple(sorted([*found, *("in " + x for x in found if inside)]))


@dataclass
class Weights:
    """Of a word by itself, of features on the words around which they stand, and of tags."""

    word: float = 1.0
    feature: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)
    #: Of a tag that the labelled pages lack.
    other_tag: float = -0.05
    #: The least score of a word.
    lowest: float = -0.5

    def says(self, names: tuple[str, ...]) -> float:
        weights = self.feature
        return sum([weights[x] for x in names if x in weights])

    def score(self, kind: str, n_words: int, around: float) -> float:
        """Of an item: a text's is its words' times that of one, a tag's its own where words score above zero (elsewhere the words tell)."""
        if kind == "text":
            return max(self.lowest, min(1.0, around)) * n_words
        return self.tag.get(kind, self.other_tag) if around > 0 else 0.0


Item = tuple[str, str, float]  # kind ("text" or a tag), text, what the elements around it say


def items(page: str, says) -> Iterator[Item]:
    """Texts and tags in order; ``says`` gives what an element's features add to the words in it, to be summed over open elements."""
    # name, sum so far, silent, inside an article; and where each name, and each block but p, is open
    stack: list[tuple[str, object, bool, bool]] = []
    open_at: dict[str, list[int]] = {}
    blocks: list[int] = []
    total, silent, inside = says(()), False, False
    none = total
    at, last, quoted = 0, page.rfind(">"), True

    def nearest(names: Iterable[str]) -> int:
        return max((open_at[x][-1] for x in names if open_at.get(x)), default=-1)

    def close_from(k: int) -> None:
        nonlocal total, silent, inside
        for name, *_ in stack[k:]:
            open_at[name].pop()
        while blocks and blocks[-1] >= k:
            blocks.pop()
        del stack[k:]
        _, total, silent, inside = stack[-1] if stack else ("", none, False, False)

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0 or begin > last and not page.startswith(("<!--", "<![CDATA["), begin):
            begin = len(page)
        if begin > at and not silent:
            yield "text", references.unescape(page[at:begin]), total
        if begin == len(page):
            break
        at = begin + 1
        if page.startswith("!--", at):
            end = page.find("-->", at + 1)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith("![CDATA[", at):
            end = page.find("]]>", at)
            at = len(page) if end < 0 else end + 3
            continue
        if page[at] in "!?":
            at = page.find(">", at) + 1 or len(page)
            continue
        head = _NAME.match(page, at)
        if not head:
            if not silent:
                yield "text", "<", total
            continue
        whole = _QUOTED.match(page, head.end()) if quoted else None
        if not whole:
            quoted = False
            whole = _PLAIN.match(page, head.end())
        at, name, attributes = whole.end(), head[2].lower(), whole[1]
        if head[1]:
            k = nearest((name,))
            # a stray closing tag doesn't reach beyond the element that holds it
            if k >= 0 and (name in BLOCKS or not blocks or k > blocks[-1]):
                close_from(k)
            yield name, "", total
            continue
        if name in _ENDS_P:
            k = nearest(("p",))
            if k >= 0 and (not blocks or k > blocks[-1]):
                close_from(k)
        if name in _CLOSES:
            names, bounds = _CLOSES[name]
            k = nearest(names)
            if k > nearest(bounds):
                close_from(k)
        if name == "body" and open_at.get("head"):
            close_from(open_at["head"][-1])
        own = says(features(name, attributes, inside))
        yield name, "", total + own
        if name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            end = _raw_end(name).search(page, at)
            at = end.end() if end else len(page)
            continue
        total, silent, inside = total + own, silent or name in NO_TEXT, inside or name in ("article", "main")
        open_at.setdefault(name, []).append(len(stack))
        if name in BLOCKS and name != "p":
            blocks.append(len(stack))
        stack.append((name, total, silent, inside))


@lru_cache(maxsize=None)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>", re.I)


def learn(pages: list[str], ridge: float = 0.1, rounds: int = 8) -> Weights:
    """Weights from pages whose articles are marked.

    Words: logistic regression of a text's being in the article on how often
    each feature is open around it (Newton's method with a ridge; a text counts
    as its words, to 20 at most).  Tags: log-odds of standing in the article, of
    tags where words score above zero.  The scale of tags and the lowest score
    of a word are those that find most of the articles exactly.
    """
    parsed: list[list[tuple[str, int, Counter, bool]]] = []
    for page in pages:
        # the marks become tags of their own, which no page has
        row, marked = [], False
        for kind, text, around in items(page.replace(OPEN, "<x-open/>").replace(SHUT, "<x-shut/>"), Counter):
            if kind in ("x-open", "x-shut"):
                marked = kind == "x-open"
            else:
                row.append((kind, len(_WORD.findall(text)), around, marked))
        parsed.append(row)
    names = sorted({name for row in parsed for _, _, around, _ in row for name in around})
    column = {name: k for k, name in enumerate(names)}
    seen: Counter[tuple[tuple[tuple[str, int], ...], bool]] = Counter()
    for row in parsed:
        for kind, n, around, marked in row:
            if kind == "text" and n:
                seen[tuple(sorted(around.items())), marked] += min(n, 20)
    x, y, n = np.zeros((len(seen), len(names) + 1)), np.zeros(len(seen)), np.zeros(len(seen))
    x[:, -1] = 1
    for i, ((around, marked), count) in enumerate(sorted(seen.items())):
        y[i], n[i] = marked, count
        for name, times in around:
            x[i, column[name]] = times
    # what speaks for an article is left out and the rest fitted again: words are above zero anyway, and an article's name can't vouch for
    # an advert in it; only what a name says inside an article may take back what it says elsewhere
    free = np.ones(x.shape[1], dtype=bool)
    for _ in range(3):
        own, held = x[:, free], np.full(free.sum(), ridge * 20)
        held[-1] = 1e-6
        w = np.zeros(own.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            slope = own.T @ (n * (y - p)) - held * w
            w += np.linalg.solve((own.T * (n * np.maximum(p * (1 - p), 1e-6))) @ own + np.diag(held), slope)
        kept = [name for name, is_free in zip(names, free) if is_free]
        feature = {k: round(float(v), 6) for k, v in zip(kept, w)}
        for name, weight in feature.items():
            free[column[name]] = weight < 0 or name.startswith("in ") and feature.get(name[3:], 0.0) < 0
    feature = {k: v if v < 0 or k.startswith("in ") else 0.0 for k, v in feature.items()}
    out = Weights(max(float(w[-1]), 0.25), feature)
    says = [[out.word + sum(feature.get(k, 0.0) * times for k, times in around.items()) for _, _, around, _ in row] for row in parsed]
    inside, outside = Counter(), Counter()
    for row, own in zip(parsed, says):
        for (kind, _, _, marked), around in zip(row, own):
            if kind != "text" and around > 0:
                (inside if marked else outside)[kind] += 1
    odds = {k: math.log((inside[k] + 1) / (outside[k] + 1)) for k in inside | outside}

    def found() -> int:
        exact = 0
        for row, own in zip(parsed, says):
            scores = [out.score(kind, n, around) for (kind, n, _, _), around in zip(row, own)]
            begin, stop = whole_blocks([kind for kind, *_ in row], *best_region(scores))
            exact += all((begin <= i < stop and scores[i] > 0) == marked for i, (kind, n, _, marked) in enumerate(row) if kind == "text" and n)
        return exact

    # one after the other, each is set to the best of its values given the other two
    chosen, values = {"scale": 1.0, "bound": -1.0, "lowest": -0.1}, {"lowest": (-0.02, -0.05, -0.1, -0.25, -0.5), "scale": (0.5, 1.0, 2.0, 3.0), "bound": (-0.5, -1.0, -2.0, -4.0)}
    for name in ("scale", "bound", "lowest", "scale", "bound"):
        exact = {}
        for value in values[name]:
            now = chosen | {name: value}
            out.tag, out.lowest = {k: max(min(now["scale"] * v, -0.05), now["bound"]) for k, v in odds.items()}, now["lowest"]
            exact[value] = found()
        chosen[name] = max(values[name], key=exact.__getitem__)
    out.tag, out.lowest = {k: max(min(chosen["scale"] * v, -0.05), chosen["bound"]) for k, v in odds.items()}, chosen["lowest"]
    return out


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    return learn(labelled_pages())


def scored(page: str, weights: Weights) -> list[tuple[str, str, float]]:
    """Kind, text and score of each item."""
    return [(kind, text, weights.score(kind, len(_WORD.findall(text)), weights.word + around)) for kind, text, around in items(page, weights.says)]


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest sum above zero, the first of equals."""
    best, total, begin, region = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, region = total, (begin, i + 1)
    return region


def whole_blocks(kinds: list[str], begin: int, stop: int) -> tuple[int, int]:
    """The region, if there is one, carried on to the ends of its first and last block."""
    while begin < stop and begin and kinds[begin - 1] not in BLOCKS:
        begin -= 1
    while begin < stop < len(kinds) and kinds[stop] not in BLOCKS:
        stop += 1
    return begin, stop


def extract(page: str, weights: Weights | None = None) -> str:
    """The main text of a page."""
    row = scored(page, weights or default_weights())
    begin, stop = whole_blocks([kind for kind, _, _ in row], *best_region([score for _, _, score in row]))
    blocks, block = [], []
    for kind, text, score in row[begin:stop]:
        if kind == "text":
            if score >= 0:
                block.append(text)
        elif kind in BLOCKS:
            blocks.append(block)
            block = []
    blocks.append(block)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page: a narrow map over whole pages."""
    # learned once, on the driver; a few hundred numbers
    weights = default_weights()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py() or "", weights) for page in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["__id", "__url", "text", "n_chars"])

    source = df.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).cast("string").alias("__html"))
    schema = f"__id {source.schema[0].dataType.simpleString()}, __url {source.schema[1].dataType.simpleString()}, text string, n_chars bigint"
    return source.mapInArrow(run, schema).withColumnRenamed("__id", id_col).withColumnRenamed("__url", url_col)
