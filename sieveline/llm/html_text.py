"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by the containers they stand in,
tags score below zero; the weights are log odds counted on pages whose content is
labelled by an ``article`` element. One linear scan finds the contiguous region with
the highest sum, and the region is the text: its bounds move only to the ends of the
blocks they fall in. Within it, what stands in containers that are never content is left
out. Reading a page takes linear time, however deep or broken its markup is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches

#: Labelled pages the weights are counted on, about; twice as many at most.
SAMPLE = 2000
#: Weights lie between this and its negative; those of tags between these two.
CLIP = 5.0
TAG, LEAST_TAG = -0.1, -1.0
#: Score of a word up to which it is left out of the region it stands in.
LEAST_WORD = -2.0

# Elements whose content is no markup (to the end of the page if they are not
# closed), others whose content is no text, elements that hold a line of a form, containers,
# elements that begin and end a line (all others stand in one).
RAW = {"script", "style", "title", "textarea", "iframe"}
SKIPPED = {"template", "svg", "select"}
CONTROLS = {"button", "label", "option"}
CONTAINERS = set("article main section div nav aside footer header form ul ol dl table body blockquote figure details dialog menu fieldset".split())
BLOCKS = CONTAINERS | set(
    "address br caption center dd dir dt figcaption h1 h2 h3 h4 h5 h6 head hgroup hr html legend li link meta optgroup p pre summary tbody td tfoot th thead tr".split()
)
# Containers that say nothing by themselves; only their names have weights.
GENERIC = set("div section body ul ol dl table blockquote figure details".split())
NEVER = {"nav", "aside", "footer", "form", "menu", "dialog", "fieldset"}
NEVER_NAMED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer header masthead share sharing social related "
    "recommended newsletter subscribe subscription login signup search popup modal comment comments commentlist respond reply disqus "
    "reactions contentinfo complementary".split()
)
# Words that only say what kind of box a listed name is on.
BOXES = set("area bar block box button buttons container content inner items left link links list outer posts right section site widget wrap wrapper".split())
#: Elements that hold the text, whatever they are called.
HOLDERS = {"body", "main", "article"}
TEXT = re.compile(r"[^<]+")
NAME = re.compile(r"/?([a-zA-Z][^\s/<>]*)")
NAMES = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
QUOTED = re.compile(r"[^\"']+|\"[^\"]*\"|'[^']*'")
ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW | SKIPPED}


class Node:
    """An open container: what words in it inherit from those around it."""

    __slots__ = ("tag", "names", "parent", "inside", "never", "known", "words", "listed")

    def __init__(self, tag: str, names: list[list[str]], parent: Node | None, listed: bool):
        self.tag, self.names, self.parent, self.listed = tag, names, parent, listed
        self.inside = tag == "article" or bool(parent and parent.inside)
        self.never = False
        self.known: tuple[float, ...] = ()
        self.words = [0, 0]  # outside and inside an article

    @property
    def keys(self) -> list[str]:
        return [self.tag, *[f".{part}" for name in self.names for part in name]]


@dataclass
class Piece:
    """A run of text: its words, the tags before it, its container and block."""

    text: str
    words: int
    tags: list[str]
    node: Node
    block: int


def named(markup: str, ids: bool = True) -> list[str]:
    """The names of a tag, in lower case."""
    return [n for m in NAMES.finditer(markup) if ids or m.group(1).lower() != "id" for n in m.group(2).strip("\"'").lower().split()]


def container_names(markup: str) -> list[list[str]]:
    """The parts of each name."""
    return [parts for name in named(markup) if (parts := [p for p in re.split(r"[_-]+", name) if p])]


def never_named(tag: str, markup: str, inside: bool) -> bool:
    """Whether a whole name of the container is listed, alone or with what kind of box it
    is; ``no-sidebar`` is none. ``inside``: in an article, whose header is part of it, and
    where an id names a place in the text."""
    if tag in HOLDERS:
        return False
    parts = [{p for p in re.split(r"[_-]+", n) if p} for n in named(markup, ids=not inside)]
    listed = NEVER_NAMED - {"header"} if inside else NEVER_NAMED
    return any(p & listed and p <= listed | BOXES for p in parts)


class Tags:
    """Finds the ends of a page's tags, each character looked at a few times at most."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.gone: set[str] = set()  # quotes that do not come again

    def end(self, at: int) -> int:
        """Behind the end of the tag at ``at``, 0 if there is none. A quoted value may
        hold the sign; with a quote that is never closed, the first sign ends the tag."""
        if at > self.last:
            return 0
        first = sign = self.page.find(">", at)
        place = at
        while sign >= 0:
            while place < sign and (run := QUOTED.match(self.page, place, sign)):
                place = run.end()
            if place >= sign:
                return sign + 1
            quote = self.page[place]
            close = -1 if quote in self.gone else self.page.find(quote, sign)
            if close < 0:
                self.gone.add(quote)
                break
            place = close + 1
            sign = self.page.find(">", place) if place <= self.last else -1
        return first + 1


def parse(page: str) -> tuple[list[Piece], list[Node]]:
    """The runs of text of a page, in order, with the tags before each, and its containers,
    outer ones first."""
    top = Node("", [], None, False)
    pieces: list[Piece] = []
    nodes, node = [top], top
    opened: Counter = Counter()
    tags: list[str] = []
    ends = Tags(page)
    unclosed: set[str] = set()
    block = at = 0

    def add(text: str) -> None:
        nonlocal tags
        words = len(text.split())
        if words or (pieces and pieces[-1].block == block):
            pieces.append(Piece(text, words, tags, node, block))
            node.words[node.inside] += words
            tags = []

    while at < len(page):
        if page[at] != "<":
            end = TEXT.match(page, at).end()
            add(page[at:end])
            at = end
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        found = NAME.match(page, at + 1)
        end = ends.end(at) if found or page[at + 1 : at + 2] in ("!", "?") else 0
        if not end:
            add("<")
            at += 1
            continue
        markup, start = page[at:end], at
        at = end
        if not found:
            continue
        tag, closing = found.group(1).lower(), markup[1] == "/"
        if tag in ENDS:
            tags.append(tag)
            if not closing and not markup.endswith("/>") and tag not in unclosed:
                stop = ENDS[tag].search(page, at)
                if stop:
                    at = stop.start()
                elif tag in RAW:
                    break
                else:
                    unclosed.add(tag)
            continue
        if tag in CONTROLS or tag not in BLOCKS:
            tags.append(tag)
            if tag in CONTROLS:
                while node.tag in CONTROLS:
                    node = node.parent
                if not closing:
                    node = Node(tag, [], node, True)
                    nodes.append(node)
            continue
        while node.tag in CONTROLS:  # a line of a form ends where a block begins or ends
            node = node.parent
        block += tag != "br"
        tags.append("/" + tag if closing else tag)
        if tag == "br" and pieces and pieces[-1].block == block:
            pieces.append(Piece(" ", 0, [], node, block))
        if tag in CONTAINERS:
            if not closing:
                node = Node(tag, container_names(markup), node, never_named(tag, markup, node.inside))
                nodes.append(node)
                opened[tag] += 1
            elif opened[tag]:
                while True:
                    opened[node.tag] -= 1
                    left, node = node.tag, node.parent
                    if left == tag:
                        break
    _inherit(nodes)
    return pieces, nodes


def _inherit(nodes: list[Node]) -> None:
    """Sum up the words of containers, and mark what is never content: a page's header,
    not an article's, and listed names, unless one holds most of the page's words."""
    for node in reversed(nodes[1:]):
        for side in (0, 1):
            node.parent.words[side] += node.words[side]
    total = sum(nodes[0].words)
    for node in nodes[1:]:
        within = node.parent.inside
        listed = node.listed and 2 * sum(node.words) <= total
        node.never = node.parent.never or listed or node.tag in NEVER or (node.tag == "header" and not within)


@dataclass
class Weights:
    containers: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def known(self, node: Node) -> tuple[float, ...]:
        """The weights of the two innermost names around a container's words. Within an
        article only names that are known as a whole count, and no tags."""
        before = node.parent.known if node.parent else ()
        if node.parent and node.parent.inside:
            parts = [[p for p in name if p not in BOXES] for name in node.names]
            own = [max(self.containers[f".{p}"] for p in name) for name in parts if name and all(f".{p}" in self.containers for p in name)]
        else:
            own = [self.containers[k] for k in node.keys if k in self.containers and k not in GENERIC]
        return (*before, *own)[-2:]

    def word(self, node: Node) -> float:
        """Within an article no word scores below zero: an advert there does not part it."""
        if node.inside:
            return 0.0 if node.never else max(1.0, min(node.known, default=1.0))
        return -CLIP if node.never else min(node.known, default=1.0)

    def tag(self, tag: str) -> float:
        return self.tags.get(tag, TAG)


def count(page: str) -> Counter:
    """Words and tags of a labelled page by container and side; nothing if it has no
    article."""
    seen: Counter = Counter()
    pieces, nodes = parse(page)
    if not any(p.node.inside for p in pieces):
        return seen
    sides = ("out", "in")
    for node in nodes:
        for key in node.keys:
            for side in (0, 1):
                if node.words[side]:
                    seen[("word", key, sides[side])] += node.words[side]
    for p in pieces:
        for tag in p.tags:
            seen[("tag", tag, sides[p.node.inside])] += 1
        seen[("all", "words", sides[p.node.inside])] += p.words
    return seen


def weigh(counts: dict[tuple[str, str, str], int]) -> Weights:
    """Log odds of content, smoothed by one and clipped; tags score below zero."""

    def odds(kind: str, key: str) -> float:
        value = math.log((counts.get((kind, key, "in"), 0) + 1) / (counts.get((kind, key, "out"), 0) + 1))
        return max(-CLIP, min(CLIP, value))

    containers = {key: odds(kind, key) for kind, key, _ in counts if kind == "word" and key not in ("", "body")}
    return Weights(containers, {key: max(LEAST_TAG, min(TAG, odds(kind, key))) for kind, key, _ in counts if kind == "tag"})


def best_region(scores: list[tuple[float, float]]) -> tuple[int, int] | None:
    """First and last place of the contiguous run with the highest sum; each place has
    a score before it (tags) and one of its own (words). None if none is above zero."""
    best, found, total, start = 0.0, None, 0.0, 0
    for i, (before, own) in enumerate(scores):
        total += before
        if total <= 0:
            total, start = 0.0, i
        total += own
        if total > best:
            best, found = total, (start, i)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region, one per line; empty if the page has none."""
    pieces, nodes = parse(page or "")
    for node in nodes:
        node.known = weights.known(node)
    scores = [(sum(map(weights.tag, p.tags)), p.words * weights.word(p.node)) for p in pieces]
    region = best_region(scores)
    if region is None:
        return ""
    first, last = region
    while first and pieces[first - 1].block == pieces[first].block:
        first -= 1
    while last + 1 < len(pieces) and pieces[last + 1].block == pieces[last].block:
        last += 1
    blocks: dict[int, list[str]] = {}
    for p in pieces[first : last + 1]:
        if not p.node.never and min(p.node.known, default=1.0) > LEAST_WORD:
            blocks.setdefault(p.block, []).append(p.text)
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(t for t in texts if t)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from about ``sample`` labelled pages, chosen by the hash of their text;
    what reaches the driver is one row per container or tag of these."""
    page = quoted("html").cast("string")
    labelled = pages.select(page.alias("html")).where(F.col("html").contains("<article"))
    total = max(1, labelled.count())
    share = min(1.0, sample / total)
    chosen = labelled.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column("html"):
                seen += count(value.as_py())
        if seen:
            kinds, keys, sides = map(list, zip(*seen))
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys), pa.array(sides), pa.array(list(seen.values()), pa.int64())], ["kind", "key", "side", "n"])

    rows = map_batches(chosen, run, "kind string, key string, side string, n bigint").groupBy("kind", "key", "side").agg(F.sum("n").alias("n"))
    return weigh({(r["kind"], r["key"], r["side"]): r["n"] for r in rows.collect()})


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``(page_id, url, html)``; null
    html is empty. Rows are not shuffled; other columns are left behind."""
    weights = weights or fit(pages)
    columns = pages.select("page_id", quoted("url").cast("string").alias("url"), quoted("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py(), weights) for value in batch.column("html")]
            lengths = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    kind = columns.schema["page_id"].dataType.simpleString()
    return map_batches(columns, run, f"page_id {kind}, url string, text string, n_chars bigint")
