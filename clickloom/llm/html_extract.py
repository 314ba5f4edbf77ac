"""Main text of web pages by minimum-cut labelling.

A page becomes a list of blocks (the text between block-level tags). A classifier gives each block a
cost for being called content and one for being called boilerplate; these are the capacities of its
edges to the two terminals of a flow network. Blocks that follow one another, and blocks that follow
one another within the same parent, are joined by smoothness edges. The minimum cut, found by
maximum flow, is the labelling of all blocks with the lowest total cost. Blocks whose costs differ
by more than all their smoothness edges weigh are settled beforehand, which does not change the cut.

All costs are finite. Tags and names of classes have fixed ones. What the text of a block looks like
(words, links, its end, kind of tag) is weighed by a logistic regression, and an edge weighs half the
log odds that the two blocks it joins are alike. Both are learned, without labels, from the pages
whose tags tell (``Weights.learn``): a block in ``article`` or ``main`` without names or tags of
page furniture is content there, others are not. So what is learned also judges pages without such
tags. Where evidence is mixed (a form, a name that says both, an ``article`` named like furniture),
the element is furniture unless it holds most of the words that nothing else marks as furniture.

Parsing takes time in proportion to the page. Quotes hide a ``>`` after ``=`` only; if a tag has no
end that way, quotes are not heeded from there on. A ``<`` that no ``>`` follows is text.

Character references are decoded, white space within a block becomes one space, and content blocks
are joined by one space in page order. Null and empty pages, and pages without content, have the
empty text. Rows are extracted one by one; repeated rows have equal results and other columns pass.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import about

# Fixed names of elements, by what they do.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript template svg math iframe object select "
                    "button canvas audio video head".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
# A start tag of the key ends open elements of the value, up to the next section.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SECTION = frozenset("article aside body div fieldset figure footer form header html main nav "
                    "section table td th ul ol dl blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu "
                  "menubar toolbar form".split())
_WORDS_OF_FURNITURE = (
    r"ads?|adverts?|advertisements?|adsense|sponsor(?:ed)?|promos?|promotion|banner|nav|navbar|"
    r"navigation|menu|submenu|sidebar|footer|header|masthead|topbar|breadcrumbs?|comments?|"
    r"commentlist|replies|respond|disqus|cookies?|consent|gdpr|notice|notification|alert|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommended|recommendations|widget|pagination|pager|toolbar|search|copyright|disclaimer|"
    r"toc|skip")
_FURNITURE_NAME = re.compile(rf"(?:^|[\s_-])(?:{_WORDS_OF_FURNITURE})(?=$|[\s_-])", re.I)
_CONTENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|content|entry|post|story|main|text|body|prose)(?=$|[\s_-])", re.I)
_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*+)")
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+>")
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Pages whose blocks the text classifier and the edges are learned from, about.
SAMPLE_PAGES = 4000
# The steps of the text classifier: words from which, and linked shares from which, a step counts.
WORD_STEPS = (2, 4, 8, 16, 32, 64)
LINK_STEPS = (0.01, 0.34, 0.67, 0.99)
KINDS = ("heading", "item", "paragraph")
FEATURES = 1 + len(WORD_STEPS) + len(LINK_STEPS) + 1 + len(KINDS)
# What the blocks seen count as, whatever their number, beside a prior of weight 1 on each step.
BLOCKS_COUNT_AS = 40.0


@dataclass(frozen=True)
class Weights:
    """Positive speaks for content. ``text`` follows the order of ``features``.

    The text of a block weighs ``text_at_most`` at most, an edge ``edge_at_most``.
    """

    in_main: float = 2.5
    beside_main: float = -4.0
    in_header: float = -3.0
    furniture: float = -8.0
    named_content: float = 1.0
    text: tuple[float, ...] = (
        -1.5, 0.4, 0.4, 0.5, 0.5, 0.5, 0.5, -0.8, -0.8, -0.8, -0.8, 1.2, 0.5, -0.5, 0.5)
    text_at_most: float = 2.5
    follows: float = 0.1
    same_parent: float = 1.0
    edge_at_most: float = 1.2

    @staticmethod
    def learn(pages: DataFrame, source: str = "html", sample_pages: int = SAMPLE_PAGES) -> Weights:
        """From the pages whose tags tell; with none, the weights are those above.

        The driver gets counts only: 2 for each combination of features, and 4 of edges.
        """
        def count(batches):
            for batch in batches:
                total: Counter = Counter()
                for page in batch[source].to_pylist():
                    total.update(_told(blocks(page or "")))
                keys = [k for k, _ in total.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.list_(pa.int32())),
                     pa.array([k[1] for k in keys], pa.bool_()),
                     pa.array([total[k] for k in keys], pa.int64())], names=["cell", "yes", "n"])

        held = pages.select(F.col(source).cast("string").alias(source))
        rows = (about(held, sample_pages, F.col(source))
                .mapInArrow(count, "cell array<int>, yes boolean, n long")
                .groupBy("cell", "yes").agg(F.sum("n").alias("n")).collect())
        return Weights.of({(tuple(r["cell"]), r["yes"]): r["n"] for r in rows})

    @staticmethod
    def of(counts: dict[tuple[tuple[int, ...], bool], int]) -> Weights:
        """The most likely weights, with normal priors around those above, by Newton's method.

        The priors keep the tags of one site's pages from deciding alone. Edges follow their odds.
        """
        w = Weights()
        cells = sorted(c for c in counts if len(c[0]) == FEATURES)
        if {yes for _, yes in cells} != {True, False}:
            return w
        x = np.array([c for c, _ in cells], dtype=float)
        y = np.array([yes for _, yes in cells], dtype=float)
        n = np.array([counts[c] for c in cells], dtype=float)
        # Each block counts once with its kind of tag hidden, as other pages use other tags.
        hidden = x.copy()
        hidden[:, -len(KINDS):] = 0
        x, y, n = np.vstack([x, hidden]), np.tile(y, 2), np.tile(n, 2)
        # Content and boilerplate count alike, whatever their numbers of blocks.
        n *= BLOCKS_COUNT_AS / 2 / np.where(y == 1, n[y == 1].sum(), n[y == 0].sum())
        prior = np.array(w.text)
        theta = prior.copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            slope = x.T @ (n * (y - p)) - (theta - prior)
            bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(FEATURES)
            step = np.linalg.solve(bend, slope)
            theta += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-9:
                break
        half = {}
        for kind in (0, 1):
            alike, other = (counts.get(((kind,), yes), 0) + 1 for yes in (True, False))
            half[kind] = min(w.edge_at_most, max(0.0, float(np.log(alike / other)) / 2))
        return Weights(text=tuple(float(t) for t in theta), follows=half[0],
                       same_parent=max(0.0, half[1] - half[0]))


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    parent: int = 0
    tag: str = ""
    main: bool = False
    header: bool = False
    named: bool = False
    furniture: bool = False
    mixed: tuple = ()
    text: str = ""


class _Element:
    """An open element, with what it has from those around it.

    ``mixed`` is a linked list, ``(number, outer)``, of the elements whose evidence is mixed.
    """

    __slots__ = ("tag", "number", "main", "header", "named", "furniture", "mixed", "link", "owner",
                 "holder", "within")

    def __init__(self, tag: str, number: int, above: "_Element | None"):
        self.tag, self.number = tag, number
        self.main = above.main if above else False
        self.header = above.header if above else False
        self.named = above.named if above else False
        self.furniture = above.furniture if above else False
        self.mixed = above.mixed if above else ()
        self.link = above.link if above else False
        self.owner = number if tag in SECTION or not above else above.owner
        # Of blocks within: the block element that holds them, and the section around that one.
        self.holder = tag if tag in BLOCK or not above else above.holder
        self.within = 0 if not above else above.owner if tag in BLOCK else above.within


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _opened(tag: str, attributes: str, number: int, above: _Element) -> _Element:
    element = _Element(tag, number, above)
    mixed = tag == "form"
    if tag in FURNITURE and not mixed:
        element.furniture = True
    elif tag in MAIN:
        element.main = True
    elif tag == "header":
        element.header = True
    elif tag == "a":
        element.link = True
    if attributes and not attributes.isspace():
        held = _attributes(attributes)
        role = held.get("role", "").lower()
        if ("hidden" in held or held.get("aria-hidden", "").lower() == "true"
                or _HIDDEN.search(held.get("style", ""))):
            element.furniture = True
        if role in ROLES:
            mixed = mixed or role == "form"
            element.furniture = element.furniture or role != "form"
        if tag not in ("html", "body"):
            # A name with a word of furniture is one of furniture; of several names each counts.
            names = f"{held.get('class', '')} {held.get('id', '')}".split()
            bad = sum(1 for name in names if _FURNITURE_NAME.search(name))
            good = any(_CONTENT_NAME.search(name) and not _FURNITURE_NAME.search(name)
                       for name in names)
            if bad and (good or tag in MAIN):
                mixed = True
            elif bad:
                element.furniture = True
            elif good:
                element.named = True
        if role in ("main", "article") and not element.furniture:
            element.main = True
    if mixed:
        element.mixed = (number, element.mixed)
    return element


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in order."""
    found: list[Block] = []
    stack = [_Element("", 0, None)]
    # Places in the stack of the open elements of a tag, and of the open sections.
    places: dict[str, list[int]] = defaultdict(list)
    sections: list[int] = []
    block, number, at = Block(), 0, 0
    quotes, unclosed = True, set()

    def text(raw: str) -> None:
        if not raw:
            return
        raw = html.unescape(raw) if "&" in raw else raw
        top = stack[-1]
        if not block.parts and not raw.isspace():
            block.tag, block.main, block.header = top.holder, top.main, top.header
            block.named, block.furniture, block.mixed = top.named, top.furniture, top.mixed
            block.parent = top.within
        if block.parts or not raw.isspace():
            block.parts.append(raw)
        if top.link:
            block.linked += len(raw)

    def flush() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                found.append(block)
            block = Block()

    def close(tags, through_sections: bool) -> None:
        place = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if not place or not through_sections and sections and sections[-1] > place:
            return
        while len(stack) > place:
            gone = stack.pop().tag
            places[gone].pop()
            if gone in SECTION:
                sections.pop()

    while True:
        less = page.find("<", at)
        if less < 0:
            text(page[at:])
            break
        named = _NAME.match(page, less + 1)
        if named is None and page[less + 1:less + 2] not in ("!", "?"):
            text(page[at:less + 1])
            at = less + 1
            continue
        if named is None:
            text(page[at:less])
            mark = "-->" if page.startswith("<!--", less) else ">"
            end = page.find(mark, less + len(mark))
            if mark == "-->" and page.startswith((">", "->"), less + 4):
                end, mark = page.find(">", less + 4), ">"
            at = len(page) if end < 0 else end + len(mark)
            continue
        rest = _REST.match(page, named.end()) if quotes else None
        quotes = rest is not None
        end = rest.end() if rest else page.find(">", named.end()) + 1
        if not end:
            text(page[at:])
            break
        text(page[at:less])
        at = end
        attributes = page[named.end():end - 1]
        tag = named[2].lower()
        if tag in BLOCK:
            flush()
        if named[1]:
            close((tag,), tag in SECTION)
            continue
        if tag in SKIPPED and not attributes.endswith("/"):
            over = None
            if tag not in unclosed:
                over = re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(page, at)
            if over:
                at = over.end()
            else:
                unclosed.add(tag)
                at = at if tag == "head" else len(page)
            continue
        if tag in VOID:
            continue
        close(ENDS.get(tag) or (("p",) if tag in BLOCK else ()), False)
        number += 1
        stack.append(_opened(tag, attributes, number, stack[-1]))
        places[tag].append(len(stack) - 1)
        if tag in SECTION:
            sections.append(len(stack) - 1)
    flush()
    _settle_mixed(found)
    return found


def _settle_mixed(held: list[Block]) -> None:
    """Elements of mixed evidence are furniture if they hold half of the other words or less."""
    if not any(b.mixed for b in held):
        return
    # The outermost first: what it holds does not count for those within it if it is furniture.
    sums: Counter = Counter()
    total = 0
    outer: dict[int, int | None] = {}
    for b in held:
        words = 0 if b.furniture else b.text.count(" ") + 1
        total += words
        if b.mixed:
            sums[b.mixed[0]] += words
            chain = b.mixed
            while chain and chain[0] not in outer:
                outer[chain[0]] = chain[1][0] if chain[1] else None
                chain = chain[1]
    # Numbers grow inwards, so sums can be passed outwards in falling order.
    for k in sorted(outer, reverse=True):
        if outer[k] is not None:
            sums[outer[k]] += sums[k]
    bad = {}
    for k in sorted(outer):
        bad[k] = 2 * sums[k] <= total or (outer[k] is not None and bad[outer[k]])
    for b in held:
        if b.mixed and bad[b.mixed[0]]:
            b.furniture = True


def features(b: Block) -> tuple[int, ...]:
    """Steps of 0 and 1: always 1, words, linked share, an end of a sentence, kind of tag."""
    words = b.text.count(" ") + 1
    share = min(1.0, b.linked / len(b.text))
    kind = ("heading" if b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else
            "item" if b.tag in ("li", "dt", "dd", "td", "th", "option") else
            "paragraph" if b.tag in ("p", "blockquote", "pre") else "")
    return (1, *(int(words >= k) for k in WORD_STEPS), *(int(share >= k) for k in LINK_STEPS),
            int(b.text[-1] in ".!?…:;\"'”’»)"), *(int(kind == k) for k in KINDS))


def _told(held: list[Block]) -> Iterator[tuple[tuple[int, ...], bool]]:
    """What a page whose tags tell adds to the counts: blocks, and edges as ``(kind,)``."""
    labels = [b.main and not b.furniture and not b.header for b in held]
    if any(labels):
        for k, b in enumerate(held):
            yield features(b), labels[k]
            if k:
                yield (int(b.parent == held[k - 1].parent),), labels[k] == labels[k - 1]


def scores(held: list[Block], w: Weights = Weights()) -> list[float]:
    """Positive: what it costs to call the block boilerplate; negative: to call it content."""
    has_main = any(b.main and not b.furniture for b in held)
    out = []
    for b in held:
        text = sum(t for t, on in zip(w.text, features(b)) if on)
        score = max(-w.text_at_most, min(w.text_at_most, text))
        if has_main:
            score += w.in_main if b.main else w.beside_main
        if b.header and not b.main:
            score += w.in_header
        if b.named:
            score += w.named_content
        if b.furniture:
            score += w.furniture
        out.append(score)
    return out


def edges(held: list[Block], w: Weights = Weights()) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for k, b in enumerate(held):
        before = last.get(b.parent)
        if k:
            out.append((k - 1, k, w.follows + (w.same_parent if before == k - 1 else 0)))
        if before is not None and before != k - 1:
            out.append((before, k, w.same_parent))
        last[b.parent] = k
    return out


def minimum_cut(score: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the content side of the minimum cut."""
    weight = [0.0] * len(score)
    near: list[list[tuple[int, float]]] = [[] for _ in score]
    for a, b, c in joined:
        weight[a] += c
        weight[b] += c
        near[a].append((b, c))
        near[b].append((a, c))
    side: list[bool | None] = [s > 0 if abs(s) >= c else None for s, c in zip(score, weight)]
    # A settled neighbour is a terminal for those that are left; that may settle more.
    score = list(score)
    open_nodes = deque(k for k, s in enumerate(side) if s is not None)
    while open_nodes:
        a = open_nodes.popleft()
        for b, c in near[a]:
            if side[b] is None:
                score[b] += c if side[a] else -c
                weight[b] -= c
                if abs(score[b]) >= weight[b]:
                    side[b] = score[b] > 0
                    open_nodes.append(b)
    left = [k for k, s in enumerate(side) if s is None]
    if left:
        rest = set(left)
        for k, on in _max_flow(left, score, [(a, b, c) for a, b, c in joined
                                             if a in rest and b in rest]).items():
            side[k] = on
    return [bool(s) for s in side]


def _max_flow(nodes: list[int], score: list[float],
              joined: list[tuple[int, int, float]]) -> dict[int, bool]:
    """Blocking flows in layers; then what the source still reaches is content."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}, **{k: {} for k in nodes}}
    for k in nodes:
        a, b = (source, k) if score[k] > 0 else (k, sink)
        room[a][b] = abs(score[k])
        room[b][a] = 0.0
    for a, b, c in joined:
        room[a][b] = room[a].get(b, 0.0) + c
        room[b][a] = room[b].get(a, 0.0) + c
    while True:
        layer = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, c in room[a].items():
                if c > 1e-12 and b not in layer:
                    layer[b] = layer[a] + 1
                    if b != sink:
                        queue.append(b)
        if sink not in layer:
            return {k: k in layer for k in nodes}
        ways = {a: iter(list(room[a])) for a in layer}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                steps = list(zip(path, path[1:]))
                flow = min(room[x][y] for x, y in steps)
                for x, y in steps:
                    room[x][y] -= flow
                    room[y][x] += flow
                # Back to the start of the first edge that is full, whose way is tried again.
                full = next(i for i, (x, y) in enumerate(steps) if room[x][y] <= 1e-12)
                del path[full + 1:]
                continue
            for b in ways[a]:
                if room[a][b] > 1e-12 and layer.get(b) == layer[a] + 1:
                    path.append(b)
                    break
            else:
                path.pop()


def main_text(page: str | None, weights: Weights = Weights()) -> str:
    if not page:
        return ""
    held = blocks(page)
    content = minimum_cut(scores(held, weights), edges(held, weights))
    return " ".join(b.text for b, on in zip(held, content) if on)


def extract(pages: DataFrame, weights: Weights = Weights(), source: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; columns of these names are replaced."""
    @F.pandas_udf("string")
    def of_page(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for held in batches:
            yield pd.Series([main_text(page, weights) for page in held], dtype=object)

    found = pages.withColumn("text", of_page(F.col(source).cast("string")))
    return found.withColumn("n_chars", F.length("text").cast("long"))
