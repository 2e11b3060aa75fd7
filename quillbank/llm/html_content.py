"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks in page order. Each block is a node of a graph:

- its terminal capacities are the costs of calling it content or boilerplate: the log odds of a classifier on the block's
  text and links, plus fixed evidence from the elements it lies in. Inside content, classes and ids are weaker evidence than classifier
  and edges together, so the cut can keep an article's section on a topic that names boilerplate elsewhere;
- edges join neighbours in the page and following blocks of the same parent; the nearer two blocks are in the tree, the
  more it costs to label them differently.

The minimum cut, found by shortest augmenting paths (maximum flow), is the cheapest labelling. Blocks whose own costs outweigh all their
edges are labelled first, which never changes the minimum.

The classifier is a logistic regression trained on at most `SAMPLE` pages, in the order of a hash of their urls, in one task: blocks
inside an article are its positive rows, blocks inside navigation, footers, adverts and the like its negative ones.
Its features leave these elements out, so it also tells blocks apart where a page lacks them.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillbank.llm.frames import attach, slices, unpacked

SAMPLE = 2000
#: Cost, in log odds, of going against the elements a block lies in.
BOILERPLATE_EVIDENCE = 8.0
CONTENT_EVIDENCE = 4.0
#: The same for containers that classes or ids name, outside of content; for those inside of it, and for other elements outside.
NAMED_EVIDENCE = 6.0
WEAK_EVIDENCE = 2.0
#: Bounds of the classifier's log odds.
CLASSIFIER_BOUND = 3.0
#: Cost of labelling neighbours differently, for blocks of one parent; halved for each step further in the tree.
ADJACENCY = 1.0
PROXIMITY = 0.5

# Element names of HTML, and words by which pages name their parts.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
STOPS_CLOSING = frozenset("ul ol menu dir dl table body html".split())
VOID_TAGS = frozenset("hr".split())
BOILERPLATE_TAGS = frozenset("nav aside footer form fieldset dialog menu search button".split())
#: A form around one of these is the page's or a part's, not one to fill in.
PAGE_PARTS = frozenset("article main nav header footer h1".split())
RAW_TAGS = frozenset("noscript template iframe object textarea select title svg math".split())
CONTENT_TAGS = frozenset("article main".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LEAF_TAGS = frozenset("address blockquote caption dt figcaption legend p pre summary".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination paywall popup promo promos promotion recommended recommendations related replies reply respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
#: Of these, what readers or advertisers wrote, also inside an article; and words that may stand beside them in an id.
FOREIGN_NAMES = frozenset(
    "ad ads adsense advert advertisement advertisements advertising adverts comment commentlist comments disqus newsletter promo promos "
    "replies respond sponsor sponsored".split()
)
GENERIC_NAMES = frozenset(
    "area body box bottom container content entry inline inner item layout left list main middle panel post reader right section side slot thread top "
    "unit user wrap wrapper".split()
)
CONTENT_NAMES = frozenset("article articlebody content entry main post story".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(script|style)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+>|[^>]*+(?:>|\Z))",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW_TAGS}
_FORM_MARKS = re.compile(rf"<(/?)(form|{'|'.join(sorted(PAGE_PARTS))})(?![^\s/>])", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Element:
    """An open block element; `evidence` is for its text being content, `inside` tells if it lies in content."""

    tag: str
    evidence: float
    inside: bool
    number: int


@dataclass
class TextBlock:
    text: str
    linked: int
    evidence: float
    tag: str
    parent: int  #: number of the element around the block's own
    depth: int  #: elements open at the block, the root included
    shared: int  #: how many of these were open all the way since the block before


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def attributes_of(text: str) -> dict[str, str]:
    """Values by lower-case name; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def wrapping_forms(page: str) -> set[int]:
    """Where the forms start that hold parts of a page."""
    found: set[int] = set()
    start, holds = -1, False
    for m in _FORM_MARKS.finditer(page):
        if m[2].lower() != "form":
            holds = holds or not m[1]
        elif m[1] or start < 0:
            if start >= 0 and holds:
                found.add(start)
            start, holds = -1 if m[1] else m.start(), False
    if start >= 0 and holds:
        found.add(start)
    return found


def is_foreign(attributes: dict[str, str]) -> bool:
    """Comments of readers and adverts: a class with such a word, or an id of such a word and generic ones only (an id can come from
    the words of a heading)."""
    for value in attributes.get("class", "").split():
        if not FOREIGN_NAMES.isdisjoint(w.lower() for w in _PARTS.findall(value)):
            return True
    named = {w.lower() for w in _PARTS.findall(attributes.get("id", "")) if not w.isdigit()}
    return bool(named & FOREIGN_NAMES) and named <= FOREIGN_NAMES | GENERIC_NAMES


def is_hard(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Boilerplate, or not shown, whatever it holds."""
    return (
        tag in BOILERPLATE_TAGS or tag == "header" and not inside or "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true" or attributes.get("role", "").strip().lower() in BOILERPLATE_ROLES
        or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I) is not None
    )


def element_evidence(tag: str, text: str, above: float, inside: bool) -> tuple[float, bool]:
    """What an element with the attributes `text` says of its own text, and whether it lies in content.

    Boilerplate by element, role or hiding stays so, inside content too. A class or id that names boilerplate is evidence: for
    containers its parts count too, for leaves whole values only, for headings (whose ids come from their words) nothing. Inside
    content it is weak, but for names of what others than the author wrote.
    """
    if above <= -BOILERPLATE_EVIDENCE:
        return above, inside
    attributes = attributes_of(text)
    if is_hard(tag, attributes, inside):
        return -BOILERPLATE_EVIDENCE, inside
    foreign = is_foreign(attributes)
    if tag in CONTENT_TAGS:
        if inside:
            return min(above, -NAMED_EVIDENCE) if foreign else above, True
        return (0.0 if above < 0 else CONTENT_EVIDENCE), True
    if tag in ("html", "body"):
        return above, inside
    given = [*attributes.get("class", "").split(), attributes.get("id", "").strip()]
    parts = {w.lower() for value in given for w in _PARTS.findall(value)}
    content = bool(parts & CONTENT_NAMES)
    if tag not in HEADING_TAGS:
        if inside and foreign:
            return min(above, -NAMED_EVIDENCE), True
        whole = not BOILERPLATE_NAMES.isdisjoint(value.lower() for value in given)
        named = parts & BOILERPLATE_NAMES - ({"header"} if content else set())
        if whole and named and tag in LEAF_TAGS:
            return min(above, 0.0 if inside else -WEAK_EVIDENCE), inside
        if named and tag not in LEAF_TAGS:
            return min(above, (-WEAK_EVIDENCE if whole else 0.0) if inside else 0.0 if content else -NAMED_EVIDENCE), inside
    if content and above >= 0 and not inside:
        return CONTENT_EVIDENCE, True
    return above, inside


def text_blocks(page: str) -> list[TextBlock]:
    """The texts between block tags, in page order, with white space made single and character references decoded."""
    blocks: list[TextBlock] = []
    stack: list[Element] = [Element("", 0.0, False, 0)]
    opened: Counter[str] = Counter()
    forms: set[int] | None = None
    endless: set[str] = set()
    made = 0
    shared = 1
    now = _Open()
    link = False

    def flush():
        nonlocal now, shared
        text = " ".join(html.unescape("".join(now.parts)).split())
        if text:
            own = stack[-1]
            blocks.append(TextBlock(text, min(now.linked, len(text)), own.evidence, own.tag, stack[-2 if len(stack) > 1 else -1].number, len(stack), shared))
            shared = len(stack)
        now = _Open()

    def add(text: str):
        if text:
            now.parts.append(text)
            if link:
                now.linked += len(text)

    def drop(k: int) -> None:
        nonlocal shared
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]
        shared = min(shared, k)

    def close(tags: set[str] | frozenset, until: frozenset) -> None:
        if not any(opened[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                drop(k)
                return
            if stack[k].tag in until:
                return

    at = 0
    while m := _TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if tag in RAW_TAGS and not m[2] and tag not in endless:
            if end := _RAW_ENDS[tag].search(page, at):
                at = end.end()
            else:
                endless.add(tag)
            continue
        if tag == "a":
            link = not m[2]
        if tag == "br":
            now.parts.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        flush()
        link = False
        if m[2]:
            close({tag}, STOPS_CLOSING if tag not in STOPS_CLOSING else frozenset())
            continue
        if tag in CLOSES:
            close(CLOSES[tag], STOPS_CLOSING)
        elif tag not in ("html", "body"):
            if stack[-1].tag == "p":
                drop(len(stack) - 1)
        if tag in VOID_TAGS:
            continue
        made += 1
        above = stack[-1]
        if tag == "form":
            forms = wrapping_forms(page) if forms is None else forms
            evidence, inside = (above.evidence, above.inside) if m.start() in forms else (-BOILERPLATE_EVIDENCE, above.inside)
        else:
            evidence, inside = element_evidence(tag, m[4], above.evidence, above.inside)
        stack.append(Element(tag, evidence, inside, made))
        opened[tag] += 1
    add(page[at:])
    flush()
    return blocks


def features(blocks: list[TextBlock]) -> np.ndarray:
    """Of each block: size, words, links, punctuation, linked list items and headings; nothing of the elements it lies in."""
    out = np.zeros((len(blocks), 8))
    for k, b in enumerate(blocks):
        n, words = len(b.text), b.text.count(" ") + 1
        out[k] = (
            1, math.log1p(n), math.log1p(words), b.linked / n, sum(map(b.text.count, ".,;:!?")) / words,
            b.text[-1] in ".!?\"'”»…", (b.tag == "li") * b.linked / n, b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
        )
    return out


def fit(x: np.ndarray, label: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, with a small squared penalty."""
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    share = np.where(label > 0, 0.5 / max(1, (label > 0).sum()), 0.5 / max(1, (label <= 0).sum())) * len(x)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - label)) + w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


def smoothness(blocks: list[TextBlock]) -> dict[tuple[int, int], float]:
    """Edges between neighbours and between following blocks of one parent, weaker the further apart in the tree."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for k, b in enumerate(blocks):
        if k:
            edges[k - 1, k] = ADJACENCY * 0.5 ** min(60, max(0, blocks[k - 1].depth + b.depth - 2 * b.shared - 2))
        if b.parent in last:
            pair = last[b.parent], k
            edges[pair] = edges.get(pair, 0) + PROXIMITY
        last[b.parent] = k
    return edges


def minimum_cut(cost: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """The cheapest labelling: a node pays its cost, if above zero, to be False and minus its cost, if below, to be True; an
    edge pays its weight if its ends differ."""
    n = len(cost)
    cost = list(cost)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    side: list[bool | None] = [None] * n
    weigh = deque(range(n))
    while weigh:
        k = weigh.popleft()
        if side[k] is not None or abs(cost[k]) < sum(near[k].values()):
            continue
        side[k] = cost[k] > 0
        for other, w in near[k].items():
            cost[other] += w if side[k] else -w
            del near[other][k]
            weigh.append(other)
        near[k] = {}
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        for k, s in zip(rest, _flow(rest, cost, near)):
            side[k] = s
    return [bool(s) for s in side]


def _flow(rest: list[int], cost: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Maximum flow over the nodes that are left, by all shortest augmenting paths at a time; True for those the source still reaches."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {k: dict(near[k]) for k in rest}
    room[source], room[sink] = {}, {}
    for k in rest:
        if cost[k] > 0:
            room[source][k], room[k][source] = cost[k], 0.0
        elif cost[k] < 0:
            room[k][sink], room[sink][k] = -cost[k], 0.0
    while True:
        level = {source: 0}
        line = deque([source])
        while line and sink not in level:
            k = line.popleft()
            for other, free in room[k].items():
                if free > 1e-9 and other not in level:
                    level[other] = level[k] + 1
                    line.append(other)
        if sink not in level:
            return [k in level for k in rest]
        onward = {k: [o for o in room[k] if level.get(o) == at + 1] for k, at in level.items()}
        path = [source]
        while path:
            k = path[-1]
            if k == sink:
                push = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= push
                    room[b][a] += push
                path = path[: next(i for i, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= 1e-9) + 1]
            elif onward.get(k):
                if room[k][onward[k][-1]] > 1e-9:
                    path.append(onward[k][-1])
                else:
                    onward[k].pop()
            else:
                path.pop()
                if path:
                    onward[path[-1]].pop()


def main_text(page: str, weights: np.ndarray) -> tuple[str, list[TextBlock], list[bool]]:
    """The content blocks joined by line feeds, all blocks, and their labels."""
    blocks = text_blocks(page)
    if not blocks:
        return "", blocks, []
    odds = np.clip(features(blocks) @ weights, -CLASSIFIER_BOUND, CLASSIFIER_BOUND).tolist()
    cost = [o + b.evidence for o, b in zip(odds, blocks)]
    labels = minimum_cut(cost, smoothness(blocks))
    return "\n".join(b.text for b, content in zip(blocks, labels) if content), blocks, labels


def train(pages: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the classifier from at most `sample` pages; zeros if none has labelled blocks."""

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for page in slices(batch["html"]):
                blocks = [b for b in text_blocks(page.decode("utf-8", "replace")) if b.evidence > 0 or b.evidence <= -NAMED_EVIDENCE]
                x = np.hstack([features(blocks), np.array([[b.evidence > 0] for b in blocks], float).reshape(len(blocks), 1)])
                rows.append(x.tobytes())
            yield pa.StructArray.from_arrays([pa.array(rows, pa.binary())], ["x"])

    def fit_rows(_: tuple, group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(r).reshape(-1, 9) for r in sorted(group.column("x").to_pylist())]
        x = np.concatenate(rows)
        return pa.table({"weights": [fit(x[:, :8], x[:, 8]).tobytes()]})

    keyed = pages.select("page_id", "html", F.xxhash64("html").alias("key"))
    ids = keyed.select("page_id", "key").orderBy("key", "page_id").limit(sample)
    picked = pages.sparkSession.createDataFrame(ids.collect(), ids.schema)
    chosen = keyed.join(F.broadcast(picked.distinct()), ["page_id", "key"]).select("html").limit(sample)
    marked = unpacked(attach(chosen, ["html"], work, "x binary", ["html"]), ["x"]).select("x")
    row = marked.groupBy(F.lit(1).alias("all")).applyInArrow(fit_rows, "weights binary").first()
    return np.zeros(8) if row is None else np.frombuffer(bytes(row.weights))


def with_main_text(pages: DataFrame, keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """`pages` packed by `attach`; `found` has the main text, its length in code points, and how many blocks were kept of how many.

    A null or empty page, and one without content, has an empty text. Repeated rows each get their result.
    """
    weights = train(pages, sample)

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, kept, total = [], [], []
            for page in slices(batch["html"]):
                text, blocks, labels = main_text(page.decode("utf-8", "replace"), weights)
                texts.append(text.encode("utf-8", "replace"))
                kept.append(sum(labels))
                total.append(len(blocks))
            yield pa.StructArray.from_arrays(
                [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(kept, pa.int64()), pa.array(total, pa.int64())],
                ["text", "n_kept", "n_blocks"],
            )

    return attach(pages, ["html"], work, "text string, n_kept bigint, n_blocks bigint", keep)
