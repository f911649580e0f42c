"""Main text of web pages by minimum-cut labelling.

A page is parsed into text blocks. A classifier, trained on a bounded draw of
blocks that semantic tags label, gives each block a cost for either label; the
costs are terminal capacities. Neighbouring blocks, and blocks that follow each
other under one parent, are tied by smoothness edges. The minimum cut separates
content from boilerplate.

Blocks inside navigation, footers, page headers, asides and hidden elements are
boilerplate for certain; scripts, styles and other unseen elements give no text.
Standing in an element whose class, id or role mentions an advert, menu, notice,
comment and the like costs a block something, and the cut decides. A name that says
only that (``comment-list``, not ``comment-policy``) costs more than any text is worth, and so
do forms and articles inside articles, unless they hold half of the page's text.
Names of html, body and main say nothing, those of an article only as whole classes
(``comment``), and names around all of the page or its article nothing either.

Text: character references decoded, white space in a block one blank, blocks
trimmed and joined by line breaks in page order. Defined cases: NULL html is
empty; pages without content give an empty text; unclosed and wrongly nested
elements are closed where their parent ends; an unfinished tag at the end is
dropped. Repeated rows are judged alike. An empty table gives no rows. Only the
id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|$)|<[a-zA-Z][^>]*(?:>|$)", re.DOTALL
)
NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

# Fixed lists of element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template iframe object svg canvas audio video select textarea title noframes noembed math".split())
RAW = set("script style title textarea iframe".split())  # without an end tag they take the rest of the page
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CERTAIN = set("nav footer aside menu dialog head button".split())
CONTENT = set("article main".split())
WHOLE = CONTENT | {"html", "body"}  # their names say nothing
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# What an opening tag ends, up to the element that bounds the search.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
HINTS = set(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended comment comments disqus replies reply pagination pager copyright legal skip toolbar masthead topbar".split()
)
EDGE_HINTS = {"header", "footer"}
OPEN_HINTS = set("related recommended copyright legal skip toolbar masthead topbar".split())  # may well name prose
FILLERS = set(
    "list area section box wrapper wrap container block thread widget body item text content author meta bar form panel card inner outer "
    "post page site user reader main top bottom left right header footer title group row col column level odd even depth new web the".split()
)  # say nothing about what an element is


@dataclass
class Block:
    text: str
    tag: str
    parent: int
    certain: bool  # boilerplate for certain
    inside: bool  # in an article or main element
    linked: int  # characters in links
    hinted: bool  # in an element that mentions one of the names
    named: bool = False  # in an element that is one of them by name
    group: int = 0  # the form, or article within an article, that it stands in


@dataclass
class _Node:
    tag: str
    number: int
    certain: bool
    inside: bool
    link: bool
    hinted: bool = False
    unseen: bool = False
    named: bool = False
    group: int = 0


def _is_name(value: str) -> bool:
    """Whether one of some classes is a name of boilerplate and nothing else."""
    for one in value.split():
        words = {w.lower() for w in WORD.findall(one)}
        if words & (HINTS - OPEN_HINTS) and words <= HINTS | FILLERS:
            return True
    return False


def _flags(tag: str, attributes: str, up: _Node) -> tuple[bool, bool, bool, bool]:
    inside = up.inside or tag in CONTENT
    certain = up.certain or tag in CERTAIN or (tag == "header" and not up.inside)
    hinted, named = up.hinted, up.named
    if attributes and not certain:
        for m in NAMES.finditer(attributes):
            name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
            if name in ("class", "id", "role"):
                if tag == "article":
                    named |= name == "class" and bool({x.lower() for x in value.split()} & (HINTS - OPEN_HINTS))
                elif tag not in WHOLE:
                    named |= _is_name(value)
                    words = {w.lower() for w in WORD.findall(value)}
                    hinted |= bool(words & HINTS) or (bool(words & EDGE_HINTS) and not inside)
            elif name == "hidden":
                certain = True
            elif name == "aria-hidden":
                certain |= value.lower() == "true"
            else:
                certain |= "display:none" in value.lower().replace(" ", "")
    return certain, inside, hinted or named, named


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order."""
    out: list[Block] = []
    root = _Node("", 0, False, False, False)
    stack, made = [root], 1
    parts: list[str] = []
    linked = 0
    home = root  # the innermost block element where the running text began

    def end_block() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, home.tag, home.number, home.certain, home.inside, linked, home.hinted, home.named, home.group))
        parts, linked = [], 0

    def say(text: str) -> None:
        nonlocal home, linked
        if not text or stack[-1].unseen:
            return
        top = stack[-1]
        if not parts or (top.certain, top.hinted, top.named) != (home.certain, home.hinted, home.named):
            end_block()  # an inline element that is or may be boilerplate stands by itself
            home = next((n for n in reversed(stack) if n.tag in BLOCK or not n.tag), root)
            if (top.certain, top.hinted, top.named) != (home.certain, home.hinted, home.named):
                home = _Node(home.tag, home.number, top.certain, home.inside, False, top.hinted, named=top.named, group=home.group)
        parts.append(text)
        if top.link:
            linked += len(text)

    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "br":
                say(" ")
            elif any(n.tag == tag for n in stack):
                while True:
                    gone = stack.pop()
                    if gone.tag in BLOCK or gone.certain or gone.hinted:
                        end_block()
                    if gone.tag == tag:
                        break
            elif tag in BLOCK:
                end_block()
            continue
        unseen = tag in UNSEEN
        if unseen:
            if m.group(3).endswith("/"):
                continue
            # Up to its end tag, unless the same element begins before that: then it is nested, or left open.
            close = re.compile(rf"<(/?){re.escape(tag)}\b[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
                at = close.end() if close else size
                continue
            if close and close.group(1):
                at = close.end()
                continue
        if tag in VOID:
            if tag == "hr":
                end_block()
            else:
                say(" ")
            continue
        if tag in BLOCK:
            end_block()
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for k in range(len(stack) - 1, max(0, len(stack) - 32), -1):
                    if stack[k].tag in bounds:
                        break
                    if stack[k].tag in ends:
                        del stack[k:]
                        break
        up = stack[-1]
        certain, inside, hinted, named = _flags(tag, m.group(3), up)
        group = made if tag == "form" or (tag == "article" and any(n.tag == "article" for n in stack)) else up.group
        stack.append(_Node(tag, made, certain, inside, up.link or tag == "a", hinted, up.unseen or unseen, named, group))
        made += 1
    end_block()
    return out


# ---- classifier

FEATURES = 9
_SENTENCE = re.compile(r"[.!?…](?=\s|$)")


def features(blocks: list[Block]) -> np.ndarray:
    """What tells content from boilerplate without semantic tags."""
    rows = np.empty((len(blocks), FEATURES))
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        rows[i] = (
            1.0, min(np.log1p(n), 8.0), b.linked / max(n, b.linked), b.tag == "p", b.tag in HEADINGS, b.tag in ("li", "td", "th", "dd", "dt"),
            min(len(_SENTENCE.findall(b.text)), 5), min(n / words, 20.0) / 10, b.text.endswith((".", "!", "?", "…", ":", '"')),
        )
    return rows


#: Used where a corpus has no labelled blocks.
PRIOR = np.array([-3.0, 0.6, -5.0, 1.0, 0.5, -0.5, 0.8, -0.2, 0.5])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression around PRIOR by Newton's method."""
    w = PRIOR.copy()
    if not len(x):
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(FEATURES), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class CutParams:
    """``pages``: about as many are drawn for training, ``per_page`` blocks of each at most.
    ``adjacent``, ``sibling``: smoothness. ``article``: what standing inside or outside
    an article adds to a block's cost, on pages that have one. ``hint``: what a mention
    adds to the cost of content; it also takes the article's part away. ``named``: what a
    name, form or inner article adds, above all other costs."""

    pages: int = 400
    per_page: int = 40
    adjacent: float = 0.7
    sibling: float = 0.7
    article: float = 6.0
    hint: float = 3.0
    named: float = 30.0
    certain: float = 1e6
    largest: float = 8.0


# ---- minimum cut

@dataclass
class Flow:
    """Residual graph; nodes are numbered, the last two are source and sink."""

    nodes: int
    to: list[int] = field(default_factory=list)
    room: list[float] = field(default_factory=list)
    edges: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        self.edges = [[] for _ in range(self.nodes)]

    def add(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        for x, y, r in ((a, b, there), (b, a, back)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)

    def source_side(self, s: int, t: int) -> list[bool]:
        """Push flow along shortest augmenting paths; what s still reaches is its side."""
        to, room, edges = self.to, self.room, self.edges
        while True:
            level = [-1] * self.nodes
            level[s] = 0
            queue = [s]
            for a in queue:
                for e in edges[a]:
                    if room[e] > 1e-9 and level[to[e]] < 0:
                        level[to[e]] = level[a] + 1
                        queue.append(to[e])
            if level[t] < 0:
                return [x >= 0 for x in level]
            turn = [0] * self.nodes
            path: list[int] = []
            a = s
            while True:
                if a == t:
                    least = min(room[e] for e in path)
                    for e in path:
                        room[e] -= least
                        room[e ^ 1] += least
                    cut_at = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                    a = to[path[cut_at] ^ 1]
                    del path[cut_at:]
                    continue
                while turn[a] < len(edges[a]):
                    e = edges[a][turn[a]]
                    if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                if turn[a] < len(edges[a]):
                    path.append(edges[a][turn[a]])
                    a = to[path[-1]]
                elif path:
                    level[a] = -1
                    a = to[path.pop() ^ 1]
                else:
                    break


def minimum_cut(unary: np.ndarray, ties: list[tuple[int, int, float]]) -> np.ndarray:
    """True where the cheapest labelling says content.

    ``unary``: cost of boilerplate less cost of content. Nodes whose own cost exceeds
    all their ties keep their label in every minimum cut; they are settled first and
    their ties become costs of the others, so only doubtful nodes enter the flow.
    """
    n = len(unary)
    cost = unary.astype(float).tolist()
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    open_ = [0.0] * n  # sum of ties to nodes that are not settled
    for a, b, w in ties:
        near[a].append((b, w))
        near[b].append((a, w))
        open_[a] += w
        open_[b] += w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is None and abs(cost[i]) > open_[i]:
            label[i] = cost[i] > 0
            for j, w in near[i]:
                if label[j] is None:
                    cost[j] += w if label[i] else -w
                    open_[j] -= w
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        s, t = len(rest), len(rest) + 1
        flow = Flow(len(rest) + 2)
        for i in rest:
            flow.add(s, place[i], max(cost[i], 0.0))
            flow.add(place[i], t, max(-cost[i], 0.0))
        for a, b, w in ties:
            if label[a] is None and label[b] is None:
                flow.add(place[a], place[b], w, w)
        side = flow.source_side(s, t)
        for i in rest:
            label[i] = side[place[i]]
    return np.array(label, bool)


def ties_of(blocks: list[Block], p: CutParams) -> list[tuple[int, int, float]]:
    """Each block with the one before it, and with the one before it under its parent."""
    last: dict[int, int] = {}
    ties = []
    for i, b in enumerate(blocks):
        if i:
            ties.append((i - 1, i, p.adjacent))
        if b.parent in last:
            ties.append((last[b.parent], i, p.sibling))
        last[b.parent] = i
    return ties


def _small_groups(blocks: list[Block], core: np.ndarray) -> np.ndarray:
    """Blocks in forms and inner articles that hold less than half of the text of ``core``."""
    size = np.array([len(b.text) for b in blocks]) * core
    held: dict[int, int] = {}
    for b, n in zip(blocks, size.tolist()):
        held[b.group] = held.get(b.group, 0) + n
    return np.array([b.group > 0 and 2 * held[b.group] < size.sum() for b in blocks])


def content(page: str, weights: np.ndarray, p: CutParams) -> str:
    """Main text of a page."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    unary = np.clip(features(blocks) @ weights, -p.largest, p.largest)
    inside = np.array([b.inside for b in blocks])
    certain = np.array([b.certain for b in blocks])
    hinted = np.array([b.hinted for b in blocks])
    core = inside & ~certain if (inside & ~certain).any() else ~certain
    named = np.array([b.named for b in blocks]) | _small_groups(blocks, core)
    # Names around all of it tell nothing apart.
    if hinted[core].all():
        hinted = hinted & ~core
    if named[core].all():
        named = named & ~core
    if (inside & ~certain).any():
        bonus = np.where(inside, np.maximum(unary + p.article, -0.5), np.minimum(unary - p.article, 0.5))
        unary = np.where(inside & hinted, unary, bonus)
    unary = unary - p.hint * hinted - p.named * named
    unary[certain] = -p.certain
    keep = minimum_cut(unary, ties_of(blocks, p))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


# ---- Spark side

def train(pages: DataFrame, p: CutParams, id_col: str = "page_id", html_col: str = "html") -> np.ndarray:
    """Weights from blocks that semantic tags label, of pages drawn by a hash of their id."""
    turn = F.md5(F.concat(F.lit("html:"), F.col(id_col).cast("string")))
    n = pages.count()
    limit = f"{int(min(1.0, p.pages / max(1, n)) * (16**8 - 1)):08x}"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[float]] = []
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page or "")
                if any(b.inside for b in blocks) and len(blocks):
                    x = features(blocks)
                    named = [i for i, b in enumerate(blocks) if b.inside or b.certain or b.hinted]
                    step = -(-len(named) // p.per_page)
                    rows += [[float(blocks[i].inside and not blocks[i].certain and not blocks[i].hinted), *x[i]] for i in named[::max(1, step)]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["row"])

    drawn = pages.filter(F.substring(turn, 1, 8) <= limit).select(html_col)
    rows = [r.row for r in drawn.mapInArrow(label, "row array<double>").orderBy(F.xxhash64("row"), "row").limit(2 * p.pages * p.per_page).collect()]
    data = np.array(sorted(rows)).reshape(-1, FEATURES + 1)
    return fit(data[:, 1:], data[:, 0])


def extract(
    pages: DataFrame, p: CutParams | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(id, url, text, n_chars) for every page."""
    p = p or CutParams()
    weights = train(pages, p, id_col, html_col)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [content(page.as_py() or "", weights, p) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long"
    )
