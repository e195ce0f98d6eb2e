"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks at block-level tags. Each block is a node of a flow network: a classifier
of its text and surroundings gives the costs of calling it content or boilerplate, which become the
capacities of its edges from the source and to the sink. Neighbouring blocks, and blocks below the
same parent element, are joined by smoothness edges, so a block of little evidence follows its
surroundings. The minimum cut separates content (source side) from boilerplate (sink side).

Scripts, styles, comments and the head hold no text. Text that no element of the page marks is
judged by length, links and words of its class and id names. Names of the html and body elements
say nothing, as these hold the whole page; a name around an article or main element counts only if
another article or main element stands outside such names.

Defined results: null or empty html gives an empty text; broken markup is read as far as it goes
(a tag that the page ends in is dropped); equal pages are extracted each; an empty table gives an
empty result; columns other than those named are left out. A page of any length is read whole.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>=]+|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?)*+)(?P<end>>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")

# Elements of HTML by their role.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas".split())
#: Silent elements of which only an end tag shows that they hold anything.
EMBEDDED = frozenset("svg math iframe object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()
)
BOILER = frozenset("nav footer aside form header menu button select option textarea dialog fieldset legend search".split())
CONTENT = frozenset("article main".split())
#: Elements that end an open p.
CLOSES_P = BLOCK - {"br", "button", "option", "legend", "caption"}

# Words of class and id names that tell what an element is.
BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|disqus|cookies?|consent|copyright|footer|header|masthead|"
    r"menu|modal|nav\w*|newsletter|notices?|pager|pagination|popup|promo\w*|recommend\w*|related|replies|reply|search|share|sharing|"
    r"sidebar|side|signup|social|sponsor\w*|subscribe|tags|toolbar|widgets?|alert)(?:$|[\s_-])",
    re.I,
)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry|main|post|story|text|prose)(?:$|[\s_-])", re.I)

#: Class names that make an article the page's own, whatever stands beside them.
OWN_NAMES = frozenset("article content entry hentry main post story".split())
REMARKS = re.compile(r"comment|repl(?:y|ies)", re.I)

#: Smoothness: between neighbours, and between blocks below one parent.
NEAR, SIBLING = 0.6, 0.5
SCALE = 1000


@dataclass
class Block:
    """Text of a block and what is known of its surroundings."""

    parent: int
    text: list[str] = field(default_factory=list)
    linked: int = 0
    tag: str = ""
    boiler: bool = False
    content: bool = False
    bad: bool = False
    good: bool = False
    outer: bool = False  # a bad name stands around the article that holds it

    def joined(self) -> str:
        return _SPACE.sub(" ", html.unescape("".join(self.text))).strip(" ")


@dataclass
class _Open:
    """An open element and what its ancestors are."""

    name: str
    number: int
    boiler: bool = False
    content: bool = False
    bad: bool = False
    good: bool = False
    hidden: bool = False
    outer: bool = False


def _names(rest: str) -> tuple[str, bool]:
    """Class, id and role of a tag; whether it is hidden."""
    words, hidden = [], False
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id", "role"):
            words.append(value)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return " ".join(words), hidden


def blocks(page: str) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    out: list[Block] = []
    stack = [_Open("", 0)]
    number, links, at, n = 0, 0, 0, len(page)
    current: Block | None = None

    def say(text: str) -> None:
        nonlocal current
        top = stack[-1]
        if not text or top.hidden:
            return
        if current is None:
            if not text.strip():
                return
            inside = next((x for x in reversed(stack) if x.name in BLOCK or not x.name), stack[0])
            parent = next((x.number for x in reversed(stack[: stack.index(inside)])), 0)
            current = Block(parent, [], 0, inside.name, top.boiler, top.content, top.bad, top.good, top.outer)
            out.append(current)
        current.text.append(text)
        if links:
            current.linked += len(text.strip())

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            tail = page[at:]
            # a tag that the page ends in
            cut = tail.rfind("<")
            say(tail[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z]|<!|</?\Z", tail[cut:]) else tail)
            break
        say(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name or not m["end"]:
            continue
        if name in BLOCK:
            current = None
        if m["close"]:
            if name == "a":
                links = max(0, links - 1)
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            # an inline end tag never closes a block
            if depth and (name in BLOCK or all(x.name not in BLOCK for x in stack[depth:])):
                del stack[depth:]
            continue
        if name in SILENT:
            if name == "head" or (name in EMBEDDED and m["rest"].endswith("/")):
                continue
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if close or name not in EMBEDDED:
                at = close.end() if close else n
            continue
        if name in VOID or m["rest"].endswith("/"):
            continue
        if name in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "p"), 0)
            if depth and not any(x.name in BLOCK for x in stack[depth + 1 :]):
                del stack[depth:]
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].name == name:
                stack.pop()
        links += name == "a"
        number += 1
        names, hidden = _names(m["rest"])
        top = stack[-1]
        # a header within the article holds its headline
        boiler = name in BOILER and not (name == "header" and top.content)
        bad = bool(names) and name not in ("html", "body") and bool(BAD_NAMES.search(names))
        if bad and name in CONTENT and not REMARKS.search(names):
            bad = OWN_NAMES.isdisjoint(names.lower().split())
        # what stands around the outermost article or main is judged when the whole page is known
        begins = name in CONTENT and not boiler and not top.content
        good = bool(names) and not bad and bool(GOOD_NAMES.search(names))
        stack.append(
            _Open(
                name,
                number,
                top.boiler or boiler,
                (top.content or name in CONTENT) and not boiler,
                bad or (top.bad and not begins),
                top.good or good,
                top.hidden or hidden,
                top.outer or (begins and top.bad),
            )
        )
    found = [b for b in out if b.joined()]
    if any(b.content and not (b.outer or b.bad or b.boiler) for b in found):
        for b in found:
            b.bad = b.bad or b.outer
    return found


def costs(block: Block) -> tuple[float, float]:
    """(evidence of content, evidence of boilerplate) of a block by itself, both at least 0."""
    text = block.joined()
    words = text.count(" ") + 1
    yes, no = 0.0, 0.0
    if block.boiler:
        no += 8
    if block.bad:
        no += 6
    if block.content:
        yes += 4
    if block.good:
        yes += 2
    linked = block.linked / max(1, len(text))
    no += 2.5 * linked
    if not block.content and not block.good:
        yes += min(2.0, words / 15)
        no += 1.0 if words < 6 else 0.3
        if block.tag in ("p", "pre", "blockquote", "h1", "h2"):
            yes += 0.5
        if block.tag in ("li", "td", "th"):
            no += 0.4
        if re.search(r"[.!?:;…]", text):
            yes += 0.3
    if re.match(r"\s*(?:©|copyright\b|all rights reserved)", text, re.I):
        no += 1.5
    return yes, no


def minimum_cut(source: list[int], sink: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut.

    Capacity from the source and to the sink by node; edges hold both ways. Flow through a node to
    both ends is sent first; the rest goes along shortest paths, level by level.
    """
    n = len(source)
    excess = [min(a, b) for a, b in zip(source, sink, strict=True)]
    supply = [a - e for a, e in zip(source, excess, strict=True)]
    demand = [b - e for b, e in zip(sink, excess, strict=True)]
    if not any(supply) or not any(demand):
        return [s > 0 for s in supply] if any(supply) and not edges else _reached(supply, edges, n)
    room: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        room[a][b] = room[a].get(b, 0) + c
        room[b][a] = room[b].get(a, 0) + c
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i])
        for i in queue:
            level[i] = 0
        found = False
        while queue:
            i = queue.popleft()
            found = found or demand[i] > 0
            for j, c in room[i].items():
                if c and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not found:
            return [x >= 0 for x in level]
        rest = [list(r) for r in room]
        for start in range(n):
            while supply[start]:
                path = [start]
                while path:
                    i = path[-1]
                    if demand[i] and level[i] >= 0:
                        break
                    while rest[i] and not (room[i][rest[i][-1]] and level[rest[i][-1]] == level[i] + 1):
                        rest[i].pop()
                    if rest[i]:
                        path.append(rest[i][-1])
                    else:
                        path.pop()
                        if path:
                            rest[path[-1]].pop()
                if not path:
                    break
                flow = min(supply[start], demand[path[-1]], *(room[a][b] for a, b in zip(path, path[1:], strict=False)))
                supply[start] -= flow
                demand[path[-1]] -= flow
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= flow
                    room[b][a] += flow


def _reached(supply: list[int], edges: dict[tuple[int, int], int], n: int) -> list[bool]:
    """Nodes that a supply reaches when nothing flows."""
    seen, todo = [s > 0 for s in supply], [i for i in range(n) if supply[i]]
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b in edges:
        near[a].append(b)
        near[b].append(a)
    while todo:
        for j in near[todo.pop()]:
            if not seen[j]:
                seen[j] = True
                todo.append(j)
    return seen


def label(found: list[Block]) -> list[bool]:
    """For each block whether it is content."""
    source, sink = [], []
    for b in found:
        yes, no = costs(b)
        source.append(int(yes * SCALE))
        sink.append(int(no * SCALE))
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = int(NEAR * SCALE)
        if b.parent in last:
            pair = (last[b.parent], i)
            edges[pair] = edges.get(pair, 0) + int(SIBLING * SCALE)
        last[b.parent] = i
    return minimum_cut(source, sink, edges)


def main_text(page: str | None) -> str:
    """The content blocks of a page, one a line."""
    found = blocks(page or "")
    return "\n".join(b.joined() for b, keep in zip(found, label(found), strict=True) if keep)


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: its id, the kept columns, `text` and `n_chars`, the code points of `text`."""
    narrow = df.select(df[id_col], *(df[c] for c in keep), df[html_col].alias("html"))
    others = [id_col, *keep]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            arrays = [batch.column(c) for c in others] + [pa.array(texts), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "text", "n_chars"])

    fields = [f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in others]
    return narrow.mapInArrow(rows, ", ".join([*fields, "text string", "n_chars long"]))
