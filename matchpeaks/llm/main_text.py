"""Main text of web pages by a minimum cut.

A page is cut into blocks: the text between two tags of block elements. A classifier gives each
block a cost for being called content and one for being called boilerplate, from the
elements it lies in, their class and id words, its share of link text and its length. A word against
counts by how much running text lies beside its element: next to nothing for a wrapper of the article. The costs
are the capacities between a block and the two terminals. Neighbours in the page, and
neighbours below the same element, are joined by edges that cost something if their labels
differ. The maximum flow gives the labelling of least total cost.

A block whose classifier costs differ by more than all its edges together keeps its label in
every optimal labelling; such blocks are settled first and only what is left goes into the
flow network, so that long pages stay cheap.

Contract: character references are decoded, white space inside a block becomes one space,
blocks are joined in page order by two line feeds; nothing else is dropped or cut.

Defined results: null html counts as empty (empty text); a page without content blocks has the
empty text; broken markup is read as browsers do in outline (unclosed elements end with their
parent); repeated rows and null ids give one row each; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, ship, table

#: A comment, a declaration, or a tag; quoted attribute values may hold ">".
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?>[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
#: Elements without markup inside: all up to their end tag, or to the end of the page, is theirs. That of xmp is shown.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "xmp")}
#: Elements that show nothing of what they hold. They end at their end tag, with their parent, or at once if self-closed.
HIDDEN = frozenset("svg template select iframe noscript noframes annotation annotation-xml".split())
#: In these a self-closed element of any name is empty.
FOREIGN = frozenset(("svg", "math"))
#: Start tags that end an open svg, as it can't hold them.
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
WORDS = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset(("hr",))
#: Elements that are one block of text each: their blocks are neighbours below the element around them.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre legend summary figcaption caption option".split())
#: A start tag ends an open element of the same group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Evidence for content in natural logarithms of odds, by element and by word of class or id.
ELEMENTS = {"article": 6.0, "main": 5.0, "nav": -40.0, "footer": -40.0, "header": -40.0, "aside": -40.0, "form": -40.0, "menu": -40.0, "button": -40.0, "dialog": -40.0, "fieldset": -40.0, "head": -40.0}
OTHER = -20.0
NAMES = {
    "content": 2.0, "article": 2.0, "post": 1.5, "entry": 1.5, "story": 2.0, "main": 2.0, "articlebody": 3.0,
    "ad": OTHER, "ads": OTHER, "advert": OTHER, "adverts": OTHER, "advertisement": OTHER, "sponsored": OTHER, "sponsor": OTHER, "promo": OTHER, "banner": OTHER,
    "nav": OTHER, "navbar": OTHER, "navigation": OTHER, "menu": OTHER, "breadcrumb": OTHER, "breadcrumbs": OTHER, "pagination": OTHER, "header": OTHER, "masthead": OTHER,
    "footer": OTHER, "copyright": OTHER, "sidebar": OTHER, "aside": OTHER, "widget": OTHER, "related": OTHER, "recommended": OTHER,
    "comment": OTHER, "comments": OTHER, "disqus": OTHER, "reply": OTHER, "replies": OTHER, "respond": OTHER,
    "cookie": OTHER, "cookies": OTHER, "consent": OTHER, "notice": OTHER, "gdpr": OTHER, "popup": OTHER, "modal": OTHER, "newsletter": OTHER, "subscribe": OTHER, "signup": OTHER, "login": OTHER,
    "share": OTHER, "sharing": OTHER, "social": OTHER, "toolbar": OTHER, "contentinfo": OTHER, "complementary": OTHER, "search": OTHER, "form": OTHER,
}
#: Words before these tell what a part has, lacks or is about, not what it is: "has-sidebar", "category-social".
STATES = frozenset("has no not with without is hide hidden show category tag type format status".split())
#: A named part that holds ``WRAPS`` times as much running text as there is beside it loses half of its name's weight and more.
WRAPS, BESIDE = 8.0, 10.0
#: Evidence without any named element; per link share; per tenfold length above 30 characters.
PRIOR, LINKS, LENGTH = -1.0, -4.0, 3.0
#: What differing labels cost next to each other in the page, and next to each other below one element.
ADJACENT, SIBLING = 0.6, 1.0
SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


class Node(NamedTuple):
    """A block element of a page."""

    around: int
    element: float
    good: float
    bad: float
    region: bool


def blocks(page: str) -> list[tuple[str, float, int]]:
    """(text, log-odds of content, number of the element around it) of each block that holds text."""
    found: list[tuple[str, float, int, int]] = []
    # All block elements by number: the element around, evidence of the element and those around it, and names for and against.
    nodes: list[Node] = [Node(0, 0.0, 0.0, 0.0, False)]
    # Open block and hidden elements: name, number, whether text is shown.
    stack: list[tuple[str, int, bool]] = [("", 0, True)]
    held: list[str] = []
    linked, in_link, math_open = 0, 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            below = stack[-2] if stack[-1][0] in LEAVES else stack[-1]
            found.append((text, evidence(0.0, len(text), min(1.0, linked / max(1, len(text)))), stack[-1][1], below[1]))
        held.clear()
        linked = 0

    def show(text: str) -> None:
        nonlocal linked
        if stack[-1][2]:
            held.append(text)
            linked += len(text) * (in_link > 0)

    def leave(depth: int) -> None:
        """End all open elements from ``depth`` on; text held so far belongs to the innermost that is shown."""
        while len(stack) > depth and not stack[-1][2]:
            stack.pop()
        if len(stack) > depth:
            close()
            del stack[depth:]

    at = 0
    while m := MARKUP.search(page, at):
        if m.start() > at:
            show(page[at : m.start()])
        at = m.end()
        name, ends, attributes = (m["name"] or "").lower(), bool(m["end"]), m["attributes"] or ""
        empty = attributes.endswith("/")
        if name == "math":
            math_open = 0 if ends or empty else 1
        if not ends and name in RAW and not (empty and (math_open or any(x[0] in FOREIGN for x in stack))):
            stop = RAW[name].search(page, at)
            inside, at = page[at : stop.start() if stop else len(page)], stop.end() if stop else len(page)
            if name == "xmp" and stack[-1][2]:
                close()
                show(html.escape(inside))
                close()
            continue
        if name in BREAKS and not ends and stack[-1][0] == "svg":
            stack.pop()
        if name in HIDDEN:
            if ends:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                # Only what is open inside it ends with it.
                if depth:
                    del stack[depth:]
            elif not empty:
                stack.append((name, stack[-1][1], False))
            continue
        if name == "a":
            in_link = 0 if ends else 1
        elif name == "br":
            show(" ")
        if name not in BLOCK:
            continue
        if ends:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                leave(depth)
            elif stack[-1][2]:
                close()
            continue
        shown = stack[-1][2]
        if shown:
            close()
        if stack[-1][0] in CLOSES.get(name, ()):
            stack.pop()
        if name not in VOID and not empty:
            around = stack[-1][1]
            good, bad = named(name, attributes)
            own = ELEMENTS.get(name, 0.0)
            nodes.append(Node(around, nodes[around].element + own, good, bad, name in ("article", "main") and not bad))
            stack.append((name, len(nodes) - 1, shown))
    show(page[at:])
    leave(1)
    close()
    around = names_around(nodes, [(node, len(text), odds) for text, odds, node, _ in found])
    return [(text, odds + around[node], below) for text, odds, node, below in found]


def named(name: str, attributes: str) -> tuple[float, float]:
    """Evidence of one element's names, for and against. Words of body and html tell about the page, not about its parts."""
    good = bad = 0.0
    if attributes and name not in ("body", "html"):
        for groups in WORDS.findall(attributes):
            known = [0.0]
            for one in re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(groups)).lower().split():
                words = re.findall(r"[a-z]+", one)
                known += [NAMES.get(w, 0.0) for w in words] if not words or words[0] not in STATES else []
            good, bad = good + max(known), bad + min(known)
    return good, bad


def names_around(nodes: Sequence[Node], held: Sequence[tuple[int, int, float]]) -> list[float]:
    """Evidence of each element and those around it. ``held``: element, length and own evidence of each block.

    A name against counts by the running text (blocks that are content by themselves) beside its element that
    no name is against: inside the article or main around it; else in all articles; else, without any, on the
    page. Elements are judged from the largest down, those with a name for them first, and one found to be a wrapper counts
    as text beside the others. So a wrapper of what the page is about weighs next to nothing, and a part beside it all its weight.
    """
    n = len(nodes)
    inner, running, regions, own = [0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(1, n):
        inner[i] = i if nodes[i].region and nodes[i].element > 0 else inner[nodes[i].around]
    for node, length, odds in held:
        if odds > 0 and nodes[node].element > -1.0:
            own[node] += length
    for i in range(n - 1, -1, -1):
        running[i] += own[i]
        regions[i] += own[i] if inner[i] else 0.0
        if i:
            running[nodes[i].around] += running[i]
            regions[nodes[i].around] += regions[i]
    against = {i for i in range(1, n) if nodes[i].bad}

    def clean() -> list[float]:
        """Running text that no name is against, for each article and (place 0) outside of them."""
        dirty, sums = [False] * n, [own[0]] + [0.0] * (n - 1)
        for i in range(1, n):
            dirty[i] = inner[i] != i and (dirty[nodes[i].around] or i in against)
            sums[inner[i]] += 0.0 if dirty[i] else own[i]
        return sums

    beside, weights = clean() if against else [], [1.0] * n
    for i in sorted(against, key=lambda i: (nodes[i].good <= 0, -running[i], i)):
        mine, near = running[i], beside[inner[i]]
        if not inner[i] and regions[0]:
            mine, near = regions[i], regions[0] - regions[i]
        weights[i] = ((near + BESIDE) / (near + BESIDE + mine / WRAPS)) ** 2
        if weights[i] < 0.5:
            against.discard(i)
            beside = clean()
    names, around = [0.0] * n, [0.0] * n
    for i in range(1, n):
        names[i] = names[nodes[i].around] + nodes[i].good + weights[i] * nodes[i].bad
        around[i] = nodes[i].element + names[i]
    return around


def evidence(around: float, length: int, linked: float) -> float:
    return PRIOR + around + LINKS * linked + LENGTH * math.log10(max(length, 1) / 30 + 0.1)


def edges(parents: Sequence[int]) -> dict[tuple[int, int], float]:
    """Smoothness between neighbours in the page, and between neighbours below one element."""
    cost: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, parent in enumerate(parents):
        if i:
            cost[i - 1, i] = ADJACENT
        if parent in last:
            pair = (last[parent], i)
            cost[pair] = cost.get(pair, 0.0) + SIBLING
        last[parent] = i
    return cost


def labels(odds: Sequence[float], cost: dict[tuple[int, int], float]) -> list[bool]:
    """The labelling (True: content) with the least sum of block and edge costs; ties go to boilerplate."""
    neighbours: list[list[tuple[int, float]]] = [[] for _ in odds]
    for (a, b), c in cost.items():
        neighbours[a].append((b, c))
        neighbours[b].append((a, c))
    lean = list(odds)
    free = [sum(c for _, c in near) for near in neighbours]
    settled: list[bool | None] = [None] * len(lean)
    waiting = deque(range(len(lean)))
    while waiting:
        i = waiting.popleft()
        if settled[i] is None and (abs(lean[i]) > free[i] or not free[i]):
            settled[i] = lean[i] > 0
            for j, c in neighbours[i]:
                if settled[j] is None:
                    lean[j] += c if settled[i] else -c
                    free[j] -= c
                    if free[j] < 1e-12:
                        free[j] = 0.0
                    waiting.append(j)
    rest = [i for i, label in enumerate(settled) if label is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = {(place[a], place[b]): c for (a, b), c in cost.items() if a in place and b in place}
        for i, label in zip(rest, minimum_cut([lean[i] for i in rest], inner)):
            settled[i] = label
    return [bool(label) for label in settled]


def minimum_cut(odds: Sequence[float], cost: dict[tuple[int, int], float]) -> list[bool]:
    """Maximum flow from the content terminal to the boilerplate terminal by shortest augmenting paths in levels.

    True for the blocks that the residual network still joins to the content terminal.
    """
    n = len(odds)
    source, sink = n, n + 1
    ends: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        for x, y, capacity in ((a, b, there), (b, a, back)):
            out[x].append(len(ends))
            ends.append(y)
            room.append(capacity)

    for i, odd in enumerate(odds):
        if odd > 0:
            join(source, i, odd, 0.0)
        elif odd < 0:
            join(i, sink, -odd, 0.0)
    for (a, b), c in cost.items():
        join(a, b, c, c)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-12 and ends[e] not in level:
                    level[ends[e]] = level[a] + 1
                    queue.append(ends[e])
        if sink not in level:
            return [i in level for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                at = ends[path[k] ^ 1]
                del path[k:]
                continue
            while tried[at] < len(out[at]):
                e = out[at][tried[at]]
                if room[e] > 1e-12 and level.get(ends[e]) == level[at] + 1:
                    break
                tried[at] += 1
            if tried[at] < len(out[at]):
                path.append(e)
                at = ends[e]
            elif at == source:
                break
            else:
                at = ends[path.pop() ^ 1]
                tried[at] += 1


def main_text(page: str) -> str:
    found = blocks(page)
    keep = labels([odds for _, odds, _ in found], edges([parent for _, _, parent in found]))
    return "\n\n".join(text for (text, _, _), kept in zip(found, keep) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page; url is carried on."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("html").cast("string"), F.lit("")), F.col("url").cast("string"))

    def row(page_id: int | None, page: str, url: str | None) -> tuple:
        text = main_text(page)
        return page_id, url, text, len(text)

    return map_texts(rows, row, SCHEMA)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
