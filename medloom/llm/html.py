"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks. A classifier gives each block the cost of
calling it content and of calling it boilerplate; these are the capacities to
the two terminals. Neighbouring blocks are tied to each other, and blocks to
the element they stand in and elements to their parents, so that a cut runs
where the page's structure has a seam. The maximum flow finds the cheapest
cut; what stays with the source is the main text.

Each page is cut alone, in the task that holds it.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
HIDDEN = frozenset("script style noscript template svg math iframe object select option button textarea title head canvas audio video datalist map".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role that name boilerplate, and content.
_NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|nav(?:bar|igation)?|menu|"
    r"breadcrumbs?|sidebar|side-bar|footer|site-?header|page-?header|masthead|topbar|toolbar|cookies?|consent|notice|"
    r"notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|social|share|sharing|related|"
    r"recommended|widget|pagination|pager|comments?|comment-?list|respond|disqus|replies|reply|complementary|contentinfo)(?:$|[\s_-])",
    re.I)
_MAIN = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body|text)(?:$|[\s_-]|-?body|-?content|-?text)", re.I)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Closing an element's siblings: a new block ends an open paragraph, a new item an open item.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}

# Names that tell a state or what is not there, not what an element is.
_STATE = re.compile(
    r"(?:^|(?<=\s))(?:no|not|has|is|with|without|hide|show)[_-]\S+|\S+[_-](?:open|opened|closed|active|enabled|disabled|visible|hidden)(?=\s|$)"
    r"|(?<=[A-Za-z0-9])[_-](?:with|without|no|has)[_-]\S+", re.I)

# Costs in whole units, all finite and set by hand. An element that says what it holds bears a cost for each block it
# speaks for; the ties from there to its blocks are stronger than what a block's text alone says, so that a line of links
# in an article and a long text in a sidebar go with their surroundings; where nothing speaks, neighbours smooth.
SPOKEN, FROM_ELEMENT, WITHIN = 500, 250, 220
NEIGHBOURS, SAME_PARENT, PARENTS = 20, 30, 10
# Share of a page's characters from which a form is the page itself, and an article is not part of what surrounds it.
WHOLE_PAGE, MAIN_ARTICLE = 0.6, 0.3


class Element:
    __slots__ = ("name", "parent", "number", "own", "inside", "hidden", "characters")

    def __init__(self, name: str, names: str, parent: Element | None, number: int):
        self.name, self.parent, self.number, self.characters = name, parent, number, 0
        self.inside = (parent is not None and parent.inside) or name in CONTENT
        self.hidden = (parent is not None and parent.hidden) or name in HIDDEN
        names = _STATE.sub(" ", names) if names else names
        against = bool(names and _NOT_MAIN.search(names)) and name not in ("html", "body", "article", "main")
        for_ = bool(names and _MAIN.search(names))
        # A header belongs to the page unless it opens an article.
        header = name == "header" and not self.inside
        # What the element says of itself: against main text, for it, or nothing.
        self.own = -1 if name in BOILERPLATE or header else for_ - against

    def speaker(self, characters: int) -> tuple[Element | None, int]:
        """The element that speaks for this one on a page of so many characters, and what it says.

        The nearest that says anything, or an article: a large one speaks for
        itself whatever stands around it, a small one, as of a comment, only
        where nothing around it says otherwise.
        """
        element, article = self, None
        while element is not None:
            # A form that holds most of a page is no form to fill in.
            whole = element.name == "form" and element.characters >= WHOLE_PAGE * characters
            if element.own and not whole:
                return (article, 1) if article is not None and element.own > 0 else (element, element.own)
            if element.name in CONTENT:
                if element.characters >= MAIN_ARTICLE * characters:
                    return element, 1
                article = article or element
            element = element.parent
        return article, int(article is not None)


class Block:
    __slots__ = ("parts", "linked", "element", "heading")

    def __init__(self, element: Element):
        self.parts, self.linked, self.element, self.heading = [], 0, element, element.name in HEADINGS


def blocks(page: str) -> tuple[list[tuple[str, float, Element]], int]:
    """(text, share of linked characters, element) of each block in page order, and the number of elements."""
    root = Element("html", "", None, 0)
    stack, found, block, elements, at, links = [root], [], None, 1, 0, 0

    def write(text: str) -> None:
        nonlocal block
        if stack[-1].hidden or not text:
            return
        if block is None:
            if text.isspace():
                return
            block = Block(next((e for e in reversed(stack) if e.name in BLOCKS), root))
            found.append(block)
        block.parts.append(text)
        if links:
            block.linked += len(text)

    def close(upto: int) -> None:
        nonlocal block, links
        for element in stack[upto:]:
            links -= element.name == "a"
            if element.name in BLOCKS:
                block = None
        del stack[upto:]

    size = len(page)
    while at < size:
        mark = _MARKUP.search(page, at)
        if mark is None:
            write(page[at:])
            break
        write(page[at:mark.start()])
        at = mark.end()
        name = mark.group(2)
        if name is None or not mark.group(4):
            continue
        name = name.lower()
        if mark.group(1):
            if name in ("p", "br") and name not in [e.name for e in stack]:
                block = None
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                close(depth)
            continue
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if name in BLOCKS:
            block = None
            paragraph = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name in BLOCKS), 0)
            if paragraph and (stack[paragraph].name == "p" or name in HEADINGS and stack[paragraph].name in HEADINGS):
                close(paragraph)
        ends = _ENDS.get(name)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ends:
                    close(i)
                    break
                if stack[i].name in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select", "div", "section", "article"):
                    break
        if name in VOID:
            continue
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(mark.group(3))) if "=" in mark.group(3) else ""
        element = Element(name, names, stack[-1], elements)
        elements += 1
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            at = end.start() if end else size
        stack.append(element)
        links += name == "a"
    out = []
    for b in found:
        text = "".join(b.parts)
        clean = " ".join(unescape(text).split())
        if clean:
            out.append((clean, min(1.0, b.linked / len(text)), b.element))
            above = b.element
            while above is not None:
                above.characters += len(clean)
                above = above.parent
    return out, elements


def costs(text: str, linked: float, element: Element) -> tuple[int, int]:
    """(cost of calling the block boilerplate, cost of calling it content), from its text and its own tag."""
    words = text.count(" ") + 1
    keep = min(words, 40) * 2 + 20 * (text[-1:] in ".!?:;…") + 40 * (element.name in HEADINGS) + 30 * (element.name == "p")
    drop = 30 + int(120 * linked) + 20 * (words < 4) + 15 * (element.name == "li")
    return keep, drop


class Flow:
    """Maximum flow between two terminals, path by shortest path, with level graphs."""

    def __init__(self, nodes: int):
        self.heads: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def edge(self, a: int, b: int, there: int, back: int) -> None:
        self.heads[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.heads[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.heads)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in self.heads[a]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Nodes that stay with the source in a minimum cut."""
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            turn = [0] * len(self.heads)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    first = next(i for i, e in enumerate(path) if not self.room[e])
                    a = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                while turn[a] < len(self.heads[a]):
                    e = self.heads[a][turn[a]]
                    if self.room[e] and level[self.to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                else:
                    if a == source:
                        break
                    level[a] = -1
                    a = self.to[path.pop() ^ 1]
                    continue
                path.append(e)
                a = self.to[e]


def graph(found: list[tuple[str, float, Element]]) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(nodes, (node, gain of calling it content), (node, node, cost of telling them apart)); the blocks are the first nodes."""
    characters, n = sum(len(text) for text, _, _ in found), len(found)
    nodes: dict[int, int] = {}
    spoken: dict[int, int] = {}
    ties: list[tuple[int, int, int]] = []
    for i, (_, _, element) in enumerate(found):
        if i:
            ties.append((i - 1, i, NEIGHBOURS))
        by, says = element.speaker(characters)
        above, known = element, element.number in nodes
        ties.append((i, nodes.setdefault(element.number, n + len(nodes)), FROM_ELEMENT if says else SAME_PARENT))
        if says:
            spoken[by.number] = spoken.get(by.number, 0) + says * SPOKEN
        # Each element hangs on its parent, firmly below the one that speaks for both.
        inner = bool(says)
        while not known and above.parent is not None:
            inner = inner and above is not by
            known = above.parent.number in nodes
            here, there = nodes[above.number], nodes.setdefault(above.parent.number, n + len(nodes))
            ties.append((here, there, WITHIN if inner else PARENTS))
            above = above.parent
    # What both terminals have alike is cut in any case.
    gains = [(i, keep - drop) for i, (keep, drop) in enumerate(costs(*b) for b in found)]
    return n + len(nodes), gains + [(nodes[number], weight) for number, weight in spoken.items()], ties


def content(found: list[tuple[str, float, Element]]) -> list[bool]:
    """Which of the blocks are main text: of the cheapest cuts the one with least of it."""
    if not found:
        return []
    source, gains, ties = graph(found)
    sink = source + 1
    flow = Flow(sink + 1)
    for node, weight in gains:
        if weight > 0:
            flow.edge(source, node, weight, 0)
        elif weight < 0:
            flow.edge(node, sink, -weight, 0)
    for a, b, weight in ties:
        flow.edge(a, b, weight, weight)
    return flow.source_side(source, sink)[:len(found)]


def main_text(page: str | None) -> str:
    """Blocks of the main text in page order, one to a line."""
    if not page:
        return ""
    found, _ = blocks(page)
    return "\n".join(text for (text, _, _), kept in zip(found, content(found)) if kept)


def extract(df: DataFrame, key: str = "page_id", html: str = "html", others: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, others, text) for every row, from the whole html.

    A null or empty html, and a page without main text, gives an empty text.
    Markup may be broken or cut off anywhere. Character references are
    decoded, white space within a block becomes one space, nothing else of
    the main text is changed. Repeated rows get equal results; an empty table
    gives an empty result; other columns are not touched.
    """
    rows = df.select(F.col(key).alias("_key"), *[F.col(c) for c in others], F.col(html).alias("_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            texts = pa.array([main_text(page) for page in batch.column(last).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], texts], names=[*batch.schema.names[:last], "text"])

    return rows.mapInArrow(run, f"{fields}, text string").withColumnRenamed("_key", key)
