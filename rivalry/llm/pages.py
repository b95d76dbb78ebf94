"""Main text of web pages by minimum-cut labelling.

A page becomes a list of blocks of text. A linear classifier gives each block a score; what it
costs to call the block content or boilerplate are its capacities towards the two terminals. Edges
join blocks that follow each other and blocks that are close in the element tree. The minimum cut
is the cheapest labelling, and the blocks on the source's side are the text.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names and words of HTML practice.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img br "
    "math semantics mrow mi mn mo ms mtext mspace msub msup msubsup munder mover munderover mfrac "
    "msqrt mroot mstyle mpadded mphantom menclose mtable mtr mtd mmultiscripts annotation "
    "annotation-xml".split()
)
UNSEEN = set(
    "script style head title template noscript iframe object svg canvas audio video select "
    "option textarea button datalist dialog annotation annotation-xml".split()
)
RAW = "script style title textarea noscript template iframe svg".split()
#: What a head may hold; anything else ends it, as its end tag may be left out.
HEAD = set("title meta link base script style noscript template".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Regions that hold no article text, whatever they contain.
OUTSIDE = set("nav footer aside".split())
OUTSIDE_ROLES = set("navigation contentinfo complementary banner search dialog alertdialog".split())
CONTENT_ELEMENTS = set("article main".split())
#: Names of boxes that are no part of an article even inside one.
BOX_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie "
    "cookies consent gdpr nav navigation navbar menu breadcrumb breadcrumbs sidebar aside widget "
    "footer newsletter subscribe signup login popup modal overlay pagination pager toolbar masthead "
    "contentinfo".split()
)
#: Names of boxes with what readers wrote.
READER_WORDS = set("comment comments reply replies disqus respond responses".split())
#: Names of boxes that a section of an article may bear as its id, made from its heading.
DOUBTFUL_WORDS = set(
    "notice notices alert discussion share sharing social related recommended recommendations skip "
    "copyright legal disclaimer banner complementary search dialog".split()
)
#: Of a name with such a word the others tell no box, but a state, a layout or a category.
STATE_WORDS = set(
    "has no not is with without js show hide enabled disabled open closed layout category cat tag "
    "type format status topic theme template".split()
)
CONTENT_WORDS = set("article content post entry story main body articlebody text".split())
#: Starting one of these ends an open one of the listed elements, up to the listed border.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    + "".join(rf"|<{name}\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</{name}\s*>|\Z)" for name in RAW)
    + r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
MARKING = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """Text between two block borders, with what the classifier sees."""

    text: str
    path: tuple[int, ...]  # numbers of the open block elements, outermost first
    element: str
    in_link: int  # characters inside links
    inside: tuple[tuple[int, str], ...]  # (number, kind) of open elements that say something
    region: int = 0  # 1 in an article, -1 in a region outside it, else 0
    named: int = 0  # 3 in a box named for what it is, 2 by part of a name, 1 of doubtful name


@dataclass(frozen=True)
class Weights:
    """Coefficients of the score and of the edges; the score is the log odds of content."""

    base: float = -1.0
    word: float = 0.06
    most_words: int = 60
    sentence: float = 0.5
    links: float = -4.0
    article: float = 6.0
    outside: float = -14.0
    likely: float = -5.0
    named: float = -9.0
    paragraph: float = 1.0
    heading: float = 0.5
    item: float = -0.3
    following: float = 0.5
    siblings: float = 0.5
    cousins: float = 0.2


def _names(value: str) -> list[list[str]]:
    """The words of each name of a class or id; none of names that tell a state or a category."""
    names = [[p.lower() for p in PART.findall(name)] for name in value.split()]
    return [words for words in names if words and not STATE_WORDS & set(words)]


def _kind(name: str, attributes: str) -> tuple[str, bool]:
    """(what an element says about its content, '' for nothing, whether it is not shown).

    A class or id names a box by its first or its last word (``ad-slot``, ``page-sidebar``), and for
    certain if that is all of it; an ``article`` or ``main`` is a box by a whole name only.
    """
    unseen, outside = name in UNSEEN, name in OUTSIDE
    classes: list[list[str]] = []
    ids: list[list[str]] = []
    if attributes and name not in ("html", "body"):
        for key, value in MARKING.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                unseen = True
            elif key == "style":
                unseen |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif key == "role" and value.lower() in OUTSIDE_ROLES:
                outside = True
            else:
                (ids if key == "id" else classes).extend(_names(value))
    if outside:
        return "outside", unseen
    if name in HEADINGS:
        # ids of headings are made from their text
        return "", unseen
    both, content = classes + ids, name in CONTENT_ELEMENTS
    ends = {w for words in both if not content or len(words) == 1 for w in (words[0], words[-1])}
    whole = {words[0] for words in both if len(words) == 1}
    if ends & READER_WORDS or content and {words[0] for words in classes} & {"comment", "reply"}:
        return "readers", unseen
    if whole & BOX_WORDS or {words[0] for words in classes if len(words) == 1} & DOUBTFUL_WORDS:
        return "box", unseen
    if ends & BOX_WORDS:
        return "likely", unseen
    if name in ("form", "fieldset", "header"):
        return name, unseen
    if content:
        return "article", unseen
    if {w for words in both for w in words} & CONTENT_WORDS:
        return "good", unseen
    return ("doubtful" if ends & DOUBTFUL_WORDS else ""), unseen


def _place(found: list[Block]) -> None:
    """Set region and name of the blocks, by the elements they are in, outermost first.

    A page without an article outside of all boxes has it in a box that is misnamed: boxes around
    an ``article`` or ``main`` then say nothing, and without those, neither does a box or form that
    holds three fifths of the text that is no link. Boxes of readers' words are no such boxes.
    """
    boxes = ("box", "likely", "form", "fieldset", "doubtful")
    plain, around, size, total = False, set(), {}, 0
    for block in found:
        kinds = [kind for _, kind in block.inside]
        if "outside" in kinds or "readers" in kinds:
            continue
        length = max(0, len(block.text) - 2 * block.in_link)
        total += length
        for number, kind in block.inside:
            if kind in boxes:
                size[number] = size.get(number, 0) + length
        if "article" in kinds:
            before = [x for x in block.inside[: kinds.index("article")] if x[1] in boxes]
            plain |= not before
            around |= {number for number, _ in before}
    misnamed = set()
    if not plain:
        misnamed = around or {number for number, n in size.items() if 5 * n >= 3 * total > 0}
    for block in found:
        region = named = 0
        for number, kind in block.inside:
            if kind == "outside":
                region = -1
                break
            if kind in boxes and number in misnamed:
                continue
            if kind in ("box", "readers", "likely"):
                region, named = min(region, 0), max(named, 2 if kind == "likely" else 3)
            elif kind in ("form", "fieldset") or (kind == "header" and region < 1):
                region = -1
            elif kind == "doubtful":
                # in an article only links speak against it
                named = max(named, 1 if region == 1 else 2)
            elif kind in ("article", "good") and named < 2:
                region = 1
        block.region, block.named = region, named


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order; unclosed elements are tolerated."""
    out: list[Block] = []
    # an open element: name, number, what it and those around it say, whether unseen
    stack: list[tuple[str, int, tuple, bool]] = [("", 0, (), False)]
    parts: list[str] = []
    linked: list[str] = []
    links = number = 0

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                path = tuple(e[1] for e in stack if e[0] not in INLINE)
                inner = next(e for e in reversed(stack) if e[0] not in INLINE)
                in_link = len(" ".join(unescape("".join(linked)).split()))
                out.append(Block(text, path, inner[0], in_link, inner[2]))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        if text and not stack[-1][3]:
            parts.append(text)
            if links:
                linked.append(text)

    def close(depth: int) -> None:
        nonlocal links
        if any(e[0] not in INLINE for e in stack[depth:]):
            flush()
        links -= sum(e[0] == "a" for e in stack[depth:])
        del stack[depth:]

    last = 0
    for token in TOKEN.finditer(html):
        add(html[last : token.start()])
        last = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        if token[1] or token[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        attributes = token[3] if token[2] else token[6]
        if stack[-1][0] == "head" and name not in HEAD:
            close(len(stack) - 1)
        if name == "br":
            add(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            flush()
            ended, border = ENDS.get(name, ((), ()))
            ended = ended or ({"p"} if any(e[0] == "p" for e in stack) else ())
            for depth in range(len(stack) - 1, 0, -1) if ended else ():
                if stack[depth][0] in ended:
                    close(depth)
                    break
                if stack[depth][0] in border:
                    break
        if (attributes or "").rstrip().endswith("/") and name in INLINE:
            continue
        number += 1
        top = stack[-1]
        kind, unseen = _kind(name, attributes or "")
        inside = (*top[2], (number, kind)) if kind else top[2]
        stack.append((name, number, inside, unseen or top[3]))
        links += name == "a"
    add(html[last:])
    flush()
    _place(out)
    return out


def score(block: Block, weights: Weights) -> float:
    """Log odds that the block is content."""
    z = weights.base + weights.word * min(block.text.count(" ") + 1, weights.most_words)
    links = min(1.0, block.in_link / len(block.text))
    z += weights.links * links
    z += (0.0, links * weights.likely, weights.likely, weights.named)[block.named]
    if block.text[-1] in ".!?…。:;\"'”»)":
        z += weights.sentence
    if block.element in ("p", "blockquote", "pre"):
        z += weights.paragraph
    elif block.element[:1] == "h" and block.element[1:].isdigit():
        z += weights.heading
    elif block.element in ("li", "td", "th", "dt", "dd"):
        z += weights.item
    return z + {1: weights.article, 0: 0.0, -1: weights.outside}[block.region]


def edges(found: list[Block], weights: Weights) -> list[tuple[int, int, float]]:
    """Neighbours in page order, and next blocks below the same parent or grandparent."""
    out = []
    last: dict[tuple[int, int], int] = {}
    for i, block in enumerate(found):
        if i:
            out.append((i - 1, i, weights.following))
        for up, weight in ((2, weights.siblings), (3, weights.cousins)):
            if len(block.path) >= up:
                key = (up, block.path[-up])
                if key in last:
                    out.append((last[key], i, weight))
                last[key] = i
    return out


def minimum_cut(to_source: list[float], to_sink: list[float], pairs: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut; of several, the most stay.

    Nodes that no neighbour can turn are settled first; for the rest, shortest augmenting paths.
    """
    n = len(to_source)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in pairs:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    lean = [s - t for s, t in zip(to_source, to_sink, strict=True)]
    label: list[bool | None] = [None] * n
    open_weight = [sum(x.values()) for x in near]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(lean[i]) < open_weight[i]:
            continue
        label[i] = lean[i] >= 0
        for j, w in near[i].items():
            if label[j] is None:
                lean[j] += w if label[i] else -w
                open_weight[j] -= w
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return [bool(x) for x in label]
    source, sink = n, n + 1
    residual: dict[int, dict[int, float]] = {i: {} for i in (*rest, source, sink)}
    for i in rest:
        residual[i].update({j: w for j, w in near[i].items() if label[j] is None})
        if lean[i] > 0:
            residual[source][i], residual[i][source] = lean[i], 0.0
        elif lean[i] < 0:
            residual[i][sink], residual[sink][i] = -lean[i], 0.0
    while True:
        before: dict[int, int] = {source: source}
        queue = deque([source])
        while queue and sink not in before:
            i = queue.popleft()
            for j, w in residual[i].items():
                if w > 1e-9 and j not in before:
                    before[j] = i
                    queue.append(j)
        if sink not in before:
            break
        path, j = [], sink
        while j != source:
            path.append((before[j], j))
            j = before[j]
        flow = min(residual[a][b] for a, b in path)
        for a, b in path:
            residual[a][b] -= flow
            residual[b][a] += flow
    # whatever can still reach the sink is boilerplate
    reached, queue = {sink}, deque([sink])
    while queue:
        j = queue.popleft()
        for i in residual[j]:
            if i not in reached and residual[i][j] > 1e-9:
                reached.add(i)
                queue.append(i)
    for i in rest:
        label[i] = i not in reached
    return [bool(x) for x in label]


def _cost(z: float) -> float:
    """-log of the probability of a label whose log odds are -z."""
    return z + log1p(exp(-z)) if z > 0 else log1p(exp(z))


def main_text(html: str | None, weights: Weights = Weights()) -> str:
    """The content blocks of a page, joined by line breaks; '' for null and for none."""
    found = blocks(html or "")
    if not found:
        return ""
    scores = [score(b, weights) for b in found]
    kept = minimum_cut([_cost(z) for z in scores], [_cost(-z) for z in scores], edges(found, weights))
    return "\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """page_id, url, text for each row of ``pages`` (page_id, url, html).

    Each page is a row of its own, so nothing is shuffled. White space inside a block, ``<br>``
    too, becomes one space; character references are decoded; blocks are joined by a line break.
    A null html, an empty one and one without content give ''. Null ids and urls stay, repeated
    rows each get their result, other columns are left out, an empty table gives an empty result.
    """
    schema = pages.select("page_id", "url").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, weights) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
