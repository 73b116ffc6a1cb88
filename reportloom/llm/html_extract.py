"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches, settle

# From so many different pages on, and in more than this share of them, equal text at
# one place of a host's pages is template.
LEAST_PAGES = 3
CONSTANT_SHARE = 0.5
# Wrappers that a task holds at a time.
KNOWN = 256

# Elements by their part in a page.
SILENT = frozenset(
    "script style noscript template iframe object svg canvas math head title select option datalist textarea "
    "button audio video map dialog".split()
)
FURNITURE = frozenset("nav footer aside form menu".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a new paragraph or list item does not reach across to close an open one.
BORDERS = frozenset("table td th blockquote div section article main aside body".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related replies reply respond share sharing sidebar sidenav signup social sponsor "
    "sponsored subscribe toolbar widget".split()
)
# Parts that stay furniture whatever they hold.
FIRM_WORDS = frozenset("comment comments disqus related replies reply".split())
FIRM_NAMES = frozenset("sidebar promo promoted ad ads widget".split())
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th a span figure".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|\Z)",
    re.DOTALL,
)
# Each attribute with its value, so that no word in a value passes for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """An element: tag, sign (tag and class), whether its text is left out, whether that
    holds whatever it contains, and its children and texts in order."""

    tag: str
    sign: str = ""
    dropped: bool = False
    firm: bool = False
    freed: bool = False
    parts: list = field(default_factory=list)

    def elements(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def _described(tag: str, attributes: str, in_content: bool) -> Node:
    firm = tag in SILENT or tag in ("nav", "footer", "aside")
    node = Node(tag, tag, firm or tag in FURNITURE or (tag == "header" and not in_content), firm)
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).strip().lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            node.dropped = node.firm = True
        elif name == "role":
            node.dropped = node.dropped or value in FURNITURE_ROLES
        elif name == "id" and tag not in ("html", "body", "main") and not in_content:
            # Headings and paragraphs have ids to link to, after their words.
            wide = value in FURNITURE_WORDS and tag not in ANCHORS
            node.dropped = node.dropped or (wide and tag != "article")
            node.firm = node.firm or (wide and value in FIRM_WORDS | FIRM_NAMES)
        elif name == "class" and tag not in ("html", "body", "main"):
            names = set(value.split())
            # In content a class counts as a whole only; what is template there, its text tells.
            words = names - {"header"} if in_content else set(_NAME.findall(value))
            firm = bool(words & FIRM_WORDS or FIRM_NAMES & names)
            node.dropped = node.dropped or firm or bool(words & FURNITURE_WORDS and tag != "article")
            node.firm = node.firm or firm
        if name == "class":
            node.sign = f"{tag}.{value}"
    return node


def parse(page: str | None) -> Node:
    """A tree of elements; unclosed and misplaced tags are mended as browsers roughly do.

    Comments, declarations, scripts and the like leave nothing. A ``<`` that opens no
    tag is text; a tag that the page's end cuts off is dropped. A part that is only
    named like furniture but holds an article is none.
    """
    stack = [Node("#page")]
    root, source = stack[0], page or ""
    # How many of each tag are open: a deep stack is searched only for what is there.
    opened: Counter = Counter()
    at = content = firm = 0

    def leave(depth: int) -> None:
        nonlocal content, firm
        for n in stack[depth:]:
            opened[n.tag] -= 1
            content -= n.tag in CONTENT
            firm -= n.firm
        del stack[depth:]

    while True:
        token = _TOKEN.search(source, at)
        text = source[at : token.start() if token else len(source)]
        if text:
            stack[-1].parts.append(text)
        if not token:
            return root
        at = token.end()
        closing, tag, attributes = token.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0) if opened[tag] else 0
            # An inline end tag closes no block, ``</p>`` nothing beyond its border.
            inner = BORDERS if tag in ("p", "li") else BLOCK if tag not in BLOCK else ()
            if depth and not any(n.tag in inner for n in stack[depth + 1 :]):
                leave(depth)
            continue
        if tag in BLOCK and opened["p"]:
            leave(_closing(stack, "p", BORDERS))
        if tag == "li" and opened["li"]:
            leave(_closing(stack, "li", BORDERS | {"ul", "ol", "menu"}))
        node = _described(tag, attributes, content > 0)
        stack[-1].parts.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
            firm += node.firm
            if tag in CONTENT:
                content += 1
                if not firm:
                    # From the last one that was freed so, all above are free.
                    for n in reversed(stack):
                        if n.freed:
                            break
                        n.dropped, n.freed = False, True


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE)


def _closing(stack: list[Node], tag: str, borders: frozenset[str]) -> int:
    """The depth of an open ``tag`` that a new block ends; that of the stack where a border
    lies between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            return i
        if stack[i].tag in borders:
            break
    return len(stack)


def _placed(node: Node) -> list[list[Node]]:
    """The children of a node as tree matching sees them: neighbours of one sign are one
    repeating slot; articles and furniture have none, so a long page's tree stays small."""
    slots: list[list[Node]] = []
    if node.tag in CONTENT or node.dropped:
        return slots
    for child in node.elements():
        if child.tag in SILENT or child.tag in VOID:
            continue
        if slots and slots[-1][0].sign == child.sign:
            slots[-1].append(child)
        else:
            slots.append([child])
    return slots


def _raw_text(nodes: list[Node]) -> str:
    out, todo = [], list(reversed(nodes))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag not in SILENT:
            todo.extend(reversed(part.parts))
    return "".join(out)


@dataclass(slots=True)
class Slot:
    """An element, or neighbours of one sign, for matching: the sign, a hash of its text, the
    slots below, its elements, and of its tree a hash of the signs and the size."""

    sign: str
    text: int = 0
    below: list[Slot] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    shape: int = 0
    size: int = 1

    def shaped(self) -> Slot:
        parts = "\n".join([self.sign, *(f"{b.shape:x}" for b in self.below)])
        self.shape = xxhash.xxh3_64_intdigest(parts)
        self.size = 1 + sum(b.size for b in self.below)
        return self


def skeleton(nodes: list[Node]) -> Slot:
    """The slots of a tree, made from its leaves up."""

    def start(nodes: list[Node]) -> tuple[list[Node], list[list[Node]], list[Slot]]:
        return nodes, _placed(nodes[0]) if len(nodes) == 1 else [], []

    opened = [start(nodes)]
    while True:
        nodes, slots, below = opened[-1]
        if len(below) < len(slots):
            opened.append(start(slots[len(below)]))
            continue
        opened.pop()
        own = "".join(p for p in nodes[0].parts if isinstance(p, str)) if below else _raw_text(nodes)
        text = xxhash.xxh64_intdigest(" ".join([*own.split(), *(f"{b.text:x}" for b in below)]))
        slot = Slot(nodes[0].sign, text, below, nodes).shaped()
        if not opened:
            return slot
        opened[-1][2].append(slot)


# Cells of the table that is kept whole for the way back; larger ones are halved.
_CELLS = 1 << 18

Paired = dict[tuple[int, int], int]


def _trimmed(first: list[Slot], second: list[Slot]) -> tuple[int, int]:
    """How many slots at both ends have one shape; to pair these up is never worse."""
    head, most = 0, min(len(first), len(second))
    while head < most and first[head].shape == second[head].shape:
        head += 1
    tail = 0
    while tail < most - head and first[-1 - tail].shape == second[-1 - tail].shape:
        tail += 1
    return head, tail


def _middles(a: Slot, b: Slot) -> tuple[list[Slot], list[Slot], int]:
    head, tail = _trimmed(a.below, b.below)
    return a.below[head : len(a.below) - tail], b.below[head : len(b.below) - tail], head


def _known(x: Slot, y: Slot, counts: Paired) -> int | None:
    """The nodes of ``x`` and ``y`` that pair up, None if they have not been counted."""
    if x.sign != y.sign:
        return 0
    if x.shape == y.shape:
        return x.size
    if not x.below or not y.below:
        return 1
    return counts.get((x.shape, y.shape))


class _Weights:
    """Rows of the table of pair counts between two lists of slots, by shape."""

    def __init__(self, second: list[Slot], counts: Paired) -> None:
        self.kinds = list({y.shape: y for y in second}.values())
        number = {y.shape: k for k, y in enumerate(self.kinds)}
        self.columns = np.fromiter((number[y.shape] for y in second), np.int64, len(second))
        self.counts = counts

    def row(self, x: Slot) -> np.ndarray:
        return np.array([_known(x, y, self.counts) for y in self.kinds], np.int32)[self.columns]


def _last_row(first: list[Slot], second: list[Slot], counts: Paired) -> np.ndarray:
    """The most nodes that pair up between ``first`` and each start of ``second``, in order."""
    weights = _Weights(second, counts)
    rows: dict[int, np.ndarray] = {}
    best = np.zeros(len(second) + 1, np.int32)
    for x in first:
        if x.shape not in rows:
            if len(rows) * len(second) > _CELLS:
                rows.clear()
            rows[x.shape] = weights.row(x)
        best[1:] = np.maximum(best[1:], best[:-1] + rows[x.shape])
        np.maximum.accumulate(best, out=best)
    return best


def _count(a: Slot, b: Slot, counts: Paired) -> int:
    """Simple tree matching: the largest number of nodes of ``a`` and ``b`` that pair up in
    order, roots with roots. Pairs of shapes are counted once, the inner ones first."""
    todo = [(a, b)]
    while todo:
        x, y = todo[-1]
        if _known(x, y, counts) is not None:
            todo.pop()
            continue
        first, second, _ = _middles(x, y)
        kinds, others = ({s.shape: s for s in side}.values() for side in (first, second))
        needed = [(u, v) for u in kinds for v in others if _known(u, v, counts) is None]
        if needed:
            todo.extend(needed)
            continue
        todo.pop()
        head, tail = _trimmed(x.below, y.below)
        same = sum(s.size for s in x.below[:head]) + sum(s.size for s in x.below[len(x.below) - tail :])
        counts[x.shape, y.shape] = 1 + same + int(_last_row(first, second, counts)[-1])
    found = _known(a, b, counts)
    assert found is not None
    return found


def _aligned(first: list[Slot], second: list[Slot], counts: Paired) -> list[tuple[int, int]]:
    """The pairs of one best way to pair up two lists in order. A large table is never
    held: the first list is halved, and two last rows say where the second one parts."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(first), 0, len(second))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a > 1 and (b - a) * (d - c) > _CELLS:
            half = (a + b) // 2
            left = _last_row(first[a:half], second[c:d], counts)
            right = _last_row(first[half:b][::-1], second[c:d][::-1], counts)
            part = c + int(np.argmax(left + right[::-1]))
            todo += [(a, half, c, part), (half, b, part, d)]
            continue
        weights = _Weights(second[c:d], counts)
        rows = [weights.row(x) for x in first[a:b]]
        table = np.zeros((b - a + 1, d - c + 1), np.int32)
        for i, row in enumerate(rows):
            np.maximum(table[i, 1:], table[i, :-1] + row, out=table[i + 1, 1:])
            np.maximum.accumulate(table[i + 1], out=table[i + 1])
        i, j = b - a, d - c
        while i and j:
            if rows[i - 1][j - 1] and table[i, j] == table[i - 1, j - 1] + rows[i - 1][j - 1]:
                i, j = i - 1, j - 1
                out.append((a + i, c + j))
            elif table[i, j] == table[i - 1, j]:
                i -= 1
            else:
                j -= 1
    return out


def match(a: Slot, b: Slot, counts: Paired | None = None) -> int:
    """The largest number of nodes of two trees that pair up in order, roots with roots."""
    return _count(a, b, {} if counts is None else counts)


def pairs(a: Slot, b: Slot, counts: Paired) -> dict[int, int]:
    """For the slots below ``b`` that pair up with one below ``a`` the place of that one."""
    if a.sign != b.sign:
        return {}
    if a.shape == b.shape:
        return {j: j for j in range(len(b.below))}
    _count(a, b, counts)
    head, tail = _trimmed(a.below, b.below)
    first, second, _ = _middles(a, b)
    found = {j: j for j in range(head)}
    found |= {head + j: head + i for i, j in _aligned(first, second, counts)}
    return found | {len(b.below) - k: len(a.below) - k for k in range(1, tail + 1)}


def addressed(reference: Slot, page: Slot) -> list[tuple[str, str, Slot]]:
    """(place, place among pages of one layout, slot) of all slots of the page.

    The place of a slot that pairs up is that in the reference. Below it, slots that
    the reference lacks have places by their signs, so pages of another layout share
    them too. The second place also holds what slots lie beside it. A place is a hash
    of the one above it and its own step.
    """
    out = []
    counts: Paired = {}
    todo: list[tuple[str, Slot | None, Slot]] = [("", reference, page)]
    while todo:
        at, a, b = todo.pop()
        paired = pairs(a, b, counts) if a is not None else {}
        beside = xxhash.xxh64_hexdigest("\n".join([slot.sign for slot in b.below]))
        unpaired: Counter = Counter()
        for j, slot in enumerate(b.below):
            if j in paired:
                step, other = str(paired[j]), a.below[paired[j]]
            else:
                step, other = f"+{xxhash.xxh64_hexdigest(slot.sign)}.{unpaired[slot.sign]}", None
                unpaired[slot.sign] += 1
            place = xxhash.xxh3_128_hexdigest(f"{at}/{step}")
            todo.append((place, other, slot))
            out.append((place, f"{place}@{beside}", slot))
    return out


def _key(place: str, layout: bool) -> int:
    """A place as a number, odd for one among pages of one layout or in articles."""
    return ((xxhash.xxh64_intdigest(place) >> 1 << 1) | layout) - (1 << 63)


def inside(node: Node, at: str) -> list[tuple[str, list[Node]]]:
    """(place, elements) of the slots of blocks in an article; neighbours of one sign are
    one slot here too. A place is the signs above it: text of an article moves, so it is
    not matched in order, which would take the square of a long article. A heading that
    many articles have, as ``Summary``, is text of theirs and has no place."""
    out, todo = [], [(node, at)]
    while todo:
        part, place = todo.pop()
        slots: list[list[Node]] = []
        for child in part.elements():
            if child.tag not in BLOCK or child.tag in VOID or child.dropped:
                continue
            if slots and slots[-1][0].sign == child.sign:
                slots[-1].append(child)
            else:
                slots.append([child])
        if part is not node and not slots:
            out.append((place, [part]))
        for slot in slots:
            below = xxhash.xxh3_128_hexdigest(f"{place}>{slot[0].sign}")
            if slot[0].tag in HEADINGS:
                continue
            if len(slot) == 1:
                todo.append((slot[0], below))
            else:
                out.append((below, slot))
    return out


def marks(reference: Slot, page: Slot) -> Iterator[tuple[int, int, list[Node]]]:
    """(place, hash of the text there, its elements) of all that may be template; first,
    with place and text 0, the page, which tells that there were enough to compare."""
    yield 0, 0, []
    for place, among, slot in addressed(reference, page):
        if slot.nodes[0].dropped:
            continue
        if slot.nodes[0].tag not in CONTENT:
            yield _key(place, False), slot.text - (1 << 63), slot.nodes
            yield _key(among, True), slot.text - (1 << 63), slot.nodes
    # One place for all articles, wherever they are.
    for article in articles(page.nodes[0]):
        for place, nodes in inside(article, article.tag):
            text = " ".join(_raw_text(nodes).split())
            if text:
                yield _key(place, True), xxhash.xxh64_intdigest(text) - (1 << 63), nodes


def articles(root: Node) -> list[Node]:
    """Outermost elements of content that are not left out, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        if node.tag in CONTENT:
            out.append(node)
        else:
            todo.extend(reversed(node.elements()))
    return out


def blocks(node: Node, beside: Callable[[str], bool] | None = None) -> list[str]:
    """Texts of the blocks in order, references decoded, white space turned to blanks. A
    text beside the articles has to be one that ``beside`` takes."""
    out: list[str] = []
    line: list[str] = []
    depth = 0

    def end() -> None:
        # ``split`` knows the no-break space too.
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text and (depth or beside is None or beside(text)):
            out.append(text)

    # An element whose end is to come stands alone in a tuple.
    todo: list = [node]
    while todo:
        part = todo.pop()
        if isinstance(part, tuple):
            end()
            depth -= part[0].tag in CONTENT
        elif isinstance(part, str):
            line.append(part)
        elif part.tag == "br":
            line.append(" ")
        elif part.dropped or part.tag in SILENT:
            if part.tag not in SILENT:
                end()
        elif part.tag in BLOCK:
            end()
            depth += part.tag in CONTENT
            todo.append((part,))
            todo.extend(reversed(part.parts))
        else:
            todo.extend(reversed(part.parts))
    end()
    return out


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def main_text(page: str | None, reference: Slot | None, constant: frozenset[tuple[int, int]]) -> str:
    """The text of a page without furniture and template: blocks in page order, joined
    by blank lines.

    ``constant`` has the place and hash of each text that is template. All else, at
    places of the reference or not, is content. Where pages were compared, what varies
    beside an article, such as its headline or lead, stays with it, but for blocks
    without a letter (a counter, the number of a page); where they were not, articles
    go before the rest. An article is content also where most pages have the same; a
    page that is template altogether is its own.
    """
    root = parse(page)
    own = articles(root)
    marked = []
    for place, text, nodes in marks(reference, skeleton([root])) if reference and constant else ():
        if (place, text) in constant:
            marked.extend(nodes)
    if not own:
        for node in marked:
            node.dropped = True
        found = blocks(root)
        if not found:
            for node in marked:
                node.dropped = False
            found = blocks(root)
        return "\n\n".join(found)
    for node in marked:
        node.dropped = True
    article = [text for node in own for text in blocks(node)]
    if article and constant:
        article = blocks(root, beside=_has_letter)
    elif not article:
        # All of it is template: then it is not what the template is for.
        for node in marked:
            node.dropped = False
        article = [text for node in own for text in blocks(node)] or blocks(root)
    return "\n\n".join(article)


def packed(slot: Slot) -> list:
    """The signs of a tree with the numbers of slots below, as alignment needs them of a
    reference page, in the order of a walk from the root; no texts, and no nesting."""
    out, todo = [], [slot]
    while todo:
        at = todo.pop()
        out.append([at.sign, len(at.below)])
        todo.extend(reversed(at.below))
    return out


def unpacked(parts: list) -> Slot:
    done: list[Slot] = []
    for sign, count in reversed(parts):
        below = [done.pop() for _ in range(count)]
        done.append(Slot(sign, below=below).shaped())
    return done[0]


def host_of(url):
    """The host of a URL, in lower case; an empty text if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: ``host``, ``reference`` (the skeleton of the page that all others
    are aligned with, the one of the smallest hash) and ``constant`` (its places that
    hold one text on most pages). All pages take part; pages of one content count once. Hosts of fewer than
    ``LEAST_PAGES`` pages have constant places only by chance and get none.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    rows = rows.where("html is not null").withColumn("h", F.xxhash64("html"))
    first = rows.groupBy("host").agg(F.min("h").alias("h"))
    chosen = rows.join(settle(first, "hosts"), ["host", "h"]).groupBy("host").agg(F.min("html").alias("reference"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [json.dumps(packed(skeleton([parse(page.as_py())]))) for page in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees, pa.string())], ["host", "reference"])

    chosen = settle(chosen.transform(map_batches, pack, "host string, reference string"), "host-references")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for host, page, h, reference in zip(*batch.columns, strict=True):
                host = host.as_py()
                if host not in known:
                    known.clear() if len(known) >= KNOWN else None
                    known[host] = unpacked(json.loads(reference.as_py()))
                found = {(at, text) for at, text, _ in marks(known[host], skeleton([parse(page.as_py())]))}
                # Each place once more without a text, to count the pages that have it.
                for at, text in found | {(at, None) for at, _ in found}:
                    for column, value in zip(out, (host, at, text, h.as_py()), strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["host", "place", "text", "h"]
            )

    placed = rows.join(chosen, "host").select("host", "html", "h", "reference")
    placed = placed.transform(map_batches, run, "host string, place long, text long, h long").distinct()
    each = placed.groupBy("host", "place", "text").agg(F.count(F.lit(1)).alias("n"))
    # A text of one page is no template.
    each = settle(each.where("text is null or n > 1"), "host-texts")
    pages_with = each.where("text is null").select("host", "place", F.col("n").alias("all"))
    best = each.where("text is not null").join(pages_with, ["host", "place"])
    constant = best.where((F.col("all") >= LEAST_PAGES) & (F.col("n") > CONSTANT_SHARE * F.col("all")))
    # Two of three pages of a layout, or two of three articles, may be alike by chance.
    constant = constant.where((F.col("place") % 2 == 0) | (F.col("n") >= LEAST_PAGES))
    constant = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("constant"))
    return chosen.join(constant, "host", "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``page``, ``url``, ``text`` and ``n_chars``, one row per row of ``pages``.

    Null and empty pages have an empty text; a page of any length and any depth of
    elements is parsed whole, without recursion; alignment holds no more than some
    hundred thousand cells of a table, however many blocks lie side by side;
    pages whose URL names no host share one wrapper; repeated rows stay; an empty table
    gives no rows; other columns are not looked at.
    """
    known = settle(wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"),
    ).join(known, "host", "left").select("page", "url", "html", "host", "reference", "constant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for page, host, reference, constant in zip(*[batch.column(i) for i in (2, 3, 4, 5)], strict=True):
                host = host.as_py()
                if host not in wrapper:
                    wrapper.clear() if len(wrapper) >= KNOWN else None
                    tree = unpacked(json.loads(reference.as_py())) if reference.is_valid else None
                    wrapper[host] = tree, frozenset((c["place"], c["text"]) for c in constant.as_py() or ())
                texts.append(main_text(page.as_py(), *wrapper[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page", "url", "text", "n_chars"],
            )

    return rows.transform(map_batches, run, "page long, url string, text string, n_chars long")
