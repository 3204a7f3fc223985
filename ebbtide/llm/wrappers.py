"""HTML extraction by wrapper induction.

Pages of one host are made by one program.  Their DOM trees are aligned with a reference
tree of the host by simple tree matching (the largest set of matched nodes that keeps
parents, order and labels); runs of alike siblings (paragraphs, list items) are folded into
one repeated node first, so trees are small and pages of any length align with each other.
A text that one node of the reference holds on most of the host's distinct pages is template,
if these pages differ in the rest of their text; on pages where that node holds another text it
varies.  A page's main text are the blocks in varying slots of its content region, without
the parts that markup itself names as menus, headers, footers, sidebars, notices, adverts,
forms or comments.

The region is the smallest subtree of the host's reference that holds ``REGION_SHARE`` of the
varying text outside such parts and does not leave out the heading; article and main elements
are not looked into.  Nodes most of whose text are links, over all of a host's pages, are menus
whatever their names, and count for nothing there.  With ``names=False`` the names of classes,
ids and elements are not asked at all, and alignment alone decides.  Where a host has none, or a page has less of its text there, the page's
own text chooses among its article elements, its main element and the whole page.

Names drop less inside an article or region than outside, as ids and classes there are often
the article's own words (``_says_otherwise``).

What travels between pages is small: per host the most frequent folded tree, and per distinct
page the hashes of its nodes' texts with their min-hash sketches, keyed by page or text, so a
host with a third of all pages is no hot spot.  The outcome is one table with a row per host,
which is broadcast only after its size has been checked and joined by host beyond that.  Pages
stay where they are; each is parsed again in every pass.

Copies of a page count once.  Near copies teach nothing either: of the pages that hold a text,
``MIN_PAGES`` and a part of ``MIN_DIFFERENT`` must have sketches of their own over the texts that
are not shared (the median of the coordinates; HyperLogLog counts).  Pages without host, or of
hosts that teach nothing, are read by their markup alone.

Edge cases: null or empty html gives the empty text; broken markup is read as browsers would
roughly do (paragraphs and list items close themselves, unknown end tags are ignored, what is
open at the end is closed); a null URL is a host of its own without template; repeated rows
are read each; an empty table stays empty; other columns, whatever their names, pass through
``with_main_text``.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import table, written

MIN_PAGES = 3
#: A text is template on more than this part of a host's distinct pages ...
MIN_SHARE = 0.5
#: ... of which at least this part differ elsewhere.
MIN_DIFFERENT = 1 / 3
#: A subtree with this part of a host's varying text may be its content region, for pages with this part there.
REGION_SHARE = 0.9
#: Article or main elements with this part of a page's text may be its content region.
PAGE_SHARE = 0.5
#: Coordinates of a sketch of 3-word shingles.
SKETCH = 5
#: Nodes with more than this part of their text in links are menus.
LINK_SHARE = 0.5
MAX_BROADCAST_BYTES = 16 << 20
#: Above this many pairs of children the rows of simple tree matching are arrays, kept in part.
MAX_CELLS = 4096
#: What is nested deeper becomes a list of siblings, at the depth where browsers do the same.
MAX_DEPTH = 512
sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * MAX_DEPTH))

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
#: Elements whose text runs on with what is around it; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that a new element of the given name closes, as the standard says.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SCOPE = frozenset("html body table td th ul ol dl article section div main aside nav form button".split())

DROPPED = frozenset("head script style noscript template iframe object svg canvas nav aside footer form button select textarea input dialog menu audio video map".split())
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsors?|sponsored|promos?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?|newsletters?|subscribe|subscriptions?"
    r"|sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|pagination|pager|headers?|masthead|topbar|footers?|bottombar|comments?|replies|disqus|respond|share|sharing|social|related|recommended|toolbar|search|login|signup|forms?|widgets?|skip|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Within an article these names are its own headings, asides and figures of speech.
OWN = re.compile(r"(?:^|[\s_-])(?:headers?|masthead|side|search|forms?|alerts?|notices?|hidden)(?:$|[\s_-])", re.IGNORECASE)
#: So do blocks of these names that hold a heading.
OWN_HEADER = re.compile(r"(?:^|[\s_-])(?:headers?|masthead)(?=$|[\s_-])", re.IGNORECASE)
#: Words of classes that leave no doubt, whatever other words stand beside them.
CERTAIN = re.compile(r"ads?|adverts?|advertisements?|advertising|sponsored|cookies?|gdpr|newsletters?|sidebars?|navbar|breadcrumbs?|pagination|comments?|disqus", re.IGNORECASE)
#: Words of layout, which do not tell what a part holds.
LAYOUT = frozenset("area bar block bottom box button buttons col column container content count fixed float floating group heading icon icons inline inner item items large left link links list main mobile outer page panel post posts reading right row section site slot small stories sticky strip thread title top unit wrap wrapper zone".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3"))
#: Blocks that hold other blocks, so that one of them can be a content region.
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/][^>]*$|[^<]+|<", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # Nodes and strings


def parse(page: str) -> Node:
    """The DOM tree of a page."""
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()
    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                stack[min(len(stack), MAX_DEPTH) - 1].children.append(html.unescape(text))
            continue
        name = name.lower()
        if m[1]:
            if not opened[name]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    _close(stack, i, opened)
                    break
                if name in INLINE and stack[i].tag not in INLINE:
                    break  # a stray end tag of an inline element closes no block
            continue
        _make_room(stack, name, opened)
        raw = m[3]
        attributes = {a.lower(): html.unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}
        node = Node(name, attributes)
        # what is nested deeper becomes a list of siblings, but its end tags still find it
        stack[min(len(stack), MAX_DEPTH) - 1].children.append(node)
        if name in VOID or raw.endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        stack.append(node)
        opened[name] += 1
    return root


def _close(stack: list[Node], at: int, opened: Counter[str]) -> None:
    for node in stack[at:]:
        opened[node.tag] -= 1
    del stack[at:]


def _make_room(stack: list[Node], name: str, opened: Counter[str]) -> None:
    """Close what an element of this name closes: a paragraph, or its own kind."""
    if name in CLOSES_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                _close(stack, i, opened)
                break
            if stack[i].tag not in INLINE:
                break
    if name in CLOSES:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in CLOSES[name]:
                _close(stack, i, opened)
                continue
            if stack[i].tag in SCOPE:
                break


@dataclass(slots=True)
class Fold:
    """A node of a folded tree: its label, whether it stands for a run of siblings, the nodes of
    the page that it stands for, and its own number in the reference (-1: not matched)."""

    label: str
    children: list = field(default_factory=list)
    nodes: list = field(default_factory=list)
    many: bool = False
    number: int = -1


def label_of(node: Node) -> str:
    kind = node.attributes.get("class", "").split()
    return node.tag + "".join("." + re.sub(r"[()]", "", k) for k in sorted(kind)) if kind else node.tag


def fold(nodes: list[Node]) -> list[Fold]:
    """Runs of siblings of one label as one node, with their children folded together."""
    out: list[Fold] = []
    for node in nodes:
        name = label_of(node)
        if out and out[-1].label == name:
            out[-1].nodes.append(node)
            out[-1].many = True
        else:
            out.append(Fold(name, nodes=[node]))
    for f in out:
        f.children = fold(_elements(f.nodes))
    return out


def _elements(nodes: list[Node]) -> list[Node]:
    """The children that are elements of blocks; inline elements are part of their text."""
    return [c for n in nodes if n.tag not in RAW for c in n.children if isinstance(c, Node) and c.tag not in INLINE]


def outline(folds: list[Fold]) -> str:
    """A folded tree as text, the same for alike pages; runs and single nodes count alike."""
    return "".join(f"({f.label}{outline(f.children)})" for f in folds)


def from_outline(text: str) -> list[Fold]:
    """The folded tree of an outline, numbered in page order."""
    root = Fold("")
    stack, number = [root], 0
    for m in re.finditer(r"\(([^()]*)|\)", text):
        if m[0] == ")":
            stack.pop()
        else:
            f = Fold(m[1], number=number)
            number += 1
            stack[-1].children.append(f)
            stack.append(f)
    return root.children


def match(page: list[Fold], reference: list[Fold]) -> int:
    """Simple tree matching of two lists of siblings; sets the numbers of the page's nodes.

    The most nodes that can be paired so that labels are equal, parents are paired and order
    is kept."""
    if not page or not reference:
        return 0
    if len(page) * len(reference) > MAX_CELLS:
        return _match_long(page, reference)
    gain = [[1 + _count(f.children, r.children) if f.label == r.label else 0 for r in reference] for f in page]
    best = [[0] * (len(reference) + 1) for _ in range(len(page) + 1)]
    for i in range(len(page) - 1, -1, -1):
        for j in range(len(reference) - 1, -1, -1):
            take = gain[i][j] + best[i + 1][j + 1] if gain[i][j] else 0
            best[i][j] = max(take, best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(page) and j < len(reference):
        if gain[i][j] and best[i][j] == gain[i][j] + best[i + 1][j + 1]:
            page[i].number = reference[j].number
            match(page[i].children, reference[j].children)
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return best[0][0]


def _count(page: list[Fold], reference: list[Fold]) -> int:
    """The size of the match of two lists of siblings, without setting numbers."""
    if not page or not reference:
        return 0
    if len(page) == len(reference) == 1:
        return 1 + _count(page[0].children, reference[0].children) if page[0].label == reference[0].label else 0
    if len(page) * len(reference) > MAX_CELLS:
        gains = _gains(page, reference)
        row = np.zeros(len(reference) + 1, np.int64)
        for gain in reversed(gains):
            row = _row(gain, row)
        return int(row[0])
    below = [0] * (len(reference) + 1)
    for f in reversed(page):
        row = [0] * (len(reference) + 1)
        for j in range(len(reference) - 1, -1, -1):
            r = reference[j]
            take = 1 + _count(f.children, r.children) + below[j + 1] if f.label == r.label else 0
            row[j] = max(take, below[j], row[j + 1])
        below = row
    return below[0]


def _gains(page: list[Fold], reference: list[Fold]) -> list[np.ndarray]:
    """By node of the page, the size of its match with each node of the reference; alike nodes share one array."""
    kinds: dict[str, list[int]] = {}
    for j, r in enumerate(reference):
        kinds.setdefault(outline([r]), []).append(j)
    known: dict[str, np.ndarray] = {}
    out = []
    for f in page:
        key = outline([f])
        if key not in known:
            known[key] = np.zeros(len(reference), np.int64)
            for at in kinds.values():
                r = reference[at[0]]
                if r.label == f.label:
                    known[key][at] = 1 + _count(f.children, r.children)
        out.append(known[key])
    return out


def _row(gain: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The sizes of the matches of a page's node and those after it, from those without it."""
    row = below.copy()
    np.maximum(row[:-1], np.where(gain > 0, gain + below[1:], 0), out=row[:-1])
    return np.maximum.accumulate(row[::-1])[::-1]


def _match_long(page: list[Fold], reference: list[Fold]) -> int:
    """``match`` with every so many rows kept; the rows between are made again on the way back."""
    gains = _gains(page, reference)
    n, m = len(page), len(reference)
    step = max(1, int(n**0.5))
    row = np.zeros(m + 1, np.int64)
    kept = {n: row}
    for i in range(n - 1, -1, -1):
        row = _row(gains[i], row)
        if i % step == 0:
            kept[i] = row
    i = j = 0
    rows: dict[int, np.ndarray] = {}
    while i < n and j < m:
        if i + 1 not in rows or i not in rows:
            end = min(n, i - i % step + step)
            rows = {end: kept[end]}
            for k in range(end - 1, i - 1, -1):
                rows[k] = _row(gains[k], rows[k + 1])
        if gains[i][j] and rows[i][j] == gains[i][j] + rows[i + 1][j + 1]:
            page[i].number = reference[j].number
            match(page[i].children, reference[j].children)
            i, j = i + 1, j + 1
        elif rows[i][j] == rows[i + 1][j]:
            i += 1
        else:
            j += 1
    return int(kept[0][0])


def _own_text(node: Node) -> str:
    """A node's text outside its block children."""
    parts = []
    for c in node.children:
        if isinstance(c, str):
            parts.append(c)
        elif c.tag in INLINE:
            parts.append(" " if c.tag == "br" else _own_text(c))
    return "".join(parts)


def _slot_text(f: Fold) -> str:
    return "\x00".join(t for n in f.nodes if n.tag not in RAW and (t := _SPACE.sub(" ", _own_text(n)).strip()))


def _link_chars(f: Fold) -> int:
    """The characters of a node's own text that lie in links."""
    count = lambda n, inside: sum(len(c.strip()) if inside else 0 if isinstance(c, str) else 0 for c in n.children if isinstance(c, str)) + sum(count(c, inside or c.tag == "a") for c in n.children if isinstance(c, Node) and c.tag in INLINE)
    return sum(count(n, False) for n in f.nodes if n.tag not in RAW)


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, (2, SKETCH, 1), dtype=np.uint64) | np.uint64(1)


def sketch_of(text: str) -> np.ndarray:
    """The smallest hash of the 3-word shingles of a text, by coordinate."""
    words = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in text.replace("\x00", " ").split()], np.uint64)
    words = np.pad(words, (0, max(0, 3 - len(words))))
    shingles = (words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + words[2:]
    shingles ^= shingles >> np.uint64(29)
    return (((shingles ^ _SEEDS[0]) * _SEEDS[1]) >> np.uint64(33)).min(axis=1)


def slots(folds: list[Fold]) -> Iterator[tuple[int, str, int]]:
    """(number in the reference, own text, characters in links) of matched nodes that have text."""
    for f in folds:
        if f.number >= 0 and (t := _slot_text(f)):
            yield f.number, t, _link_chars(f)
        yield from slots(f.children)


def _unnamed(node: Node, inside: bool) -> bool:
    """For ``names=False``: only what no page shows is left out."""
    return node.tag in ("head", "script", "style", "noscript", "template")


def _named_otherwise(node: Node, inside: bool) -> bool:
    """Whether markup itself says that this is not main text."""
    if node.tag in DROPPED or node.tag == "header" and not inside:
        return True
    a = node.attributes
    if not a:
        return False
    if a.get("role", "").lower() in NOT_MAIN_ROLES or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    return node.tag not in ("html", "body", "main") and _says_otherwise(node, inside)


def _says_otherwise(node: Node, inside: bool) -> bool:
    """Whether a class or id names a part that is not main text.

    Outside articles one such word is enough.  Inside, names are also the article's own: an id
    is often made from a heading ("search-algorithms"; a heading's own id always counts as
    such), and classes describe figures ("side-by-side").  There a name must consist of such
    words and of words of layout, or, as a class, hold a certain one; with other words beside
    them, the part must look like one as well: mostly links, or a form."""
    a = node.attributes
    names = [(w, True) for w in a.get("class", "").split()]
    if not (inside and _is_heading(node)):
        names += [(w, False) for w in a.get("id", "").split()]
    own = OWN if inside and (node.tag in HEADINGS or node.tag in ("header", "hgroup")) else None
    doubtful = False
    for name, is_class in names:
        words = [w for w in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name)) if w]
        found = {w for w in words if NOT_MAIN.search(w)}
        if inside and found:
            if own is None and any(map(OWN_HEADER.search, found)) and _has_heading(node):
                own = OWN_HEADER
            found = {w for w in found if not (own and own.search(w))}
        if not found:
            continue
        if not inside or is_class and any(map(CERTAIN.fullmatch, found)) or all(w in found or w.lower() in LAYOUT or w[0].isdigit() for w in words):
            return True
        doubtful = True
    return doubtful and _like_a_menu(node)


def _is_heading(node: Node) -> bool:
    return len(node.tag) == 2 and node.tag[0] == "h" and node.tag[1] in "123456"


def _like_a_menu(node: Node) -> bool:
    """Whether the text below lies mostly in links, or is a form's."""
    chars = links = 0
    todo = [(node, False)]
    while todo:
        at, linked = todo.pop()
        for c in at.children:
            if isinstance(c, str):
                chars += len(c.strip())
                links += len(c.strip()) if linked else 0
            elif c.tag in ("form", "input", "textarea", "select"):
                return True
            elif c.tag not in RAW:
                todo.append((c, linked or c.tag == "a"))
    return links > LINK_SHARE * chars


def _has_heading(node: Node) -> bool:
    return any(isinstance(c, Node) and (c.tag in HEADINGS or _has_heading(c)) for c in node.children)


def region_of(reference: list[Fold], mass: dict[int, int], otherwise=_named_otherwise) -> int:  # noqa: ANN001
    """The number of the reference's node that is the content region, -1 for none; mass: the
    characters of varying text by number."""
    below: dict[int, tuple[int, int]] = {}

    def node_of(f: Fold) -> Node:
        tag, *kind = f.label.split(".")
        return Node(tag, {"class": " ".join(kind)}, [node_of(c) for c in f.children])

    def weigh(f: Fold, inside: bool) -> tuple[int, int]:
        """Varying characters outside parts that markup names otherwise, and the rank of the highest varying heading (9: none)."""
        tag = f.label.split(".")[0]
        if otherwise(node_of(f), inside or tag != "header"):
            below[f.number] = 0, 9
        else:
            own = mass.get(f.number, 0)
            parts = [weigh(c, inside or tag in MAIN) for c in f.children]
            rank = min([int(tag[1]) if own and tag in HEADINGS else 9, *(r for _, r in parts)])
            below[f.number] = own + sum(n for n, _ in parts), rank
        return below[f.number]

    at, found = Fold("#root", reference), -1
    total = sum(weigh(f, False)[0] for f in reference)
    while total and at.label.split(".")[0] not in MAIN:
        best = max(at.children, key=lambda f: below[f.number][0], default=None)
        if best is None or best.label.split(".")[0] not in CONTAINERS or below[best.number][0] < REGION_SHARE * total:
            break
        if min((below[f.number][1] for f in at.children if f is not best), default=9) < min(4, below[best.number][1]):
            break  # the heading is outside
        at, found = best, best.number
    return found


def main_text(root: Node, folds: list[Fold], template: frozenset[tuple[int, int]], region_number: int = -1, otherwise=_named_otherwise) -> str:  # noqa: ANN001
    """The page's main text; template: (number in the reference, hash of the text) of nodes that do not vary;
    region_number: the number of the content region."""
    constant = set()
    numbers = {n for n, _ in template}

    def mark(fs: list[Fold]) -> None:
        for f in fs:
            if f.number in numbers and (f.number, hash_of(_slot_text(f))) in template:
                constant.update(map(id, f.nodes))
            mark(f.children)

    if template:
        mark(folds)
    regions = _regions(root, constant, _numbered(folds, region_number) if region_number >= 0 else [], otherwise)
    blocks: list[str] = []
    for region, inside in regions:
        current: list[str] = []

        def flush() -> None:
            text = _SPACE.sub(" ", "".join(current)).strip()  # noqa: B023
            if text:
                blocks.append(text)
            current.clear()  # noqa: B023

        def walk(node: Node, keep: bool, inside: bool) -> None:
            for c in node.children:
                if isinstance(c, str):
                    if keep:
                        current.append(c)  # noqa: B023
                elif c.tag == "br":
                    current.append(" ")  # noqa: B023
                elif c.tag in RAW or otherwise(c, inside):
                    if c.tag not in INLINE:
                        flush()  # noqa: B023
                elif c.tag in INLINE:
                    walk(c, keep, inside)
                else:
                    flush()  # noqa: B023
                    walk(c, id(c) not in constant, inside or c.tag in MAIN)
                    flush()  # noqa: B023

        walk(region, id(region) not in constant, inside)
        flush()
    return " ".join(blocks)


def _numbered(folds: list[Fold], number: int) -> list[Node]:
    for f in folds:
        if f.number == number:
            return f.nodes
        if found := _numbered(f.children, number):
            return found
    return []


def _regions(root: Node, constant: set[int], aligned: list[Node], otherwise) -> list[tuple[Node, bool]]:  # noqa: ANN001
    """The region by alignment; else the outermost article or main elements outside what is not
    main text; else the whole page.  Each must hold its part of the page's text outside links."""

    def size(node: Node, inside: bool, own: bool) -> int:
        n = 0
        for c in node.children:
            if isinstance(c, str):
                n += len(c.strip()) if own else 0
            elif c.tag not in RAW and c.tag != "a" and not otherwise(c, inside):
                n += size(c, inside or c.tag in MAIN, own if c.tag in INLINE else id(c) not in constant)
        return n

    def enough(share: float) -> bool:
        return sum(size(n, i, id(n) not in constant) for n, i in found) >= share * whole

    found: list[tuple[Node, bool]] = []

    def look(node: Node, tags: frozenset[str]) -> None:
        for c in node.children:
            if isinstance(c, Node) and not otherwise(c, False):
                if c.tag in tags:
                    found.append((c, True))
                else:
                    look(c, tags)

    whole = size(root, False, True)
    if aligned:
        found.extend((n, n.tag not in ("html", "body")) for n in aligned)
        if enough(REGION_SHARE if otherwise is _named_otherwise else 0.0):  # without names the host decides
            return found
        found.clear()
    for tags in (frozenset(("article",)), frozenset(("main",))) if otherwise is _named_otherwise else ():
        look(root, tags)
        if found and enough(PAGE_SHARE):
            return found
        found.clear()
    return [(root, False)]


def host_of(column: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(column).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


_SLOT = pa.struct([("number", pa.int64()), ("text", pa.int64()), ("chars", pa.int64()), ("links", pa.int64()), ("sketch", pa.list_(pa.int64()))])


def induced(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(host, outline, template, mass): each host's reference tree, the numbers of its nodes with
    the hashes of their texts that do not vary, and with the characters of those that do.
    pages: (host, html)."""

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [h or "" for h in batch.column(html_column).to_pylist()]
            made = [outline(fold(_elements([parse(h)]))) for h in texts]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(made, pa.string()), pa.array(map(hash_of, texts), pa.int64())], names=["host", "outline", "page"])

    slim = pages.where("host <> ''").select("host", html_column)
    trees = slim.mapInArrow(outlines, "host string, outline string, page long").groupBy("host", "outline")
    trees = trees.agg(F.approx_count_distinct("page").alias("n"), F.count(F.lit(1)).alias("rows"))
    # the most frequent tree; of equally frequent ones the first as text
    references = trees.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("neg"), "outline")).alias("best"), F.sum("rows").alias("pages"))
    references = written(references.where(F.col("pages") >= MIN_PAGES).select("host", F.col("best.outline").alias("outline")))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[Fold]] = {}
        for batch in batches:
            ids, ends, numbers, texts, chars, links, sketches = [], [0], [], [], [], [], []
            for h, o in zip(*(batch.column(c).to_pylist() for c in (html_column, "outline")), strict=True):
                folds = fold(_elements([parse(h or "")]))
                match(folds, _reference(o, known))
                for number, text, linked in slots(folds):
                    numbers.append(number)
                    links.append(linked)
                    texts.append(hash_of(text))
                    chars.append(len(text))
                    sketches.append(sketch_of(text).astype(np.int64))
                ids.append(hash_of(h or ""))
                ends.append(len(numbers))
            flat = pa.ListArray.from_arrays(pa.array(range(0, SKETCH * len(numbers) + 1, SKETCH), pa.int32()), pa.array(np.concatenate(sketches) if sketches else [], pa.int64()))
            made = pa.StructArray.from_arrays([pa.array(numbers, pa.int64()), pa.array(texts, pa.int64()), pa.array(chars, pa.int64()), pa.array(links, pa.int64()), flat], fields=list(_SLOT))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)], names=["host", "page", "slots"])

    joined = slim.join(_small(references, F.char_length("outline")), "host")
    seen = joined.mapInArrow(aligned, "host string, page long, slots array<struct<number: long, text: long, chars: long, links: long, sketch: array<long>>>")
    seen = written(seen.dropDuplicates(["host", "page"]))

    # texts that most of a host's distinct pages hold
    total = seen.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= MIN_PAGES)
    held = seen.select("host", F.explode("slots").alias("s")).groupBy("host", "s.number", "s.text").agg(F.count(F.lit(1)).alias("n"))
    held = held.where(F.col("n") >= MIN_PAGES).join(total, "host").where(F.col("n") > MIN_SHARE * F.col("pages"))
    common = written(held.groupBy("host").agg(F.collect_list(F.struct("number", "text")).alias("common")))

    # of these, the ones whose pages differ in the rest of their text
    is_common = lambda s: F.array_contains("common", F.struct(s["number"].alias("number"), s["text"].alias("text")))
    rest = F.filter("slots", lambda s: ~is_common(s))
    own = [F.array_min(F.transform("rest", lambda s, i=i: s["sketch"][i])).alias(f"own{i}") for i in range(SKETCH)]
    marked = seen.join(_small(common, 16 * F.size("common")), "host").select("host", F.filter("slots", is_common).alias("shared"), rest.alias("rest"))
    marked = marked.select("host", F.explode("shared").alias("s"), *own).groupBy("host", "s.number", "s.text")
    marked = marked.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.array(*(F.approx_count_distinct(f"own{i}") for i in range(SKETCH))))[SKETCH // 2].alias("different"))
    marked = marked.where((F.col("different") >= MIN_PAGES) & (F.col("different") >= MIN_DIFFERENT * F.col("n")))
    templates = written(marked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("number", "text"))).alias("template")))

    # how much text varies, by node
    varying = F.filter("slots", lambda s: ~F.coalesce(F.array_contains("template", F.struct(s["number"].alias("number"), s["text"].alias("text"))), F.lit(False)))
    mass = seen.join(_small(templates, 16 * F.size("template")), "host", "left")
    mass = mass.select("host", F.explode(varying).alias("s")).groupBy("host", "s.number").agg(F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links")).where(F.col("links") <= LINK_SHARE * F.col("chars")).join(total.select("host"), "host", "left_semi")
    mass = mass.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("number", "chars"))).alias("mass"))
    return written(references.join(templates, "host", "left").join(mass, "host", "left").select("host", "outline", "template", "mass"))


def _reference(text: str | None, known: dict[str, list[Fold]]) -> list[Fold]:
    if text not in known:
        if len(known) > 1000:
            known.clear()
        known[text] = from_outline(text or "")
    return known[text]


def _small(hosts: DataFrame, bytes_each: Column) -> DataFrame:
    """The table of hosts, for broadcast if the sum of its rows is small; else joined by host."""
    size = hosts.agg(F.sum(bytes_each + 200)).first()[0] or 0
    return F.broadcast(hosts) if size <= MAX_BROADCAST_BYTES else hosts


def with_main_text(pages: DataFrame, html_column: str = "html", url_column: str = "url", out: str = "text", names: bool = True) -> DataFrame:
    """Replace the html column by the page's main text."""
    kept = [c for c in pages.columns if c not in (html_column, out)]
    schema = pages.select(*kept).schema.add(out, "string")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("of") if kept else F.lit(0).alias("of"), F.col(html_column).alias("html"), host_of(url_column).alias("host"))
    wrappers = induced(rows)
    otherwise = _named_otherwise if names else _unnamed

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[Fold]] = {}
        regions: dict[tuple, int] = {}
        for batch in batches:
            made = []
            for h, o, t, m in zip(*(batch.column(c).to_pylist() for c in ("html", "outline", "template", "mass")), strict=True):
                root = parse(h or "")
                folds: list[Fold] = []
                region = -1
                if m:
                    key = o, tuple((x["number"], x["chars"]) for x in m)
                    if key not in regions:
                        if len(regions) > 1000:
                            regions.clear()
                        regions[key] = region_of(_reference(o, known), dict(key[1]), otherwise)
                    region = regions[key]
                if t or region >= 0:
                    folds = fold(_elements([root]))
                    match(folds, _reference(o, known))
                made.append(main_text(root, folds, frozenset((x["number"], x["text"]) for x in t or ()), region, otherwise))
            yield pa.RecordBatch.from_arrays([*(batch.column("of").flatten() if kept else []), pa.array(made, pa.string())], names=[*kept, out])

    joined = rows.join(_small(wrappers, F.char_length("outline") + 16 * (F.greatest(F.size("template"), F.lit(0)) + F.greatest(F.size("mass"), F.lit(0)))), "host", "left")
    return joined.select("of", "html", "outline", "template", "mass").mapInArrow(extract, schema)


def op1_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES = {"op1_wrapper_induction": op1_wrapper_induction}
ORACLE_SQL: dict[str, str] = {}
