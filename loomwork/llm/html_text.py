"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of the same host.

All pages of a host are aligned: those of one shape, that is alike but for their texts, place by place, and shapes one
after another. Where two pages differ in text, the wrapper gets a text slot; where an element is missing in one, an
optional group; where alike elements follow each other, a repeated group. The
wrapper tells where the article lies: the main article element or, without one, the innermost element that holds all of
the varying text. What nearly all pages of a host, counted over every page, have word for word at the same place is
template. Every page is then read in one pass: blocks within the article, without menus, headers, footers, sidebars,
notices, adverts, forms, comments and template text. Pages most of whose text lies outside that element, which the
wrapper does not know therefore, pages without it, and hosts with too few pages to tell, follow the same rule on the page
alone.
"""

from __future__ import annotations

import bisect
import functools
import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import materialise

#: Pages that must share a text for it to be template.
MIN_SHARED = 4
#: Share of the host's pages that must have it.
SHARED = 0.8
#: Names that a path spells out; what is nested deeper is named by a digest of its path.
SPELT = 200
#: Children of two elements that are aligned by a table, as their product; more are cut at children that both have once.
TABLE = 10_000
#: Parts of a host's shapes that are aligned apart.
PARTS = 16
#: Shapes that a task remembers; more are passed on more than once.
REMEMBERED = 10_000

RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title")
EXCLUDED = frozenset(("head", "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", *RAW))
MAIN = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body head article main section nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th blockquote pre figure figcaption address fieldset details summary hr menu dialog center hgroup".split()
)
#: Opening one of these ends an open element of the set.
ENDS = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
    "body": frozenset(("head",)),
}
#: Words that mark what is not the article where a whole class, id or role is made of them.
_WORDS = (
    r"ads?|advert\w*|sponsor\w*|promo\w*|notice|cookies?|consent|gdpr|alert|popup|modal|nav\w*|menu|breadcrumbs?|sidebar|widget|"
    r"comments?|replies|reply|disqus|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|"
    r"pagination|pager|copyright|disclaimer"
)
#: Words that do so outside article and main alone: inside, they may name parts of the article.
_OUTSIDE = r"banner|overlay|side|footer|header|masthead|search|toolbar|hidden|skip|complementary|contentinfo"


def _made_of(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|\s)(?:{words})(?:[_-]+(?:{words}))*(?:$|\s)", re.I)


BOILERPLATE, WITHIN = _made_of(f"{_WORDS}|{_OUTSIDE}"), _made_of(_WORDS)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass
class Block:
    """Text between two block boundaries: the elements around it, and whether one of them is not the article's."""

    path: str
    excluded: bool
    text: str


@dataclass
class Open:
    tag: str
    path: str
    excluded: bool
    #: number of the innermost open element, or itself, that only its attributes mark; -1: none
    mark: int = -1
    #: whether it is, or lies in, an article or main element
    within: bool = False


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def blocks(page: str | None) -> list[Block]:
    """A page's blocks in order, by one pass over its tokens; unclosed and stray tags are put up with."""
    out: list[Block] = []
    stack = [Open("", "", False)]
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    pending: list[str] = []
    mark_of: list[int] = []
    around: list[int] = []  # of each mark, the mark around it

    def end_block() -> None:
        if pending:
            if text := clean("".join(pending)):
                out.append(Block(stack[-1].path, stack[-1].excluded, text))
                mark_of.append(stack[-1].mark)
            pending.clear()

    def cut(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop().tag].pop()

    def close_to(size: int) -> None:
        end_block()
        cut(size)

    page = page or ""
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            pending.append(page[at : token.start()])
        at = token.end()
        if not token["tag"]:
            if token["raw"] and token["raw"].lower() == "textarea":
                pending.append(" ")
            continue
        tag = token["tag"].lower()
        if tag not in BLOCKS:
            if tag in VOID:
                if tag == "br":
                    pending.append(" ")
                continue
            attributes = token["attributes"]
            if tag not in EXCLUDED and not (attributes and not token["close"] and _marked(attributes, stack[-1].within)):
                if token["close"] and opened.get(tag):
                    close_to(opened[tag][-1])
                continue
        if token["close"]:
            if opened.get(tag):
                close_to(opened[tag][-1])
            else:
                end_block()
            continue
        end_block()
        ends = ENDS.get(tag)
        for i in range(len(stack) - 1, 0, -1):
            open_tag = stack[i].tag
            if open_tag == "p" and tag in BLOCKS or ends and open_tag in ends:
                cut(i)
            elif open_tag in BLOCKS:
                break
        if tag in VOID:
            continue
        top = stack[-1]
        name, bad = _name(tag, token["attributes"], top.within)
        path = f"{top.path}/{name}"
        if len(stack) > SPELT:
            path = f"{stack[SPELT].path}/~{zlib.crc32(path.encode()):08x}"
        if bad:
            around.append(top.mark)
        opened.setdefault(tag, []).append(len(stack))
        stack.append(Open(tag, path, top.excluded or tag in EXCLUDED, len(around) - 1 if bad else top.mark, top.within or tag in MAIN))
    if at < len(page):
        # a tag that the page's end cuts off is no text
        pending.append(re.sub(r"<[a-zA-Z/!][^<>]*\Z", "", page[at:]))
    end_block()
    # attributes alone do not exclude what holds most of the page's text
    total, mass = 0, [0] * len(around)
    for b, mark in zip(out, mark_of):
        if not b.excluded:
            total += len(b.text)
            if mark >= 0:
                mass[mark] += len(b.text)
    for mark in range(len(around) - 1, -1, -1):
        if around[mark] >= 0:
            mass[around[mark]] += mass[mark]
    away: list[bool] = []
    for mark, outer in enumerate(around):
        away.append(2 * mass[mark] <= total or (outer >= 0 and away[outer]))
    for b, mark in zip(out, mark_of):
        b.excluded = b.excluded or (mark >= 0 and away[mark])
    return out


def _marked(attributes: str, within: bool) -> bool:
    words = WITHIN if within else BOILERPLATE
    return any(words.search(" ".join(filter(None, m.groups()[1:]))) for m in _ATTRIBUTE.finditer(attributes)) or bool(_HIDDEN.search(attributes))


def _name(tag: str, attributes: str, within: bool) -> tuple[str, bool]:
    """An element's name in paths, tag and classes, and whether its attributes mark it as not the article's."""
    if not attributes.strip():
        return tag, False
    bad, names = bool(_HIDDEN.search(re.sub(_ATTRIBUTE, "", attributes))), []
    words = WITHIN if within else BOILERPLATE
    for m in _ATTRIBUTE.finditer(attributes):
        value = next(filter(None, m.groups()[1:]), "")
        bad = bad or (tag not in MAIN and bool(words.search(value)))
        if m[1].lower() == "class":
            names = value.split()
    # html and body carry classes for the whole page
    return ".".join([tag, *names]).replace("/", "_"), bad and tag not in ("html", "body")


@dataclass
class Node:
    """Part of a wrapper: an element, or a text (``text`` is None in a slot)."""

    name: str
    excluded: bool = False
    children: list[Node] = field(default_factory=list)
    text: str | None = None
    optional: bool = False
    repeated: bool = False
    #: pages that have it, and how much varying text it holds
    pages: int = 1
    mass: int = 0

    def show(self) -> str:
        if self.name == "#":
            body = "#" if self.text is None else repr(self.text)
        else:
            body = f"<{self.name}>{''.join(c.show() for c in self.children)}</{self.name.split('.')[0]}>"
        mark = ("+" if self.repeated else "") + ("?" if self.optional else "")
        return f"({body}){mark}" if mark else body


def page_tree(page: str) -> Node:
    """A page's elements and texts; runs of alike neighbours are one repeated group already."""
    return _tree(blocks(page))


def _tree(found: list[Block]) -> Node:
    root = Node("")
    for b in found:
        node, names = root, b.path.split("/")[1:]
        for i, name in enumerate(names):
            last = node.children[-1] if node.children else None
            # a text ends its element: the next block of that name is a neighbour, unless it is a container
            if last is None or last.name != name or (i == len(names) - 1 and name.split(".")[0] not in ("div", "section", "article", "main", "body")):
                last = Node(name)
                node.children.append(last)
            node = last
        node.excluded = b.excluded
        node.children.append(Node("#", text=b.text, mass=len(b.text)))
    _fold(root)
    return root


def _fold(node: Node) -> None:
    for c in node.children:
        _fold(c)
    out: list[Node] = []
    for c in node.children:
        if out and out[-1].name == c.name:
            merged = _merge(out[-1], c, same_page=True)
            merged.repeated = True
            out[-1] = merged
        else:
            out.append(c)
    node.children = out


def _merge(a: Node, b: Node, same_page: bool = False) -> Node:
    """The wrapper of both: differing texts become a slot, unmatched children optional groups."""
    out = Node(a.name, a.excluded or b.excluded, optional=a.optional or b.optional, repeated=a.repeated or b.repeated)
    out.pages = a.pages if same_page else a.pages + b.pages
    out.mass = a.mass + b.mass
    if a.name == "#":
        out.text = a.text if a.text == b.text else None
        return out
    i = j = 0
    for x, y in [*_aligned(a.children, b.children), (len(a.children), len(b.children))]:
        for extra in (*a.children[i:x], *b.children[j:y]):
            extra.optional = True
            out.children.append(extra)
        if x < len(a.children):
            out.children.append(_merge(a.children[x], b.children[y], same_page))
        i, j = x + 1, y + 1
    return out


def _alike(x: Node, y: Node) -> int:
    """What aligning two children is worth: texts that differ less than what is the same."""
    return (2 if x.name != "#" or x.text == y.text else 1) if x.name == y.name else 0


def _aligned(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Places of children that match, ascending in both: the best alignment where a table is small enough for it.

    Longer lists are first cut at children that both have once (by name and text), in the longest order that they share;
    a piece that is still too long is aligned child by child, each with the next of its name.
    """
    if len(a) * len(b) <= TABLE:
        return _table(a, b)
    once: list[dict[tuple, int]] = []
    for children in (a, b):
        seen: dict[tuple, int] = {}
        for i, c in enumerate(children):
            k = (c.name, c.text if c.name == "#" else _digest(c))
            seen[k] = -1 if k in seen else i
        once.append({k: i for k, i in seen.items() if i >= 0})
    common = sorted((i, once[1][k]) for k, i in once[0].items() if k in once[1])
    anchors = _ascending(common)
    if not anchors:
        return _next_of_name(a, b)
    out, i, j = [], 0, 0
    for x, y in [*anchors, (len(a), len(b))]:
        inner = _table if (x - i) * (y - j) <= TABLE else _next_of_name
        out += [(i + s, j + t) for s, t in inner(a[i:x], b[j:y])]
        if x < len(a):
            out.append((x, y))
        i, j = x + 1, y + 1
    return out


def _digest(node: Node) -> int:
    """What tells elements apart: their names and texts in order."""
    h, stack = xxhash.xxh64(), [node]
    while stack:
        c = stack.pop()
        h.update(f"{c.name}\0{c.text or ''}\0{len(c.children)}\0")
        stack += reversed(c.children)
    return h.intdigest()


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, sorted by the first, that ascends in the second."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        at = bisect.bisect_left(tails, y)
        before[i] = ends[at - 1] if at else -1
        tails[at : at + 1], ends[at : at + 1] = [y], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _next_of_name(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    places: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c.name, []).append(j)
    out, j = [], 0
    for i, c in enumerate(a):
        own = places.get(c.name, [])
        at = bisect.bisect_left(own, j)
        # what lies further ahead than a's own rest is left to later children
        if at < len(own) and own[at] - j <= len(a) - i:
            out.append((i, own[at]))
            j = own[at] + 1
    return out


def _table(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            same = _alike(a[i], b[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + same if same else 0)
    out, i, j = [], 0, 0
    while i < n and j < m:
        same = _alike(a[i], b[j])
        if same and best[i][j] == best[i + 1][j + 1] + same:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def infer(pages: list[str]) -> Node:
    """The wrapper of pages of one host, in their order."""
    wrapper = page_tree(pages[0])
    for p in pages[1:]:
        wrapper = _merge(wrapper, page_tree(p))
    return wrapper


def _articles(node: Node, path: str, found: list[tuple[int, str]], least: float) -> int:
    """Text under a node that fewer than ``least`` pages share; notes main elements."""
    if node.name == "#":
        return node.mass if node.text is None or node.pages < least else 0
    mass = sum(_articles(c, f"{path}/{c.name}", found, least) for c in node.children if c.name == "#" or not c.excluded)
    if node.name.split(".")[0] in MAIN and not node.excluded:
        found.append((mass, path))
    return mass


def article_path(wrapper: Node) -> str:
    """Path of the element that holds the article; empty: the whole page."""
    found: list[tuple[int, str]] = []
    least = max(2, SHARED * wrapper.pages)
    _articles(wrapper, "", found, least)
    if found:
        masses: dict[str, int] = {}  # elements that were not aligned may have one path
        for m, p in found:
            masses[p] = masses.get(p, 0) + m
        mass = max(masses.values())
        # the outermost of those that hold the most
        return min((len(p), p) for p, m in masses.items() if m == mass)[1]
    node, path = wrapper, ""
    while True:
        inner = [(_articles(c, "", [], least), c) for c in node.children if c.name != "#" and not c.excluded]
        total = _articles(node, "", [], least)
        good = [(m, c) for m, c in inner if total and m == total and not c.repeated and c.name.split(".")[0] not in ("p", "li", "h1")]
        if not good:
            return path
        node = max(good, key=lambda x: x[0])[1]
        path = f"{path}/{node.name}"


def _own_path(found: list[Block]) -> str:
    """The article's element by the page alone."""
    mass: dict[str, int] = {}
    for b in found:
        if not b.excluded:
            names = b.path.split("/")
            for i in range(1, len(names) + 1):
                p = "/".join(names[:i])
                mass[p] = mass.get(p, 0) + len(b.text)
    main = {p: m for p, m in mass.items() if p.rsplit("/", 1)[-1].split(".")[0] in MAIN}
    if main:
        most = max(main.values())
        return min((len(p), p) for p, m in main.items() if m == most)[1]
    return ""


def place(block: Block) -> int:
    """A block's path and text as a number: what a host's pages share."""
    return int(xxhash.xxh64_intdigest(f"{block.path}\t{block.text}") - (1 << 63))


def extract(page: str | None, path: str | None, template: frozenset[int]) -> str:
    """The article of a page: blocks under ``path`` or, where that holds less than half of the text, by the page alone."""
    found = blocks(page)
    if all(b.excluded for b in found):
        return "\n".join(b.text for b in found)
    kept = [b for b in found if not b.excluded and place(b) not in template] if template else [b for b in found if not b.excluded]
    inside = [b for b in kept if path and (b.path == path or b.path.startswith(f"{path}/"))]
    if not inside or 2 * sum(len(b.text) for b in inside) < sum(len(b.text) for b in kept):
        path = _own_path(found)
        inside = [b for b in kept if not path or b.path == path or b.path.startswith(f"{path}/")]
    return "\n".join(b.text for b in inside)


def host(url) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _kept_tree(root: Node) -> str:
    """A wrapper as a row: its nodes in page order with their depths."""
    out, stack = [], [(0, root)]
    while stack:
        depth, c = stack.pop()
        out.append((depth, c.name, c.excluded + 2 * c.optional + 4 * c.repeated, c.pages, c.mass, c.text))
        stack += [(depth + 1, x) for x in reversed(c.children)]
    return json.dumps(out)


def _read_tree(row: str) -> Node:
    above: list[Node] = []
    for depth, name, marks, pages, mass, text in json.loads(row):
        node = Node(name, bool(marks & 1), text=text, optional=bool(marks & 2), repeated=bool(marks & 4), pages=pages, mass=mass)
        del above[depth:]
        if above:
            above[-1].children.append(node)
        above.append(node)
    return above[0]


def _leaves(root: Node) -> tuple[int, list[Node]]:
    """What a page's tree is but for its texts, as a number, and its texts in order."""
    h, stack, out = xxhash.xxh64(), [root], []
    while stack:
        c = stack.pop()
        h.update(f"{c.name}\0{len(c.children)},{c.excluded:d}{c.optional:d}{c.repeated:d}\0".encode("utf-8", "surrogatepass"))
        if c.name == "#":
            out.append(c)
        stack += reversed(c.children)
    return h.intdigest() - (1 << 63), out


def shapes(pages: DataFrame) -> DataFrame:
    """(host, hash, shape, texts, sizes, places, tree) of every distinct page of each host, in one pass over the pages.

    ``shape`` names the tree without its texts, ``texts`` holds their hashes (null: a slot within the page), ``sizes`` their
    lengths, ``places`` what template texts are counted by. ``tree`` is the tree with its texts, on one page of a shape,
    host and task at least. Only these are shuffled, no html.
    """
    kinds = {"host": pa.string(), "hash": pa.int64(), "shape": pa.int64(), "texts": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "places": pa.list_(pa.int64()), "tree": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            rows = []
            for name, key, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = blocks(page)
                root = _tree(found)
                shape, leaves = _leaves(root)
                new = (name, shape) not in seen
                if new and len(seen) < REMEMBERED:
                    seen.add((name, shape))
                texts = [None if c.text is None else xxhash.xxh64_intdigest(c.text) - (1 << 63) for c in leaves]
                rows.append((name, key, shape, texts, [c.mass for c in leaves], list({place(b) for b in found if not b.excluded}), _kept_tree(root) if new else None))
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    schema = "host string, hash long, shape long, texts array<long>, sizes array<long>, places array<long>, tree string"
    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("hash"), "html").where("html is not null and html <> ''").mapInArrow(run, schema)
    same = [F.first(c).alias(c) for c in ("shape", "texts", "sizes", "places")]
    return materialise(rows.groupBy("host", "hash").agg(*same, F.max("tree").alias("tree")), "page-shapes")


def templates(found: DataFrame) -> DataFrame:
    """(host, template): numbers of the texts that nearly all of a host's distinct pages have, counted over all of them.

    ``found`` has the pages' ``shapes``. Only numbers are shuffled, counted before the shuffle.
    """
    rows = found.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "places")).alias("place"))
    counts = materialise(rows.groupBy("host", "place").agg(F.count("*").alias("n")).where(F.col("place").isNull() | (F.col("n") >= MIN_SHARED)), "template-counts")
    totals = counts.where("place is null").select(F.col("host").alias("t_host"), F.col("n").alias("pages"))
    shared = counts.where("place is not null").join(totals, F.col("host") == F.col("t_host")).where(F.col("n") >= SHARED * F.col("pages"))
    # each is in most of the host's pages, so a host has no more of them than its pages have blocks
    return shared.groupBy("host").agg(F.sort_array(F.collect_list("place")).alias("template"))


class Shape:
    """All pages of one tree: how many, which texts they share (None: a slot), how long their texts are, one page's tree."""

    def __init__(self, texts: list, sizes: list) -> None:
        self.pages, self.texts, self.sizes, self.tree = 0, list(texts), [0] * len(sizes), None

    def add(self, pages: int, texts: list, sizes: list, tree: str | None) -> None:
        self.pages += pages
        self.texts = [x if x == y else None for x, y in zip(self.texts, texts)]
        self.sizes = [x + y for x, y in zip(self.sizes, sizes)]
        if tree and (self.tree is None or tree < self.tree):
            self.tree = tree

    def wrapper(self) -> Node:
        root = _read_tree(self.tree)
        for c, text, size in zip(_leaves(root)[1], self.texts, self.sizes):
            c.text, c.mass = None if text is None else c.text, size
        stack = [root]
        while stack:
            c = stack.pop()
            c.pages = self.pages
            stack += c.children
        return root


def _by_shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's pages of one host and shape as one row."""
    known: dict[tuple[str, int], Shape] = {}

    def out() -> pa.RecordBatch:
        rows = [(h, s, x.pages, x.texts, x.sizes, x.tree) for (h, s), x in known.items()]
        known.clear()
        kinds = {"host": pa.string(), "shape": pa.int64(), "pages": pa.int64(), "texts": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "tree": pa.string()}
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    for batch in batches:
        for name, shape, texts, sizes, tree in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (name, shape) not in known:
                if len(known) >= REMEMBERED:
                    yield out()
                known[name, shape] = Shape(texts, sizes)
            known[name, shape].add(1, texts, sizes, tree)
    yield out()


def _merged(trees: list[Node]) -> Node:
    """The wrapper of all, small ones first; their order is that of what they hold, so it is the same in every run."""
    return functools.reduce(_merge, trees)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, path, template, wrapper): wrappers inferred from all distinct pages of each host.

    Pages of one shape are aligned place by place, summed up in the tasks that read them; shapes are aligned by ``_merge``,
    PARTS parts of a host's shapes apart and then the parts, so that a host of any size is spread over tasks.
    """
    found = shapes(pages)
    rows = found.select("host", "shape", "texts", "sizes", "tree").mapInArrow(_by_shape, "host string, shape long, pages long, texts array<long>, sizes array<long>, tree string")

    def part(key, table):
        known: dict[int, Shape] = {}
        for shape, n, texts, sizes, tree in zip(*(table.column(c).to_pylist() for c in ("shape", "pages", "texts", "sizes", "tree"))):
            known.setdefault(shape, Shape(texts, sizes)).add(n, texts, sizes, tree)
        order = sorted(known.items(), key=lambda x: (len(x[1].sizes), x[0]))
        tree = _kept_tree(_merged([x.wrapper() for _, x in order]))
        return pa.table({"host": [key[0].as_py()], "part": [key[1].as_py()], "tree": [tree]})

    def whole(key, table):
        trees = sorted(zip(table.column("part").to_pylist(), table.column("tree").to_pylist()))
        wrapper = _merged([_read_tree(t) for _, t in trees])
        return pa.table({"host": [key[0].as_py()], "path": [article_path(wrapper)], "wrapper": [wrapper.show()]})

    parts = rows.groupBy("host", F.pmod("shape", F.lit(PARTS)).alias("part")).applyInArrow(part, "host string, part long, tree string")
    paths = parts.groupBy("host").applyInArrow(whole, "host string, path string, wrapper string")
    own = templates(found).withColumnRenamed("host", "of_host")
    return paths.join(own, F.col("host") == F.col("of_host"), "left").select("host", "path", "template", "wrapper")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Null and empty pages have an empty text; pages without a host in their url are a host together. Rows that repeat
    are extracted each; copies of a page count once for what is template. An empty table gives an empty table.
    """
    known = materialise(wrappers(pages).select(F.col("host").alias("of_host"), "path", "template"), "wrappers")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    rows = rows.join(known, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "path", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple, frozenset[int]] = {}
        for batch in batches:
            texts = []
            for page, path, template in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                key = tuple(template or ())
                if key not in sets:
                    if len(sets) > 10_000:
                        sets.clear()
                    sets[key] = frozenset(key)
                texts.append(extract(page, path, sets[key]))
            n = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
