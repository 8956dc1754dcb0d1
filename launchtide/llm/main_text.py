"""Main text of web pages by wrapper induction over the pages of a host.

Pages of a host are parsed to trees of blocks and aligned by simple tree matching. Nodes
whose text is the same in nearly all of them are the template; what varies is a slot.
A page's text is what stands in its article (its slots, if it has none), without
parts that are by their tag, role or name no article text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.llm.shared import broadcast_if_small, stored

#: Pages that must agree on a text outside an article, and inside one, to make it template.
OUTSIDE, INSIDE = 2, 8
AGREEING = 0.9
#: How deep the containers lie that tell layouts of a host apart.
LAYOUT_DEPTH = 3
#: Blocks deeper than this are laid in page order into the one at this depth, or a deeper article.
DEPTH = 100

# Element names of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var".split()
)
DROPPED = frozenset(
    "nav aside form button select option noscript template iframe svg math canvas object audio "
    "video dialog menu fieldset".split()
)
FOREIGN = frozenset(("svg", "math"))
CONTAINERS = frozenset("div section main article header center table tbody tr td".split())
ENDED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
# Words in class and id that name parts which are no article text.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr privacy notice notices notification popup modal overlay "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar "
    "comment comments disqus respond replies share sharing social related recommended "
    "newsletter subscribe subscription signup login search widget toolbar pagination pager "
    "skip copyright".split()
)
QUALIFIED = frozenset(("has", "with", "no", "without"))

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|/([a-zA-Z][^\s>/]*)[^>]*>"
    r"|([a-zA-Z][^\s>/]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([a-zA-Z][^\s>/]*)([^>]*)>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    """An element: its parts in order are texts and elements."""

    __slots__ = ("tag", "label", "parts", "inline", "dropped", "template")

    def __init__(self, tag: str, label: str = "", inline: bool = False, dropped: bool = False):
        self.tag, self.label, self.inline, self.dropped = tag, label or tag, inline, dropped
        self.parts: list[Node | str] = []
        self.template = False


def _element(tag: str, raw: str, inside: bool) -> Node:
    """An element from its start tag; ``inside``: whether an article is around it."""
    inline = tag in INLINE
    if not raw or not raw.strip("/ \n\t"):
        dropped = tag in DROPPED or (tag in ("header", "footer") and not inside)
        return Node(tag, tag, inline, dropped or (tag == "footer"))
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), a or b or c)
    # Inside an article an id is a place to link to, and names no kind of part.
    named = f"{found.get('class', '')} {'' if inside else found.get('id', '')}".lower()
    drop = tag in DROPPED or tag == "footer" or (tag == "header" and not inside)
    drop |= "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES
    drop |= "display:none" in found.get("style", "").replace(" ", "").lower()
    for name in named.split():
        tokens = _WORD.findall(name)
        if not QUALIFIED.intersection(tokens):
            # Half of a name's words have to be such words: menu-left, but not menu-of-the-day.
            drop |= 2 * sum(x in NAMED for x in tokens) >= max(len(tokens), 1) and not (inside and tag == "header")
    label = f"{tag}.{found.get('class', '').lower()}"
    return Node(tag, label, inline, drop and tag not in ("html", "body", "main", "article"))


def parse(html: str) -> Node:
    """The tree of a page. Elements that are never closed end with what holds them."""
    root = Node("root")
    stack, at, articles = [root], 0, 0
    # Where each open element is laid, by its place in the stack; open elements by tag.
    boxes, opened = [0], Counter()

    def cut(k: int) -> None:
        nonlocal articles
        articles -= sum(x.tag in ("article", "main") for x in stack[k:])
        opened.subtract(x.tag for x in stack[k:])
        del stack[k:], boxes[k:]

    def box(inline: bool) -> int:
        """Where an element is laid that begins now."""
        top = len(stack) - 1
        if top < DEPTH - 1:
            return top
        if inline:
            return boxes[top] if top >= DEPTH and stack[top].inline else top
        while top >= DEPTH and stack[top].tag not in ("article", "main"):
            top = boxes[top]
        return top

    def last(k: int) -> Node:
        """The open element at k, continued if another was laid behind it since."""
        if k >= DEPTH:
            holder = last(boxes[k])
            if holder.parts[-1:] != [stack[k]]:
                known = stack[k]
                stack[k] = Node(known.tag, known.label, known.inline, known.dropped)
                holder.parts.append(stack[k])
        return stack[k]

    for match in iter(lambda: _TAG.search(html, at), None):
        if match.start() > at:
            last(len(stack) - 1).parts.append(html[at : match.start()])
        at = match.end()
        end, tag = match[1], match[2] or match[4]
        if end:
            end = end.lower()
            for k in range(len(stack) - 1, 0, -1) if opened[end] else ():
                if stack[k].tag == end:
                    cut(k)
                    break
                if end in INLINE and not stack[k].inline:
                    break
            continue
        if not tag:
            continue
        tag = tag.lower()
        raw = match[3] or match[5] or ""
        if tag in RAW:
            close = re.compile(rf"</{tag}", re.I).search(html, at)
            at = close.start() if close else len(html)
            continue
        if tag in VOID or raw.endswith("/") and tag in FOREIGN:
            if tag in ("br", "hr"):
                last(len(stack) - 1).parts.append(" " if tag == "br" else Node(tag))
            continue
        if tag in ("html", "head", "body"):
            continue
        if tag not in INLINE:
            ends = ENDED_BY.get(tag)
            for k in range(len(stack) - 1, 0, -1) if any(opened[x] for x in ("p", *(ends or ()))) else ():
                open_tag = stack[k].tag
                if open_tag == "p" or (ends and open_tag in ends):
                    cut(k)
                    if not ends:
                        break
                elif open_tag not in INLINE and not (ends and open_tag not in ("ul", "ol", "dl", "table", "tbody")):
                    break
        node = _element(tag, raw, articles > 0)
        # An article in an article is a reader's comment.
        node.dropped |= tag == "article" and opened["article"] > 0
        place = box(node.inline)
        node.dropped |= len(stack) > DEPTH and stack[-1].dropped
        last(place).parts.append(node)
        stack.append(node)
        boxes.append(place)
        opened[tag] += 1
        articles += tag in ("article", "main")
    if at < len(html):
        last(len(stack) - 1).parts.append(html[at:])
    return root


def blocks(node: Node, linked: bool = False) -> list[tuple[str, int]]:
    """Texts of a node's blocks in page order, with how many of their letters are links."""
    found: list[tuple[str, int]] = []
    buffer: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(buffer).split())
        if text:
            found.append((text, links))
        buffer.clear()
        links = 0

    def walk(at: Node, linked: bool) -> None:
        nonlocal links
        for part in at.parts:
            if isinstance(part, str):
                text = unescape(part)
                buffer.append(text)
                links += len(text) if linked else 0
            elif not part.dropped and not part.template:
                if part.inline:
                    walk(part, linked or part.tag == "a")
                else:
                    flush()
                    walk(part, linked)
                    flush()

    walk(node, linked)
    flush()
    return found


def _articles(node: Node, tag: str) -> list[Node]:
    """The outermost elements of a tag that are not inside a dropped part."""
    found = []
    for part in node.parts:
        if not isinstance(part, str):
            if part.tag == tag and not part.dropped:
                found.append(part)
            elif not part.dropped:
                found += _articles(part, tag)
    return found


def _size(node: Node) -> int:
    return sum(len(p) if isinstance(p, str) else _size(p) for p in node.parts)


def main_text(root: Node) -> str:
    """The blocks of a page's articles; without one, of its body, but for lists of links."""
    holders = [x for tag in ("article", "main") for x in _articles(root, tag)[: None if tag == "article" else 1]]
    holders = [x for x in holders if x.tag == "article"] or holders
    texts = [text for holder in holders for text, _ in blocks(holder)]
    if texts:
        return "\n".join(texts)
    # A named part that holds most of a page without an article is not an extra.
    whole, most = _size(root), [root]
    while most:
        for part in most.pop().parts:
            if not isinstance(part, str):
                if part.dropped and part.tag not in DROPPED and 2 * _size(part) > whole:
                    part.dropped = False
                most.append(part)
    return "\n".join(text for text, links in blocks(root) if 5 * links < 4 * len(text))


class Shape:
    """Trees as numbers: each distinct structure of labels has one, with its matching."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.matched: dict[tuple[int, int], int] = {}

    def of(self, label: str, children: list[int]) -> int:
        key = (label, *children)
        if key not in self.numbers:
            self.numbers[key] = len(self.known)
            self.known.append((label, np.array(children, np.int64)))
        return self.numbers[key]

    def score(self, a: int, b: int) -> int:
        """Simple tree matching: the most pairs of nodes that a top-down, ordered map makes."""
        key = (a, b)
        if key not in self.matched:
            (one, left), (two, right) = self.known[a], self.known[b]
            total = 0
            if one == two:
                total = 1 + int(_forward(self.rows(left, right), len(right))[-1])
            self.matched[key] = total
        return self.matched[key]

    def rows(self, left: np.ndarray, right: np.ndarray, one: np.ndarray | None = None, two: np.ndarray | None = None) -> list:
        """For each left child what its pair with each right child is worth.

        Pairs of equal text are worth as much again, and one more.
        """
        a, at = np.unique(left, return_inverse=True)
        b, to = np.unique(right, return_inverse=True)
        table = np.array([[self.score(int(x), int(y)) for y in b] for x in a], np.int64).reshape(len(a), len(b))
        if one is None:
            return [table[k][to] for k in at]
        return [table[k][to] * (1 + (own == two)) for k, own in zip(at, one, strict=True)]


def _forward(rows: list, n: int) -> np.ndarray:
    best = np.zeros(n + 1, np.int64)
    for row in rows:
        taken = np.maximum(best[:-1] + row, best[1:])
        best[1:] = np.maximum.accumulate(taken)
    return best


def _pairs(rows: list, first: int, a: int, b: int) -> list[tuple[int, int]]:
    """The best ordered pairs of rows with columns a to b, in space of one row."""
    if not rows or a >= b:
        return []
    if len(rows) == 1:
        best = int(np.argmax(rows[0][a:b]))
        return [(first, a + best)] if rows[0][a + best] > 0 else []
    half = len(rows) // 2
    up = _forward([r[a:b] for r in rows[:half]], b - a)
    down = _forward([r[a:b][::-1] for r in rows[half:][::-1]], b - a)[::-1]
    cut = a + int(np.argmax(up + down))
    return _pairs(rows[:half], first, a, cut) + _pairs(rows[half:], first + half, cut, b)


class Tree:
    """A page's blocks as they are matched: label, hash of own text, children, structure."""

    def __init__(self, node: Node, shape: Shape, inside: bool = False):
        self.node, self.inside = node, inside or node.tag in ("article", "main")
        own, kids = [], []

        def walk(at: Node) -> None:
            for part in at.parts:
                if isinstance(part, str):
                    own.append(part)
                elif part.inline:
                    walk(part)
                elif not part.dropped:
                    kids.append(part)

        walk(node)
        self.text = crc32(" ".join("".join(own).split()).encode("utf-8", "replace"))
        self.children = [Tree(kid, shape, self.inside) for kid in kids]
        self.shape = shape.of(node.label, [kid.shape for kid in self.children])
        self.whole = crc32(repr((self.text, [kid.whole for kid in self.children])).encode())

    def count(self) -> int:
        return 1 + sum(kid.count() for kid in self.children)


def align(a: Tree, b: Tree, shape: Shape) -> Iterator[tuple[Tree, Tree]]:
    """Matched nodes of two trees, from the roots down."""
    yield a, b
    if a.children and b.children:
        left, right = (np.array([kid.shape for kid in t.children]) for t in (a, b))
        one, two = (np.array([kid.whole for kid in t.children]) for t in (a, b))
        for i, j in _pairs(shape.rows(left, right, one, two), 0, 0, len(right)):
            yield from align(a.children[i], b.children[j], shape)


def layout(root: Node) -> tuple[int, int] | None:
    """Two hashes of a page: of its containers' label paths, and of its tree but for articles.

    Nothing for a page without text.
    """
    paths = set()
    text = False

    def walk(at: Node, path: str, depth: int, inside: bool) -> list[int]:
        nonlocal text
        inner = []
        for part in at.parts:
            if isinstance(part, str):
                text = text or bool(part.strip())
            elif part.dropped:
                continue
            elif part.inline:
                inner += walk(part, path, depth, inside)
            else:
                own = f"{path}/{part.label}" if depth <= LAYOUT_DEPTH else ""
                if own and not inside and part.tag in CONTAINERS:
                    paths.add(own)
                found = walk(part, own, depth + 1, inside or part.tag in ("article", "main"))
                if not inside:
                    inner.append(crc32(repr((part.label, found)).encode("utf-8", "replace")))
        return inner

    skeleton = crc32(repr(walk(root, "", 1, False)).encode())
    return (crc32("\n".join(sorted(paths)).encode("utf-8", "replace")), skeleton) if text else None


class Wrapper:
    """A packed tree to be matched: label, text where that is template, hash, children."""

    def __init__(self, packed: list, shape: Shape, nodes: list[Wrapper]):
        label, self.text, self.whole, self.inside, children = packed
        self.number = len(nodes)
        nodes.append(self)
        self.children = [Wrapper(kid, shape, nodes) for kid in children]
        self.shape = shape.of(label, [kid.shape for kid in self.children])


def pack_tree(page: str) -> str:
    """A page's tree as the pivot that other pages of its layout are matched with."""

    def packed(tree: Tree) -> list:
        return [tree.node.label, None, tree.whole, tree.inside, [packed(kid) for kid in tree.children]]

    return json.dumps(packed(Tree(parse(page), Shape())), separators=(",", ":"))


def votes(pivots: list[Wrapper], tree: Tree, shape: Shape) -> Iterator[tuple[int, int, int, bool]]:
    """Texts that a page has where it matches a pivot: which pivot, node, text, in an article."""
    empty = crc32(b"")
    for k, pivot in enumerate(pivots):
        for known, own in align(pivot, tree, shape) if pivot else ():
            if own.text != empty:
                yield k, known.number, own.text, known.inside or own.inside


def template(pivot: str, texts: dict[int, int]) -> str:
    """The wrapper: the pivot, with the hashes of those texts that are template."""
    number = -1

    def filled(packed: list) -> list:
        nonlocal number
        number += 1
        label, _, whole, inside, children = packed
        return [label, texts.get(number), whole, inside, [filled(kid) for kid in children]]

    return json.dumps(filled(json.loads(pivot)), separators=(",", ":"))


def learn(pages: list[str]) -> str | None:
    """The wrapper of pages of one layout, or nothing if no text is constant.

    As :func:`wrappers` finds it for each layout of each host: every page with text is
    matched with the pivot, and texts are counted by its nodes.
    """
    found = [(page, layout(parse(page))) for page in sorted(set(pages))]
    known = [(page, own[1]) for page, own in found if own]
    if not known:
        return None
    number = Counter(skeleton for _, skeleton in known)
    pivot = pack_tree(max(known, key=lambda x: number[x[1]])[0])
    counts: Counter = Counter()
    for page, _ in known:
        shape = Shape()
        counts.update(votes([Wrapper(json.loads(pivot), shape, [])], Tree(parse(page), shape), shape))
    texts = {
        node: text
        for (_, node, text, inside), n in counts.items()
        if n >= (INSIDE if inside else OUTSIDE) and n >= AGREEING * len(known)
    }
    return template(pivot, texts) if texts else None


def unwrap(root: Node, *wrappers: str) -> None:
    """Take out of a page the texts that its wrappers have as template in the same place."""
    shape = Shape()
    page = Tree(root, shape)
    found = [
        tree
        for wrapper in wrappers
        for known, tree in align(Wrapper(json.loads(wrapper), shape, []), page, shape)
        if known.text is not None and known.text == tree.text
    ]
    for tree in found:
        # Its own text goes; what it holds besides is judged for itself.
        tree.node.parts = [kid.node for kid in tree.children]


def host(url: str = "url"):
    """The host of a URL in lower case, "" if it has none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _function(each, returns: str, kind: pa.DataType, columns: int = 1):
    """Arrow function of columns, row by row."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for own in batches:
            own = own if isinstance(own, tuple) else (own,)
            yield pa.array([each(*row) for row in zip(*(x.to_pylist() for x in own), strict=True)], kind)

    taken = Iterator[pa.Array] if columns == 1 else Iterator[tuple[(pa.Array,) * columns]]
    rows.__annotations__ = {"batches": taken, "return": Iterator[pa.Array]}
    return F.arrow_udf(rows, returns)


def _laid_out(html, with_text: bool = False):
    """Layout and skeleton of a page's html, null without text; and its text by no wrapper."""
    kind = pa.struct([("layout", pa.int64()), ("skeleton", pa.int64()), ("text", pa.string())])

    def each(html: str | None) -> dict | None:
        if not html:
            return None
        root = parse(html)
        found = layout(root) or (None, None)
        text = main_text(root) if with_text else None
        return dict(zip(("layout", "skeleton", "text"), (*found, text), strict=True))

    return _function(each, "struct<layout:bigint,skeleton:bigint,text:string>", kind)(html)


def _by_layout(pages: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """``pages`` with what is known of each one's host as a whole and, at hosts of several, of its layout."""
    known = known.withColumnRenamed("host", "of")
    whole = known.groupBy("of").agg(
        F.max(F.when(F.col("layout") == -1, F.col(name))).alias("whole"), F.max(F.col("layout") != -1).alias("several")
    )
    own = known.filter("layout <> -1").select("of", F.col("layout").alias("laid"), F.col(name).alias("own"))
    whole, own = broadcast_if_small(whole), broadcast_if_small(own)
    pages = pages.join(whole, F.col("host") == whole["of"], "left").drop("of")
    pages = pages.withColumn("layout", _laid_out(F.when(F.col("several"), F.col("html")))["layout"])
    return pages.join(own, (F.col("host") == own["of"]) & (F.col("layout") == F.col("laid")), "left").drop("of", "laid")


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, hash, layout, skeleton, text``: each page parsed once, stored.

    ``text`` is what the page gives where its host has no wrapper.
    """
    html = F.coalesce("html", F.lit(""))
    first = pages.select("page_id", "url", host().alias("host"), F.xxhash64(html).alias("hash"), _laid_out("html", True).alias("found"))
    return stored(first.select("page_id", "url", "host", "hash", "found.*"), "parsed")


def wrappers(pages: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """``(host, layout, wrapper)`` for layouts with a template; layout -1 is a host's pages together.

    A host of one layout has only the latter.

    Every distinct page with text has a say. A layout's pivot is a page of its commonest
    skeleton, a host's that of its commonest layout. Each page is matched with both, and
    its texts are counted by pivot node; only these counts are shuffled, combined before.
    ``first`` are the pages as :func:`parsed`, if they are at hand.
    """
    keyed = pages.select(host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    keyed = keyed.withColumn("hash", F.xxhash64("html"))
    first = parsed(pages) if first is None else first
    laid = F.first(F.struct("layout", "skeleton")).alias("found")
    distinct = first.filter("layout is not null").groupBy("host", "hash").agg(laid)
    skeletons = distinct.groupBy("host", "found.layout", "found.skeleton").agg(F.count("*").alias("n"), F.min("hash").alias("hash"))
    most = F.max(F.struct("n", "hash"))
    layouts = stored(skeletons.groupBy("host", "layout").agg(F.sum("n").alias("n"), most["hash"].alias("hash")), "layouts")
    whole = layouts.groupBy("host").agg(F.count("*").alias("k"), F.sum("n").alias("n"), most["hash"].alias("hash"))
    several = whole.filter("k > 1").select("host").join(layouts, "host").select("host", "layout", "n", "hash")
    chosen = several.union(whole.select("host", F.lit(-1).cast("long"), "n", "hash")).filter(F.col("n") >= OUTSIDE)
    chosen = stored(chosen, "chosen")
    packed = _function(pack_tree, "string", pa.string())
    same = ["host", "hash"]
    pivots = keyed.join(broadcast_if_small(chosen.select(*same).distinct()), same).groupBy(*same).agg(F.first("html").alias("html"))
    pivots = stored(pivots.select(*same, packed("html").alias("pivot")).join(chosen, same).select("host", "layout", "n", "pivot"), "pivots")

    def vote(html: str, *pivots: str | None) -> list[dict]:
        shape = Shape()
        known = [x and Wrapper(json.loads(x), shape, []) for x in pivots]
        names = ("pivot", "node", "text", "inside")
        return [dict(zip(names, own, strict=True)) for own in votes(known, Tree(parse(html), shape), shape)] if any(known) else []

    fields = [("pivot", pa.int32()), ("node", pa.int32()), ("text", pa.int64()), ("inside", pa.bool_())]
    says = _function(vote, "array<struct<pivot:int,node:int,text:bigint,inside:boolean>>", pa.list_(pa.struct(fields)), 3)
    said = _by_layout(keyed, pivots, "pivot").filter("own is not null or whole is not null")
    said = said.select(*same, "layout", says("html", "own", "whole").alias("votes"))
    said = said.groupBy(*same).agg(F.first(F.struct("layout", "votes")).alias("page"))
    said = said.select("host", F.col("page.layout").alias("layout"), F.explode("page.votes").alias("vote"))
    said = said.select("host", F.when(F.col("vote.pivot") == 0, F.col("layout")).otherwise(-1).alias("layout"), "vote.node", "vote.text", "vote.inside")
    place = ["host", "layout"]
    counts = said.groupBy(*place, "node", "text", "inside").agg(F.count("*").alias("k"))
    counts = counts.filter(F.col("k") >= F.when(F.col("inside"), INSIDE).otherwise(OUTSIDE))
    agreed = counts.join(broadcast_if_small(pivots.select(*place, "n")), place).filter(F.col("k") >= AGREEING * F.col("n"))
    agreed = agreed.groupBy(*place).agg(F.collect_list(F.struct("node", "text")).alias("texts"))

    def fill(pivot: str, texts: list[dict]) -> str:
        return template(pivot, {x["node"]: x["text"] for x in texts})

    filled = _function(fill, "string", pa.string(), 2)("pivot", "texts")
    return pivots.join(agreed, place).select(*place, filled.alias("wrapper"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    ``text`` is the page's main text: the blocks of its article, each with white space
    as single spaces, trimmed, joined by line feeds. Menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles and reader comments are left out by their
    element, role, class or id, and so is what the host's wrapper (:func:`learn`) knows as
    template. Inside an article a text is template only if at least ``INSIDE`` different
    pages have it in the same place. A page without an article gives the blocks of its
    body that vary and are not lists of links.

    Pages are parsed once for their layouts and for the text that they have without a wrapper,
    and once to count what agrees with the pivots; a third time only at hosts with a wrapper. At
    hosts of several layouts each of the latter two parses twice. Only pivots, hashes and
    counts are shuffled. Wrappers are joined by host and layout, and broadcast if they are small.

    A null or empty page has the empty text. Rows keep their number, also when page_ids
    repeat or are null; pages without a host share the host "". Only ``page_id, url`` and
    ``html`` are read.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    first = parsed(pages)
    known = stored(wrappers(pages, first), "wrappers")
    wrapped = broadcast_if_small(known.select("host").distinct())

    def extract(html: str, *own: str | None) -> str:
        root = parse(html)
        if any(own):
            unwrap(root, *filter(None, own))
        return main_text(root)

    text = _function(extract, "string", pa.string(), 3)
    keyed = pages.select("page_id", "url", host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    again = _by_layout(keyed.join(wrapped, "host", "left_semi"), known, "wrapper")
    return (
        first.join(wrapped, "host", "left_anti")
        .select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"))
        .unionByName(again.select("page_id", "url", text("html", "own", "whole").alias("text")))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
