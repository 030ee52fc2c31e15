"""Main text of pages by wrappers inferred from pages of the same host.

A wrapper is a union-free regular expression over nested tags: elements, optional groups ``( )?``, repeated groups ``( )+``, constant
texts and text slots. It starts as one page and is aligned with further ones, one at a time: neighbouring elements of the same
kind fold into a repeated group, an element that one side lacks becomes optional, texts that differ become a slot. A block whose text
is the same on all pages that have its element, three different ones at least, is fixed. What is not fixed says where the host's
pages keep their text: article elements or main elements with half of it, or the innermost element that holds most of it. All elements
at that place are read from every page of the host. A page where they hold less than half of what is not fixed, as one of another
template, is read by the wrapper inferred from itself if that finds more.

Fixed lists of tags and classes (``html_tree.NOT_CONTENT``, ``MARKS``) take away menus, forms, adverts and the like before that.
Fixed blocks are left out of regions other than article and main elements, whose authors have marked the text themselves; a first
heading stays, and so does a text that is fixed as a whole.

Every page has a part in its host's wrapper. A task aligns the pages of a host that it sees; wrappers of many pages are aligned in
``PARTS`` groups by hash first, so that no task has all of a large host. Of at least ``MANY`` pages, optional elements on less than
a hundredth leave the wrapper (their text still counts for what is around them), so that a wrapper does not grow with the host.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .common import record_batch, row_slices
from .html_tree import BLOCK, Element, blocks, measure, parse

#: Levels of elements that an outline has; deeper text counts for its ancestors.
DEPTH = 40
#: Share of a region's text that an element inside needs to be the region itself.
MOST = 0.7
#: Share of the text that is not fixed which article and main elements, or the host's region on a page, hold at least.
SHARE = 0.5
#: Pages a task aligns before it hands the wrappers on.
HELD = 2_000
#: Groups for wrappers of ``SEVERAL`` pages or more of one host.
PARTS, SEVERAL = 32, 8
#: Pages from which rare elements leave a wrapper.
MANY = 100
SLOT = None
#: Different pages that must share a text before it counts as fixed.
CERTAIN = 3
NAMED = ("article", "main")


@dataclass
class Node:
    """Part of a wrapper: an element with the text right inside it, which is a checksum if constant and ``SLOT`` if not.

    ``fixed``: checksums and lengths of whole texts that every page with this element has in it. ``pages``: their number, and
    ``marks`` the smallest ``CERTAIN`` checksums of different pages among them.
    """

    key: str
    text: int | None = 0
    chars: float = 0.0
    optional: bool = False
    repeated: bool = False
    children: list[Node] = field(default_factory=list)
    fixed: dict[int, float] = field(default_factory=dict)
    pages: int = 1
    marks: tuple[int, ...] = ()

    @property
    def tag(self) -> str:
        return tag_of(self.key)

    def packed(self, above: Node | None = None) -> list:
        """As a list; what equals the parent's is left out."""
        seen = 0 if above and (above.pages, above.marks) == (self.pages, self.marks) else [self.pages, *self.marks]
        return [self.key, self.text, self.chars, int(self.optional), int(self.repeated), [c.packed(self) for c in self.children], list(self.fixed.items()), seen]

    @staticmethod
    def unpacked(data: list, above: Node | None = None) -> Node:
        pages, marks = (above.pages, above.marks) if not data[7] else (data[7][0], tuple(data[7][1:]))
        node = Node(*data[:3], bool(data[3]), bool(data[4]), [], dict(data[6]), pages, marks)
        node.children = [Node.unpacked(c, node) for c in data[5]]
        return node

    def loose(self) -> float:
        """Characters that are not fixed."""
        own = self.chars - sum(c.chars for c in self.children)
        left = own + sum(c.loose() for c in self.children)
        return max(0.0, min(left, self.chars - self.pages * sum(self.fixed.values()) if len(self.marks) == CERTAIN else left))

    def __str__(self) -> str:
        inner = ("#TEXT" if self.text is SLOT else "text" if self.text else "") + "".join(map(str, self.children))
        whole = f"<{self.key}>{inner}</{self.tag}>" if self.key else inner
        return f"({whole})" + ("+" if self.repeated else "") + ("?" if self.optional else "") if self.optional or self.repeated else whole


def tag_of(key: str) -> str:
    return key.split(".")[0].split("#")[0]


def outline(element: Element) -> Node:
    """A measured page as a wrapper. Elements that are not content have no part in it."""
    return _outline(element, 0, (element.checksum,))


def _outline(element: Element, depth: int, marks: tuple[int, ...]) -> Node:
    texts = [c.strip() for c in element.children if isinstance(c, str)]
    node = Node(element.key, crc32(" ".join(texts).encode("utf-8", "replace")) if any(texts) else 0, float(element.chars - element.link_chars), marks=marks)
    if element.tag in BLOCK and element.tag not in ("html", "body", "h1"):
        node.fixed = {element.checksum: node.chars}
    if depth < DEPTH:
        node.children = folded([_outline(c, depth + 1, marks) for c in element.children if not isinstance(c, str) and c.content and c.chars])
    return node


def folded(children: list[Node]) -> list[Node]:
    """Neighbours of the same kind on a page become one repeated group."""
    out: list[Node] = []
    for child in children:
        if out and out[-1].key == child.key:
            out[-1] = aligned(out[-1], child, one_page=True)
            out[-1].repeated = True
        else:
            out.append(child)
    return out


def aligned(left: Node, right: Node, one_page: bool = False) -> Node:
    """The wrapper of two parts of the same kind, of different pages or of one; texts' lengths add up."""
    text = left.text if left.text == right.text else SLOT
    node = Node(left.key, text, left.chars + right.chars, left.optional or right.optional, left.repeated or right.repeated, marks=left.marks)
    if one_page:
        node.fixed, node.pages = {k: left.fixed.get(k, 0.0) + right.fixed.get(k, 0.0) for k in {**left.fixed, **right.fixed}}, 1
    else:
        node.fixed = {k: min(n, right.fixed[k]) for k, n in left.fixed.items() if k in right.fixed}
        node.pages, node.marks = left.pages + right.pages, tuple(sorted({*left.marks, *right.marks})[:CERTAIN])
    a, b = left.children, right.children
    if [c.key for c in a] == [c.key for c in b]:
        node.children = [aligned(x, y, one_page) for x, y in zip(a, b)]
        return node
    # Longest common subsequence of kinds.
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].key == b[j].key else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].key == b[j].key:
            node.children.append(aligned(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        else:
            lacks = j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1])
            alone, i, j = (a[i], i + 1, j) if lacks else (b[j], i, j + 1)
            node.children.append(replace(alone, optional=True))
    return node


def pruned(wrapper: Node) -> Node:
    """The wrapper of many pages without elements that few of them have."""
    todo = [wrapper] if wrapper.pages >= MANY else []
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if not c.optional or 100 * c.pages >= node.pages]
        todo += [c for c in node.children if c.pages >= MANY]
    return wrapper


def infer(pages: list[Node]) -> Node:
    """The wrapper of pages or of wrappers, neighbours aligned first so that all have the same weight."""
    while len(pages) > 1:
        pages = [pruned(aligned(*pages[i : i + 2])) if i + 1 < len(pages) else pages[i] for i in range(0, len(pages), 2)]
    return pages[0]


def region_path(wrapper: Node) -> list[str]:
    """Kinds of elements from the root to the region that holds the main text: text that is not fixed, if there is any."""
    weight = Node.loose if wrapper.loose() else lambda node: node.chars
    best: dict[str, tuple[float, list[str]]] = {}
    todo = [(wrapper, [])]
    while todo:
        node, path = todo.pop()
        if node.tag in NAMED and (found := weight(node)) > best.get(node.tag, (0, []))[0]:
            best[node.tag] = (found, path)
        todo += [(c, [*path, c.key]) for c in node.children]
    for tag in NAMED:
        if tag in best and best[tag][0] >= SHARE * weight(wrapper):
            return best[tag][1]
    node, path = wrapper, []
    while inner := max((c for c in node.children if not c.repeated and c.tag not in ("p", "pre", "ul", "ol", "h1")), key=weight, default=None):
        if not weight(inner) or weight(inner) < MOST * weight(node):
            break
        node, path = inner, [*path, inner.key]
    return path


def step(at: int, key: str) -> int:
    """The place of an element below another one's place."""
    return crc32(f"/{key}".encode("utf-8", "replace"), at)


def fixed_blocks(wrapper: Node) -> list[int]:
    """Places and texts of the fixed blocks, as numbers; none if all text is fixed."""
    found: set[int] = set()
    todo = [(wrapper, 0)] if wrapper.loose() else []
    while todo:
        node, at = todo.pop()
        if len(node.marks) == CERTAIN:
            found.update(at << 32 | whole for whole in node.fixed)
        if node.loose():
            todo += [(c, step(at, c.key)) for c in node.children]
    return sorted(found)


def fixed_elements(root: Element, fixed: frozenset[int]) -> list[Element]:
    """The fixed blocks of a page."""
    found, todo = [], [(root, 0, 0)] if fixed else []
    while todo:
        element, at, depth = todo.pop()
        for c in element.children:
            if not isinstance(c, str) and c.content and c.chars and depth < DEPTH:
                below = step(at, c.key)
                if c.tag in BLOCK and below << 32 | c.checksum in fixed:
                    found.append(c)
                else:
                    todo.append((c, below, depth + 1))
    return found


def at_path(root: Element, path: list[str]) -> list[Element]:
    """All elements that the path leads to."""
    here = [root]
    for key in path:
        here = [c for e in here for c in e.children if not isinstance(c, str) and c.key == key and c.content]
    return here


def own_chars(elements: list[Element]) -> int:
    return sum(e.chars - e.link_chars for e in elements)


def main_text(html: str | None, known: dict | None) -> str:
    """The main text; ``known``: the path of the host's region and its fixed blocks, None if nothing is known of the host."""
    root = parse(html)
    measure(root)
    gone = fixed_elements(root, frozenset(known["fixed"])) if known else []
    if own_chars(gone) >= own_chars([root]):
        gone = []

    def mark(content: bool) -> None:
        for element in gone:
            element.content = content
        if gone:
            measure(root)

    mark(False)
    path = known["path"] if known else []
    regions = at_path(root, path) if known else []
    held = own_chars(regions)
    if not sum(e.chars for e in regions) or held < SHARE * own_chars([root]):
        own = region_path(outline(root))
        found = at_path(root, own) or [root]
        if not regions or own_chars(found) > held or (own_chars(found) == held and sum(e.chars for e in found) > sum(e.chars for e in regions)):
            path, regions = own, found
    if any(tag_of(k) in NAMED for k in path):
        mark(True)
        regions = at_path(root, path)
    return "\n".join(text for region in regions for text in blocks(region))


def host_of(url: Column) -> Column:
    """Host in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


OUTLINES = pa.schema([("host", pa.string()), ("part", pa.int32()), ("outline", pa.string())])
OUTLINES_SQL = "host string, part int, outline string"


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, region)`` for every host of ``pages`` (host, hash, html); region is its path and the fixed blocks as JSON."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, Node]] = {}
        taken = 0

        def out() -> pa.RecordBatch:
            rows = [(host, hashed % PARTS if w.pages >= SEVERAL else 0, json.dumps(pruned(w).packed(), separators=(",", ":"))) for host, (hashed, w) in held.items()]
            return record_batch(OUTLINES, list(zip(*rows)) or [[]] * len(OUTLINES))

        for hosts, hashes, htmls in row_slices(batches):
            for host, hashed, html in zip(hosts, hashes, htmls):
                root = parse(html)
                measure(root)
                page = outline(root)
                held[host] = (held[host][0], aligned(held[host][1], page)) if host in held else (hashed, page)
            taken += len(hosts)
            if taken >= HELD:
                yield out()
                held.clear()
                taken = 0
        yield out()

    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("region", pa.string())])

    def infer_all(some: list[str]) -> Node:
        return infer([Node.unpacked(json.loads(o)) for o in sorted(some)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hosts, outlines in row_slices(batches, 32):
            yield record_batch(OUTLINES, [hosts, [0] * len(hosts), [o[0] if len(o) == 1 else json.dumps(infer_all(o).packed(), separators=(",", ":")) for o in outlines]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hosts, outlines in row_slices(batches, 32):
            made = [infer_all(o) for o in outlines]
            regions = [json.dumps({"path": region_path(m), "fixed": fixed_blocks(m)}) for m in made]
            yield record_batch(schema, [hosts, list(map(str, made)), regions])

    taken = pages.select("host", "hash", "html").mapInArrow(align, OUTLINES_SQL)
    parts = taken.groupBy("host", "part").agg(F.collect_list("outline").alias("outlines")).select("host", "outlines").mapInArrow(merge, OUTLINES_SQL)
    return parts.groupBy("host").agg(F.collect_list("outline").alias("outlines")).mapInArrow(build, "host string, wrapper string, region string")


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. ``known``: wrappers to use, else they are inferred from ``pages``.

    A null or empty html has an empty text; a null url belongs to the host without a name. Ids may be null or repeat. Other columns
    are not read.
    """
    hosted = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"),
        F.xxhash64("page_id", "url").alias("hash"),
    )
    regions = materialize((known if known is not None else wrappers(hosted)).select(F.col("host").alias("of"), "region"), "regions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, htmls, paths in row_slices(batches):
            texts = [main_text(h, None if p is None else json.loads(p)) for h, p in zip(htmls, paths)]
            yield record_batch(TEXTS, [ids, urls, texts, [len(t) for t in texts]])

    joined = hosted.join(regions, F.col("host") == F.col("of"), "left")
    return joined.select("page_id", "url", "html", "region").mapInArrow(run, "page_id long, url string, text string, n_chars long")
