"""N-gram Jaccard join: sets of word windows linked at a Jaccard similarity, by count vectors.

Tokens (hashes of word windows) are hashed into groups. A set is a point of group counts; points are kept in R-trees, which
prune by the sum of coordinate minima, and pairs that survive are verified on the whole sets.

In as many dimensions as texts need, one tree over a corpus prunes nothing near its root, so the points are first
dealt out by the groups themselves. Two linked sets differ in at most ``d`` tokens, ``d`` following from their size; with more than
``d`` groups some group has the very same tokens in both. The key of a group's content therefore brings linked sets together:
classes of sizes have their own number of groups, larger sets also use that of the class below, and three or more
groups beyond ``d + 1`` make sure that an agreeing group is not an empty one (sets with more empty groups than that share a
key of their own). Keys travel once, 13 bytes each with their set, dealt to 4,096 parts by their first bits; a part is sorted by one task, which
drops the keys that occur once. Each of the others is a block with its own tree. 44 bits of a key are compared: what agrees by chance is one more
candidate.

Blocks that share sets form clusters. A cluster that fits a page is linked in one task: its sets come there once, the tree
proposes partners, and sets that are already connected are not compared. In a larger cluster links come from its blocks, page
by page, in the form of ids and packed count vectors: each point proposes its best partner, which connects groups of copies
without listing their pairs, and a text travels once to the partner it is compared with. Blocks left in several components are compared
whole, and what leaves a task is a spanning forest. Equal sets are one point from the start, so no link is lost and none is
listed twice.

Texts and count vectors travel packed; what is written in between is deleted at the end.

Sets and contents are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize, scratch_scope

from .common import partitions, record_batch, row_slices
from .components import components
from .count_tree import CountTree
from .words import ODD, mixed, shingle_sets

WINDOW = 4
SHARE = (85, 100)
#: Groups of a count vector, at least and at most; in between about half as many as tokens, a power of two.
GROUPS = (32, 8192)
#: Blocks of at most so many sets give all their pairs within the bound.
SMALL_BLOCK = 8
#: Grades of a partner between no and whole overlap (which is half of both sizes).
STEPS = 400
#: Points of a page, and tokens of all its sets, about.
PAGE_POINTS, PAGE_TOKENS = 512, 400_000
#: What is broadcast has so many rows, and with the lists in them so many bytes, at most; more is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 8 << 20
#: Keys that are packed together, and sets that a task remembers so that it gives their keys once.
PACKED_KEYS, KNOWN_SETS = 1 << 18, 1 << 16


def _upper(j: int, k: int) -> int:
    return (j << 64) // k


@cache
def _bounds(k: int) -> np.ndarray:
    """Where the ``k`` groups of hash values begin."""
    return np.array([_upper(j, k) for j in range(k)], np.uint64)


@cache
def _classes(share: tuple[int, int]) -> list[int]:
    """Smallest sizes of the size classes; a partner is never more than one class away."""
    sizes = [1]
    while sizes[-1] < 1 << 40:
        sizes.append(max(sizes[-1] + 1, -(-sizes[-1] * max(140, 100 * share[1] // share[0] + 1) // 100)))
    return sizes


@cache
def _groups(size_class: int, share: tuple[int, int]) -> tuple[int, int, np.uint64]:
    """Number of groups of a class, how many may be empty, and its tag. No groups: only equal sets are linked."""
    largest = _classes(share)[size_class + 1] - 1
    differing = largest * (share[1] - share[0]) // share[0]
    spare = 3 + differing // 12
    tag = mixed(np.array([size_class + 1], np.uint64) * ODD[10])[0]
    return (differing + 1 + spare if differing else 0), spare, tag


def group_keys(tokens: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray:
    """Keys under which a set (sorted token hashes) can meet every set it may be linked with."""
    return keys_of([tokens], share)[0]


def keys_of(sets: list[np.ndarray], share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of several sets, and the number of the set that each belongs to."""
    sizes, counts = _classes(share), np.array(list(map(len, sets)), np.int64)
    own = np.searchsorted(sizes, counts, side="right") - 1
    # a set and a class, with the class's number of groups, how many may be empty, and its tag
    uses = [(i, c) for i, (n, o) in enumerate(zip(counts.tolist(), own.tolist())) if n for c in ((o, o - 1) if o and share[0] * n <= share[1] * (sizes[o] - 1) else (o,))]
    uses = [(i, *_groups(c, share)) for i, c in uses]
    uses = [use for use in uses if use[1]]
    if not uses:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number, groups, spare = (np.array(c, np.int64) for c in list(zip(*uses))[:3])
    tags = np.array([use[3] for use in uses], np.uint64)
    lengths = counts[number]
    tokens = np.concatenate([sets[i] for i in number.tolist()])
    k = np.repeat(groups.astype(np.uint64), lengths)
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    # tokens * k / 2**64: groups are ranges of hashes
    group = ((tokens >> half) * k + ((tokens & low) * k >> half)) >> half
    starts = np.append(0, np.cumsum(lengths)[:-1])
    begins = np.append(True, group[1:] != group[:-1])
    begins[starts] = True
    at = np.flatnonzero(begins)
    use = np.searchsorted(starts, at, side="right") - 1
    content = np.add.reduceat(mixed(tokens ^ ODD[11]), at)
    keys = mixed(content + mixed(tags[use] + group[at] * ODD[12]))
    sparse = groups - np.bincount(use, minlength=len(uses)) > spare
    return np.concatenate([keys, tags[sparse]]), np.concatenate([number[use], number[sparse]])


def set_id(tokens: np.ndarray) -> int:
    """Identifies a set; 0 for the empty one."""
    return set_ids([tokens])[0]


def set_ids(sets: list[np.ndarray]) -> list[int]:
    """``set_id`` of several sets."""
    counts = np.array(list(map(len, sets)), np.int64)
    sums = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.append(0, np.cumsum(counts[full])[:-1])
        sums[full] = np.add.reduceat(mixed(np.concatenate(sets) ^ ODD[13]), starts)
    ids = mixed(sums + counts.astype(np.uint64)).view(np.int64)
    ids[ids == 0] = 1
    ids[counts == 0] = 0
    return ids.tolist()


def group_counts(tokens: np.ndarray) -> bytes:
    groups = min(GROUPS[1], max(GROUPS[0], 1 << max(0, len(tokens) // 2 - 1).bit_length()))
    starts = np.searchsorted(tokens, _bounds(groups))
    return np.diff(starts, append=len(tokens)).astype("<u2").tobytes()


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int]) -> bool:
    """Jaccard similarity of two sorted sets, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return share[1] * both >= share[0] * (len(a) + len(b) - both)


DESCRIBED = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64())])


def described(docs: DataFrame, window: int) -> DataFrame:
    """``(id, tag, n_shingles, set_id)`` of rows (id, text, tag)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, tags in row_slices(batches):
            sets = shingle_sets(texts, window)
            yield record_batch(DESCRIBED, [ids, tags, list(map(len, sets)), set_ids(sets)])

    return docs.mapInArrow(run, "id long, tag long, n_shingles long, set_id long")


#: A key in a part of all keys, the set it belongs to, and the size class of that.
ENTRY = np.dtype([("key", "<u4"), ("set", "<i8"), ("size", "u1")])


def _cells(keys: np.ndarray, owners: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
    """``(part, entries)`` of keys, their sets and the size classes of these. A part is 12 bits of the key, an entry holds 32 more."""
    order = np.argsort(keys)
    every = keys[order]
    entries = np.empty(len(every), ENTRY)
    entries["key"] = every >> np.uint64(20) & np.uint64(0xFFFFFFFF)
    entries["set"], entries["size"] = owners[order], classes[order]
    parts, starts = np.unique((every >> np.uint64(52)).astype(np.int32), return_index=True)
    ends = np.append(starts, len(every)).astype(np.int32) * ENTRY.itemsize
    cells = pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(entries.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(parts), cells], names=["part", "entries"])


def keyed(docs: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """``(part, entries)``: every key of every set, packed; equal sets near each other give theirs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _classes(share)
        cells, held, done = [], 0, set()
        for _, texts, _ in row_slices(batches):
            sets = shingle_sets(texts, window)
            fresh = {i: s for i, s in zip(set_ids(sets), sets) if i not in done}
            done.update(fresh)
            keys, number = keys_of(list(fresh.values()), share)
            ids = np.fromiter(fresh, np.int64, len(fresh))
            classes = np.searchsorted(sizes, list(map(len, fresh.values())), side="right").astype(np.uint8)
            cells.append((keys, ids[number], classes[number]))
            held += len(keys)
            if held >= PACKED_KEYS:
                yield _cells(*map(np.concatenate, zip(*cells)))
                cells, held = [], 0
            if len(done) > KNOWN_SETS:
                done.clear()
        if held:
            yield _cells(*map(np.concatenate, zip(*cells)))

    return docs.mapInArrow(run, "part int, entries binary")


def repeated_keys(cells: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(key, pivot, set_id, n)`` for the keys of several sets: their sets, the smallest of these, and the most tokens of the set's size class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.array(_classes(share)) - 1
        for rows in _runs(batches, ["part"]):
            entries = np.concatenate([np.frombuffer(c.as_buffer(), ENTRY) for r in rows for c in r.column("entries")])
            order = np.lexsort((entries["set"], entries["key"]))
            keys, sets = entries["key"][order], entries["set"][order]
            once = np.append(True, (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1]))
            keys, sets, order = keys[once], sets[once], order[once]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(starts, append=len(keys))
            pivots, kept = np.repeat(sets[starts], counts), np.repeat(counts > 1, counts)
            named = keys[kept].astype(np.int64) | rows[0].column("part")[0].as_py() << 32
            columns = [named, pivots[kept], sets[kept], most[entries["size"][order][kept]]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["key", "pivot", "set_id", "n"])

    dealt = cells.repartition(partitions(cells), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "key long, pivot long, set_id long, n long")


def _within(rows: DataFrame, few: DataFrame, on: str, how: str = "inner", listed: Column | None = None) -> DataFrame:
    """Join with a table that is broadcast if it is small; it has been written, so measuring it is cheap. ``listed``: bytes of a row's lists."""
    # beside the values a row has a null bitmap and two words in the hash table
    width = F.lit(8 * (len(few.columns) + 3)) + (F.lit(0) if listed is None else listed)
    size = few.agg(F.count("*").alias("rows"), F.sum(width.cast("long")).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(few) if small else few.hint("shuffle_merge"), on, how)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """Rows with the same values in ``names``, which come together, as lists of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = values[start].tolist()
            if held and key != last:
                yield held
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield held


def _column(run: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in run])


def _vectors(run: list[pa.RecordBatch]) -> np.ndarray:
    return _folded([zlib.decompress(v) for b in run for v in b.column("counts").to_pylist()])


def _folded(counts: list[bytes]) -> np.ndarray:
    """Count vectors as a matrix; groups are ranges of hashes, so longer vectors fold into fewer groups by adding neighbours."""
    own = [np.frombuffer(v, "<u2").astype(np.int64) for v in counts]
    fewest = min(map(len, own))
    return np.stack([v if len(v) == fewest else v.reshape(fewest, -1).sum(axis=1) for v in own])


def block_pairs(ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, share: tuple[int, int], every: bool) -> list[tuple[int, int]]:
    """Candidates of one page: pairs within the bound, all or for each point the best with a point before it."""
    tree, found = CountTree(counts, sizes, share), []
    for i in range(1, len(ids)):
        best = None
        for others, bound in tree.leaves(tree.counts[i], int(sizes[i])):
            usable = others < i
            if every:
                found += [(int(ids[j]), int(ids[i])) for j in others[usable]]
            elif usable.any():
                # Of about equally good partners the first, so that blocks with the same sets agree.
                grade = np.floor(STEPS * bound[usable] / (sizes[others[usable]] + sizes[i]))
                top = (float(grade.max()), -int(others[usable][grade == grade.max()].min()))
                best = top if best is None else max(best, top)
        if best is not None:
            found.append((int(ids[-best[1]]), int(ids[i])))
    return found


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return record_batch(PAIRS, list(zip(*((min(p), max(p)) for p in pairs))) or [[], []])


TEXTS = pa.schema([("set_id", pa.int64()), ("text", pa.binary())])


def texts_of(docs: DataFrame, sets: DataFrame, points: DataFrame, window: int) -> DataFrame:
    """``(set_id, cluster, pages, text)`` for the points (set_id, cluster, pages), one packed text each or a few equal ones.

    Documents are found by id, or by their set where that is null.
    """
    chosen = materialize(sets.join(points, "set_id").select("set_id", F.col("first.id").alias("id"), "cluster", "pages"), "wanted")
    by_id = _within(docs, chosen.where("id IS NOT NULL").select("id").distinct(), "id", "left_semi")
    rows = by_id if chosen.where("id IS NULL").isEmpty() else by_id.unionByName(docs.where("id IS NULL"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in row_slices(batches):
            yield record_batch(TEXTS, [set_ids(shingle_sets(texts, window)), [zlib.compress((t or "").encode(), 1) for t in texts]])

    found = rows.select("id", "text").mapInArrow(run, "set_id long, text binary")
    return _within(found, chosen.select("set_id", "cluster", "pages"), "set_id").select("set_id", "cluster", "pages", "text")


def _tokens_of(rows: list[pa.RecordBatch], window: int) -> list[np.ndarray]:
    """Tokens of packed texts."""
    return shingle_sets([zlib.decompress(t.as_py()).decode() for r in rows for t in r.column("text")], window)


def _sets_of(rows: list[pa.RecordBatch], window: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ids, tokens and count vectors of rows sorted by ``set_id``, every set once."""
    ids = _column(rows, "set_id")
    once = np.append(True, ids[1:] != ids[:-1])
    tokens = [t for t, first in zip(_tokens_of(rows, window), once) if first]
    return ids[once], tokens, _folded([group_counts(t) for t in tokens])


def star_links(pairs: DataFrame, texts: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """Those of the pairs (a, b) that are linked. A text goes where it is the ``b`` of a pair once, and to every page of the pairs of an ``a``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["a", "page"]):
            hub, ids = rows[0].column("a")[0].as_py(), _column(rows, "set_id").tolist()
            tokens = dict(zip(ids, _tokens_of(rows, window)))
            yield _pair_batch([(hub, i) for i, own in tokens.items() if i != hub and linked(tokens[hub], own, share)])

    sizes = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / PAGE_POINTS).cast("int").alias("pages")), "hubs")
    placed = _within(pairs, sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("pages")).cast("int").alias("page"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"), F.col("a").alias("set_id"))
    rows = placed.select("a", "page", F.col("b").alias("set_id")).unionByName(hubs)
    rows = materialize(rows, "hubs-and-partners")
    dealt = _within(texts, rows, "set_id").select("a", "page", "set_id", "text").repartition(partitions(rows), "a", "page")
    return dealt.sortWithinPartitions("a", "page", "set_id").mapInArrow(run, "a long, b long")


def cluster_links(clustered: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """A spanning forest of the links within each cluster, from rows (cluster, set_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["cluster"]):
            ids, tokens, counts = _sets_of(rows, window)
            tree, found, label = CountTree(counts, np.array([len(t) for t in tokens]), share), [], np.arange(len(ids))
            for i in range(1, len(ids)):
                for j in _partners(tree, i, label, None):
                    if linked(tokens[i], tokens[j], share):
                        found.append((int(ids[i]), int(ids[j])))
                        label[label == max(label[i], label[j])] = min(label[i], label[j])
            yield _pair_batch(found)

    dealt = clustered.select("cluster", "set_id", "text").repartition(partitions(clustered), "cluster").sortWithinPartitions("cluster", "set_id")
    return dealt.mapInArrow(run, "a long, b long")


def proposals(points: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs to verify, distinct, from ``points`` (key, page, block_size, pivot, set_id, n, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[int, int]] = set()
        for rows in _runs(batches, ["key", "page"]):
            ids = _column(rows, "set_id")
            size, pivot = int(rows[0].column("block_size")[0].as_py()), int(rows[0].column("pivot")[0].as_py())
            pairs.update(block_pairs(ids, _column(rows, "n"), _vectors(rows), share, size <= SMALL_BLOCK))
            if int(ids[0]) != pivot and size > SMALL_BLOCK:
                pairs.add((pivot, int(ids[0])))
            if len(pairs) > 50_000:
                yield _pair_batch(list(pairs))
                pairs.clear()
        yield _pair_batch(list(pairs))

    dealt = points.repartition(partitions(points), "key", "page").sortWithinPartitions("key", "page", "set_id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


PLACED = "key long, low int, high int, page int, set_id long, label long"
PLACED_COLUMNS = ["key", "low", "high", "page", "set_id", "label"]


def _dealt(placed: DataFrame) -> DataFrame:
    return placed.repartition(partitions(placed), "key", "low", "high").sortWithinPartitions("key", "low", "high", "set_id")


def _partners(tree: CountTree, i: int, label: np.ndarray, page: np.ndarray | None) -> Iterator[int]:
    """Points before ``i`` within the bound that have another label when their turn comes, and are of another page if pages are given."""
    same = lambda s, e: bool((label[tree.order[s:e]] == label[i]).all())
    for others, _ in tree.leaves(tree.counts[i], int(tree.sizes[i]), same):
        for j in others[others < i].tolist():
            if label[j] != label[i] and (page is None or page[i] != page[j]):
                yield j


def _placed(places: DataFrame, sets: DataFrame) -> DataFrame:
    """Places of sets (set_id, ..) with what is known of the set; it meets a set's places once, however many they are."""
    names = [c for c in places.columns if c != "set_id"]
    per_set = places.groupBy("set_id").agg(F.collect_list(F.struct(*names)).alias("_places"))
    listed = F.size("_places") * (8 * (len(names) + 2))
    return _within(sets, materialize(per_set, "places"), "set_id", listed=listed).withColumn("_place", F.explode("_places")).select("_place.*", *sets.columns)


VECTORS = pa.schema([("set_id", pa.int64()), ("n", pa.int64()), ("counts", pa.binary())])


def vectors_of(texts: DataFrame, window: int) -> DataFrame:
    """``(set_id, n, counts)`` of rows (set_id, text); most counts are small, so they are packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in row_slices(batches):
            tokens = shingle_sets([zlib.decompress(t).decode() for t in texts], window)
            yield record_batch(VECTORS, [ids, list(map(len, tokens)), [zlib.compress(group_counts(t), 1) for t in tokens]])

    return texts.select("set_id", "text").mapInArrow(run, "set_id long, n long, counts binary")


def rest_links(active: DataFrame, vectors: DataFrame, texts: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """Links between different labels within blocks (key, page, pages, set_id, label): a spanning forest per pair of pages.

    Points without a partner of another label within the bound are dropped before texts are fetched.
    """

    def pages_of(rows: list[pa.RecordBatch]) -> np.ndarray | None:
        return None if rows[0].column("low")[0] == rows[0].column("high")[0] else _column(rows, "page")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["key", "low", "high"]):
            label, page = _column(rows, "label"), pages_of(rows)
            wanted = np.zeros(len(label), bool)
            if (label != label[0]).any():
                tree = CountTree(_vectors(rows), _column(rows, "n"), share)
                for i in range(1, len(label)):
                    for others, _ in tree.leaves(tree.counts[i], int(tree.sizes[i])):
                        usable = others[label[others] != label[i]] if page is None else others[(label[others] != label[i]) & (page[others] != page[i])]
                        wanted[usable] = True
                        wanted[i] |= len(usable) > 0
            start = 0
            for batch in rows:
                yield batch.select(PLACED_COLUMNS).filter(pa.array(wanted[start : start + batch.num_rows]))
                start += batch.num_rows

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["key", "low", "high"]):
            ids, label, page, found = _column(rows, "set_id"), _column(rows, "label").copy(), pages_of(rows), []
            tokens = _tokens_of(rows, window)
            tree = CountTree(_folded([group_counts(t) for t in tokens]), np.array([len(t) for t in tokens]), share)
            for i in range(1, len(ids)):
                for j in _partners(tree, i, label, page):
                    if linked(tokens[i], tokens[j], share):
                        found.append((int(ids[i]), int(ids[j])))
                        label[label == max(label[i], label[j])] = min(label[i], label[j])
            yield _pair_batch(found)

    placed = _placed(active, vectors)
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    spread = spread.withColumns({"low": F.least("page", "other"), "high": F.greatest("page", "other")}).select(*PLACED_COLUMNS, "n", "counts")
    kept = materialize(_dealt(spread).mapInArrow(needed, PLACED), "rest-points")
    return _dealt(_placed(kept, texts.select("set_id", "text")).select(*PLACED_COLUMNS, "text")).mapInArrow(link, "a long, b long")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per document: id, n_shingles, and component_id, the smallest id reachable by links.

    Words are runs of other characters than space and controls 9-13, in lower case (A-Z only); a text of fewer than ``window`` words is one
    window, one without words has no windows and is linked with nothing. Two sets are linked when
    ``share[1] * intersection >= share[0] * union``. A null id is never the smallest; it stands for itself if all ids of its component are null.
    Ids may repeat: each row is a document. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.lit(None).cast("long").alias("tag"))
    known, rooted = _rooted_sets(rows, window, share)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    final = rooted.join(smallest, "root").select(F.col("set_id").alias("of"), F.col("least.id").alias("component_id"))
    return known.join(final, F.col("set_id") == F.col("of"), "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("set_id") != 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def _rooted_sets(docs: DataFrame, window: int, share: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """``(id, tag, n_shingles, set_id)`` of rows (id, text, tag), and ``(set_id, first, root)`` of every set: the least of its rows
    by id and tag, those without an id last, and the smallest set of its component. All else that was written is deleted."""
    with scratch_scope(docs.sparkSession):
        known = materialize(described(docs, window), "known", keep=True)
        # Keys are many times more than documents: they travel once, packed, and are never stored.
        members = materialize(repeated_keys(keyed(docs, window, share), share), "members")
        row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "tag")
        sets = known.where("set_id <> 0").groupBy("set_id").agg(F.min(row).alias("first"), F.first("n_shingles").alias("n"))
        sets = materialize(sets, "sets")
        found = components(set_links(docs, sets, members, window, share))
        joined = sets.select("set_id", "first").join(found.select(F.col("vertex").alias("set_id"), "root"), "set_id", "left")
        rooted = materialize(joined.select("set_id", "first", F.coalesce("root", "set_id").alias("root")), "rooted", keep=True)
    return known, rooted


def set_links(docs: DataFrame, sets: DataFrame, members: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """``(a, b)``: links that connect every component, from rows (id, text, tag), their sets, and the sets under repeated keys (key, pivot, set_id)."""
    clusters = components(members.where("pivot <> set_id").select(F.col("pivot").alias("a"), F.col("set_id").alias("b")))
    ends = members.select("set_id").distinct().join(clusters.select(F.col("vertex").alias("set_id"), "root"), "set_id", "left")
    ends = ends.select("set_id", F.coalesce("root", "set_id").alias("cluster")).join(sets.select("set_id", "n"), "set_id")
    points = materialize(ends, "points")
    spread = points.groupBy("cluster").agg(_pages(F.count("*"), F.sum("n")).alias("pages"))
    points = materialize(points.join(spread, "cluster").select("set_id", "cluster", "pages", "n"), "paged-points")
    texts = materialize(texts_of(docs, sets, points.select("set_id", "cluster", "pages"), window), "texts")
    links = materialize(cluster_links(texts.where("pages = 1"), window, share), "cluster-links")
    large = points.where("pages > 1").select("set_id")
    if large.isEmpty():
        return links
    own = texts.where("pages > 1").select("set_id", "text")
    # rows with the same id bring a text several times; texts are shuffled only then
    if not own.groupBy("set_id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        own = materialize(own.groupBy("set_id").agg(F.min("text").alias("text")), "large-texts")
    return links.unionByName(_large_links(members.select("key", "set_id", "n"), large, own, window, share))


def _pages(points: Column, tokens: Column) -> Column:
    return F.greatest(F.ceil(points / PAGE_POINTS), F.ceil(tokens / PAGE_TOKENS)).cast("int")


def _large_links(members: DataFrame, large: DataFrame, texts: DataFrame, window: int, share: tuple[int, int]) -> DataFrame:
    """Links within clusters of several pages."""
    inside = members.join(large, "set_id", "left_semi")
    prints = inside.groupBy("key").agg(F.count("*").alias("block_size"), F.sum("n").alias("tokens"), F.min("set_id").alias("pivot"), F.expr("bit_xor(xxhash64(set_id))").alias("print"))
    # Of blocks with the same sets one is enough.
    blocks = prints.groupBy("print", "block_size").agg(F.min(F.struct("key", "tokens", "pivot")).alias("one")).where("block_size > 1")
    pages = _pages(F.col("block_size"), F.col("one.tokens")).alias("pages")
    blocks = materialize(blocks.select("one.key", "one.pivot", "block_size", pages), "distinct-blocks")
    page = F.pmod(F.xxhash64("set_id"), F.col("pages")).cast("int").alias("page")
    rows = materialize(_within(inside.select("key", "set_id"), blocks, "key").select("*", page), "blocks")
    vectors = materialize(vectors_of(texts, window), "vectors")
    pairs = materialize(proposals(_placed(rows, vectors), share), "proposals")
    links = materialize(star_links(pairs, texts, window, share), "links")
    labels = components(links).select(F.col("vertex").alias("set_id"), "root")
    labelled = rows.join(labels, "set_id", "left").withColumn("label", F.coalesce("root", "set_id")).drop("root")
    several = labelled.where((F.col("block_size") > SMALL_BLOCK) | (F.col("pages") > 1)).groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    several = materialize(several.where("low < high").select("key"), "active-blocks")
    active = materialize(_within(labelled, several, "key", "left_semi").select("key", "set_id", "label", "pages", "page"), "active")
    return links.unionByName(materialize(rest_links(active, vectors, texts, window, share), "rest-links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, share: tuple[int, int] = SHARE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, of rows that share it one, and one without an id only if all are.

    Documents without words are linked with nothing and stay. The rows are written once with a tag that tells them apart.
    """
    tag = "_row"
    while tag in {c.lower() for c in docs.columns}:
        tag += "_"
    tagged = materialize(docs.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    rows = tagged.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(tag).alias("tag"))
    known, rooted = _rooted_sets(rows, window, share)
    kept = rooted.groupBy("root").agg(F.min("first").alias("least")).select("least.tag")
    kept = materialize(kept.unionByName(known.where("set_id = 0").select("tag")).select(F.col("tag").alias(tag)), "kept")
    return tagged.join(kept, tag, "left_semi").drop(tag)
