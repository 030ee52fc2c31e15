"""Byte-level BPE: merging by a segment tree over byte positions, for many words at once.

The leaves of a word's tree are its byte positions; a leaf holds the rank of the pair made of the live token that starts there
and its live right neighbour. Inner nodes hold the smaller rank, the left one on ties, so the root names the leftmost
pair of minimum rank. A merge writes three leaves (the merged token, its left neighbour, and the position that
dies) and repairs the paths to the root: logarithmic work per merge, ``n log n`` for a word of ``n`` bytes.

Short words are merged together as numpy arrays, one tree per row; long ones one by one. Texts are cut at spaces; the
ids of a piece between spaces are remembered per worker up to a bounded number of pieces, which changes time only.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, row_slices

#: Pieces and words remembered by a worker; when full, the memory is emptied and fills again.
REMEMBERED = 700_000
#: Words of at most so many bytes are merged together.
SHORT_BYTES = 64
NONE = np.int64(1 << 40)
#: Texts of more characters are matched as a whole, so that what is remembered stays small.
LONG_TEXT = 1 << 22
#: Pieces of more characters are not remembered.
LONG_PIECE = 1_000
#: A space before white space or at the end; the first forms cover ASCII texts and are quicker to search.
UNSAFE_ASCII = ("  ", *(" " + c for c in "\t\n\v\f\r\x1c\x1d\x1e\x1f"))
UNSAFE = re.compile(r" (?:\s|$)")


class Ranks:
    """Vocabulary of a rank file: token bytes by id, and the merge table of all pairs of tokens that make a token.

    Ids and ranks are the same numbers. The merge table is sorted by ``left id << 32 | right id``.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        self.decimal = [str(i) for i in range(len(self.tokens))]
        pairs = [
            (left << 32 | right, rank)
            for token, rank in self.ids.items()
            for cut in range(1, len(token))
            if (left := self.ids.get(token[:cut])) is not None and (right := self.ids.get(token[cut:])) is not None
        ]
        pairs.sort()
        self.pairs = dict(pairs)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)


@cache
def ranks(path: str) -> Ranks:
    return Ranks(path)


def merge_long(word: bytes, table: Ranks) -> list[int]:
    """Ids of one word of any length."""
    size = 1 << max(1, (len(word) - 1).bit_length())
    none, pairs = int(NONE), table.pairs
    token = [int(table.byte_ids[b]) for b in word]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    # A node holds rank * size + position, so the minimum is the leftmost pair of minimum rank.
    tree = [none] * (2 * size)
    for i in range(len(word) - 1):
        rank = pairs.get(token[i] << 32 | token[i + 1])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(position: int, value: int) -> None:
        node = size + position
        tree[node] = value
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    def refresh(position: int) -> None:
        right = after[position]
        rank = pairs.get(token[position] << 32 | token[right]) if right < len(word) else None
        put(position, none if rank is None else rank * size + position)

    while tree[1] != none:
        rank, i = divmod(tree[1], size)
        gone = after[i]
        token[i], after[i] = rank, after[gone]
        if after[i] < len(word):
            before[after[i]] = i
        put(gone, none)
        refresh(i)
        if before[i] >= 0:
            refresh(before[i])
    ids, i = [], 0
    while i < len(word):
        ids.append(token[i])
        i = after[i]
    return ids


def merge_short(words: list[bytes], table: Ranks) -> list[list[int]]:
    """Ids of many words of similar length: row ``r`` of every array belongs to word ``r``."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    size = 1 << max(1, (width - 1).bit_length())
    rows = np.arange(len(words))
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    token = table.byte_ids[flat]
    after = np.tile(np.arange(1, width + 1), (len(words), 1))
    before = np.tile(np.arange(-1, width - 1), (len(words), 1))
    leaves = np.full((len(words), size), NONE)
    if width > 1:
        rank = table.rank_of(token[:, :-1], token[:, 1:])
        inside = np.arange(1, width)[None, :] < lengths[:, None]
        leaves[:, : width - 1] = np.where(inside & (rank < NONE), rank * size + np.arange(width - 1), NONE)
    tree = np.full((len(words), 2 * size), NONE)
    tree[:, size:] = leaves
    level = size
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    def put(row: np.ndarray, position: np.ndarray, value: np.ndarray) -> None:
        node = size + position
        tree[row, node] = value
        node = node >> 1
        while node[0]:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node = node >> 1

    def refresh(row: np.ndarray, position: np.ndarray) -> None:
        right = after[row, position]
        inside = right < lengths[row]
        rank = table.rank_of(token[row, position], token[row, np.minimum(right, width - 1)])
        put(row, position, np.where(inside & (rank < NONE), rank * size + position, NONE))

    live = rows[tree[:, 1] < NONE]
    while len(live):
        rank, i = np.divmod(tree[live, 1], size)
        gone = after[live, i]
        following = after[live, gone]
        token[live, i], after[live, i] = rank, following
        linked = following < lengths[live]
        before[live[linked], following[linked]] = i[linked]
        put(live, gone, np.full(len(live), NONE))
        refresh(live, i)
        left = before[live, i]
        if len(has := np.flatnonzero(left >= 0)):
            refresh(live[has], left[has])
        live = live[tree[live, 1] < NONE]
    # A position is live if some other live one points at it; position 0 always is.
    alive = np.zeros((len(words), width + 1), bool)
    at, row = np.zeros(len(words), np.int64), rows
    while len(row):
        alive[row, at] = True
        at = after[row, at]
        more = at < lengths[row]
        row, at = row[more], at[more]
    kept = token[alive[:, :width]].tolist()
    ends = np.cumsum(alive.sum(axis=1)).tolist()
    return [kept[a:b] for a, b in zip([0, *ends], ends)]


def merge_words(words: list[bytes], table: Ranks) -> list[list[int]]:
    """Ids of each word. Words that are tokens, empty or long are dealt with one by one."""
    out: list[list[int]] = [[]] * len(words)
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if (known := table.ids.get(word)) is not None:
            out[i] = [known]
        elif len(word) > SHORT_BYTES:
            out[i] = merge_long(word, table)
        elif word:
            groups.setdefault((len(word) - 1).bit_length(), []).append(i)
    for places in groups.values():
        for start in range(0, len(places), 8192):
            some = places[start : start + 8192]
            for i, ids in zip(some, merge_short([words[j] for j in some], table)):
                out[i] = ids
    return out


class Encoder:
    """Encodes texts as the rank file and the pattern define it; remembers pieces between spaces.

    Cutting before a space is safe because the pattern takes a space only as the first character of a match or within a
    run of white space. Texts where a space stands before white space or the end are matched as a whole.
    Ids are kept as bytes, four each, little-endian.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.table = ranks(path)
        self.match = regex.compile(pattern)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merged(self, words: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in merge_words([w.encode() for w in words], self.table)]

    def _learn(self, pieces: set[str]) -> None:
        """Remember pieces (without their space; the one that starts a text ends with a space); new words go together."""
        if len(self.words) > REMEMBERED // 4:
            self.words.clear()
        plain = [p for p in pieces if p.isascii() and p.isalpha()]
        self.pieces.update(zip(plain, self.merged([" " + p for p in plain])))
        others = list(pieces.difference(plain))
        matches = [self.match.findall(p[:-1] if p[-1:] == " " else " " + p) for p in others]
        fresh = list(set(chain.from_iterable(matches)).difference(self.words))
        self.words.update(zip(fresh, self.merged(fresh)))
        find = self.words.__getitem__
        self.pieces.update((p, b"".join(map(find, m))) for p, m in zip(others, matches))

    def cut(self, text: str) -> list[str] | None:
        """Keys of the pieces whose encodings, joined, are the text's encoding; None if it can't be cut."""
        unsafe = text.endswith(" ") or any(map(text.__contains__, UNSAFE_ASCII)) if text.isascii() else UNSAFE.search(text)
        if unsafe or len(text) > LONG_TEXT:
            return None
        pieces = text.split(" ")
        if max(map(len, pieces)) > LONG_PIECE:
            return None
        pieces[0] += " "
        return pieces

    def encode_bytes(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, four bytes each."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cuts = [self.cut(t) for t in texts]
        self._learn(set(chain.from_iterable(c for c in cuts if c)).difference(self.pieces))
        find = self.pieces.__getitem__
        for text, pieces in zip(texts, cuts):
            yield self._whole(text) if pieces is None else b"".join(map(find, pieces))

    def _whole(self, text: str) -> bytes:
        words = self.match.findall(text)
        fresh = list(set(words))
        found = dict(zip(fresh, self.merged(fresh)))
        return b"".join(map(found.__getitem__, words))

    def encode_many(self, texts: list[str]) -> Iterator[list[int]]:
        return (np.frombuffer(ids, "<u4").tolist() for ids in self.encode_bytes(texts))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.tokens.__getitem__, ids))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DIGESTS = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` for each row; a null text has no ids. Null and repeated ids stay, other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for ids, texts in row_slices(batches):
            yield record_batch(ENCODED, [ids, list(own.encode_many([t or "" for t in texts]))])

    return _picked(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, bytes)`` of token ids; null ids give null bytes, an id outside the vocabulary is an error."""
    schema = pa.schema([("id", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for ids, tokens in row_slices(batches):
            yield record_batch(schema, [ids, [None if t is None else own.decode(t) for t in tokens]])

    return _picked(encoded, id_col, ids_col).mapInArrow(run, "id long, bytes binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: number of ids and the digests of ids and of decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        decimal = own.table.decimal
        for ids, texts in row_slices(batches):
            out: list[list] = [ids, [], [], []]
            for tokens in own.encode_many([t or "" for t in texts]):
                out[1].append(len(tokens))
                out[2].append(hashlib.sha256(",".join(map(decimal.__getitem__, tokens)).encode()).hexdigest())
                out[3].append(hashlib.sha256(own.decode(tokens)).hexdigest())
            yield record_batch(DIGESTS, out)

    done = _picked(docs, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("id", id_col)


def _picked(df: DataFrame, id_col: str, value_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{value_col}`").alias("value"))
