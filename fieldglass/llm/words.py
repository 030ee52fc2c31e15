"""Words, lines and shingles of a text as numpy arrays over its UTF-8 bytes.

A word is a run of characters other than space and the control characters 9 to 13. Words are compared by 64-bit hashes of
their bytes (a polynomial hash, mixed); a text with a word of over ``LONG_WORD`` bytes, where such a polynomial is weaker, gets
its hashes from a cryptographic one.
"""

from __future__ import annotations

import hashlib

import numpy as np

LONG_WORD = 512
#: Bytes of short texts that are cut together, about.
TOGETHER = 1 << 16
_random = np.random.Generator(np.random.PCG64(20_240_601))
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
ODD = _random.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
BASE = int(ODD[0]) & ~7 | 5  # 5 modulo 8: of the largest order
INVERSE = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below at least ``n``, kept and doubled when too short."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        table = np.full(size, base, np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_array(text: str | None, lower: bool = False) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return LOWER[data] if lower else data


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of all words."""
    edge = np.flatnonzero(np.diff(SPACE[data], prepend=True, append=True))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    if lengths.max() > LONG_WORD:
        raw = data.tobytes()
        return np.array([int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "big") for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _powers_of(BASE, len(data))[: len(data)], out=sums[1:])
    own = (sums[ends] - sums[starts]) * _powers_of(INVERSE, len(data))[starts]
    return mixed(own + lengths.astype(np.uint64) * ODD[1])


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` words; none if there are fewer words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += words[k : k + count] * ODD[2 + k]
    return mixed(total)


def repeated_words(words: np.ndarray, n: int = 5) -> int:
    """Words that lie in a window of ``n`` words found twice or more."""
    windows = window_hashes(words, n)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    repeated = np.zeros(len(windows), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(repeated)
    change[at] += 1
    np.subtract.at(change, at + n, 1)
    return int((np.cumsum(change) > 0).sum())


def shingle_set(text: str | None, n: int = 4) -> np.ndarray:
    """Sorted hashes of the distinct windows of ``n`` words in lower case (A-Z only); fewer words make one window."""
    data = byte_array(text, lower=True)
    starts, ends = word_spans(data)
    words = word_hashes(data, starts, ends)
    if 0 < len(words) < n:
        return mixed((words * ODD[2 : 2 + len(words)]).sum(keepdims=True, dtype=np.uint64) + ODD[9] * np.uint64(len(words)))
    return np.unique(window_hashes(words, n))


def shingle_sets(texts: list[str | None], n: int = 4) -> list[np.ndarray]:
    """``shingle_set`` of every text; short ones are cut together, as most of the time goes into calls on small arrays."""
    found: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode()
        if held and size + len(raw) > TOGETHER:
            found += _sets_together(held, n)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    return found + _sets_together(held, n)


def _sets_together(texts: list[bytes], n: int) -> list[np.ndarray]:
    if len(texts) < 2:
        return [shingle_set(t.decode(), n) for t in texts]
    data = LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    starts, ends = word_spans(data)
    # where texts begin, among the bytes and among the words
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    first = np.searchsorted(starts, begin).tolist()
    if (ends - starts > LONG_WORD).any():
        # a text with a long word has hashes of its own kind
        return [shingle_set(t.decode(), n) for t in texts]
    words = word_hashes(data, starts, ends)
    windows = window_hashes(words, n)
    found = []
    for i, (a, b) in enumerate(zip(first, first[1:])):
        if b - a < n:
            found.append(shingle_set(texts[i].decode(), n))
            continue
        own = np.sort(windows[a : b - n + 1])
        once = np.append(True, own[1:] != own[:-1])
        found.append(own if once.all() else own[once])
    return found
