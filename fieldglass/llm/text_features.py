"""Counts per line of a text, the base measures of a document, and feature vectors built from them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .words import byte_array, repeated_words, word_hashes, word_spans

#: Classes of bytes counted per line.
SYMBOLS = b"#*$%&|<>"
KINDS = ("space", "lower", "upper", "digit", "symbol", "stop", "other", "accented")
KIND_OF = np.full(256, KINDS.index("other"), np.uint8)
KIND_OF[[32, *range(9, 14)]] = KINDS.index("space")
KIND_OF[97:123] = KINDS.index("lower")
KIND_OF[65:91] = KINDS.index("upper")
KIND_OF[48:58] = KINDS.index("digit")
KIND_OF[list(SYMBOLS)] = KINDS.index("symbol")
KIND_OF[list(b".,;:?")] = KINDS.index("stop")
KIND_OF[192:] = KINDS.index("accented")  # first bytes of longer characters
KIND_OF[128:192] = len(KINDS)  # their later bytes


@dataclass
class Lines:
    """Lines of a text that have a word. ``counts`` has a row per line and a column per kind of character."""

    counts: np.ndarray
    words: np.ndarray
    earlier: np.ndarray
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def lines_of(text: str | None) -> Lines:
    text = text or ""
    data = byte_array(text)
    starts, ends = word_spans(data)
    cuts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    if len(data):
        kinds = KIND_OF[data]
        inside = cuts[cuts < len(data)]
        counts = np.stack([np.add.reduceat(kinds == k, inside, dtype=np.int64) for k in range(len(KINDS))], axis=1)
        line_of_word = np.searchsorted(inside, starts, side="right") - 1
        words = np.bincount(line_of_word, minlength=len(inside))
    else:
        counts, words = np.zeros((0, len(KINDS)), np.int64), np.zeros(0, np.int64)
    seen: set[str] = set()
    earlier = np.zeros(len(words), bool)
    for i, line in enumerate(text.split("\n")[: len(words)]):
        if words[i]:
            earlier[i] = line in seen
            seen.add(line)
    full = words > 0
    totals = counts.sum(axis=0)
    return Lines(
        counts=counts[full],
        words=words[full],
        earlier=earlier[full],
        n_words=len(starts),
        word_chars=int(totals[1:].sum()),
        n_symbols=int(totals[KINDS.index("symbol")]),
        n_dup_lines=int(earlier.sum()),
        n_repeat_words=repeated_words(word_hashes(data, starts, ends)),
    )


def _shares(counts: np.ndarray) -> np.ndarray:
    """Share of each kind but space among the other characters."""
    return counts[:, 1:] / np.maximum(counts[:, 1:].sum(axis=1, keepdims=True), 1)


LINE_FEATURES = ("one", "log_words", "word_length", *KINDS[1:], "caps_word", "symbol_word", "earlier", "first", "last")


def line_features(lines: Lines) -> np.ndarray:
    """One row of ``LINE_FEATURES`` for each line with a word."""
    n = len(lines.words)
    shares, words = _shares(lines.counts), np.maximum(lines.words, 1)
    upper, symbol = lines.counts[:, KINDS.index("upper")], lines.counts[:, KINDS.index("symbol")]
    letters = np.maximum(lines.counts[:, 1:3].sum(axis=1), 1)
    ends = np.zeros((n, 2))
    if n:
        ends[0, 0] = ends[-1, 1] = 1
    return np.column_stack([
        np.ones(n), np.log1p(words) / 4, np.minimum(lines.counts[:, 1:].sum(axis=1) / words, 30) / 10, shares,
        upper / letters > 0.6, symbol / words > 0.3, lines.earlier, ends,
    ]).astype(float)


DOCUMENT_FEATURES = ("one", "log_words", "word_length", *KINDS[1:], "caps_lines", "symbol_lines", "dup_lines", "repeated", "words_per_line")


def document_features(lines: Lines) -> np.ndarray:
    """``DOCUMENT_FEATURES`` of a text; all zero but the first for a text without words."""
    if not lines.n_words:
        return np.eye(1, len(DOCUMENT_FEATURES))[0]
    shares = _shares(lines.counts.sum(axis=0, keepdims=True))[0]
    by_line = line_features(lines)
    weight = lines.words / lines.words.sum()
    caps, symbol = (float(weight @ by_line[:, LINE_FEATURES.index(c)]) for c in ("caps_word", "symbol_word"))
    n = len(lines.words)
    return np.array([
        1, np.log1p(lines.n_words) / 8, min(lines.word_chars / lines.n_words, 30) / 10, *shares, caps, symbol,
        lines.n_dup_lines / n, lines.n_repeat_words / lines.n_words, np.log1p(lines.n_words / n) / 6,
    ])
