"""An R-tree over count vectors, searched by an upper bound of set overlap.

Tokens are hashed into groups; a set becomes the vector of its group counts. Two sets share at most the sum over the groups of
the smaller count, and a node's largest counts bound that sum for all its points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 32


class CountTree:
    """Bulk-loaded tree over ``counts`` (points by groups) and set sizes, for pairs with overlap of ``share`` times union.

    ``share`` is a fraction ``(numerator, denominator)``. Linked sets share at least
    ``numerator * (|a| + |b|) / (numerator + denominator)`` tokens.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, share: tuple[int, int]):
        self.counts, self.sizes, self.share = counts.astype(np.int64), sizes.astype(np.int64), share
        self.order = np.arange(len(sizes))
        self.nodes: list[tuple[int, int, int, int, np.ndarray, int]] = []  # start, end, left, right, largest counts, least size
        if len(sizes):
            self._pack(0, len(sizes))

    def _pack(self, start: int, end: int) -> int:
        """Pack a stretch of the order: halves along the widest group until a leaf is reached."""
        some = self.order[start:end]
        points = self.counts[some]
        at = len(self.nodes)
        top, least = points.max(axis=0), int(self.sizes[some].min())
        self.nodes.append((start, end, -1, -1, top, least))
        if end - start > LEAF:
            widest = int((top - points.min(axis=0)).argmax())
            self.order[start:end] = some[np.argsort(points[:, widest], kind="stable")]
            middle = (start + end) // 2
            left, right = self._pack(start, middle), self._pack(middle, end)
            self.nodes[at] = (start, end, left, right, top, least)
        return at

    def leaves(self, counts: np.ndarray, size: int, skip=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points that may be linked with the query, leaf by leaf, and their overlap bounds.

        ``skip(start, end)``: true if none of that stretch of ``order`` is of interest.
        """
        numerator, denominator = self.share
        stack = [0] if self.nodes else []
        while stack:
            start, end, left, right, top, least = self.nodes[stack.pop()]
            if np.minimum(counts, top).sum() * (numerator + denominator) < numerator * (size + least) or (skip and skip(start, end)):
                continue
            if left >= 0:
                stack += [right, left]
                continue
            some = self.order[start:end]
            bound = np.minimum(self.counts[some], counts).sum(axis=1)
            good = bound * (numerator + denominator) >= numerator * (size + self.sizes[some])
            if good.any():
                yield some[good], bound[good]
