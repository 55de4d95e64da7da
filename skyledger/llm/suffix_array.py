"""Enhanced suffix array of many short sequences at once: order, inverse, common prefixes, intervals.

The sequences lie one after another; a symbol is numbered together with its
sequence, so no prefix is shared by two of them. Everything is a pass over
whole arrays but the stack that finds the intervals.
"""

from __future__ import annotations

import numpy as np

Array = np.ndarray


class SuffixArray:
    """Suffixes of ``symbols``, equal only within one of the sequences that end at ``ends``.

    ``ranks[k][i]`` is the same for two places exactly if the ``2**k`` symbols
    from there are the same. Memory is 4 bytes a symbol for each doubling of
    the longest repeat, and some 60 bytes besides.
    """

    def __init__(self, symbols: Array, ends: Array) -> None:
        n = len(symbols)
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        keys = owner * (int(symbols.max(initial=0)) + 1) + symbols
        self.order = np.argsort(keys, kind="stable")
        in_order = keys[self.order]
        first = np.concatenate((np.ones(min(n, 1), bool), in_order[1:] != in_order[:-1]))
        self.ranks = [self._heads(first)]
        self._refine(first)
        self.inverse = np.empty(n, np.int64)
        self.inverse[self.order] = np.arange(n)
        self.common = self._common()

    def _heads(self, first: Array) -> Array:
        """Each place's rank: where its group of equal prefixes begins in the order."""
        heads = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        rank = np.empty(len(first), np.int32)
        rank[self.order] = heads
        return rank

    def _refine(self, first: Array) -> None:
        """Double the sorted prefix until all suffixes differ; groups of one are left alone."""
        n, width = len(self.order), 1
        while True:
            alone = first & np.concatenate((first[1:], np.ones(min(n, 1), bool)))
            open_ = np.flatnonzero(~alone)
            if not len(open_):
                return
            rank, places = self.ranks[-1], self.order[open_]
            behind = places + width
            follow = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1).astype(np.int64)
            keys = rank[places].astype(np.int64) * (n + 1) + follow + 1
            by_key = np.argsort(keys, kind="stable")
            keys = keys[by_key]
            self.order[open_] = places[by_key]
            first = first.copy()
            first[open_[1:]] |= keys[1:] != keys[:-1]
            self.ranks.append(self._heads(first))
            width *= 2

    def _common(self) -> Array:
        """Length of the prefix each suffix shares with the one before it in the order."""
        common = np.zeros(len(self.order), np.int64)
        rank = self.ranks[0]
        pairs = np.flatnonzero(rank[self.order[1:]] == rank[self.order[:-1]]) + 1
        a, b = self.order[pairs - 1].copy(), self.order[pairs].copy()
        common[pairs] = self.shared(a, b, 1)
        return common

    def shared(self, a: Array, b: Array, way: int) -> Array:
        """How far the symbols from places ``a`` and ``b`` agree, on to the right (1) or to the left (-1).

        To the left the places themselves do not count. No two different places
        agree for as long as the widest rank tells, so each width is tried once.
        """
        n, found = len(self.order), np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[k], 1 << k
            x, y = (a + found, b + found) if way > 0 else (a - found - width, b - found - width)
            inside = (x >= 0) & (y >= 0) & (x < n) & (y < n)
            same = np.zeros(len(a), bool)
            same[inside] = rank[x[inside]] == rank[y[inside]]
            found[same] += width
        return found

    def intervals(self, least: int) -> tuple[Array, Array, Array, Array]:
        """Depth, first and last place in the order of each interval, and which interval each boundary splits.

        Only symbols that occur ``least`` times or more are looked at; a boundary
        of none has -1.
        """
        rank = self.ranks[0][self.order] if len(self.order) else np.zeros(0, np.int32)
        starts = np.flatnonzero(np.concatenate((np.ones(min(len(rank), 1), bool), rank[1:] != rank[:-1])))
        sizes = np.diff(starts, append=len(rank))
        depth, low, high = [], [], []
        splits = np.full(len(rank), -1, np.int64)
        for start, size in zip(starts[sizes >= least].tolist(), sizes[sizes >= least].tolist(), strict=True):
            depths, owners, open_ = [0], [], []
            for k, value in enumerate(self.common[start + 1 : start + size].tolist(), start + 1):
                left = k - 1
                while depths[-1] > value:
                    done = open_.pop()
                    depths.pop()
                    high[done] = k - 1
                    left = low[done]
                if depths[-1] < value:
                    open_.append(len(depth))
                    depths.append(value)
                    depth.append(value)
                    low.append(left)
                    high.append(-1)
                owners.append(open_[-1])
            for done in open_:
                high[done] = start + size - 1
            splits[start + 1 : start + size] = owners
        return (*(np.array(x, np.int64) for x in (depth, low, high)), splits)
