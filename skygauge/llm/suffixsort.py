"""Mergesort of suffixes with hash-compared steps.

Two suffixes are compared by their longest common extension: prefix polynomial hashes tell in constant time whether n bytes agree, and a
binary search over n finds the first that differs. All merges of a level are done at once: each suffix finds its place in the
sibling run by binary search. Equal neighbours are verified byte by byte.
"""

import numpy as np

from skygauge.llm.anchors import Hashes


class Suffixes:
    """Suffixes of ``data`` at ``start``, compared on their first ``length`` bytes, which must lie inside ``data``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: int):
        self.data, self.start, self.length = data, start, length
        self.hashes = Hashes(data)
        self.whole = self.hashes.of(start, length)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of common bytes at the start of suffixes a and b."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)  # low bytes agree, high + 1 don't
        low[(same := self.whole[a] == self.whole[b])] = self.length
        open_ = np.flatnonzero(~same)
        at, bt, lo, hi = self.start[a[open_]], self.start[b[open_]], low[open_], high[open_] - 1
        while (lo < hi).any():
            middle = (lo + hi + 1) >> 1
            agree = self.hashes.of(at, middle) == self.hashes.of(bt, middle)
            lo, hi = np.where(agree, middle, lo), np.where(agree, hi, middle - 1)
        low[open_] = lo
        return low

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1."""
        common = self.extension(a, b)
        differ = common < self.length
        out = np.zeros(len(a), np.int8)
        x, y = self.data[self.start[a[differ]] + common[differ]], self.data[self.start[b[differ]] + common[differ]]
        out[differ] = np.where(x < y, -1, 1)
        return out

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each group; ``group`` is ascending and equal suffixes keep their order."""
        n = len(group)
        if not n:
            return np.zeros(0, np.int64)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        begin = np.repeat(first, np.diff(np.append(first, n)))
        end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
        order, width = np.arange(n), 1
        longest = int((end - begin).max())
        while width < longest:
            place = np.arange(n) - begin
            run = place // width
            left = run % 2 == 0
            own = begin + run * width
            sibling = np.where(left, own + width, own - width)
            moving = np.flatnonzero(sibling < end)  # a last run without a sibling stays
            lo, hi = sibling[moving], np.minimum(sibling[moving] + width, end[moving])
            base, after_equal = lo.copy(), ~left[moving]
            while len(live := np.flatnonzero(lo < hi)):
                middle = (lo[live] + hi[live]) >> 1
                sign = self.compare(order[moving[live]], order[middle])
                beyond = (sign > 0) | ((sign == 0) & after_equal[live])
                lo[live] = np.where(beyond, middle + 1, lo[live])
                hi[live] = np.where(beyond, hi[live], middle)
            target = np.arange(n)
            target[moving] = np.minimum(own[moving], base) + (moving - own[moving]) + (lo - base)
            merged = np.empty(n, np.int64)
            merged[target] = order
            order, width = merged, width * 2
        return order

    def classes(self, group: np.ndarray, order: np.ndarray) -> np.ndarray:
        """For each place of ``order`` a number that equal suffixes of a group share, verified on the bytes."""
        if not len(order):
            return np.zeros(0, np.int64)
        a, b = order[:-1], order[1:]
        same = (group[a] == group[b]) & (self.whole[a] == self.whole[b])
        reach = np.arange(self.length)
        at = np.flatnonzero(same)
        for part in np.array_split(at, len(at) // 50_000 + 1):
            x, y = self.data[self.start[a[part], None] + reach], self.data[self.start[b[part], None] + reach]
            wrong = part[(x != y).any(1)]
            same[wrong] = False
        return np.cumsum(np.concatenate([[0], ~same]))
