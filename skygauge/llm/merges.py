"""Byte-pair merges: the pair whose joined text has the smallest rank is merged first, the leftmost among equals.

``Pairs`` merges many words of numbered symbols at once, one merge a word and round; ``merge`` merges one long word with a heap.
"""

import heapq

import numpy as np

LONG = 100
_NONE = np.iinfo(np.int32).max


class Pairs:
    """A table from pairs of symbols to their rank and to the symbol that replaces them."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, joined: np.ndarray, symbols: int):
        """``symbols``: larger than every symbol that will be merged."""
        key = left.astype(np.int64) * symbols + right
        order = np.argsort(key)
        self.size, self.key, self.rank, self.joined = symbols, key[order], rank[order].astype(np.int32), joined[order].astype(np.int64)

    def merge(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, their words, the first symbols' number in each) after all merges; ``word`` numbers the words and rises."""
        width = np.ones(len(symbol), np.int32)
        done: list[tuple[np.ndarray, ...]] = [(symbol[:0], word[:0], width[:0])]
        word = word.astype(np.int32)
        rank, to = np.full(len(symbol), _NONE, np.int32), np.zeros(len(symbol), np.int64)  # of the pair that begins at each place
        self._look(symbol, rank, to, np.flatnonzero(word[:-1] == word[1:]))
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(starts, append=len(word))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            kept = best != _NONE
            if not kept.all():
                done.append((symbol[~kept], word[~kept], width[~kept]))
            hit = np.flatnonzero((rank == best) & kept)
            hit = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of each word
            symbol[hit] = to[hit]
            width[hit] += width[hit + 1]
            kept[hit + 1] = False
            hit = (np.cumsum(kept) - 1)[hit]
            symbol, word, width, rank, to = symbol[kept], word[kept], width[kept], rank[kept], to[kept]
            # the merged symbols have new pairs on both sides
            rank[hit] = _NONE
            after = hit[hit + 1 < len(word)]
            self._look(symbol, rank, to, after[word[after] == word[after + 1]])
            before = hit[hit > 0] - 1
            before = before[word[before] == word[before + 1]]
            rank[before] = _NONE
            self._look(symbol, rank, to, before)
        symbol, word, width = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order].astype(np.int64), width[order].astype(np.int64)

    def _look(self, symbol: np.ndarray, rank: np.ndarray, to: np.ndarray, at: np.ndarray) -> None:
        """Fill in rank and replacement of the pairs at ``at`` that are in the table."""
        key = symbol[at] * self.size + symbol[at + 1]
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        found = self.key[place] == key
        at, place = at[found], place[found]
        rank[at], to[at] = self.rank[place], self.joined[place]


def merge(parts: list[str], rank) -> list[str]:
    """The parts of one word after all merges, with a heap and links; ``rank`` is the ``get`` of a table from joined texts to ranks."""
    parts = list(parts)
    before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
    heap = [(r, i, i + 1, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a + b)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, a, b = heapq.heappop(heap)
        if after[i] != j or parts[i] != a or parts[j] != b:
            continue
        parts[i] = a + b
        parts[j] = None
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (r := rank(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (r, i, k, parts[i], parts[k]))
        h = before[i]
        if h >= 0 and (r := rank(parts[h] + parts[i])) is not None:
            heapq.heappush(heap, (r, h, i, parts[h], parts[i]))
    return [p for p in parts if p is not None]
