"""Multikey three-way quicksort of weighted suffixes, all partitions of a round at once."""

import numpy as np

from skygauge.llm.common import ragged


def heavy_prefixes(keys: np.ndarray, weight: np.ndarray, least: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every depth the prefixes whose weight reaches ``least[depth]``: (a suffix that has it, its weight).

    ``keys[depth, suffix]``: the words as numbers, negative past the end. A partition is split by its pivot into smaller, equal and greater
    suffixes; the equal ones share a prefix, their weight is its count, and they are split on by the next word. Partitions
    that weigh less than what is asked for can hold nothing frequent and are abandoned.
    """
    depths, n = keys.shape
    order = np.arange(n)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(depths)]
    floor = np.array([*least, 0])
    start, size, depth = np.zeros(1, np.int64), np.array([n]), np.zeros(1, np.int64)
    if not n:
        start, size, depth = (np.zeros(0, np.int64),) * 3
    while len(start):
        at = ragged(start, size)
        of = np.repeat(np.arange(len(start)), size)
        own = order[at]
        key = keys[depth[of], own]
        first, middle, last = (keys[depth, order[start + x]] for x in (0, size // 2, size - 1))
        pivot = np.maximum(np.minimum(first, middle), np.minimum(np.maximum(first, middle), last))[of]
        side = (key > pivot).astype(np.int64) - (key < pivot) + 1
        group = of * 3 + side
        sizes = np.bincount(group, minlength=3 * len(start))
        weights = np.bincount(group, weight[own], minlength=3 * len(start)).astype(np.int64)
        order[at] = own[np.argsort(group, kind="stable")]
        starts = np.repeat(start, 3) + (np.cumsum(sizes) - sizes) - np.repeat(np.cumsum(size) - size, 3)
        depth = np.repeat(depth, 3)
        equal = np.arange(len(sizes)) % 3 == 1
        word = np.zeros(len(sizes), np.int64)
        word[equal] = keys[depth[equal], order[starts[equal]]]
        alive = (sizes > 0) & (weights >= floor[depth]) & (word >= 0)
        for d in range(depths):
            hit = np.flatnonzero(alive & equal & (depth == d))
            if len(hit):
                found[d].append((order[starts[hit]], weights[hit]))
        depth = depth + equal
        alive &= (depth < depths) & (weights >= floor[depth])
        start, size, depth = starts[alive], sizes[alive], depth[alive]
    return [tuple(map(np.concatenate, zip(*own))) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for own in found]
