"""Prefix polynomial hashes of concatenated texts, and anchors: content-chosen positions that equal strings share.

The hash of bytes [i, i + n) is (S[i + n] - S[i]) * B^-i modulo 2^64, where S sums a random number for each byte times B^position. An
anchor of a window of ``LENGTH`` bytes is the start of the ``GRAM``-byte string in it with the smallest hash (the leftmost of equals). Equal
windows have their anchors at equal distances, and consecutive windows mostly share one.
"""

import numpy as np
import xxhash

LENGTH = 100
GRAM = 32
SPREAD = LENGTH - GRAM + 1
_PLACE = np.uint64((1 << 24) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i for i < n."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Hashes:
    """Prefix sums over ``data``; hashes of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(max(1, len(data)))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive entries, from running minima of blocks forwards and backwards."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def runs(hashes: Hashes, n: int, begin: np.ndarray, end: np.ndarray):
    """Maximal runs of windows with one anchor, inside the texts [begin, end).

    Returns (gram hash, segment hash, first window, number of windows). A segment is what the run's windows cover, with the
    anchor's place in it.
    """
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(n - GRAM + 1)
    gram = mixed(hashes.of(at, GRAM))
    anchor = (_window_minimum((gram & ~_PLACE) | at.astype(np.uint64), SPREAD) & _PLACE).astype(np.int64)
    window = np.arange(len(anchor))
    text = np.searchsorted(begin, window, "right") - 1
    good = window + LENGTH <= end[text]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (good[1:] != good[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(anchor)))
    keep = good[first]
    first, count = first[keep], count[keep]
    gram = gram[anchor[first]]
    segment = mixed(hashes.of(first, count + LENGTH - 1) + mixed((anchor[first] - first).astype(np.uint64) * np.uint64(256) + count.astype(np.uint64)))
    return gram, segment, first, count


def proofs(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A second hash of each substring, of another kind than ``Hashes``: what collides in one does so in the other by chance only."""
    whole, digest = memoryview(data), xxhash.xxh3_64_intdigest
    return np.fromiter((digest(whole[a:a + n]) for a, n in zip(first.tolist(), size.tolist())), np.uint64, len(first))
