"""Hashed words of whole texts, as one flat array for a slice of documents."""

import re
import zlib
from array import array

import numpy as np

#: ASCII without letters becomes space; so do the usual punctuation and signs beyond ASCII
_ASCII = bytes(i if i > 127 or chr(i).isalpha() else 32 for i in range(256))
_SIGNS = re.compile(rb"\xc2[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf]|\xc3[\x97\xb7]|\xe2[\x80-\xaf][\x80-\xbf]|\xe3\x80[\x80-\x84\x88-\x9f]")
CACHE = 300_000


def split(text: str | None) -> list[bytes]:
    """Runs of letters in lower case, as UTF-8."""
    if not text:
        return []
    data = text.lower().encode("utf-8", "replace").translate(_ASCII)
    return (data if data.isascii() else _SIGNS.sub(b" ", data)).split()


class Buckets(dict):
    """word -> bucket, remembered for up to ``CACHE`` words; a plain hash, so the cache never changes a result."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.buckets
        if len(word) < 40:
            if len(self) >= CACHE:
                self.clear()
            self[word] = bucket
        return bucket


class Stems(dict):
    """word -> row of ``table``, which has the buckets of the word and of its beginnings; emptied with the cache."""

    def __init__(self, buckets: int, beginnings: tuple[int, ...]):
        super().__init__()
        self.buckets, self.beginnings, self.rows = buckets, beginnings, array("q")

    def __missing__(self, word: bytes) -> int:
        whole = zlib.crc32(word)
        self.rows.append(whole % self.buckets)
        for n in self.beginnings:
            self.rows.append((zlib.crc32(word[:n] + b"-") if len(word) > n else whole) % self.buckets)
        row = self[word] = len(self)
        return row

    def start(self) -> None:
        """Called before a slice of documents: row numbers stay valid within one."""
        if len(self) >= CACHE:
            self.clear()
            self.rows = array("q")

    @property
    def table(self) -> np.ndarray:
        return np.frombuffer(self.rows.tobytes(), np.int64).reshape(-1, 1 + len(self.beginnings))


def distinct(texts: list[str | None], stems: Stems) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of each document's different words and of their beginnings, with repeats."""
    stems.start()
    counts, flat = [], []
    for text in texts:
        own = set(split(text))
        counts.append(len(own))
        flat.extend(map(stems.__getitem__, own))
    found = stems.table[np.array(flat, np.int64)]
    return np.repeat(np.repeat(np.arange(len(texts)), counts), found.shape[1]), found.ravel()


def of(texts: list[str | None], buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every word; a word is a run of letters in lower case."""
    counts, flat = [], []
    for text in texts:
        own = split(text)
        counts.append(len(own))
        flat.extend(map(buckets.__getitem__, own))
    return np.repeat(np.arange(len(texts)), counts), np.array(flat, np.int64)


def weighted(doc: np.ndarray, bucket: np.ndarray, n_docs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, count, weight) of distinct pairs; weights log(1 + count), of length 1 for each document."""
    key, count = np.unique(doc * buckets + bucket, return_counts=True)
    doc, bucket = key // buckets, key % buckets
    weight = np.log1p(count)
    length = np.sqrt(np.bincount(doc, weight * weight, n_docs))
    return doc, bucket, count, weight / np.maximum(length, 1e-12)[doc]
