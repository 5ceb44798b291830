"""Token ids of whole texts by a byte-level BPE tokenizer file, remembered by words.

A slice of texts is cut into words at once, by the classes of its characters, and its different words are looked up among those that are known;
new ones are merged at once (``merges.Pairs``). Texts with a special token or an unusual
case rule, and very long words, go to the file's own library. The cache changes no result.
"""

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from skygauge.llm import common, merges

#: words, and bytes of words, that are remembered between slices
CACHE, CACHE_BYTES = 400_000, 8_000_000
#: characters whose lower case or spacing the library and Python treat differently
_UNUSUAL, _UNUSUAL_ASCII = "Σİ", "\x1c\x1d\x1e\x1f"

#: the words that ``_starts`` finds
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _kinds() -> np.ndarray:
    """The class of each character."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *[0xFFFD] * 0x800, *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            kinds[found.start():found.end()] = kind
    return kinds


def _starts(chars: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a word of ``PATTERN`` begins at each character; ``chars`` begin with white space and end with three."""
    start = (kinds != np.roll(kinds, 1)) & (kinds != _SPACE) | (kinds == _NUMBER)
    # 's and the like; behind another mark the apostrophe belongs to that one's word
    at = np.flatnonzero(chars == ord("'"))
    at = at[kinds[at - 1] != _OTHER]
    one, two = chars[at + 1], chars[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    start[at[short | long] + 1] = False
    after = np.concatenate([at[short] + 2, at[long] + 3])
    start[after] = kinds[after] != _SPACE
    return start


def _byte_names() -> list[str]:
    """A printable character for each byte, as byte-level vocabularies write them."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.library = Tokenizer.from_file(path)
        splits = [p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if splits[0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"words of another kind in {path}")
        self.special = [t["content"] for t in data["added_tokens"]]
        self.names, self.kinds = _byte_names(), _kinds()
        model = data["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.inner = np.array([vocabulary[n] for n in self.names], np.int64)
        self.last = np.array([vocabulary[n + end] for n in self.names], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, joined = (np.array([vocabulary[x] for x in column], np.int64) for column in zip(*((a, b, a + b) for a, b in pairs)))
        self.pairs = merges.Pairs(left, right, np.arange(len(pairs)), joined, 1 + max(vocabulary.values()))
        self.forget()

    def forget(self) -> None:
        """The remembered words; each has a row with its ids. Rows of other texts have no word."""
        self.known = pa.array([], pa.string())
        self.flat, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def start(self) -> None:
        """Called before a slice of texts; rows stay valid within one."""
        if len(self.known) > CACHE or self.known.nbytes > CACHE_BYTES:
            self.forget()

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word)."""
        _, bounds, data = pa.array(words, pa.string()).buffers()
        bounds = np.frombuffer(bounds, np.int32)[:len(words) + 1]
        size, byte = np.diff(bounds).astype(np.int64), np.frombuffer(data, np.uint8)[:bounds[-1]]
        symbol = self.inner[byte]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last[byte[ends]]
        word = np.repeat(np.arange(len(words)), size)
        short = (size <= merges.LONG)[word]
        ids, of, _ = self.pairs.merge(symbol[short], word[short])
        for w in np.flatnonzero(size > merges.LONG):
            own = [t.id for t in self.library.model.tokenize("".join([self.names[b] for b in byte[bounds[w]:bounds[w + 1]]]))]
            at = np.searchsorted(of, w)
            ids, of = np.insert(ids, at, own), np.insert(of, at, [w] * len(own))
        return ids, np.bincount(of, minlength=len(words))

    def _add(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, words])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])

    def _plain(self, text: str) -> bool:
        if any(mark in text for mark in _UNUSUAL_ASCII) or not text.isascii() and any(mark in text for mark in _UNUSUAL):
            return False
        return not any(token in text for token in self.special)

    def _cut(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """(all words, number of words of each text)."""
        parts = [text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower() for text in texts]
        chars = np.frombuffer("\n".join(["", *parts, "\n\n"]).encode("utf-32-le", "replace"), np.uint32)
        kinds = self.kinds[chars]
        start = _starts(chars, kinds)
        ends = np.cumsum([len(part) + 1 for part in parts])
        counts = np.diff(np.searchsorted(np.flatnonzero(start), ends), prepend=0)
        kept = kinds != _SPACE
        chars, first = chars[kept], np.flatnonzero(start[kept])
        data = chars.tobytes().decode("utf-32-le").encode()
        if len(data) > len(chars):  # places of bytes, not of characters
            width = 1 + (chars >= 0x80).astype(np.uint8) + (chars >= 0x800) + (chars >= 0x10000)
            size = np.add.reduceat(width, first, dtype=np.int64)
            first = np.cumsum(size) - size
        offsets = np.append(first, len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)), counts

    def all_rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(rows of all texts, number of rows of each)."""
        plain = [self._plain(text) for text in texts]
        words, counts = self._cut([text if own else "" for text, own in zip(texts, plain)])
        coded = words.dictionary_encode()
        different = coded.dictionary
        row = pc.index_in(different, value_set=self.known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = row < 0
        if fresh.any():
            row[fresh] = len(self.known) + np.arange(np.count_nonzero(fresh))
            new = different.filter(pa.array(fresh))
            self._add(new, *self._merged(new.to_pylist()))
        rows = row[coded.indices.to_numpy()]
        odd = [i for i, own in enumerate(plain) if not own]
        if odd:
            found = [self.library.encode(texts[i], add_special_tokens=False).ids for i in odd]
            at = np.cumsum(counts)[odd]
            rows = np.insert(rows, at, len(self.known) + np.arange(len(odd)))
            counts[odd] = 1
            self._add(pa.nulls(len(odd), pa.string()), np.concatenate(found), np.array([len(x) for x in found]))
        return rows, counts

    def all_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        rows, counts = self.all_rows(texts)
        total = np.concatenate([[0], np.cumsum(self.bounds[rows + 1] - self.bounds[rows])])
        return self.ids(rows), np.diff(total[np.cumsum(counts)], prepend=0)

    def rows(self, text: str) -> np.ndarray:
        return self.all_rows([text])[0]

    def ids(self, rows: list[int] | np.ndarray) -> np.ndarray:
        own = np.asarray(rows, np.int64)
        return self.flat[common.ragged(self.bounds[own], self.bounds[own + 1] - self.bounds[own])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
