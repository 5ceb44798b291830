"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the longest prefix found in the model's compiled character map (a double-array trie); every
normalised character records the byte of the source it came from. White space becomes the mark U+2581, one mark is
put in front, and byte-pair merges in the order of the pieces' scores give the pieces; characters without a piece
fall back to bytes. Each piece is projected to the bytes of the source that it came from.

Merges never cross a place between two characters that no piece has side by side, so texts are cut there. The parts that a slice of texts has
anew are merged all at once and remembered; the cache changes no result.

Defined results: a null text is empty, an empty text is the end id alone and decodes to nothing. Very long texts and texts without
spaces are encoded whole (merging with a heap). Repeated rows are answered one by one.
"""

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import common, merges

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: bytes above 127 and control pieces, while a text is put together
_ESCAPED, PARTED = re.compile("[\udc80-\udcff]+"), "\ud800"
#: parts, and characters of parts, that are remembered between slices
CACHE, CACHE_CHARS = 200_000, 4_000_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        elif kind == 2:
            size = number()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield key >> 3, data[at:at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map: size of the trie, the trie's units, the replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4) if size else ()
        self.replacements = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest entry that starts at ``at``."""
        best, node = None, self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                best = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if best is None:
            return None
        end = self.replacements.index(b"\0", best[1])
        return best[0], self.replacements[best[1]:end]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)

    def apply(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters the source byte it starts at; the last entry is the end."""
        data = text.encode("utf-8", "replace")
        if not self.units:
            code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
            width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            return text, np.concatenate([[0], np.cumsum(width)])
        out, source, at = [], [], 0
        while at < len(data):
            found = self.longest(data, at)
            if found is None:
                size = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                found = size, data[at:at + size]
            chars = found[1].decode("utf-8", "replace")
            out.append(chars)
            source.extend([at] * len(chars))
            at += found[0]
        return "".join(out), np.array([*source, at], np.int64)


class Model:
    """A BPE model file: its pieces, flags and the parts seen so far."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.texts, scores, kinds = [], [], []
        dummy, squeeze, escape, compiled = True, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode("utf-8"))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != 2 or trainer.get(24, 0):
                    raise ValueError("only BPE models with white space in front are read")
                self.fallback = bool(trainer.get(35, 0))
            elif field == 3:
                norm = dict(_fields(value))
                compiled, dummy, squeeze, escape = norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        self.dummy, self.squeeze, self.escape = dummy, squeeze, escape
        self.map = CharacterMap(compiled)
        if USER in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not read")
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, kinds)) if k == NORMAL}
        self.cost = {t: -scores[i] for t, i in self.ids.items()}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, kinds)) if k == BYTE}
        self.kinds = kinds
        self.unknown, self.end = kinds.index(UNKNOWN), self.texts.index("</s>")
        inner = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1)}
        marks = not any(b == MARK and a != MARK for a, b in inner)
        lines = not any("\n" in pair for pair in inner)
        self.parts = re.compile(rf"{MARK}*[^{MARK}\n]+|\n|{MARK}+" if marks and lines else rf"{MARK}*[^{MARK}]+|{MARK}+" if marks else r"(?s).+")
        self._number(inner)
        self.names = [str(i) for i in range(len(kinds))]
        self.shown = [self._shown(t, k) for t, k in zip(self.texts, kinds)]
        self.forget()

    def _number(self, inner: set[str]) -> None:
        """Symbols: pieces by their id, then the other characters that pieces have, then one for all other characters."""
        numbers = dict(self.ids)
        for char in sorted(set("".join(self.ids)) - numbers.keys()):
            numbers[char] = len(self.texts) + len(numbers) - len(self.ids)
        size = len(self.texts) + len(numbers) - len(self.ids) + 1
        self.symbol = np.full(0x110000, size - 1, np.int64)
        for text, number in numbers.items():
            if len(text) == 1:
                self.symbol[ord(text)] = number
        self.is_piece = np.zeros(size, bool)
        self.is_piece[list(self.ids.values())] = True
        self.inner = np.sort(np.array([ord(a) * 0x110000 + ord(b) for a, b in inner] or [-1], np.int64))
        rank = {cost: i for i, cost in enumerate(sorted(set(self.cost.values())))}
        found = [(numbers[t[:i]], numbers[t[i:]], rank[self.cost[t]], n) for t, n in self.ids.items() for i in range(1, len(t)) if t[:i] in numbers and t[i:] in numbers]
        self.pairs = merges.Pairs(*np.array(found or [(size, size, 0, 0)], np.int64).T, size)

    def forget(self) -> None:
        """The remembered parts: row numbers, and for each row its pieces and their places."""
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.flat, self.first, self.last = (np.zeros(0, np.int32) for _ in range(3))
        self.bounds = np.zeros(1, np.int64)

    def learn(self, parts: list[str]) -> None:
        """New rows for all parts."""
        text, sizes = "".join(parts), np.array([len(p) for p in parts], np.int64)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)
        key = code[:-1] * 0x110000 + code[1:]
        whole = self.inner[np.minimum(np.searchsorted(self.inner, key), len(self.inner) - 1)] == key
        stretch = np.concatenate([[0], np.cumsum((part[1:] != part[:-1]) | ~whole)])
        lengths = np.bincount(stretch)
        short = (lengths <= merges.LONG)[stretch]
        symbol, of, width = self.pairs.merge(self.symbol[code][short], stretch[short])
        longer = np.flatnonzero(lengths > merges.LONG)
        if len(longer):
            starts, more = np.cumsum(lengths) - lengths, []
            for i in longer:
                found = merges.merge(list(text[starts[i]:starts[i] + lengths[i]]), self.cost.get)
                more.append((np.array([self.ids[x] if x in self.ids else self.symbol[ord(x)] for x in found], np.int64), np.full(len(found), i), np.array([len(x) for x in found], np.int64)))
            symbol, of, width = (np.concatenate(x) for x in zip((symbol, of, width), *more))
            order = np.argsort(of, kind="stable")
            symbol, of, width = symbol[order], of[order], width[order]
        begin = np.cumsum(width) - width
        own = part[begin]
        first = begin - (np.cumsum(sizes) - sizes)[own]
        # characters that are no piece: their bytes, or the unknown piece
        strange = np.flatnonzero(~self.is_piece[symbol])
        spelled = [[self.bytes[b] for b in text[i].encode("utf-8", "replace")] if self.fallback else [self.unknown] for i in begin[strange].tolist()]
        count = np.ones(len(symbol), np.int64)
        count[strange] = [len(x) for x in spelled]
        token = np.repeat(symbol, count)
        if len(strange):
            token[common.ragged((np.cumsum(count) - count)[strange], count[strange])] = np.concatenate(spelled)
        self.flat = np.concatenate([self.flat, token.astype(np.int32)])
        self.first = np.concatenate([self.first, np.repeat(first, count).astype(np.int32)])
        self.last = np.concatenate([self.last, np.repeat(first + width, count).astype(np.int32)])
        per_part = np.bincount(own, count, len(parts)).astype(np.int64)
        self.rows.update(zip(parts, range(len(self.bounds) - 1, len(self.bounds) - 1 + len(parts))))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(per_part)])
        self.chars += len(text)

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """Marks put in; for each character the source byte, and the end."""
        text, source = self.map.apply(text)
        if self.squeeze:
            kept = np.array([not (c == " " and (i == 0 or text[i - 1] == " ")) for i, c in enumerate(text)], bool)
            while kept.any() and text[(last := int(np.flatnonzero(kept)[-1]))] == " ":
                kept[last] = False
            text, source = "".join(c for c, k in zip(text, kept) if k), np.append(source[:-1][kept], source[-1])
        if not text:
            return text, source[-1:]
        if self.dummy:
            text, source = " " + text, np.concatenate([source[:1], source])
        return (text.replace(" ", MARK) if self.escape else text), source

    def rows_of(self, texts: list[str]) -> list[tuple[list[int], np.ndarray]]:
        """(rows of its parts, source byte of its characters) of each text."""
        norm = [self.normalised(text) for text in texts]
        parts = [self.parts.findall(text) for text, _ in norm]
        new = set().union(*parts).difference(self.rows)
        if new:
            self.learn(list(new))
        return [(list(map(self.rows.__getitem__, own)), source) for own, (_, source) in zip(parts, norm)]

    def start(self) -> None:
        """Called before a slice of texts; row numbers stay valid within one."""
        if len(self.rows) > CACHE or self.chars > CACHE_CHARS:
            self.forget()

    def pieces(self, rows: list[int], source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte, byte after the last) of every piece."""
        own = np.array(rows, np.int64)
        count = self.bounds[own + 1] - self.bounds[own]
        at = common.ragged(self.bounds[own], count)
        lengths = self.last[self.bounds[own + 1] - 1].astype(np.int64)
        begin = np.repeat(np.cumsum(lengths) - lengths, count)
        return self.flat[at], source[begin + self.first[at]], source[begin + self.last[at]]

    @staticmethod
    def _shown(text: str, kind: int) -> str:
        """What a piece stands for; a byte above 127 is escaped as Python does it, a control piece only parts the bytes around it."""
        if kind == BYTE:
            return bytes([int(text[3:5], 16)]).decode("ascii", "surrogateescape")
        return " ⁇ " if kind == UNKNOWN else PARTED if kind == CONTROL else text.replace(MARK, " ")

    def decode_ids(self, ids: list[int], first: bool = True) -> str:
        """The library's decode: marks to spaces, bytes joined, one space dropped in front of the text."""
        end = len(ids)
        while end and self.kinds[ids[end - 1]] == CONTROL:
            end -= 1
        out = list(map(self.shown.__getitem__, ids[:end]))
        if first and (self.dummy or self.squeeze):
            for k, i in enumerate(ids[:end]):
                if self.kinds[i] == NORMAL and self.texts[i].startswith(MARK):
                    out[k] = out[k][1:]
                    if not self.squeeze:
                        break
                elif self.kinds[i] != CONTROL:
                    break
        text = "".join(out)
        try:
            text.encode()
        except UnicodeEncodeError:  # bytes to be joined
            text = _ESCAPED.sub(lambda run: _utf8(run[0].encode("ascii", "surrogateescape")), text).replace(PARTED, "")
        return text


def _utf8(data: bytes) -> str:
    """Valid characters, and U+FFFD for each byte that belongs to none."""
    return re.sub("[\udc80-\udcff]", "�", data.decode("utf-8", "surrogateescape"))


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of this Python process."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns (default all), then ids, begin and end: one entry for each piece, the end id last."""
    names = [prefix + n for n in ("ids", "begin", "end")]
    return _mapped(docs, path, keep, [(n, T.ArrayType(T.IntegerType())) for n in names], _encoded)


def digests(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, then n_tokens, ids_sha256, decoded_sha256 and covered_bytes (by all spans), taken from the encoded pieces in the same pass."""
    types = (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("covered_bytes", T.LongType()))
    return _mapped(docs, path, keep, types, _digested)


def _mapped(docs: DataFrame, path: str, keep, out, function) -> DataFrame:
    names = [n for n, _ in out]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("text").alias("text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in common.slices(batches):
            own.start()
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"k_{c}") for c in kept] + function(own, [t or "" for t in batch.column("text").to_pylist()]), names=[*kept, *names])
        own.forget()  # the process may go on with other work

    return source.mapInArrow(run, schema)


def _encoded(own: Model, texts: list[str]) -> list[pa.Array]:
    found = own.rows_of(texts)
    done = [own.pieces(rows, source) for rows, source in found]
    cuts = np.cumsum([0, *(len(d[0]) + 1 for d in done)]).astype(np.int32)
    flat = []
    for k, last in enumerate((lambda source: own.end, lambda source: source[-1], lambda source: source[-1])):
        flat.append(pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(
            [x for d, (_, source) in zip(done, found) for x in (d[k], [last(source)])]).astype(np.int32))))
    return flat


def _digested(own: Model, texts: list[str]) -> list[pa.Array]:
    n_tokens, ids, decoded, covered = [], [], [], []
    for rows, source in own.rows_of(texts):
        found, begin, end = own.pieces(rows, source)
        tokens = [*found.tolist(), own.end]
        n_tokens.append(len(tokens))
        ids.append(hashlib.sha256(" ".join(map(own.names.__getitem__, tokens)).encode()).hexdigest())
        decoded.append(hashlib.sha256(own.decode_ids(tokens).encode()).hexdigest())
        covered.append(int(end[-1] - begin[0]) if len(found) else 0)
    return [pa.array(n_tokens, pa.int64()), pa.array(ids), pa.array(decoded), pa.array(covered, pa.int64())]


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path(MODEL))
