"""Removal of repeated strings: every byte covered by a string of ``LENGTH`` bytes that also starts earlier.

Candidates come from anchors (see ``anchors``): equal windows have equal anchor strings, and runs of windows with one anchor form segments.
An anchor string that occurs once has no repeated window. Of equal segments all but the first are removed whole; equal are those that agree
in a polynomial hash and in a second one of another kind, 64 bits each, both of all their bytes (in a slice and between slices). Only first segments
whose anchor string has other segments too are looked into: their bytes are grouped by the anchor string, and
their windows are sorted as suffixes by a mergesort with hash comparisons and verified on the bytes (``suffixsort``). In
each group of equal windows all but the first are removed.

Bounds: rows of one slice of documents are reduced before the shuffle, so an anchor string sends one row from each slice at most, and an
equal segment one. An anchor string with more than ``HOT`` different first segments is not gathered: its windows
are dealt by the same two hashes of their whole content instead. Texts travel compressed.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` lose nothing. Earlier means a smaller (doc_id, start). Rows without
doc_id come after all others and have no order among each other: they lose what occurs with an id, and are otherwise judged alone. Rows that
repeat a doc_id keep their own ranges (a row is named by doc_id and a hash of its text); between them only the start counts, so
identical rows of one id are judged alike, neither loses text to the other, and each keeps what starts nowhere earlier. Rows of one id with the
same passage at the same start, and rows without id, each send their own row of it, where otherwise a slice sends one.
An empty table gives an empty result. ``stage`` decodes what is left, leaving out characters that were cut apart.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import anchors, common
from skygauge.llm.anchors import LENGTH
from skygauge.llm.suffixsort import Suffixes
from skygauge.store import landed

HOT = 2048
#: what a row of the first pass is: the only segment of its anchor string in its slice, a sign that there were several, one of those, a removal
ALONE, SEVERAL, ONE_OF, REMOVED = range(4)
CHUNK = 8_000
PIECE = 512 << 10


class Rows(NamedTuple):
    """Whose row it is: ``null`` without doc_id (``doc`` is 0 then), ``name`` a hash of the text."""

    null: np.ndarray
    doc: np.ndarray
    name: np.ndarray

    @staticmethod
    def read(batch: pa.RecordBatch | pa.Table) -> "Rows":
        doc = batch.column("doc_id")
        return Rows(np.asarray(doc.is_null()), np.asarray(doc.fill_null(0)), np.asarray(batch.column("row")))

    def __getitem__(self, at) -> "Rows":
        return Rows(*(x[at] for x in (self.null, self.doc, self.name))) if not isinstance(at, int) else tuple.__getitem__(self, at)

    def arrow(self) -> list[pa.Array]:
        """doc_id and row."""
        return [pa.array(self.doc, pa.int64(), mask=self.null), pa.array(self.name, pa.int64())]

    def changes(self) -> np.ndarray:
        """Where another row begins."""
        new = np.ones(len(self.doc), bool)
        new[1:] = (self.null[1:] != self.null[:-1]) | (self.doc[1:] != self.doc[:-1]) | (self.name[1:] != self.name[:-1])
        return new

    def order(self, start: np.ndarray, *groups: np.ndarray) -> np.ndarray:
        """By ``groups`` (the last one first), then ids before none, then doc_id and start; without id row by row."""
        return np.lexsort((self.name, start, np.where(self.null, self.name, 0), self.doc, self.null, *groups))

    def later(self, start: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Which of rows in that order have an equal before them that is earlier; ``new`` is where groups of equals begin."""
        at = np.arange(len(start))
        part = new | (self.null & self.changes())
        first, group = np.maximum.accumulate(np.where(part, at, 0)), np.maximum.accumulate(np.where(new, at, 0))
        return (self.doc != self.doc[first]) | (start != start[first]) | (self.null & ~self.null[group])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Rows, np.ndarray]]:
    """(bytes, begin, end, row, offset in the document) of about ``PIECE`` bytes; longer texts in pieces that overlap by a window."""
    def made(parts):
        size = np.array([len(p[0]) for p in parts], np.int64)
        end = np.cumsum(size)
        return (np.frombuffer(b"".join(p[0] for p in parts), np.uint8), end - size, end,
                Rows(np.array([p[1] is None for p in parts]), np.array([p[1] or 0 for p in parts], np.int64), np.array([p[2] for p in parts], np.int64)),
                np.array([p[3] for p in parts], np.int64))

    parts, size = [], 0
    for batch in common.slices(batches):
        for doc_id, name, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            data = (text or "").encode("utf-8", "replace")
            if len(data) < LENGTH:
                continue
            for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                parts.append((data[at:at + PIECE + LENGTH - 1], doc_id, name, at))
                size += len(parts[-1][0])
                if size >= PIECE:
                    yield made(parts)
                    parts, size = [], 0
    if parts:
        yield made(parts)


def _segments(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(lane, key, segment, proof, doc_id, row, place) with place = start * 256 + windows; for removals start * 2^24 + bytes.

    A segment is named by its hash, of which ``bits`` are kept (fewer are for tests), and a second hash as the proof.
    """
    names = ["lane", "key", "segment", "proof", "doc_id", "row", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, begin, end, rows, offset in _slices(batches):
            gram, segment, first, count = anchors.runs(anchors.Hashes(data), len(data), begin, end)
            if not len(gram):
                continue
            segment >>= np.uint64(64 - bits)
            proof = anchors.proofs(data, first, count + LENGTH - 1)
            text = np.searchsorted(begin, first, "right") - 1
            row, start = rows[text], first - begin[text] + offset[text]
            order = row.order(start, proof, segment, gram)
            gram, segment, proof, row, start, count = (x[order] for x in (gram, segment, proof, row, start, count))
            new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
            new_segment = new_gram | np.concatenate([[True], (segment[1:] != segment[:-1]) | (proof[1:] != proof[:-1])])
            twin = ~(new_segment | row.changes() | np.concatenate([[True], start[1:] != start[:-1]]))  # an identical row has it here too
            gone = row.later(start, new_segment)
            stays = ~gone & ~twin
            group = np.cumsum(new_gram) - 1
            several = np.bincount(group, new_segment)[group] > 1
            repeated = np.bincount(group)[group] > 1
            place = start * 256 + count
            # more than once here: told to the other slices, with the least and the largest segment if there are several
            sign = (new_gram & repeated) | (several & np.append(new_gram[1:], True))
            parts = [(ALONE, stays & ~several, gram), (SEVERAL, sign, gram), (ONE_OF, several & stays, segment)]
            own, at, size = _ranges(row[gone], start[gone], start[gone] + count[gone] + LENGTH - 1)
            none = np.zeros(len(at), np.uint64)
            lanes, keys = [np.full(int(m.sum()), lane) for lane, m, _ in parts] + [np.full(len(at), REMOVED)], [k[m] for _, m, k in parts] + [own.name.view(np.uint64)]
            segs, sure, places = ([x[m] for _, m, _ in parts] + [last] for x, last in ((segment, none), (proof, none), (place, at * (1 << 24) + size)))
            whose = Rows(*(np.concatenate(x) for x in zip(*[row[m] for _, m, _ in parts], own)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(lanes).astype(np.int8)), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(segs).view(np.int64)),
                pa.array(np.concatenate(sure).view(np.int64)), *whose.arrow(), pa.array(np.concatenate(places))], names=names)

    return docs.mapInArrow(run, "lane byte, key long, segment long, proof long, doc_id long, row long, place long")


def _ranges(rows: Rows, start: np.ndarray, end: np.ndarray) -> tuple[Rows, np.ndarray, np.ndarray]:
    """``_merged`` of each row's ranges."""
    order = np.lexsort((rows.name, rows.doc, rows.null))
    rows, start, end = rows[order], start[order], end[order]
    new = rows.changes()
    which, start, size = _merged(np.cumsum(new) - 1, start, end)
    return rows[np.flatnonzero(new)[which]], start, size


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = (1 << 24) - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, size) of the unions of overlapping or touching ranges of one document, none longer than ``most``."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    reach, new = end.copy(), np.ones(len(doc), bool)
    rank = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])).astype(np.int64)
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(rank * step + end) - rank * step
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    doc, start, size = doc[first], start[first], reach[last] - start[first]
    pieces = -(-size // most)
    if (pieces > 1).any():
        at = np.repeat(np.arange(len(doc)), pieces)
        turn = common.ragged(np.zeros(len(doc), np.int64), pieces)
        doc, start, size = doc[at], start[at] + turn * most, np.minimum(most, size[at] - turn * most)
    return doc, start, size


def _leads(rows: DataFrame, at: str, by: list[str]) -> DataFrame:
    """``rows`` with ``lead``: no row of equal ``by`` is earlier."""
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", at)
    least, own = F.min(place).over(Window.partitionBy(*by)), F.min(at).over(Window.partitionBy(*by, "row"))
    return rows.withColumns({"_least": least, "_own": own}).withColumn(
        "lead", F.when(F.col("doc_id").isNotNull(), F.col("_least") == place).otherwise(F.col("_least.null") & (F.col(at) == F.col("_own")))).drop("_least", "_own")


def _resolved(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(doc_id, row, start, size, check): removed ranges, and first segments (check) whose windows must be looked into."""
    rows = _segments(docs, bits)
    same = Window.partitionBy("key", F.col("lane") == REMOVED, F.col("lane") == ONE_OF)
    least = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "place")
    joined = rows.withColumns({
        "rows": F.count(F.when(F.col("lane") == ALONE, 1)).over(same), "signs": F.count(F.when(F.col("lane") == SEVERAL, 1)).over(same),
        "low": F.min("segment").over(same), "high": F.max("segment").over(same), "less": F.min("proof").over(same), "more": F.max("proof").over(same), "least": F.min(F.when(F.col("lane") == ALONE, least)).over(same)})
    several = (F.col("low") != F.col("high")) | (F.col("less") != F.col("more"))
    start, count = F.shiftright("place", 8), F.col("place").bitwiseAND(255)
    # without id the least of the own row counts, if no id has the segment
    lead = F.when(F.col("doc_id").isNotNull(), least == F.col("least")).otherwise(F.col("least.null"))
    one = joined.where(f"lane = {REMOVED} OR lane = {ONE_OF} OR (lane = {ALONE} AND (rows > 1 OR signs > 0))").select(
        "lane", "segment", "proof", "doc_id", "row", "place", (several | (F.col("lane") == ONE_OF)).alias("several"), lead.alias("least"))
    one = landed(one, "segments")
    removed = one.where(f"lane = {REMOVED}").select("doc_id", "row", F.shiftright("place", 24).alias("start"), F.col("place").bitwiseAND((1 << 24) - 1).alias("size"))
    plain = one.where(f"lane = {ALONE} AND NOT several")
    own = plain.where("doc_id IS NULL AND least").withColumn("least", F.min("place").over(Window.partitionBy("segment", "proof", "row")) == F.col("place"))
    plain = plain.where("NOT (doc_id IS NULL AND least)").unionByName(own).where("NOT least").select("doc_id", "row", start.alias("start"), (count + LENGTH - 1).alias("size"))
    among = _leads(one.where(f"several AND lane <> {REMOVED}"), "place", ["segment", "proof"])
    first = among.select("doc_id", "row", start.alias("start"), (count + LENGTH - 1).alias("size"), F.col("lead").alias("check"))
    none = F.lit(False)
    return removed.withColumn("check", none).unionByName(plain.withColumn("check", none)).unionByName(first)


def _joined(texts: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Each row with its ranges as an array; identical rows have the same."""
    ranges = ranges.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_name")).agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
    return texts.join(ranges, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_name")), how)


def _name():
    """What tells rows of one doc_id apart."""
    return F.xxhash64("text")


def _texts(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns, doc_id as _doc, the row's name as _row, and the compressed text (null for null)."""
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("doc_id").cast("long").alias("_doc"), _name().alias("_row"), F.col("text").alias("text"))
    schema = T.StructType([T.StructField(f"k_{c}", docs.schema[c].dataType) for c in kept] + [T.StructField("_doc", T.LongType()), T.StructField("_row", T.LongType()), T.StructField("_packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in common.slices(batches):
            packed = [None if t is None else press.compress(t.encode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=[*batch.schema.names[:-1], "_packed"])

    return source.mapInArrow(run, schema)


SPANS = "key long, doc_id long, row long, start long, windows int, offset int, span binary"


def _spans(texts: DataFrame, checks: DataFrame) -> DataFrame:
    """Segments to look into, with their bytes under their anchor string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, name, packed, ranges in zip(*(batch.column(c).to_pylist() for c in ("_doc", "_row", "_packed", "ranges"))):
                data = unpack.decompress(packed)
                for r in ranges:
                    start, size = r["start"], r["size"]
                    span = data[start:start + size]
                    windows = size - LENGTH + 1
                    own = np.frombuffer(span, np.uint8)
                    hashes = anchors.Hashes(own)
                    gram = anchors.mixed(hashes.of(np.arange(size - anchors.GRAM + 1), anchors.GRAM))
                    # the anchor is in every window of the segment: the least gram between the last window's start and the first's end
                    among = gram[windows - 1:LENGTH - anchors.GRAM + 1]
                    at = int(among.argmin()) + windows - 1
                    out.append((int(among[at - windows + 1].view(np.int64)), doc, name, start, windows, at, span))
            if out:
                columns = list(zip(*out))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "doc_id", "row", "start", "windows", "offset", "span"])

    wanted = _joined(texts, checks, "inner").select("_doc", "_row", "_packed", "ranges")
    return wanted.mapInArrow(run, SPANS)


def _compared(group: np.ndarray, doc: np.ndarray | Rows, start: np.ndarray, windows: np.ndarray, offset: np.ndarray, spans: list[bytes]):
    """(row, start, end) of windows that have an equal, earlier one in their group; ``doc`` is ids, or rows."""
    rows = doc if isinstance(doc, Rows) else Rows(np.zeros(len(doc), bool), doc, np.zeros(len(doc), np.int64))
    data = np.frombuffer(b"".join(spans), np.uint8)
    size = windows + LENGTH - 1
    base = np.cumsum(size) - size
    row = np.repeat(np.arange(len(start)), windows)
    turn = common.ragged(np.zeros(len(start), np.int64), windows)
    # equal windows have the anchor at the same place, so they are sorted apart from the others
    bucket = group[row] * 256 + (offset[row] - turn)
    shared = np.bincount(np.unique(bucket, return_inverse=True)[1])[np.unique(bucket, return_inverse=True)[1]] > 1
    row, turn, bucket = row[shared], turn[shared], bucket[shared]
    at = start[row] + turn
    order = rows[row].order(at, bucket)
    row, turn, bucket, at = row[order], turn[order], bucket[order], at[order]
    suffixes = Suffixes(data, base[row] + turn, LENGTH)
    order = suffixes.sort(bucket)
    kind = suffixes.classes(bucket, order)
    # the sort is stable: the earliest of equals comes first
    later = order[rows[row[order]].later(at[order], np.concatenate([[True], kind[1:] != kind[:-1]]) if len(kind) else np.zeros(0, bool))]
    return rows[row[later]] if rows is doc else doc[row[later]], at[later], at[later] + LENGTH


def _windows(spans: DataFrame) -> DataFrame:
    """Hot lane: windows with two hashes of all their bytes, of equal ones in a batch those with none earlier; and what is removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                rows, start, windows = Rows.read(part), part.column("start").to_numpy(), part.column("windows").to_numpy().astype(np.int64)
                data = np.frombuffer(b"".join(part.column("span").to_pylist()), np.uint8)
                size = windows + LENGTH - 1
                base = np.cumsum(size) - size
                row, turn = np.repeat(np.arange(len(start)), windows), common.ragged(np.zeros(len(start), np.int64), windows)
                at = base[row] + turn
                one = anchors.mixed(anchors.Hashes(data).of(at, LENGTH))
                other = anchors.proofs(data, at, np.full(len(at), LENGTH))
                rows, place = rows[row], start[row] + turn
                order = rows.order(place, other, one)
                rows, place, one, other = rows[order], place[order], one[order], other[order]
                new = np.concatenate([[True], (one[1:] != one[:-1]) | (other[1:] != other[:-1])])
                later = rows.later(place, new)
                stays = ~later & (new | rows.changes() | np.concatenate([[True], place[1:] != place[:-1]]))
                gone, begin_, size_ = _ranges(rows[later], place[later], place[later] + LENGTH)
                whose = Rows(*(np.concatenate(x) for x in zip(rows[stays], gone)))
                none = np.zeros(len(begin_), np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([one[stays].view(np.int64), none])), pa.array(np.concatenate([other[stays].view(np.int64), none])), *whose.arrow(),
                    pa.array(np.concatenate([place[stays], begin_])), pa.array(np.concatenate([np.zeros(int(stays.sum()), np.int64), size_]))], names=["one", "other", "doc_id", "row", "start", "size"])

    return spans.mapInArrow(run, "one long, other long, doc_id long, row long, start long, size long")


def _repeated_windows(spans: DataFrame) -> DataFrame:
    """(doc_id, row, start, size) of what repeats among the looked-into segments."""
    spans = landed(spans, "spans")
    hot = spans.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key", (F.col("n") > HOT).alias("hot"))
    spans = spans.join(hot, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def judged(t: pa.Table):
            key = t.column("key").to_numpy()
            rows, at, end = _compared(np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])), Rows.read(t), t.column("start").to_numpy(),
                                     t.column("windows").to_numpy().astype(np.int64), t.column("offset").to_numpy().astype(np.int64), t.column("span").to_pylist())
            rows, at, size = _ranges(rows, at, end)
            return pa.RecordBatch.from_arrays([*rows.arrow(), pa.array(at, pa.int64()), pa.array(size, pa.int64())], names=["doc_id", "row", "start", "size"])

        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                t = pa.Table.from_batches([batch.slice(begin, CHUNK)])
                rest = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
                key = rest.column("key").to_numpy()
                change = np.flatnonzero(key[1:] != key[:-1])
                if len(change) and len(key) >= CHUNK:
                    yield judged(rest.slice(0, int(change[-1]) + 1))
                    rest = rest.slice(int(change[-1]) + 1)
        if rest is not None and rest.num_rows:
            yield judged(rest)

    cold = spans.where("NOT hot").repartition("key").sortWithinPartitions("key").select("key", "doc_id", "row", "start", "windows", "offset", "span")
    found = cold.mapInArrow(run, "doc_id long, row long, start long, size long")
    windows = _windows(spans.where("hot").select("doc_id", "row", "start", "windows", "span"))
    later = _leads(windows.where("size = 0"), "start", ["one", "other"]).where("NOT lead")
    columns = ["doc_id", "row", "start"]
    return found.union(later.select(*columns, F.lit(LENGTH).cast("long").alias("size"))).union(windows.where("size > 0").select(*columns, "size"))


def _apply(docs: DataFrame, kept: list[str], out: list[tuple[str, T.DataType]], function, bits: int = 64) -> DataFrame:
    """``kept`` columns and those that ``function(bytes or None, removed starts, removed ends)`` makes of each document."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _name().alias("row"), F.col("text").alias("text"))
    resolved = landed(_resolved(ids, bits), "resolved")
    texts = _texts(docs, kept)
    removed = resolved.where("NOT check").select("doc_id", "row", "start", "size").union(_repeated_windows(_spans(texts, resolved.where("check"))))
    joined = _joined(texts, removed, "left").select(*[f"k_{c}" for c in kept], "_packed", "ranges")
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            ranges = batch.column("ranges")
            found = []
            for i, packed in enumerate(batch.column("_packed").to_pylist()):
                flat = ranges[i].values
                start = size = np.zeros(0, np.int64)
                if flat is not None and len(flat):
                    _, start, size = _merged(np.zeros(len(flat), np.int64), flat.field("start").to_numpy(), (flat.field("start").to_numpy() + flat.field("size").to_numpy()), 1 << 60)
                found.append(function(None if packed is None else unpack.decompress(packed), start, start + size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"k_{c}") for c in kept] + [pa.array(list(c), pa_type) for c, pa_type in zip(zip(*found), [_ARROW[type(t)] for _, t in out])], names=schema.names) if found else pa.RecordBatch.from_pylist([], batch.schema)

    return joined.mapInArrow(run, schema)


_ARROW = {T.LongType: pa.int64(), T.StringType: pa.string()}


def _left(data: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    if not len(start):
        return data
    return b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)]))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")

    def digest(data: bytes | None, start, end):
        data = data or b""
        return len(data), int((end - start).sum()), len(start), hashlib.sha256(_left(data, start, end)).hexdigest()

    return _apply(docs, ["doc_id"], [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())], digest)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their repeated strings; n_chars follows."""

    def rest(data: bytes | None, start, end):
        return (None if data is None else _left(data, start, end).decode("utf-8", "ignore"),)

    kept = [c for c in docs.columns if c != "text"]
    left = _apply(docs, kept, [("text", T.StringType())], rest)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)
