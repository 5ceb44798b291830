"""Near-duplicate documents by MinHash.

A document is the set of its distinct ``n``-word shingles. Documents of equal sets form a class, and one of each class goes on.
``BANDS`` x ``ROWS`` universal hash functions give minima; documents that share a band's minima meet in a bucket. Two sets of similarity
0.8 miss every bucket with a probability of 3e-6. Buckets with the same members are
compared once. In a bucket, pairs are taken by falling similarity of their signatures; a pair whose ends are not yet connected is
confirmed on the full sets. Links of classes and buckets are joined to components by alternating stars.

A bucket of more than ``TILE`` documents is dealt to tiles, and each pair of tiles is a group of its own, so no group is larger than two
tiles and no pair of the bucket is left out. Only connecting links leave a group, never all its pairs.

Defined results: a null text, or one without words, has no shingle, is linked with nothing and kept. With fewer than ``n`` words the whole
sequence is one shingle. Rows without doc_id are linked with nothing and kept. Repeated rows of one doc_id share their result; ``stage``
leaves one of them. An empty table gives an empty result. Extra columns are ignored by ``near_duplicates`` and kept by ``stage``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygauge.llm import common
from skygauge.llm.components import components
from skygauge.operators.ordered import positions
from skygauge.store import landed

BANDS = 24
ROWS = 4
TILE = 800
SIMILAR = 80
#: signatures of a pair of similarity 0.8 stay above this but for one in a million
FLOOR = 0.6
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_rng = np.random.default_rng(20240601)
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """word -> 64-bit hash; the cache changes no result."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 40:
            if len(self) > 300_000:
                self.clear()
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, n: int, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of UTF-8 text; words are runs without space, tab or line breaks, in lower-case ASCII."""
    own = np.fromiter(map(words.__getitem__, text.translate(_LOWER).split()), np.uint64)
    if not len(own):
        return own
    if len(own) < n:
        return np.array([xxhash.xxh3_64_intdigest(own.tobytes(), 1)], np.uint64)
    total = np.zeros(len(own) - n + 1, np.uint64)
    for i in range(n):
        total = _mixed(total + own[i:len(own) - n + 1 + i])
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal functions a x + b over each non-empty set: (sets, functions)."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), len(_A)), np.uint64)
    for i, (a, b) in enumerate(zip(_A, _B)):
        out[:, i] = np.minimum.reduceat(flat * a + b, starts)
    return out


def _signed(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set, and its band keys (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in common.slices(batches, most=1 << 20):
            sets = [shingles((t or "").encode("utf-8", "replace"), n, words) for t in batch.column("text").to_pylist()]
            size = np.array([len(s) for s in sets])
            some = np.flatnonzero(size)
            keys = np.zeros((0, BANDS), np.int64)
            if len(some):
                signs = signature([sets[i] for i in some]).reshape(len(some), BANDS, ROWS)
                total = np.arange(1, BANDS + 1, dtype=np.uint64)[None] * _MIX
                for r in range(ROWS):
                    total = _mixed(total + signs[:, :, r])
                keys = total.view(np.int64)
            whole = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            cuts = np.concatenate([[0], np.cumsum(size > 0)]).astype(np.int32) * BANDS
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(whole, pa.binary()),
                pa.ListArray.from_arrays(cuts, np.ascontiguousarray(keys).ravel())], names=["doc_id", "n_shingles", "whole", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, whole binary, bands array<long>")


def _packed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in common.slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [press.compress((t or "").encode("utf-8", "replace")) for t in batch.column("text").to_pylist()], pa.binary())], names=["id", "packed"])

    return docs.mapInArrow(run, "id long, packed binary")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


class _Group:
    """Members of one bucket, or of two of its tiles."""

    def __init__(self, n: int):
        self.n, self.words, self.unpack, self.sets = n, _Words(), zstandard.ZstdDecompressor(), {}

    def links(self, ids: list[int], tiles: np.ndarray, packed: list[bytes]) -> list[tuple[int, int]]:
        """Pairs that connect similar members: within the tile if there is one, else across the two."""
        sets = [shingles(self.unpack.decompress(p), self.n, self.words) for p in packed]
        across = tiles.min() != tiles.max()
        a, b, alike = self._candidates(sets, tiles, across)
        parent = list(range(len(ids)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found = []
        for k in np.argsort(-alike, kind="stable"):
            i, j = root(a[k]), root(b[k])
            if i != j and _similar(sets[a[k]], sets[b[k]]):
                parent[i] = j
                found.append((ids[a[k]], ids[b[k]]))
        return found

    @staticmethod
    def _candidates(sets, tiles, across):
        if len(sets) == 2:
            return [0], [1], np.ones(1)
        signs = (signature(sets) >> np.uint64(32)).astype(np.uint32)
        a, b, alike = [], [], []
        for i in range(len(sets) - 1):
            share = (signs[i + 1:] == signs[i]).mean(1)
            good = share >= FLOOR
            if across:
                good &= tiles[i + 1:] != tiles[i]
            own = np.flatnonzero(good)
            a.append(np.full(len(own), i))
            b.append(own + i + 1)
            alike.append(share[own])
        return np.concatenate(a), np.concatenate(b), np.concatenate(alike)


def _linked(groups: DataFrame, n: int) -> DataFrame:
    """``groups``: (key, one, two, tile, id, packed), the rows of a group one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, now, rows = _Group(n), None, []

        def close():
            found = work.links([r[0] for r in rows], np.array([r[1] for r in rows]), [r[2] for r in rows]) if len(rows) > 1 else []
            rows.clear()
            return found

        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("key", "one", "two", "id", "tile", "packed")]
            for key, one, two, *row in zip(*columns):
                if (key, one, two) != now:
                    found += close()
                    now = key, one, two
                rows.append(row)
            if found:
                yield _pairs(found)
        if found := close():
            yield _pairs(found)

    return groups.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "id").mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    signed = landed(_signed(docs, n), "signed")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("whole").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    copies = some.select("whole", F.col("doc_id").alias("a")).join(classes.where("copies > 1").select("whole", F.col("id").alias("b")), "whole").where("a <> b").select("a", "b")
    # one document of each class, with its bands: the smallest id is found again by a join on the id alone
    first = classes.select(F.col("id").alias("doc_id"))
    bands = some.join(first, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")).distinct()
    sizes = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("least"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("members"))
    buckets = sizes.where("size > 1").groupBy("size", "least", "members").agg(F.min("key").alias("key")).select("key", "size")
    tiled = bands.join(buckets, "key").withColumn("tiles", F.ceil(F.col("size") / TILE)).withColumn(
        "tile", F.pmod(F.xxhash64("id", F.lit(7)), F.col("tiles")))
    rows = landed(tiled.select("key", "id", "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")).select(
        "key", "id", "tile", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two")), "buckets")
    # the same join at every size: a small side is not broadcast
    texts = _packed(docs.where("doc_id IS NOT NULL")).join(rows.select("id").distinct().hint("merge"), "id", "left_semi").dropDuplicates(["id"])
    links = _linked(rows.join(landed(texts, "texts"), "id"), n)
    found = components(links.union(copies))
    joined = signed.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                         F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")), F.lit(True)).alias("kept"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), 2)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles): the one with the smallest id.

    Rows that share a doc_id are documents of their own if their texts differ, and one document otherwise; of those one row stays, and among
    near duplicates of one id the one whose text has the smallest hash. Rows without id all stay.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1")
    if repeated.isEmpty():
        drop = near_duplicates(docs, 5).where("NOT kept").select(F.col("doc_id").alias("_drop"))
        return docs.join(drop, docs["doc_id"] == drop["_drop"], "left_anti")
    # documents are numbered in the order of (doc_id, hash of the text)
    own = common.unused(docs.columns, "_near_")
    named = docs.withColumn(f"{own}name", F.xxhash64("text"))
    texts = named.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(f"{own}id"), F.col(f"{own}name").alias(f"{own}key")).agg(F.min("text").alias("text"))
    numbered = landed(positions(texts, [f"{own}id", f"{own}key"], f"{own}number"), "numbered")
    kept = near_duplicates(numbered.select(F.col(f"{own}number").alias("doc_id"), "text"), 5).where("kept").select(F.col("doc_id").alias(f"{own}number"))
    kept = numbered.join(kept, f"{own}number", "left_semi").select(f"{own}id", f"{own}key")
    chosen = named.join(kept, (F.col("doc_id") == F.col(f"{own}id")) & (F.col(f"{own}name") == F.col(f"{own}key")), "left_semi")
    whole = F.struct(*[F.hash(c).alias(f"h{i}") for i, c in enumerate(docs.columns)])
    place = F.row_number().over(Window.partitionBy("doc_id", f"{own}name").orderBy(whole))
    once = chosen.withColumn(f"{own}place", place).where(F.col(f"{own}place") == 1).select(*docs.columns)
    return once.unionByName(docs.where("doc_id IS NULL"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id, coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id
"""
