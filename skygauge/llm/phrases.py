"""Phrase collocations: frequent phrases of two and three words, scored at their weakest cut.

Texts are lower-cased (A-Z only), split at punctuation into pieces and those into words. Every word starts a suffix of up to
three words of its piece; a slice of documents holds each different suffix once, with its count. The suffixes are routed by their leading
words, up to and including the first word that is not frequent: a frequent word (more than ``HEAVY`` occurrences and more than 1 / 65536 of all)
never brings its suffixes to one task, and at most 65,536 words are frequent (their 64-bit hashes go to every task; words that share such a hash are routed alike,
which changes no count). The routes are dealt to buckets of about ``BUCKET`` words; a slice sends one compressed block of suffixes to each bucket and language.
A bucket's suffixes are sorted by a multikey three-way quicksort; the weight of an equal partition is the phrase's count, and
partitions below ``LEAST`` are abandoned (``multikey``). Prefixes shorter than their route are counted in part there and summed afterwards.

A phrase of ``a`` occurrences, cut into parts of ``l`` and ``r``, scores floor(1000000 a a / (l r)) in decimal arithmetic, exact for counts below
10^16; the lowest cut counts, of equal ones the shorter first part. A pair inside a frequent triple that has at least half of its occurrences is dropped.

Defined results: a null text has no words, a null language is ``und``; n counts every word. Words keep every character but A-Z, spaces, tabs and the
punctuation named, of whatever length. Repeated rows count each. Equal scores go by a, then by the phrase's bytes. Other columns are ignored.
An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygauge.llm import common
from skygauge.llm.multikey import heavy_prefixes
from skygauge.store import landed

LEAST = 10
TOP = 2000
HEAVY = 1000
SHARE = 1 << 16
SLICE = 8 << 20
BUCKET = 2_000_000
WORDS = ("w1", "w2", "w3")
SUFFIX = "lang string, w1 string, w2 string, w3 string, n long"
_SUFFIX_SCHEMA = pa.schema([("lang", pa.string()), *((w, pa.string()) for w in WORDS), ("n", pa.int64())])
#: every end of a piece becomes a full stop, the tab a space
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"." * 10 + b" ")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[str]) -> pa.Array:
    """The words of all texts, dictionary-encoded; code 0 is a full stop and stands for the end of a piece."""
    data = b" . ".join([t.encode("utf-8", "replace") for t in texts]).lower().translate(_ENDS)
    data = b". " + data.replace(b".", b" . ") + b" . ."
    parts = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int64)), pa.py_buffer(data)]))
    words = parts.flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()


def hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A 64-bit hash of each word of a language."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"))
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Language and words of the texts of each slice."""
    for batch in common.slices(batches, most=SLICE):
        langs, texts = batch.column("lang"), batch.column("text")
        for lang in langs.unique().to_pylist():
            yield lang, words_of(texts.filter(pc.equal(langs, lang)).to_pylist())


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, w1, hash and n of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, coded in _by_lang(batches):
            n = np.bincount(coded.indices.to_numpy(zero_copy_only=False))[1:]
            words = coded.dictionary[1:]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), words.cast(pa.string()), pa.array(hashes(words, lang).view(np.int64)), pa.array(n, pa.int64())],
                                             names=["lang", "w1", "hash", "n"])

    return _filled(docs).mapInArrow(run, "lang string, w1 string, hash long, n long").groupBy("lang", "w1", "hash").agg(F.sum("n").alias("n"))


def counted(coded: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes of up to three words, as codes (place, suffix) with 0 past the end, and their numbers."""
    code, size = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    first, second, third = code[:-2], code[1:-1], code[2:]
    kept = first > 0
    first, second, third = first[kept], second[kept], (third * (second > 0))[kept]
    pair = first * size + second
    known = None
    if size >= 1 << 20:  # three numbers would not fit
        known, pair = np.unique(pair, return_inverse=True)
    key, n = np.unique(pair * size + third, return_counts=True)
    pair, third = key // size, key % size
    pair = pair if known is None else known[pair]
    return np.stack([pair // size, pair % size, third]), n


def routes(codes: np.ndarray, hashed: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number) of each suffix's leading words up to the first that is not frequent; ``hashed``: of the words by code, ``heavy``: sorted."""
    place = np.minimum(np.searchsorted(heavy, hashed), max(len(heavy) - 1, 0))
    frequent = heavy[place] == hashed if len(heavy) else np.zeros(len(hashed), bool)
    route, depth, on = hashed[codes[0]], np.ones(codes.shape[1], np.int8), np.ones(codes.shape[1], bool)
    for level in (1, 2):
        on = on & frequent[codes[level - 1]]
        depth[on] = level + 1
        route = np.where(on, (route ^ (route >> np.uint64(29))) * _MIX + hashed[codes[level]], route)
    return route ^ (route >> np.uint64(32)), depth


def _packed(words: pa.Array, codes: np.ndarray, n: np.ndarray, depth: np.ndarray) -> bytes:
    """Suffixes as the words they use and columns of numbers, byte planes apart."""
    used, own = np.unique(codes, return_inverse=True)
    text = b" ".join(words.take(pa.array(used)).cast(pa.large_binary()).to_pylist())
    columns = np.concatenate([own.reshape(3, -1), n[None]]).astype(np.uint32)
    columns[0, 1:] -= columns[0, :-1].copy()  # they are sorted
    planes = columns.view(np.uint8).reshape(4, -1, 4).transpose(0, 2, 1).tobytes()
    sizes = np.array([len(n), len(used), len(text)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + planes + depth.tobytes() + text)


def _unpacked(payload: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n, _, size = np.frombuffer(data, np.int64, 3)
    columns = np.frombuffer(data, np.uint8, 16 * n, 24).reshape(4, 4, n).transpose(0, 2, 1).copy().view(np.uint32)[..., 0]
    columns[0] = np.cumsum(columns[0], dtype=np.uint32)
    return data[len(data) - size:].split(b" "), columns[:3], columns[3], np.frombuffer(data, np.int8, n, 24 + 16 * n)


def routed(docs: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """bucket, lang and payload: the suffixes of up to three words, once for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, coded in _by_lang(batches):
            codes, n = counted(coded)
            hashed = hashes(coded.dictionary, lang)
            route, depth = routes(codes, hashed, heavy)
            bucket = (route % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                own = order[a:b]
                payload = _packed(coded.dictionary, codes[:, own], n[own], depth[own])
                yield pa.RecordBatch.from_pydict({"bucket": [int(bucket[own[0]])], "lang": [lang], "payload": [payload]})

    return _filled(docs).mapInArrow(run, "bucket long, lang string, payload binary")


def _frequent(lang: str, payloads: list[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """The frequent prefixes of one bucket and language."""
    parts = [_unpacked(p) for p in payloads]
    words = pa.array([w for part in parts for w in part[0]], pa.binary()).dictionary_encode()
    number = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    stop = np.flatnonzero(np.array([w == b"." for w in words.dictionary.to_pylist()]))
    first = np.cumsum([0, *(len(part[0]) for part in parts)])
    codes = np.concatenate([number[at + part[1]] for at, part in zip(first, parts)], axis=1)
    codes[np.isin(codes, stop)] = -1
    weight, depth = (np.concatenate([part[i] for part in parts]) for i in (2, 3))
    shown = words.dictionary.cast(pa.string())
    for d in (1, 2, 3):
        rows = np.flatnonzero(depth == d)
        floors = tuple(least if level >= d else 1 for level in (1, 2, 3))  # prefixes shorter than the route are only a part
        for level, (at, n) in enumerate(heavy_prefixes(codes[:, rows], weight[rows], floors), 1):
            own = codes[:, rows[at]]
            columns = [shown.take(pa.array(own[i])) if i < level else pa.nulls(len(n), pa.string()) for i in range(3)]
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *columns, pa.array(n, pa.int64())], schema=_SUFFIX_SCHEMA)


def frequent(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, w1, w2, w3 (null past the end) and n of every prefix of a routed suffix that occurs ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        for (_, lang), group in groupby(each, key=lambda row: row[:2]):
            yield from _frequent(lang, [row[2] for row in group], least)

    parts = rows.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(run, SUFFIX)
    return parts.groupBy("lang", *WORDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    words = landed(word_counts(docs), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = words.where(F.col("n") > max(HEAVY, total // SHARE)).select("hash").distinct().collect()  # at most ``SHARE`` rows
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    counts = landed(frequent(routed(docs, np.sort(np.array([r.hash for r in hot], np.int64).view(np.uint64)), buckets), least), "frequent")
    one = counts.where("w2 IS NULL").select("lang", "w1", "n")
    two = counts.where("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", "n")
    three = counts.where("w3 IS NOT NULL").select("lang", *WORDS, F.col("n").alias("a"))

    def with_count(left: DataFrame, right: DataFrame, names: list[str], out: str) -> DataFrame:
        return left.join(right.toDF("lang", *names, out), ["lang", *names])

    score = "CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)) DIV (CAST({l} AS DECIMAL(19, 0)) * CAST({r} AS DECIMAL(19, 0)))"
    triples = with_count(with_count(three, one, ["w1"], "l1"), two, ["w2", "w3"], "r1")
    triples = with_count(with_count(triples, two, ["w1", "w2"], "l2"), one, ["w3"], "r2")
    triples = triples.withColumns({"s1": F.expr(score.format(l="l1", r="r1")), "s2": F.expr(score.format(l="l2", r="r2"))})
    later = F.col("s2") < F.col("s1")
    triples = triples.select("lang", F.concat_ws(" ", *WORDS).alias("phrase"), "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                             F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    inside = three.select("lang", "w1", "w2", "a").union(three.select("lang", "w2", "w3", "a")).groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    pairs = two.withColumnRenamed("n", "a").join(inside, ["lang", "w1", "w2"], "left").where("longer IS NULL OR 2 * longer < a")
    pairs = with_count(with_count(pairs, one, ["w1"], "l"), one, ["w2"], "r")
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", F.expr(score.format(l="l", r="r")).alias("score"))

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = triples.union(pairs).withColumn("part", F.xxhash64("phrase") % 64)
    # the best of each part first: a language is never sorted in one task
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), numbered AS (
    SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), placed AS (
    SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM numbered
), runs AS (
    SELECT lang, w AS w1, lead(w) OVER own AS w2, lead(w, 2) OVER own AS w3 FROM placed WINDOW own AS (PARTITION BY p ORDER BY i)
), grams AS (
    SELECT lang, w1 AS g, count(*) AS f FROM runs GROUP BY ALL
    UNION ALL SELECT lang, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
), pairs AS (
    SELECT lang, w1, w2, count(*) AS a FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), triples AS (
    SELECT lang, w1, w2, w3, count(*) AS a FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), longest AS (
    SELECT lang, g, max(a) AS f
    FROM (SELECT lang, w1 || ' ' || w2 AS g, a FROM triples UNION ALL SELECT lang, w2 || ' ' || w3, a FROM triples) GROUP BY ALL
), halves AS (
    SELECT lang, w1 || ' ' || w2 AS phrase, a, 1 AS k, w1 AS x, w2 AS y FROM pairs
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 1, w1, w2 || ' ' || w3 FROM triples
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 2, w1 || ' ' || w2, w3 FROM triples
), cuts AS (
    SELECT h.lang, h.phrase, h.a, h.k, l.f AS l, r.f AS r, (1000000::HUGEINT * h.a * h.a) // (l.f::HUGEINT * r.f) AS score
    FROM halves h JOIN grams l ON l.lang = h.lang AND l.g = h.x JOIN grams r ON r.lang = h.lang AND r.g = h.y
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN longest i ON i.lang = s.lang AND i.g = s.phrase WHERE i.f IS NULL OR 100 * i.f < 50 * s.a
), totals AS (
    SELECT lang, count(*) AS n FROM runs GROUP BY lang
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
