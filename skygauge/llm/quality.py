"""Document quality by a factorisation machine.

Inputs of a score are the whole text and its stored length: hashed words (log counts of unit length), and
structure statistics cut into bins. The model is w0 + w.x + sum over pairs of <v_i, v_j> x_i x_j;
with the identity 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) the pairs cost as much as the words.

Learning takes at most ``SAMPLE`` labelled documents (in hash order of their ids); the factors are fitted with numpy.

Defined results: null and empty texts are scored like any other, as a text without words. Several labels for one
document count as their maximum; null labels are ignored. If no label, or only one value, can be learned, every
document scores the constant share of that label (0.5 without any). Repeated rows are answered one by one.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import common, words

SAMPLE = 6000
BUCKETS = 1 << 14
FACTORS = 8
BINS = 12
EPOCHS = 12
THRESHOLD = 0.7
STATS = ("length", "stored length", "letters", "upper case", "digits", "spaces", "punctuation", "symbols", "words", "word length", "distinct words",
         "most common word", "word repeats", "lines", "repeated lines", "words per line")
_CLASS = np.zeros(256, np.uint8)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b".,;:'\"?()-", b"\n"), 1):
    _CLASS[np.frombuffer(_set, np.uint8)] = _i


def statistics(texts: list[str | None], stored: np.ndarray, doc: np.ndarray, bucket: np.ndarray, pair_doc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(document, statistic) table; ``pair_doc`` and ``count`` are of the distinct words."""
    n = len(texts)
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    where = np.repeat(np.arange(n), size)
    seen = np.bincount(where * 8 + _CLASS[np.frombuffer(b"".join(raw), np.uint8)], minlength=n * 8).reshape(n, 8)
    per = 1.0 / np.maximum(size, 1)
    n_words = np.bincount(doc, minlength=n)
    distinct = np.bincount(pair_doc, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, pair_doc, count)
    repeats = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (bucket[1:] == bucket[:-1])], minlength=n)
    lines = seen[:, 6] + 1
    again = np.array([1 - len(set(own)) / len(own) if len(own := t.split("\n")) > 1 else 0.0 for t in ((t or "") for t in texts)])
    some = np.maximum(n_words, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(np.where(np.isnan(stored), size, stored)), (seen[:, 1] + seen[:, 2]) * per, seen[:, 2] * per, seen[:, 3] * per, seen[:, 4] * per,
        seen[:, 5] * per, seen[:, 0] * per, np.log1p(n_words), size / some, distinct / some, top / some, repeats / some, np.log1p(lines), again, n_words / lines])


def features(texts: list[str | None], stored: np.ndarray, buckets: words.Buckets):
    """Distinct words as (document, bucket, weight), and the table of statistics."""
    doc, bucket = words.of(texts, buckets)
    pair_doc, pair_bucket, count, weight = words.weighted(doc, bucket, len(texts), buckets.buckets)
    return pair_doc, pair_bucket, weight, statistics(texts, stored, doc, bucket, pair_doc, count)


@dataclass
class Machine:
    edges: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, doc: np.ndarray, bucket: np.ndarray, weight: np.ndarray, stats: np.ndarray) -> np.ndarray:
        n = len(stats)
        if not len(self.linear):
            return np.full(n, self.bias)
        at = binned(stats, self.edges)
        total = self.bias + np.bincount(doc, weight * self.linear[bucket], n) + self.linear[at].sum(1)
        for f in self.factors.T:
            words_f, stats_f = f[bucket] * weight, f[at]
            total += 0.5 * ((np.bincount(doc, words_f, n) + stats_f.sum(1)) ** 2 - np.bincount(doc, words_f**2, n) - (stats_f**2).sum(1))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def binned(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Feature numbers of the statistics, behind the words: one of ``BINS`` for each statistic."""
    return BUCKETS + np.arange(stats.shape[1]) * BINS + (stats[:, :, None] > edges[None]).sum(2)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, label: np.ndarray, seed: int = 5) -> Machine:
    """``rows``: the (buckets, weights) of each document. Logistic loss, AdaGrad, batches of 256."""
    if not len(label) or label.min() == label.max():
        return Machine(np.zeros((0, 0)), float(label.mean()) if len(label) else 0.5, np.zeros(0), np.zeros((0, FACTORS)))
    rng = np.random.default_rng(seed)
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    at = binned(stats, edges)
    size = BUCKETS + stats.shape[1] * BINS
    bias, linear, factors = float(np.log(label.mean() / (1 - label.mean()))), np.zeros(size, np.float32), rng.normal(0, 0.03, (size, FACTORS)).astype(np.float32)
    past_l, past_f = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for start in range(0, len(order), 256):
            own = order[start:start + 256]
            x = np.zeros((len(own), size), np.float32)
            for i, j in enumerate(own):
                x[i, rows[j][0]] = rows[j][1]
            x[np.arange(len(own))[:, None], at[own]] = 1
            square, inner = x * x, x @ factors
            total = bias + x @ linear + 0.5 * (inner**2 - square @ factors**2).sum(1)
            slope = ((1 / (1 + np.exp(-np.clip(total, -30, 30))) - label[own]) / len(own)).astype(np.float32)
            to_l = x.T @ slope + 1e-5 * linear
            to_f = x.T @ (slope[:, None] * inner) - factors * (square.T @ slope)[:, None] + 1e-5 * factors
            past_l += to_l**2
            past_f += to_f**2
            bias -= 0.5 * float(slope.sum())
            linear -= 0.1 * to_l / np.sqrt(past_l)
            factors -= 0.02 * to_f / np.sqrt(past_f)
    return Machine(edges, bias, linear.astype(float), factors.astype(float))


def labelled(docs: DataFrame, labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents. The broadcast side has at most ``limit`` rows of ids and labels."""
    chosen = common.sampled(labels.where(F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).alias("_label")), limit)
    return docs.join(F.broadcast(chosen), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Machine:
    rows = labelled(docs, labels, "quality", limit).select("text", F.col("n_chars").cast("double").alias("n_chars"), F.col("_label").cast("double").alias("_label"))

    def run(batches):
        buckets = words.Buckets(BUCKETS)
        for batch in common.slices(batches):
            doc, bucket, weight, stats = features(batch.column("text").to_pylist(), stored(batch), buckets)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(cuts, bucket.astype(np.int32)), pa.ListArray.from_arrays(cuts, weight.astype(np.float32)),
                pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * stats.shape[1], stats.ravel()), batch.column("_label")],
                names=["bucket", "weight", "stats", "label"])

    found = rows.mapInArrow(run, "bucket array<int>, weight array<float>, stats array<double>, label double").toPandas()
    stats = np.array(found["stats"].tolist()).reshape(len(found), len(STATS))
    return fit(list(zip(found["bucket"], found["weight"])), stats, found["label"].to_numpy(float))


def stored(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)


def score(docs: DataFrame, machine: Machine, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns (default all), then ``prefix``score and ``prefix``predicted, which replace columns of their names."""
    names = [f"{prefix}score", f"{prefix}predicted"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    length = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("text").alias("text"), length.alias("n_chars"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = words.Buckets(BUCKETS)
        for batch in common.slices(batches):
            found = machine.score(*features(batch.column("text").to_pylist(), stored(batch), buckets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"k_{c}") for c in kept] + [pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def learned(spark: SparkSession, sf_dir: str) -> Machine:
    labels = common.table(spark, sf_dir, "labels").where(~common.held_out(4, 2)).select("doc_id", "quality")
    return learn(common.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), labels)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return score(docs, learned(spark, sf_dir), ["doc_id"]).select("doc_id", common.held_out(4, 2).alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``THRESHOLD``."""
    prefix = common.unused(docs.columns, "_quality_")
    return score(docs, learned(spark, sf_dir), prefix=prefix).where(F.col(f"{prefix}predicted") == 1).select(*docs.columns)
