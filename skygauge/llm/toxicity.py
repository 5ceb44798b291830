"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all documents, whatever their labels, is the unlabelled
set. With class prior p and the logistic loss, the risk is  p R+(1) + max(0, Ru(0) - p R+(0)):  the share of
positives hidden in the unlabelled set is taken out again, and where the corrected part falls below
zero the step goes the other way. Members trained on different four fifths are averaged; an L1 term keeps them
sparse, and words that the positives don't use more often than the unlabelled texts are left out. Inputs of a score are the words of the whole text and nothing else.

The prior is the share of toxic documents among the labelled ones that may be learned from; for lists of positives
only, pass ``prior``. Learning takes at most ``POSITIVES`` toxic documents and ``UNLABELLED`` others,
both in hash order of their ids. The averaged logit is shifted so that ``THRESHOLD`` lies where the
same non-negative estimate, of the 0-1 loss, is least: the raw output of the risk is not a probability.

Defined results: null, empty or wordless texts are scored by the intercept. Several labels for one document count
as their maximum; null labels are ignored. Without a positive or an unlabelled document every score is 0. Repeated rows
are answered one by one.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import common, words

POSITIVES = 2500
UNLABELLED = 7500
BUCKETS = 1 << 16
MEMBERS = 3
BEGINNINGS = (4, 5)
EXCESS = 4.0
STEPS = 300
SPARSITY = 0.002
THRESHOLD = 0.7


@dataclass
class Ensemble:
    weight: np.ndarray
    bias: float

    def score(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        if not len(self.weight):
            return np.zeros(n)
        total = self.bias + np.bincount(doc, self.weight[bucket], n)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def features(texts: list[str | None], buckets: words.Stems) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) of words and of their first four and five letters.

    Presence counts, so an insult weighs the same in a long text; beginnings carry insults over to inflected forms.
    """
    doc, bucket = words.distinct(texts, buckets)
    key = np.unique(doc * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


def fit(rows: list[np.ndarray], positive: np.ndarray, prior: float, members: int = MEMBERS) -> Ensemble:
    """``rows``: distinct buckets of each document; ``positive`` marks the confirmed ones, the others are unlabelled."""
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    if not len(pos) or not len(unl) or prior <= 0:
        return Ensemble(np.zeros(0), 0.0)
    docs = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64)
    known = _telling(docs, flat, positive)[flat]
    docs, flat = docs[known], flat[known]
    weight = np.zeros(BUCKETS)
    for seed in range(members):
        rng = np.random.default_rng(seed)
        share = np.zeros((2, len(rows)))  # the weight of each document among the positives, among the unlabelled
        for side, own in enumerate((pos, unl)):
            chosen = rng.choice(own, max(1, len(own) * 4 // 5), replace=False)
            share[side, chosen] = 1 / len(chosen)
        weight += _member(docs, flat, share, prior) / members
    raw = np.bincount(docs, weight[flat], len(rows))
    return Ensemble(weight, float(np.log(THRESHOLD / (1 - THRESHOLD)) - _cut(raw[pos], raw[unl], prior)))


def _telling(docs: np.ndarray, flat: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Words that are more frequent among the positives than in the unlabelled set, by ``EXCESS`` standard errors."""
    own = positive[docs]
    n_pos, n_unl = positive.sum(), (~positive).sum()
    seen_pos, seen_unl = np.bincount(flat[own], minlength=BUCKETS), np.bincount(flat[~own], minlength=BUCKETS)
    pooled = (seen_pos + seen_unl + 1) / (n_pos + n_unl + 2)
    excess = seen_pos / n_pos - seen_unl / n_unl
    return excess > EXCESS * np.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))


def _member(docs: np.ndarray, flat: np.ndarray, share: np.ndarray, prior: float) -> np.ndarray:
    """Accelerated proximal steps on the non-negative risk; the L1 term drops words that toxic texts don't prefer."""
    used = share.sum(0)[docs] > 0
    docs, flat = docs[used], flat[used]
    mass = share.sum(0) * (1 + np.bincount(docs, minlength=share.shape[1]))
    rate = 4 / np.maximum(np.bincount(flat, mass[docs], BUCKETS), 0.01)  # a bound of each word's curvature
    rate_bias = 4 / mass.sum()
    weight, ahead, bias, bias_ahead = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for step in range(STEPS):
        z = np.clip(np.bincount(docs, ahead[flat], share.shape[1]) + bias_ahead, -30, 30)
        slope = 1 / (1 + np.exp(-z))  # of the loss of "negative"; that of "positive" is one less
        loss = np.log1p(np.exp(z))
        as_negative = share[1] @ loss - prior * (share[0] @ loss)
        if as_negative >= 0:
            pull = share[1] * slope - prior * share[0]
        else:
            pull = prior * share[0] * slope - share[1] * slope
        new = ahead - rate * np.bincount(flat, pull[docs], BUCKETS)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * SPARSITY * prior, 0)
        new_bias = bias_ahead - rate_bias * pull.sum()
        momentum = step / (step + 3)
        ahead, bias_ahead = new + momentum * (new - weight), new_bias + momentum * (new_bias - bias)
        weight, bias = new, new_bias
    return weight


def _cut(pos: np.ndarray, unl: np.ndarray, prior: float) -> float:
    """The cut with the least non-negative 0-1 risk; the middle of the widest gap among equally good ones."""
    values = np.unique(np.concatenate([pos, unl]))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts) / len(x)
    risk = prior * (1 - above(pos)) + np.maximum(0, above(unl) - prior * above(pos))
    good = np.flatnonzero(risk <= risk.min() + 0.002)
    return float(cuts[good[len(good) // 2]])


def learn(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Ensemble:
    """``labels``: doc_id, toxic of the rows that may be learned from."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    toxic = common.sampled(known.where("toxic = 1").select("doc_id"), positives).withColumn("_toxic", F.lit(True))
    other = common.sampled(docs.select("doc_id"), unlabelled, seed=23).withColumn("_toxic", F.lit(False))
    # at most ``positives + unlabelled`` ids are broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(toxic.union(other)), "doc_id").select("text", "_toxic")

    def run(batches):
        buckets = words.Stems(BUCKETS, BEGINNINGS)
        for batch in common.slices(batches):
            doc, bucket = features(batch.column("text").to_pylist(), buckets)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(cuts, bucket.astype(np.int32)), batch.column("_toxic")], names=["bucket", "toxic"])

    found = rows.mapInArrow(run, "bucket array<int>, toxic boolean").toPandas()
    return fit([np.asarray(x, np.int64) for x in found["bucket"]], found["toxic"].to_numpy(bool), prior)


def score(docs: DataFrame, ensemble: Ensemble, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns (default all), then ``prefix``score and ``prefix``predicted, which replace columns of their names."""
    names = [f"{prefix}score", f"{prefix}predicted"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("text").alias("text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = words.Stems(BUCKETS, BEGINNINGS)
        for batch in common.slices(batches):
            found = ensemble.score(*features(batch.column("text").to_pylist(), buckets), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"k_{c}") for c in kept] + [pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = common.held_out(3, 1)
    labels = common.table(spark, sf_dir, "labels").where(~held).select("doc_id", "toxic")
    ensemble = learn(docs.where(~held), labels)
    return score(docs, ensemble, ["doc_id"]).select("doc_id", held.alias("held_out"), "score", "predicted")
