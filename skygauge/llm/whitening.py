"""Whitening of embeddings by an incremental eigendecomposition.

Every entry c becomes the integer x = floor(64 c) + 1000000. The fit list holds each different x vector once. Each task keeps the spectrum
of its rows' scatter: rows are condensed in blocks of ``BLOCK`` by orthogonal reflections to at most as many rows as there are
dimensions, and each of those is a centred rank-one update, solved by the secular equation with deflation (``rankone``). The tasks' spectra are
combined, ``FAN`` at a time, by successive rank-one updates. The leading vectors are then refined by distributed Rayleigh-Ritz
steps: one pass over the fit list multiplies them by the covariance, the small projected problem is solved, and residuals
that are still too large widen the space for the next pass.

What reaches the driver is one spectrum, one product matrix a pass and the sums of the dimensions: sizes that depend on the dimensions only.

Defined results: rows whose vector is null or empty, or holds null, non-finite or unrepresentable entries (64 c beyond 62 bits) are left out, as are
vectors of rarer lengths (of equally frequent lengths the larger counts); zero vectors count. A null vec_id is kept. Repeated rows are answered one by
one and count once in the fit. Other columns are ignored. Components whose variance is zero to double precision have no whitened value and are
not returned; with a single different vector, or an empty table, the result is empty. ``deviation`` is null where it needs more than 64 bits.
"""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge.llm import common
from skygauge.llm.rankone import Spectrum
from skygauge.store import landed

SHIFT = 1_000_000
COMPONENTS = 16
SPARE = 8
BLOCK = 2048
FAN = 16
PASSES = 30
PRECISE = 1e-13


def integers(rows: DataFrame) -> DataFrame:
    """vec_id and y = floor(64 c), the integers without their shift, of the rows that take part."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("c")).where("c IS NOT NULL AND size(c) > 0")
    rows = rows.where(~F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(2**56))))
    first = rows.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("c") == (first.d if first else 0)).select("vec_id", F.transform("c", lambda c: F.floor(c * 64.0)).alias("y"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _reduced(rows: DataFrame, start: Callable, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One payload of all rows: ``start`` makes one of a task's matrices, ``merge`` joins up to ``FAN`` at a time, in the order of the tasks."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = start(_matrices(batches))
        if payload is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "payload": [payload]})

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        return pa.table({"part": pa.array([group["part"][0].as_py() // FAN], pa.int64()), "payload": pa.array([merge(group["payload"].to_pylist())], pa.binary())})

    parts = landed(rows.mapInArrow(first, "part long, payload binary"), "parts")
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last:
        parts = parts.groupBy(F.expr(f"part div {FAN}")).applyInArrow(join, "part long, payload binary")
        last //= FAN
    return bytes(parts.first().payload)


def spectrum(fit: DataFrame, block: int = BLOCK) -> Spectrum | None:
    """Count, mean and scatter of ``y``, from rank-one updates in each task and between tasks."""

    def start(matrices: Iterator[np.ndarray]) -> bytes | None:
        own, kept = None, []
        for matrix in matrices:
            own = own or Spectrum.empty(matrix.shape[1])
            kept.append(matrix.astype(np.float64))
            while sum(map(len, kept)) >= block:
                rows = np.concatenate(kept)
                own.add_block(rows[:block])
                kept = [rows[block:]]
        if own is None:
            return None
        own.add_block(np.concatenate(kept))
        return own.to_bytes()

    def merge(payloads: list[bytes]) -> bytes:
        own = Spectrum.from_bytes(payloads[0])
        for other in payloads[1:]:
            own.add(Spectrum.from_bytes(other))
        return own.to_bytes()

    found = _reduced(fit, start, merge)
    return found and Spectrum.from_bytes(found)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of ``y`` in each dimension."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for matrix in _matrices(batches):
            part = matrix.sum(0) if np.abs(matrix.astype(np.float64)).sum() < 2**62 else matrix.astype(object).sum(0)
            total = part.astype(object) + (0 if total is None else total)
            n += len(matrix)
        if n:
            yield pa.RecordBatch.from_pydict({"d": list(range(len(total) + 1)), "s": [str(int(x)) for x in [*total, n]]})

    parts = fit.mapInArrow(own, "d long, s string").groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = [int(row.s) for row in parts.orderBy("d").collect()]
    return (found[-1], found[:-1]) if found else (0, [])


class Whitener(NamedTuple):
    n: int
    sums: list[int]  # of y
    vectors: np.ndarray  # a column for each component
    values: np.ndarray  # falling
    trace: float

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _deviations(matrix: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n y - sums, exact: as 64-bit integers where they fit, else as Python's."""
    reach = n * float(np.abs(matrix.astype(np.float64)).max(initial=0)) + max(map(abs, total), default=0)
    if reach < 2**62:
        return matrix.astype(np.int64) * n - np.array(total, np.int64)
    return matrix.astype(object) * n - np.array(total, object)


def _products(fit: DataFrame, n: int, total: list[int], right: np.ndarray, left: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(covariance times ``right``, its trace); with ``left`` its transpose goes in front. One pass."""

    def pack(product: np.ndarray, square: float) -> bytes:
        return np.append(product.ravel(), square).tobytes()

    def start(matrices: Iterator[np.ndarray]) -> bytes | None:
        product, square = None, 0.0
        for matrix in matrices:
            centred = _deviations(matrix, n, total).astype(np.float64) / n
            own = (centred if left is None else centred @ left).T @ (centred @ right)
            product = own if product is None else product + own
            square += float((centred * centred).sum())
        return None if product is None else pack(product, square)

    def merge(payloads: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(p) for p in payloads], axis=0).tobytes()

    flat = np.frombuffer(_reduced(fit, start, merge)) / n
    return flat[:-1].reshape(-1, right.shape[1]), float(flat[-1])


def learn(fit: DataFrame, components: int = COMPONENTS, spare: int = SPARE) -> Whitener | None:
    """``fit``: the different vectors ``y``."""
    found = spectrum(fit)
    if found is None or found.count < 2:
        return None
    n, total = sums(fit)
    basis = found.vectors[:, ::-1][:, :components + spare]
    for _ in range(PASSES):
        product, trace = _products(fit, n, total, basis)
        projected = basis.T @ product
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors = basis @ turn
        rest = product @ turn - vectors * values
        leading = rest[:, :components]
        wrong = np.linalg.norm(leading, axis=0) > PRECISE * max(trace, 1e-300)
        if basis.shape[1] == len(basis) or not wrong.any():
            break
        wider = np.hstack([vectors[:, :components + spare], leading[:, wrong]])
        basis = np.linalg.qr(wider)[0]
    kept = values[:components] > max(trace, 0) * len(basis) * 1e-14
    vectors = np.linalg.qr(vectors[:, :components][:, kept])[0]
    return Whitener(n, total, vectors, values[:components][kept], trace)


def identity_error(fit: DataFrame, own: Whitener) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    found, _ = _products(fit, own.n, own.sums, own.scaled, own.scaled)
    return float(np.abs(found - np.eye(len(found))).max())


def whiten(rows: DataFrame, own: Whitener) -> DataFrame:
    """vec_id, deviation and whitened (an array with an entry for each component) of rows of ``integers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = next(_matrices([batch]))
            apart = _deviations(matrix, own.n, own.sums)
            if (apart.astype(np.float64) ** 2).sum(1).max() < 2**62:
                deviation = (apart.astype(np.int64) ** 2).sum(1)
            else:
                deviation = [x if x < 2**63 else None for x in (apart.astype(object) ** 2).sum(1)]
            white = apart.astype(np.float64) / own.n @ own.scaled
            cuts = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(cuts, white.ravel())],
                                             names=["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(integers(common.table(spark, sf_dir, "embeddings")), "integers")
    fit = landed(rows.select("y").distinct(), "fit_list")
    own = learn(fit)
    if own is None or not len(own.values):
        return rows.limit(0).selectExpr("vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    white = whiten(rows, own).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return white.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(own.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.lit([float(x / own.trace) for x in own.values]), F.col("place") + 1).alias("explained"), F.lit(identity_error(fit, own)).alias("identity_error"))
