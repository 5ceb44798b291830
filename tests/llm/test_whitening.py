import math

import numpy as np
import pytest
from pyspark.sql import types as T

from skygauge.llm import rankone, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def write(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def brute_force(rows):
    x = {i: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, total = len(fit), fit.sum(0)
    centred = np.array((fit * n - total).tolist(), float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return x, n, total, values[::-1], vectors[:, ::-1], covariance


def compare(found, rows, components=16):
    x, n, total, values, vectors, covariance = brute_force(rows)
    assert len(found) == len(rows) * components
    whitened = found.pivot(index="vec_id", columns="component", values="whitened")
    for component in range(1, components + 1):
        own = vectors[:, component - 1] / np.sqrt(values[component - 1])
        expected = np.array([[float(v) for v in (np.array(x[i], object) * n - total)] for i in whitened.index]) @ own / n
        got = whitened[component].to_numpy()
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-6
    assert np.allclose(found.explained, values[found.component - 1] / np.trace(covariance), rtol=1e-9)
    assert (found.identity_error < 1e-9).all() and found.identity_error.nunique() == 1 and (found.n == n).all()
    expected = {i: sum((n * a - b) ** 2 for a, b in zip(v, total)) for i, v in x.items()}
    assert dict(zip(found.vec_id, found.deviation)) == expected


def test_whitening_equals_dense_eigenvectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(400, 40)) @ np.diag(np.linspace(3, 0.5, 40))).astype(np.float32)
    x[50:90] = x[7]  # copies count once in the fit
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, [float("nan")] * 40), (902, [None] * 40), (903, [float("inf")] + [0.0] * 39), (904, []), (905, [1.0])]
    found = whitening.op13(spark, write(spark, tmp_path, rows + odd)).toPandas()
    compare(found, rows)


def test_few_dimensions_and_zero_variance(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    x[:, 3] = x[:, 1]  # a component without variance
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(60, [0.0] * 5)]
    found = whitening.op13(spark, write(spark, tmp_path, rows)).toPandas()
    compare(found, rows, 4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_variance_nothing_is_returned(spark, tmp_path, rows):
    found = whitening.op13(spark, write(spark, tmp_path, rows))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.count() == 0


def test_extra_columns_null_and_repeated_ids(spark, tmp_path):
    schema = T.StructType([*SCHEMA, T.StructField("y", T.StringType()), T.StructField("component", T.IntegerType())])
    rows = [(1, [1.0, 2.0], "a", 1), (1, [1.0, 2.0], "b", 2), (None, [3.0, -1.0], None, None), (4, [0.5, 0.25], "c", None)]
    found = whitening.op13(spark, write(spark, tmp_path, rows, schema)).toPandas()
    assert len(found) == 8 and found.vec_id.isna().sum() == 2 and (found.n == 3).all()
    twice = found[found.vec_id == 1].sort_values("component").whitened.to_numpy()
    assert twice[0] == twice[1] and twice[2] == twice[3]


def test_refinement_widens_a_poor_basis(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(300, 32)).astype(np.float32) * np.linspace(2, 0.5, 32).astype(np.float32))]
    good = whitening.spectrum

    def poor(fit):
        own = good(fit)
        own.vectors = np.linalg.qr(own.vectors + 1e-4 * rng.normal(size=own.vectors.shape))[0]
        return own

    monkeypatch.setattr(whitening, "spectrum", poor)
    compare(whitening.op13(spark, write(spark, tmp_path, rows)).toPandas(), rows)


def test_deviations_beyond_64_bits_are_exact_or_null():
    matrix = np.array([[2**50, -5], [3, 2**52]], np.int64)
    found = whitening._deviations(matrix, 2**20, [7, 9])
    assert found.tolist() == [[2**70 - 7, -5 * 2**20 - 9], [3 * 2**20 - 7, 2**72 - 9]]


def test_rank_one_updates_with_equal_values_and_zero_parts():
    rng = np.random.default_rng(0)
    rows = rng.integers(-9, 9, (300, 12)).astype(float)
    rows[:, 4], rows[:, 8] = rows[:, 3], 0
    one, blocks = rankone.Spectrum.empty(12), rankone.Spectrum.empty(12)
    for row in rows:
        one.add_row(row)
    for part in np.array_split(rows, 5):
        own = rankone.Spectrum.empty(12)
        own.add_block(part)
        blocks.add(rankone.Spectrum.from_bytes(own.to_bytes()))
    centred = rows - rows.mean(0)
    for own in (one, blocks):
        assert own.count == 300 and np.allclose(own.mean, rows.mean(0))
        assert np.allclose(own.vectors.T @ own.vectors, np.eye(12), atol=1e-12)
        assert np.allclose(own.vectors * own.values @ own.vectors.T, centred.T @ centred, atol=1e-9)


def test_secular_roots_lie_between_the_poles():
    poles, weight = np.array([0.0, 1e-9, 1.0, 5.0]), np.array([1e-18, 2.0, 1e-12, 3.0])
    roots, apart = rankone.secular(poles, weight)
    assert (roots > poles).all() and (roots[:-1] < poles[1:]).all()
    assert math.isclose(roots.sum(), poles.sum() + weight.sum(), rel_tol=1e-12)  # the trace
    terms = weight / apart
    assert (np.abs(1 + terms.sum(1)) <= 1e-14 * (1 + np.abs(terms).sum(1))).all()
