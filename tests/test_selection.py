"""Percentiles, running totals and areas against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skygauge.operators import evaluate as E, percentiles
from skygauge.operators.ordered import positions, running_totals
from skygauge.operators.percentiles import approx_percentiles, exact_percentiles

CASES = {
    "one": [3.5], "two": [1.0, 2.0], "same": [7.0] * 1000, "ties": [float(i % 4) for i in range(999)],
    "line": [float(i) for i in range(5000)], "hot": [0.0] * 4000 + [float(i) for i in range(2000)],
    "outlier": [i / 1e6 for i in range(3000)] + [1e12], "negative": [float(-i * i) for i in range(777)],
}


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_exact_percentiles(spark, accuracy):
    rows = [(k, v) for k, vs in CASES.items() for v in vs] + [("one", None), ("none", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    ps = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p100": 1.0}
    got = {r.k: r for r in exact_percentiles(df, "k", {n: ("v", p) for n, p in ps.items()}, accuracy).collect()}
    assert set(got) == {*CASES, "none"} and got["none"].p50 is None
    for k, vs in CASES.items():
        for n, p in ps.items():
            assert got[k][n] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12, abs=1e-12), (k, n)


@pytest.mark.parametrize("groups", [0, 100])
def test_percentiles_of_large_groups_are_narrowed(spark, monkeypatch, groups):
    """Brackets that hold more than a task should sort are narrowed first, ties and nulls included."""
    monkeypatch.setattr(percentiles, "INSIDE", 60)
    monkeypatch.setattr(percentiles, "CUTS", 16)
    monkeypatch.setattr(percentiles, "GROUPS", groups)
    monkeypatch.setattr(percentiles, "PART_ROWS", 5000)
    rng = np.random.default_rng(6)
    data = {"even": rng.normal(size=30_000), "ties": np.where(rng.random(20_000) < 0.7, 0.0, rng.exponential(size=20_000)),
            "steps": rng.integers(0, 5, 10_000).astype(float), "far": np.append(rng.normal(size=5000), [1e300, -1e300]), "few": np.array([3.0, 1.0])}
    df = spark.createDataFrame(pd.DataFrame({"k": np.repeat(list(data), [len(v) for v in data.values()]), "v": np.concatenate(list(data.values()))}))
    df = df.union(spark.createDataFrame([("none", None), ("even", None)], "k string, v double")).repartition(4)
    rounds = []
    narrowed = percentiles._narrowed
    monkeypatch.setattr(percentiles, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    ps = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p69": 0.6999, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in exact_percentiles(df, "k", {n: ("v", p) for n, p in ps.items()}, 200).collect()}
    assert rounds and got.keys() == {*data, "none"} and got["none"].p50 is None
    for k, v in data.items():
        for name, p in ps.items():
            assert got[k][name] == pytest.approx(np.quantile(v, p, method="linear"), rel=1e-12), (k, name)


def test_approx_percentiles_are_values(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "k string, v double")
    assert approx_percentiles(df, "k", {"p": ("v", 0.95)}).first().p == 94.0


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_running_totals_any_layout(spark, parts):
    values = random.Random(2).sample(range(10_000), 700)
    df = spark.createDataFrame([(v, v % 5) for v in values], "v int, w int").repartition(4)
    got = [(r.v, r.t) for r in running_totals(df, ["v"], {"t": "w"}, parts).orderBy("v").collect()]
    total, want = 0, []
    for v in sorted(values):
        total += v % 5
        want.append((v, total))
    assert got == want


def test_positions(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "k string, n int")
    assert [tuple(r) for r in positions(df, ["k", "n"]).orderBy("position").collect()] == [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)]


def scores(spark, rows):
    return spark.createDataFrame([(float(p), int(y)) for p, y in rows], "p double, y bigint").repartition(3)


def brute_auc(rows):
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_ties_and_single_class(spark):
    assert E.roc_auc(scores(spark, [(0.5, 1), (0.5, 0)])).first()[0] == 0.5
    assert E.roc_auc(scores(spark, [(0.5, 0), (0.7, 0)])).first()[0] is None
    assert E.average_precision(scores(spark, [(0.5, 0)])).first()[0] is None
    m = E.binary_metrics(scores(spark, [(0.5, 0), (0.1, 0)])).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_auc_and_precision_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(round(rng.random() ** 6, 2), int(rng.random() < 0.3)) for _ in range(400)]  # most scores near 0
    df = scores(spark, rows)
    assert E.roc_auc(df).first()[0] == pytest.approx(brute_auc(rows), abs=1e-9)
    p_total, ap = sum(y for _, y in rows), 0.0
    for t in sorted({p for p, _ in rows}, reverse=True):
        tp = sum(y for p, y in rows if p >= t)
        ap += sum(y for p, y in rows if p == t) / p_total * tp / sum(p >= t for p, _ in rows)
    assert E.average_precision(df).first()[0] == pytest.approx(ap, abs=1e-9)
    curve = {r.threshold: (r.fpr, r.tpr) for r in E.roc_curve(df).collect()}
    assert curve[None] == (0.0, 0.0) and max(curve[t][1] for t in curve if t is not None) == 1.0


def test_error_analysis_counts(spark):
    rows = {r.error: r for r in E.error_analysis(scores(spark, [(0.9, 0), (0.7, 0), (0.1, 1), (0.9, 1)])).collect()}
    assert rows["false_positive"].n == 2 and rows["false_positive"].mean_probability == 0.8 and rows["false_negative"].share_pct == 25.0


def test_histogram_closes_the_last_bin(spark):
    assert {(r.y, r.bin, r.n) for r in E.prob_histogram(scores(spark, [(1.0, 1), (0.99, 1), (0.0, 0)])).collect()} == {(1, 49, 2), (0, 0, 1)}
