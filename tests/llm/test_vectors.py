"""Vector operators and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygauge.llm import ann, embdedup
from skygauge.llm.components import components

VEC = "vec_id long, embedding array<float>, label int, score double, id long"
BAD = [None, [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [], [1.0, 2.0]]


def table(spark, x, extra=()):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, 0.0, 5) for i, v in enumerate([*x, *extra])]
    return spark.createDataFrame(rows, VEC).repartition(3)


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(2600, 16)) * rng.uniform(0.5, 2, (2600, 1))).astype(np.float32)
    x[100:140] = x[0]  # ties of equal vectors
    rows = table(spark, x, BAD)
    good = ann.vectors.usable(rows)
    queries = good.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = ann.search(queries, ann.index(good, shard=700), good).toPandas().sort_values(["query_id", "rank"])
    y, hits = x.astype(float), 0
    for q, own in found.groupby("query_id"):
        score = y @ y[q]
        order = np.lexsort((np.arange(len(y)), -score))
        order = order[order != q][:20]
        hits += len(set(order) & set(own.vec_id))
        assert list(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        assert np.allclose(own.score, [y[v] @ y[q] for v in own.vec_id]) and (np.diff(own.score) <= 1e-12).all()
    assert found.query_id.nunique() == 130 and hits >= 0.9 * 20 * 130


def test_nearest_takes_smaller_ids_of_equal_scores(spark):
    """On unit vectors the copies of a vector are its nearest, all with one score: more of them than are returned."""
    x = np.random.default_rng(4).normal(size=(900, 16))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x[100:140] = x[0]
    good = ann.vectors.usable(table(spark, x))
    queries = good.where("vec_id IN (0, 100, 120)").select(F.col("vec_id").alias("query_id"), "embedding")
    found = ann.search(queries, ann.index(good, shard=300), good).toPandas().sort_values(["query_id", "rank"])
    copies = [0, *range(100, 140)]
    for q, own in found.groupby("query_id"):
        assert own.score.nunique() == 1 and list(own.vec_id) == [c for c in copies if c != q][:20]


def test_nearest_of_few_and_of_none(spark):
    few = ann.vectors.usable(table(spark, np.eye(16)[:3]))
    queries = few.where("vec_id = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    assert sorted(r.vec_id for r in ann.search(queries, ann.index(few), few).collect()) == [1, 2]
    none = ann.vectors.usable(table(spark, [], BAD[:6]))
    assert ann.search(none.select(F.col("vec_id").alias("query_id"), "embedding"), ann.index(none), none).count() == 0


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    x = np.concatenate([base, base[:60] + rng.normal(0, 0.05, (60, 16)), 3 * base[10:20], base[:5], base[:5], base[:1] + rng.normal(0, 0.08, (60, 16))]).astype(np.float32)
    rows = {r.vec_id: r for r in embdedup.link(table(spark, x, BAD)).collect()}
    y = x.astype(float)
    unit = y / np.linalg.norm(y, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    reach = links | np.eye(len(x), dtype=bool)
    for _ in range(9):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    for i in range(len(x)):
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (links[i].sum(), reach[i].argmax(), reach[i].argmax() == i)
    for i in range(len(x), len(x) + len(BAD)):
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (0, i, True)
    assert embdedup.link(table(spark, [])).count() == 0
    assert [r.kept for r in embdedup.link(table(spark, [], BAD[:3])).collect()] == [True] * 3


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_of_many_blocks_copy_no_vectors(spark, monkeypatch, kind):
    """Blocks are compared where they lie: what makes the links has no exchange, and there are many pairs of blocks."""
    plans, landed = {}, embdedup.landed

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = landed(df, name)
        if name == "blocks":
            assert out.count() >= 8
        return out

    monkeypatch.setattr(embdedup, "landed", watched)
    monkeypatch.setattr(embdedup, "BLOCK", 64)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(500, 16))
    x = np.concatenate([base, base[:90] + rng.normal(0, 0.06, (90, 16)), base[:40], base[:1] + rng.normal(0, 0.06, (150, 16)), np.repeat(base[1:2], 70, 0)]).astype(np.float32)
    x[0, 3], x[590, 3] = 0.0, -0.0  # equal
    rows = table(spark, x).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    found = {r.vec_id: r for r in embdedup.link(rows.repartition(5)).collect()}
    assert "Exchange" not in plans["links"]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    reach = links.copy()
    for _ in range(9):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    for i in range(len(x)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (links[i].sum() - 1, reach[i].argmax(), reach[i].argmax() == i)


def test_links_of_crowded_blocks(monkeypatch):
    """Two blocks with links nearly everywhere, more than are held at once."""
    monkeypatch.setattr(embdedup, "HELD", 5000)
    rng = np.random.default_rng(7)
    x = (rng.normal(size=16) + rng.normal(0, 0.15, (700, 16))).astype(np.float32)
    x[::9] = rng.normal(size=x[::9].shape)
    ids, weights = rng.permutation(700) + 10, rng.integers(1, 4, 700)
    turn = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    one, two = (embdedup._Side(ids[p].tobytes(), weights[p].tobytes(), x[p].tobytes(), turn, "<f4") for p in (slice(0, 400), slice(400, 700)))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    for a, b, mask in ((one, one, near[:400, :400] & ~np.eye(400, dtype=bool)), (one, two, near[:400, 400:])):
        own, n, apart, to = embdedup._compare(a, b, a is b, 0.95, 0.1**0.5)
        want = dict(zip(a.ids.tolist(), mask @ b.weights))
        if a is not b:
            want |= dict(zip(b.ids.tolist(), mask.T @ a.weights))
        assert dict(zip(own.tolist(), n.tolist())) == {i: v for i, v in want.items() if v}
        root = {i: i for i in want}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for r, c in np.argwhere(mask):
            p, q = find(int(a.ids[r])), find(int(b.ids[c]))
            root[max(p, q)] = min(p, q)
        assert dict(zip(apart.tolist(), to.tolist())) == {i: find(i) for i in root if find(i) != i}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 440)] + [(900, i) for i in range(901, 960)] + [(5, 5)]
    root = {x: x for p in links if p[0] != p[1] for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
