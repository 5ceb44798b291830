"""Nearest neighbours by inner product with robust-pruned directed graphs.

Vectors are dealt by a hash of their ids to shards of about ``SHARD``. Largest inner product becomes smallest distance by one more
component, sqrt(M^2 - |x|^2) with M the largest length of the shard (0 for a query). In a shard, greedy searches from the current graph
propose the neighbours of each vector; among them, nearest first, one is kept and drops all candidates p' with
alpha * d(kept, p') <= d(x, p'), so edges stay diverse and at most ``DEGREE``. Reverse edges are added and pruned alike. A query is
a beam search of width ``BEAM`` in every shard; the shards' answers are merged by exact scores, first in the task that has
several of them.

Equal vectors share a node. Of their ids the ``top + 1`` smallest are kept with it: ties go to the smaller id, so no other can be
among the nearest.

Defined results: vectors that take no part (see ``vectors.usable``) are neither queries nor candidates. With fewer candidates than
asked for, all are returned. Of rows that repeat a vec_id with one vector, one counts. An empty table gives an empty result.
Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygauge.llm import common, vectors
from skygauge.store import landed

TOP = 20
SHARD = 2048
DEGREE = 24
BUILD_BEAM = 40
BEAM = 80
ALPHA = 1.2
BATCH = 512
#: a task has this many queries and shards, and hands on the best of all its shards
QUERY_GROUP = 512
SHARD_GROUP = 16


class Graph:
    """Out-neighbours of the nodes (-1: none) and their vectors in the space of distances."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.points, self.edges, self.entries = points, edges, entries
        self.squares = np.einsum("ij,ij->i", points, points)

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances, up to a constant of each query, to the nodes of each row; infinite for -1."""
        d = self.squares[nodes] - 2 * np.einsum("bcd,bd->bc", self.points[nodes], queries)
        d[nodes < 0] = np.inf
        return d

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, distances) of the beam, nearest first, and which of them were expanded."""
        n, rows = len(self.points), np.arange(len(queries))
        seen = np.zeros((len(queries), n + 1), bool)  # the last column takes -1
        nodes = np.full((len(queries), beam), -1)
        start = self.entries[:beam]
        nodes[:, :len(start)] = start
        seen[:, start] = True
        far = self.distances(queries, nodes)
        order = np.argsort(far, 1, kind="stable")
        nodes, far = np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)
        done = nodes < 0
        while True:
            live = np.flatnonzero(~done.all(1))
            if not len(live):
                return nodes, far, done & (nodes >= 0)
            pick = np.argmin(done[live], 1)
            done[live, pick] = True
            new = self.edges[nodes[live, pick]].copy()
            new[seen[live[:, None], new]] = -1
            seen[live[:, None], new] = True
            seen[:, n] = False
            d = self.distances(queries[live], new)
            all_nodes, all_far = np.concatenate([nodes[live], new], 1), np.concatenate([far[live], d], 1)
            all_done = np.concatenate([done[live], new < 0], 1)
            order = np.argsort(all_far, 1, kind="stable")[:, :beam]
            nodes[live], far[live], done[live] = (np.take_along_axis(x, order, 1) for x in (all_nodes, all_far, all_done))


def _prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Robust pruning of each row's candidates (-1: none), for the nodes ``own``."""
    x = points[candidates]
    d = ((x - points[own][:, None]) ** 2).sum(2)
    d[(candidates < 0) | (candidates == own[:, None])] = np.inf
    order = np.argsort(d, 1, kind="stable")
    candidates, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
    x = np.take_along_axis(x, order[:, :, None], 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= ~((candidates[:, 1:] == candidates[:, :-1]) & alive[:, :-1])  # repeats stand side by side
    out, rows = np.full((len(own), degree), -1), np.arange(len(own))
    for k in range(degree):
        if not alive.any():
            break
        pick = np.argmax(alive, 1)
        some = alive[rows, pick]
        out[some, k] = candidates[rows, pick][some]
        apart = ((x - x[rows, pick][:, None]) ** 2).sum(2)
        alive &= ~(some[:, None] & (alpha * alpha * apart <= d))
        alive[rows, pick] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 3) -> Graph:
    n, rng = len(points), np.random.default_rng(seed)
    degree = max(1, min(degree, n - 1))
    edges = np.full((n, degree), -1)
    if n > 1:
        guess = (np.arange(n)[:, None] + rng.integers(1, n, (n, degree))) % n
        guess.sort(1)
        repeated = np.zeros_like(guess, bool)
        repeated[:, 1:] = guess[:, 1:] == guess[:, :-1]
        edges = np.where(repeated, -1, guess)
    middle = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    entries = np.unique(np.concatenate([[middle], rng.choice(n, min(n, 8), replace=False)]))
    graph = Graph(points, edges, entries)
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for start in range(0, n, BATCH):
            own = order[start:start + BATCH]
            nodes, _, _ = graph.search(points[own], min(beam, n))
            graph.edges[own] = _prune(points, own, np.concatenate([nodes, graph.edges[own]], 1), alpha, degree)
            _add_reverse(graph, own, alpha, degree)
    return graph


def _add_reverse(graph: Graph, own: np.ndarray, alpha: float, degree: int) -> None:
    to, source = graph.edges[own].ravel(), np.repeat(own, degree)
    to, source = to[to >= 0], source[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    targets, first, count = np.unique(to, return_index=True, return_counts=True)
    for a in range(0, len(targets), BATCH):
        t, f, c = targets[a:a + BATCH], first[a:a + BATCH], count[a:a + BATCH]
        width = int(c.max()) if len(c) else 0
        new = np.full((len(t), width), -1)
        new[np.repeat(np.arange(len(t)), c), common.ragged(np.zeros(len(c), np.int64), c)] = source[common.ragged(f, c)]
        candidates = np.concatenate([graph.edges[t], new], 1)
        graph.edges[t] = _prune(graph.points, t, candidates, alpha, degree)


def augmented(x: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)
    return np.column_stack([x, np.sqrt(np.maximum(squares.max() - squares, 0))]).astype(np.float32)


INDEX = "shard long, nodes binary, vectors binary, points binary, edges binary, entries binary"


def index(candidates: DataFrame, shard: int = SHARD, top: int = TOP) -> DataFrame:
    """One row per shard: its nodes (smallest ids of the vectors), their vectors, and the graph."""
    few = vectors.smallest_ids(candidates, top + 1)
    nodes = landed(few.groupBy("embedding").agg(F.min("vec_id").alias("node")), "nodes")
    shards = max(1, -(-nodes.count() // shard))

    def make(key, rows):
        rows = rows.sort_by("node")
        x = vectors.matrix(rows.column("embedding"))
        graph = build(augmented(x))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), **{name: pa.array([np.ascontiguousarray(value).tobytes()], pa.binary()) for name, value in (
            ("nodes", rows.column("node").to_numpy()), ("vectors", x), ("points", graph.points), ("edges", graph.edges.astype(np.int32)), ("entries", graph.entries.astype(np.int64)))}})

    dealt = nodes.select(F.pmod(F.xxhash64("node"), F.lit(shards)).alias("shard"), "node", "embedding")
    return landed(dealt.groupBy("shard").applyInArrow(make, INDEX), "index")


def search(queries: DataFrame, built: DataFrame, candidates: DataFrame, top: int = TOP, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of every query (query_id, embedding), its own row left out."""
    groups = max(1, -(-queries.count() // QUERY_GROUP))
    # every query goes to every shard, in groups of both
    last = (built.agg(F.max("shard")).first()[0] or 0) // SHARD_GROUP
    left = built.select("*", F.floor(F.col("shard") / SHARD_GROUP).alias("shards"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    right = queries.select("query_id", "embedding", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("part_"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last))).alias("shards_"))

    def ask(own: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        q, ids = (vectors.matrix(asked.column("embedding")), asked.column("query_id").to_numpy()) if asked.num_rows else (np.zeros((0, 0)), None)
        for shard in range(own.num_rows if asked.num_rows else 0):
            read = lambda name, kind: np.frombuffer(own.column(name)[shard].as_py(), kind)  # noqa: B023, E731
            nodes, entries = read("nodes", np.int64), read("entries", np.int64)
            points, edges, x = (read(name, kind).reshape(len(nodes), -1) for name, kind in (("points", np.float32), ("edges", np.int32), ("vectors", np.float64)))
            graph = Graph(points, edges.astype(np.int64), entries)
            for start in range(0, len(q), BATCH):
                part = q[start:start + BATCH]
                lengths = np.linalg.norm(part, axis=1, keepdims=True)
                asked_at = np.column_stack([part / lengths * np.sqrt(graph.squares.max()), np.zeros(len(part))]).astype(np.float32)
                found, _, _ = graph.search(asked_at, min(beam, len(nodes)))
                score = np.einsum("bcd,bd->bc", x[found], part)
                good = found >= 0
                out.append((np.repeat(ids[start:start + BATCH], good.sum(1)), nodes[found[good]], score[good]))
        query, node, score = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((node, -score, query))
        query, node, score = query[order], node[order], score[order]
        first = np.searchsorted(query, query)
        best = np.arange(len(query)) - first <= top  # one more than asked for: a query's own vector may be among them
        return pa.table({"query_id": query[best], "node": node[best], "score": score[best]})

    found = left.groupBy("shards", "part").cogroup(right.groupBy("shards_", "part_")).applyInArrow(ask, "query_id long, node long, score double")
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "node"))).where(F.col("place") <= top + 1)
    # back from nodes to ids
    few = vectors.smallest_ids(candidates, top + 1)
    node = few.withColumn("node", F.min("vec_id").over(Window.partitionBy("embedding"))).select("node", "vec_id").distinct()
    rows = best.join(node, "node").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= top)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(vectors.usable(common.table(spark, sf_dir, "embeddings")), "usable")
    queries = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding").dropDuplicates(["query_id"])
    return search(queries, index(rows), rows)
