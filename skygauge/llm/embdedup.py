"""Near-duplicate vectors by the epsilon grid order join.

Vectors are scaled to length one, so cosine >= c means a distance of at most e = sqrt(2 - 2c). They are projected on ``DIMS`` leading
principal directions; a projection never lengthens a distance. Sorted by their grid cells of width e, the vectors form a
sequence that is cut to blocks of about ``BLOCK``. Every pair of blocks is looked at once and dropped if their bounding boxes are further
apart than e; inside two blocks the same is done with runs of ``RUN`` vectors, and then with single vectors in ``FINE`` directions, in single
precision with ``SLACK`` to spare. What remains is compared by cosine in double precision.

Blocks are read where they were written, by each task the few that it pairs: nothing is copied for a pair, so disk grows with the rows while
time grows with the pairs of blocks that are close. The vectors are written three times in all, in the type they came in: once with
equal ones of a batch joined, once sorted, once as blocks.

Equal vectors are joined first, in their batch and then in the sequence, and weighted by their number. A pair of blocks gives the number of
links of each vector and links that connect its groups, never all pairs. The directions are fitted to at most ``SAMPLE`` vectors; any
directions give the same result.

Defined results: vectors that take no part (see ``vectors.usable``) have no links, their own id as component and are kept; a null id
has a null component and is kept. Rows that repeat a vec_id count as separate vectors. An empty table gives an empty result.
Extra columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from skygauge.llm import common, vectors
from skygauge.llm.components import components
from skygauge.store import landed

COSINE = 0.95
DIMS = 8
FINE = 16
BLOCK = 8192
RUN = 256
SAMPLE = 4000
EDGE = 1e-9
SLACK = 1e-4
SHARE = 32
HELD = 1 << 20


def _directions(good: DataFrame, n: int, dims: int) -> np.ndarray:
    """Leading principal directions (columns) of a bounded sample."""
    place, share = F.xxhash64("vec_id"), 4 * SAMPLE / max(1, n)
    near = good.where(place < F.lit(int((share - 0.5) * 2**64))) if share < 1 else good
    sample = near.orderBy(place, "vec_id").limit(SAMPLE).select("embedding").toArrow()
    if not sample.num_rows:  # few different ids
        sample = good.limit(SAMPLE).select("embedding").toArrow()
    if not sample.num_rows:
        return np.zeros((0, 0))
    x = vectors.matrix(sample.column("embedding"))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:dims].T


def _units(data: bytes, n: int, kind: str) -> np.ndarray:
    x = np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _joined(good: DataFrame, directions: np.ndarray, reach: float, kind: str) -> DataFrame:
    """A node for each different vector of a batch: cell (as bytes that sort like the cells), vec, id (the smallest), weight and members."""

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            x = (vectors.matrix(batch.column("embedding")) + 0.0).astype(kind)  # no negative zeros
            raw = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
            first, group = np.unique(raw, return_index=True, return_inverse=True)[1:]
            ids = batch.column("vec_id").to_numpy()
            order = np.lexsort((ids, group.ravel()))
            weight = np.bincount(group.ravel())
            cuts = np.append(0, np.cumsum(weight))
            cells = np.floor(_units(x[first].tobytes(), len(first), kind) @ directions[:, :DIMS] / reach)
            cells = (np.clip(cells, -2**30, 2**30).astype(np.int64) + 2**31).astype(">u4")
            yield pa.RecordBatch.from_arrays([
                pa.array([row.tobytes() for row in cells], pa.binary()), pa.array([row.tobytes() for row in x[first]], pa.binary()), pa.array(np.arange(at, at + len(first))),
                pa.array(ids[order[cuts[:-1]]]), pa.array(weight.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids[order]))],
                names=["cell", "vec", "node", "id", "weight", "members"])
            at += len(first)

    return landed(good.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        run, "cell binary, vec binary, node long, id long, weight long, members array<long>"), "nodes")


def _blocks(nodes: DataFrame, n: int, directions: np.ndarray, kind: str) -> DataFrame:
    """(block, lo, hi, ids, weights, vecs, nodes): the sequence of different vectors cut to blocks, with the box of each, and the class of each node."""

    def block(number: int, vec: np.ndarray, node: np.ndarray, ids: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        least, total = np.minimum.reduceat(ids, starts), np.add.reduceat(weight, starts)
        sizes = np.diff(np.append(starts, len(ids)))
        data = vec[starts].tobytes()
        at = _units(data, len(starts), kind) @ directions[:, :DIMS]
        own = pa.StructArray.from_arrays([pa.array(node), pa.array(np.repeat(least, sizes)), pa.array(np.repeat(total, sizes))], names=["node", "id", "weight"])
        return pa.RecordBatch.from_arrays([
            pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), pa.array([at.min(0).tolist()], pa.list_(pa.float64())), pa.array([at.max(0).tolist()], pa.list_(pa.float64())),
            *(pa.array([d], pa.binary()) for d in (least.tobytes(), total.tobytes(), data)), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)],
            names=["block", "lo", "hi", "ids", "weights", "vecs", "nodes"])

    def cut(batches):
        number, held = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            new = [vec, *(batch.column(c).to_numpy() for c in ("node", "id", "weight"))]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            starts = np.flatnonzero(np.append(True, (held[0][1:] != held[0][:-1]).any(1)))
            while len(starts) > BLOCK * 3 // 2:  # the last block of a task has up to half as many again, so that none is small
                end = starts[BLOCK]
                yield block(number, *(x[:end] for x in held), starts[:BLOCK])
                number, held, starts = number + 1, [x[end:] for x in held], starts[BLOCK:] - end
        if held is not None:
            yield block(number, *held, starts)

    parts = max(1, min(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK)))
    order = ["cell", "hash", "vec"]  # equal vectors have one hash, so they meet in one task
    rows = nodes.select("cell", F.xxhash64("vec").alias("hash"), "vec", "node", "id", "weight")
    rows = rows.repartitionByRange(parts, "cell", "hash").sortWithinPartitions(*order).coalesce(parts)
    return landed(rows.mapInArrow(cut, "block long, lo array<double>, hi array<double>, ids binary, weights binary, vecs binary, "
                                  "nodes array<struct<node:long,id:long,weight:long>>"), "blocks")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches by the links a - b."""
    root = np.arange(n)
    while True:
        one, two = root[a], root[b]
        apart = one != two
        if not apart.any():
            return root
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root != root[root]).any():
            root = root[root]


class _Side:
    """A block as it is compared: ids, weights, unit vectors, run boxes, and rows for the product that bounds distances."""

    def __init__(self, ids: bytes, weights: bytes, vecs: bytes, directions: np.ndarray, kind: str):
        self.ids, self.weights = np.frombuffer(ids, np.int64), np.frombuffer(weights, np.int64)
        self.units = _units(vecs, len(self.ids), kind)
        at = self.units @ directions
        self.runs = np.arange(0, len(at), RUN)
        self.lo, self.hi = (f.reduceat(at[:, :DIMS], self.runs) for f in (np.minimum, np.maximum))
        half, one = -(at * at).sum(1, keepdims=True) / 2, np.ones((len(at), 1))
        self.row = np.hstack([at, half, one]).astype(np.float32)  # row . column = - distance^2 / 2 of the projections
        column = np.hstack([at, one, half]).astype(np.float32)
        rest = np.zeros((-len(at) % 8, column.shape[1]), np.float32)  # filled up to eights with what is near nothing
        rest[:, -1] = -1e30
        column = np.vstack([column, rest])
        self.tiles = [np.ascontiguousarray(column[i:i + RUN].T) for i in range(0, len(column), RUN)]


def _linked(one: _Side, two: _Side, same: bool, cosine: float, reach: float):
    """(rows, columns) of the links of two blocks, a run of rows at a time."""
    gaps = np.maximum(0, np.maximum(one.lo[:, None] - two.hi[None], two.lo[None] - one.hi[:, None]))
    near = (gaps**2).sum(2) <= (reach + EDGE) ** 2
    least = np.float32(-reach * reach / 2 - SLACK)
    if same:
        near = np.triu(near)
    product, hits = np.empty(RUN * RUN, np.float32), np.empty(RUN * RUN, bool)
    for k, start in enumerate(one.runs):
        likely, rows = [], one.row[start:start + RUN]
        for j in np.flatnonzero(near[k]):
            begin, tile = j * RUN, two.tiles[j]
            shape = len(rows), tile.shape[1]
            own, fine = (x[:shape[0] * shape[1]].reshape(shape) for x in (product, hits))
            np.greater_equal(np.matmul(rows, tile, out=own), least, out=fine)
            eights = np.flatnonzero(fine.view(np.uint64))  # eight at a time: most are empty
            if len(eights) * 32 > fine.size:
                r, c = np.nonzero(one.units[start:start + RUN] @ two.units[begin:begin + RUN].T >= cosine)
                yield _once(r + start, c + begin, same)
            elif len(eights):
                found = np.flatnonzero(fine.reshape(-1, 8)[eights])
                found = eights[found // 8] * 8 + found % 8
                likely.append((found // fine.shape[1] + start, found % fine.shape[1] + begin))
        if likely:
            r, c = (np.concatenate(x) for x in zip(*likely))
            hit = np.einsum("ij,ij->i", one.units[r], two.units[c]) >= cosine
            yield _once(r[hit], c[hit], same)


def _once(r: np.ndarray, c: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    return (r[r < c], c[r < c]) if same else (r, c)


def _compare(one: _Side, two: _Side, same: bool, cosine: float, reach: float):
    """ids and their link counts, and links (a, b) of ids that connect what the pair of blocks connects."""
    ids = one.ids if same else np.concatenate([one.ids, two.ids])
    weights = one.weights if same else np.concatenate([one.weights, two.weights])
    counts, a, b = np.zeros(len(ids), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for r, c in _linked(one, two, same, cosine, reach):
        if not len(r):
            continue
        c = c if same else c + len(one.ids)
        for own, other in ((r, c), (c, r)):
            counts += np.bincount(own, weights[other], len(ids)).astype(np.int64)
        a, b = np.append(a, r), np.append(b, c)
        if len(a) > HELD:
            root = _roots(len(ids), a, b)
            a = np.flatnonzero(root != np.arange(len(ids)))
            b = root[a]
    some = counts > 0
    if not some.any():
        return None
    root = _roots(len(ids), a, b)
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    label = least[root]
    apart = label != ids
    return ids[some], counts[some], ids[apart], label[apart]


def _links(blocks: DataFrame, directions: np.ndarray, cosine: float, reach: float, kind: str) -> DataFrame:
    """(id, n, to): numbers of links n of an id, and, with ``to`` not null, links that connect what is connected.

    Each task reads a share of the blocks for either side: as few shares as give each core about eight tasks, more where a share would
    have over ``SHARE`` blocks.
    """
    dims = min(DIMS, directions.shape[1])
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    shares = max(math.ceil(math.sqrt(8 * cores)), -(-blocks.count() // SHARE))
    whole = blocks.select("block", "lo", "hi", "ids", "weights", "vecs").coalesce(shares)
    a, b = (whole.toDF(*(c + end for c in whole.columns)) for end in ("", "_"))
    gaps = [F.greatest(F.lit(0.0), F.col("lo")[i] - F.col("hi_")[i], F.col("lo_")[i] - F.col("hi")[i]) for i in range(dims)]
    close = sum(g * g for g in gaps) <= (reach + EDGE) ** 2
    # either order of two blocks is as frequent, so that tasks have about the same to do
    once = F.when((F.col("block") + F.col("block_")) % 2 == 0, F.col("block") <= F.col("block_")).otherwise(F.col("block") > F.col("block_"))
    pairs = a.join(b.hint("shuffle_replicate_nl"), once & close).drop("lo", "hi", "lo_", "hi_")

    def compare(batches):
        last, one = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block, block2 = batch.column("block")[i].as_py(), batch.column("block_")[i].as_py()
                if block != last:
                    last, one = block, _Side(*(batch.column(c)[i].as_buffer() for c in ("ids", "weights", "vecs")), directions, kind)
                two = one if block == block2 else _Side(*(batch.column(c)[i].as_buffer() for c in ("ids_", "weights_", "vecs_")), directions, kind)
                found = _compare(one, two, block == block2, cosine, reach)
                if found:
                    ids, n, apart, to = found
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, apart])), pa.concat_arrays([pa.array(n), pa.nulls(len(apart), pa.int64())]),
                                                      pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(to)])], names=["id", "n", "to"])

    return landed(pairs.mapInArrow(compare, "id long, n long, to long"), "links")


def link(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    good = vectors.usable(rows)
    n = good.count()
    reach = float(np.sqrt(max(1e-12, 2 - 2 * cosine)))
    directions = _directions(good, n, FINE)
    whole = rows.select("vec_id")
    if directions.size:
        kind = "<f4" if isinstance(rows.schema["embedding"].dataType.elementType, FloatType) else "<f8"
        nodes = _joined(good, directions, reach, kind)
        blocks = _blocks(nodes, n, directions, kind)
        found = _links(blocks, directions, cosine, reach, kind)
        counts = found.where("to IS NULL").groupBy("id").agg(F.sum("n").alias("n"))
        links = components(found.where("to IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b")))
        per_node = blocks.select(F.inline("nodes")).join(counts, "id", "left").join(links.withColumnRenamed("node", "id"), "id", "left").select(
            "node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
        linked = nodes.select("node", F.explode("members").alias("vec_id")).join(per_node, "node")
        whole = whole.join(linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")), "vec_id", "left")
    else:
        whole = whole.withColumns({"n_links": F.lit(None).cast("long"), "component_id": F.lit(None).cast("long")})
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(common.table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
u AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS n FROM v),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.95),
r AS (SELECT DISTINCT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node),
k AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.component, m.vec_id) AS component_id, coalesce(c.component, m.vec_id) = m.vec_id AS kept
FROM embeddings m LEFT JOIN k ON k.a = m.vec_id LEFT JOIN c ON c.node = m.vec_id
"""
