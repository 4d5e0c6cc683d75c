"""Exact top-k by inner product: ball trees over shards, searched by branch and bound.

Each task builds ball trees over its own rows, so candidates are never shuffled.  A
node's ball bounds the inner product of anything in it with a query: q·c + r·|q|.  Nodes
are visited in the order of that bound, and a search ends once the bound falls below the
kth score.  That score is shared: a first round searches one leaf of some trees for every
query, the kth best of what it finds bounds the second round from the start, and within a
task each tree goes on from what the trees before it have found.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finfilings.llm.common import settle, table
from finfilings.llm.registry import query

#: Rows of one tree, and of a leaf.
TREE_ROWS, LEAF_ROWS = 8_192, 64
#: Components of queries sent to the tasks at a time.
WAVE_NUMBERS = 2_000_000
#: Trees searched in the first round.
SEED_TREES = 16
SCALE = 1024


def scaled(values: np.ndarray) -> np.ndarray | None:
    """floor(1024·x) as whole numbers; None if a component is null or not finite."""
    x = np.floor(np.asarray(values, float) * SCALE)
    if not np.all(np.isfinite(x)):
        return None
    return np.clip(x, -(2.0 ** 62), 2.0 ** 62)


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while they hold every sum exactly, else in whole
    numbers without bounds, held to the range of a long at the end."""
    if rows.size == 0:
        return np.zeros(len(rows), np.int64)
    if np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) * max(1, rows.shape[1]) < 2.0 ** 53:
        return (rows @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows]
    return np.array([max(-(2 ** 63), min(2 ** 63 - 1, x)) for x in exact], np.int64)


class BallTree:
    """A tree over ``rows`` [n, dimensions]; nodes as arrays, rows in the order of the leaves."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        self.left, self.right, self.begin, self.end = [], [], [], []
        centres, radii, self.least_id = [], [], []
        todo = [(0, len(ids), None, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            node, own = len(self.begin), rows[order[a:b]]
            if parent is not None:
                (self.right if side else self.left)[parent] = node
            centre = own.mean(0)
            away = np.sqrt(((own - centre) ** 2).sum(1))
            self.begin.append(a), self.end.append(b), self.left.append(-1), self.right.append(-1)
            centres.append(centre), radii.append(away.max()), self.least_id.append(ids[order[a:b]].min())
            if b - a > LEAF_ROWS and radii[-1] > 0:
                one = own[np.argmax(away)]
                far = ((own - one) ** 2).sum(1)
                other = own[np.argmax(far)]
                cut = np.argsort(far - ((own - other) ** 2).sum(1), kind="stable")  # from near `one` to near `other`
                order[a:b] = order[a:b][cut]
                todo += [(a, (a + b) // 2, node, 0), ((a + b) // 2, b, node, 1)]
        self.ids, self.rows = ids[order], rows[order]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds [query, node], with room for rounding."""
        norms = np.sqrt((queries ** 2).sum(1))
        at = queries @ self.centres.T
        return at + norms[:, None] * self.radii + 1e-9 * (np.abs(at) + norms[:, None] * (self.radii + np.abs(self.centres).max(initial=0))) + 1e-6

    def search(self, query_id: int, q: np.ndarray, bounds: np.ndarray, k: int, best: list, floor: float, one_leaf: bool = False) -> None:
        """Adds to ``best``, a heap of (score, -id), rows that score ``floor`` at least."""
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            kth = max(floor, best[0][0]) if len(best) >= k else floor
            if -bound < kth:
                return
            if len(best) >= k and -bound < best[0][0] + 1 and self.least_id[node] > -best[0][1]:
                continue  # can only tie, with larger ids
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    heapq.heappush(todo, (-bounds[child], child))
                continue
            a, b = self.begin[node], self.end[node]
            scores, ids = products(self.rows[a:b], q), self.ids[a:b]
            for i in np.flatnonzero((scores >= kth) & (ids != query_id)):
                found = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if one_leaf:
                return


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of largest inner product.

    Components are floor(1024·x); the score is their exact integer inner product, and ties
    go to the smaller id.  A row is no candidate for a query with its own id.  Vectors
    that are null or hold null or non-finite components, and rows with a null id, take no
    part; neither do candidates with another number of components than the query.  A
    vector without components scores 0.  Candidates that repeat an id count as often as
    they occur; of queries that repeat an id the smallest vector counts.  Fewer candidates
    than k give fewer rows; empty tables give none.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    columns = [F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("x")]
    usable = "id is not null and x is not null and not exists(x, v -> v is null or isnan(v) or abs(v) = double('infinity'))"

    def grow(batches):
        """Rows of a task, per number of components, to trees of bounded size."""
        held: dict[int, list] = {}
        for batch in batches:
            for name, values in zip(batch.column("id").to_pylist(), batch.column("x").to_pylist()):
                rows = held.setdefault(len(values), [])
                x = scaled(np.array(values, float))
                if x is not None:
                    rows.append((name, x))
                if len(rows) >= TREE_ROWS:
                    yield packed(len(values), held.pop(len(values)))
        for size, rows in held.items():
            if rows:
                yield packed(size, rows)

    def packed(size, rows):
        ids = np.array([r[0] for r in rows], np.int64)
        flat = np.array([r[1] for r in rows], float).reshape(len(rows), size)
        return pa.RecordBatch.from_arrays([
            pa.array([size], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary()),
            pa.array([int(ids.min())], pa.int64()),
        ], names=["size", "ids", "rows", "least"])

    shards = settle(vectors.select(*columns).where(usable).mapInArrow(grow, "size long, ids binary, rows binary, least long"))
    asked = settle(queries.select(*columns).where(usable).groupBy("id").agg(F.min("x").alias("x")).select("id", "x", F.size("x").alias("size")))
    widths = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("x") + 1), F.lit(0)).alias("numbers")).first()
    waves = max(1, -(-widths["numbers"] // WAVE_NUMBERS))
    seeds = shards.orderBy("size", "least").limit(SEED_TREES)
    found = None
    for wave in range(waves):
        # a block of the queries, of bounded size
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == wave).collect()
        sent = spark.sparkContext.broadcast([(r["id"], scaled(np.array(r["x"], float))) for r in block])
        first = settle(seeds.mapInArrow(_searcher(sent, None, k, True), "query_id long, vec_id long, score long"))
        ranked = _ranked(first, k)
        floors = spark.sparkContext.broadcast({r["query_id"]: r["score"] for r in ranked.where(F.col("rank") == k).select("query_id", "score").collect()})  # one per query of the block
        part = shards.mapInArrow(_searcher(sent, floors, k, False), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searcher(sent, floors, k, one_leaf):
    def run(batches):
        queries: dict[int, list] = {}
        for name, x in sent.value:
            if x is not None:
                queries.setdefault(len(x), []).append((name, x))
        known = floors.value if floors else {}
        best: dict[int, list] = {}
        for batch in batches:
            for size, ids, rows in zip(*(batch.column(c).to_pylist() for c in ("size", "ids", "rows"))):
                own = queries.get(size)
                if not own:
                    continue
                ids = np.frombuffer(ids, np.int64)
                tree = BallTree(ids, np.frombuffer(rows).reshape(len(ids), size))
                for at in range(0, len(own), 512):
                    block = own[at:at + 512]
                    bounds = tree.bounds(np.array([x for _, x in block]).reshape(len(block), size))
                    for (name, q), b in zip(block, bounds):
                        tree.search(name, q, b, k, best.setdefault(name, []), known.get(name, -np.inf), one_leaf)
        out = [(name, -i, s) for name, heap in best.items() for s, i in heap]
        if out:
            q, i, s = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q, i, s)], names=["query_id", "vec_id", "score"])

    return run


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


@query("op2_exact_top_k", SQL)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)
