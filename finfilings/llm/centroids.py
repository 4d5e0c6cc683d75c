"""Centroid clustering by dimension-sharded Lloyd rounds.

Vectors are cut into column blocks.  A row holds one block of the components of a few
thousand vectors (a chunk), and meets that block's slice of the centroids only, so no task
needs a whole centroid or a whole vector.

1. Each block gives the exact partial squared distances of its vectors to all centroids.
2. The blocks of a chunk are added up by key; the least sum names each vector's centroid.
3. The labels go back to the blocks.  A task adds up the vectors of each centroid for the
   blocks it holds, and each block's sums make the next slice of that block alone.

All arithmetic is in whole numbers, so the result does not depend on how the rows are dealt.
Chunks are cut by place, not by value: copies of one vector are spread like any others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import settle, stored, table
from finfilings.llm.registry import query
from finfilings.session import BROADCAST_BYTES

#: Components in a column block, and whole numbers that a chunk's partial distances may take.
WIDTH, CHUNK_NUMBERS = 16, 1 << 17
#: Scaled components beyond this could overflow a 64-bit distance and are refused.
LARGEST = 1 << 27


def _cut(dims: int, width: int, scale: int, rows: int, id_type: pa.DataType):
    """Whole-number vectors, ``rows`` at most a chunk; block -1 carries the ids."""
    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * scale)
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: 64-bit distances could overflow")
            whole = whole.astype(np.int64).reshape(batch.num_rows, dims)
            blocks = range(0, dims, width)
            n = 1 + len(blocks)
            ids = pa.array([batch.column("id").to_pylist()] + [None] * (n - 1), pa.list_(id_type))
            yield pa.RecordBatch.from_arrays([
                pa.array([(task << 33) + k] * n, pa.int64()), pa.array([-1, *range(n - 1)], pa.int32()), ids,
                pa.array([None] + [np.ascontiguousarray(whole[:, b:b + width]).tobytes() for b in blocks], pa.binary()),
            ], names=["chunk", "block", "ids", "part"])
            k += 1

    return run


def _matrix(cell: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(cell, "<i8").reshape(rows, -1)


def _partial(k: int):
    """Squared distances of a block's vectors to all slices, over the block's components."""
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                slices = _matrix(row.column("slice")[0].as_buffer(), k)
                part = np.frombuffer(row.column("part")[0].as_buffer(), "<i8").reshape(-1, slices.shape[1])
                far = np.empty((len(part), k), np.int64)
                for c in range(k):
                    off = part - slices[c]
                    far[:, c] = (off * off).sum(axis=1)
                yield pa.RecordBatch.from_arrays([row.column("chunk"), pa.array([far.tobytes()], pa.binary())], names=["chunk", "far"])

    return run


def _nearest(k: int):
    """Adds a chunk's blocks up; the smaller number wins ties."""
    def run(group: pa.Table) -> pa.Table:
        total = 0
        for cell in group.column("far"):
            total = total + np.frombuffer(cell.as_buffer(), "<i8")
        total = total.reshape(-1, k)
        label = total.argmin(axis=1)
        return pa.table({
            "chunk": group.column("chunk").slice(0, 1), "labels": pa.array([label.astype("<i4").tobytes()], pa.binary()),
            "least": pa.array([total[np.arange(len(label)), label].tobytes()], pa.binary()),
        })

    return run


def _sums(k: int):
    """What a task's vectors add up to by centroid: one row a block that it holds."""
    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for block, part, labels in zip(batch.column("block").to_pylist(), batch.column("part"), batch.column("labels")):
                label = np.frombuffer(labels.as_buffer(), "<i4")
                part = np.frombuffer(part.as_buffer(), "<i8").reshape(len(label), -1)
                sums, counts = total.setdefault(block, [np.zeros((k, part.shape[1]), np.int64), np.zeros(k, np.int64)])
                order = np.argsort(label, kind="stable")
                own, begin = np.unique(label[order], return_index=True)
                if len(own):
                    sums[own] += np.add.reduceat(part[order], begin, axis=0)
                counts += np.bincount(label, minlength=k)
        names = sorted(total)
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.int32()), pa.array([None] * len(names), pa.binary()),
            pa.array([total[b][0].tobytes() for b in names], pa.binary()), pa.array([total[b][1].tobytes() for b in names], pa.binary()),
        ], names=["block", "slice", "sums", "counts"])

    return run


def _moved(k: int):
    """A block's next slice out of its old one and the tasks' sums; empty centroids stay."""
    def run(group: pa.Table) -> pa.Table:
        sums, counts, old = 0, 0, None
        for row in group.to_pylist():
            if row["slice"] is not None:
                old = row["slice"]
            else:
                sums, counts = sums + _matrix(row["sums"], k), counts + np.frombuffer(row["counts"], "<i8")
        new = _matrix(old, k).copy()
        full = np.flatnonzero(counts)
        if len(full):
            new[full] = sums[full] // counts[full][:, None]
        return pa.table({"block": group.column("block").slice(0, 1), "slice": pa.array([new.tobytes()], pa.binary())})

    return run


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3,
            scale: int = 64, salt: str = "1:", width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """``vec_id, cluster, distance`` of each vector, and the centroids' slices ``block, slice``
    (``k`` rows of at most ``width`` little-endian 64-bit numbers).

    Vectors of other than ``dims`` components, or with a null or non-finite one, take no
    part.  Components become floor(scale * x).  The centroids start as the vectors with the
    smallest sha256 of ``salt`` and id (a null id never starts one, a repeated id once with
    its smallest components), fewer than ``k`` if there are fewer.  Rows that repeat come back
    each; ties go to the smaller centroid.  Without vectors, or without one that has an id,
    the result is empty.  Components beyond 2^27 after scaling are refused with an error.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(f"`{vec_id}`").alias("id"), v.alias("v")).where((F.size("v") == dims) & F.coalesce(finite, F.lit(False)))
    # k ids, of which only ids are shuffled, then their vectors
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    names = settle(kept.where("id is not null").select("id", digest.alias("digest")).distinct().orderBy("digest").limit(k))
    first = kept.join(F.broadcast(names), "id").groupBy("digest").agg(F.min("v").alias("v")).orderBy("digest").collect()
    id_name = kept.schema["id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"vec_id {id_name}, cluster int, distance long"), spark.createDataFrame([], "block int, slice binary")
    k = len(first)
    centres = np.floor(np.array([r["v"] for r in first]) * scale)
    if np.abs(centres).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}: 64-bit distances could overflow")
    centres = centres.astype(np.int64)
    slices = spark.createDataFrame(
        [(b // width, bytearray(np.ascontiguousarray(centres[:, b:b + width]).tobytes())) for b in range(0, dims, width)], "block int, slice binary")

    id_type = kept.limit(0).select("id").toArrow().schema.field("id").type
    rows = max(1, min(8192, CHUNK_NUMBERS // max(k, width)))
    parts = stored(kept.mapInArrow(_cut(dims, width, scale, rows, id_type), f"chunk long, block int, ids array<{id_name}>, part binary"))
    blocks = parts.where("block >= 0").drop("ids")
    n_rows = parts.where("block < 0").agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    sent = F.broadcast if 8 * k * dims <= BROADCAST_BYTES else lambda side: side  # of known size

    def assigned(slices: DataFrame) -> DataFrame:
        partial = blocks.join(sent(slices), "block").mapInArrow(_partial(k), "chunk long, far binary")
        return settle(partial.groupBy("chunk").applyInArrow(_nearest(k), "chunk long, labels binary, least binary"))

    labels = assigned(slices)
    for _ in range(rounds):
        side = labels.select("chunk", "labels")
        side = F.broadcast(side) if 4 * n_rows <= BROADCAST_BYTES else side
        sums = blocks.join(side, "chunk").select("block", "part", "labels").mapInArrow(_sums(k), "block int, slice binary, sums binary, counts binary")
        old = slices.select("block", "slice", F.lit(None).cast("binary").alias("sums"), F.lit(None).cast("binary").alias("counts"))
        slices = settle(old.unionByName(sums).groupBy("block").applyInArrow(_moved(k), "block int, slice binary"))
        labels = assigned(slices)

    def flat(batches):
        for batch in batches:
            for ids, own, least in zip(batch.column("ids"), batch.column("labels"), batch.column("least")):
                yield pa.RecordBatch.from_arrays([
                    ids.values, pa.array(np.frombuffer(own.as_buffer(), "<i4")), pa.array(np.frombuffer(least.as_buffer(), "<i8")),
                ], names=["vec_id", "cluster", "distance"])

    ids = parts.where("block < 0").select("chunk", "ids").join(labels, "chunk")
    return ids.mapInArrow(flat, f"vec_id {id_name}, cluster int, distance long"), slices


def digests(slices: DataFrame, k: int) -> DataFrame:
    """``cluster, centroid_sha256``: the lowercase hex digest of each centroid's components,
    joined by commas; ``k`` bounds the rows of a slice."""
    def texts(batches):
        for batch in batches:
            for block, cell in zip(batch.column("block").to_pylist(), batch.column("slice").to_pylist()):
                rows = _matrix(cell, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(k), pa.int32()), pa.array([block] * k, pa.int32()), pa.array([",".join(map(str, r)) for r in rows.tolist()]),
                ], names=["cluster", "block", "text"])

    parts = slices.mapInArrow(texts, "cluster int, block int, text string")
    # one row a block in each of k groups
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), ",")
    return parts.groupBy("cluster").agg(F.sha2(joined.cast("binary"), 256).alias("centroid_sha256"))


def _sql(rounds: int = 3) -> str:
    near = """
n{r} AS (
  SELECT vec_id, v, arg_min(c, (d, c))::INTEGER AS c, min(d) AS d
  FROM (SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d FROM kept, c{r}) GROUP BY vec_id, v)"""
    move = """
c{s} AS (
  SELECT c{r}.c, coalesce(u.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS m FROM (
      SELECT c, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS x FROM n{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c) u ON u.c = c{r}.c)"""
    steps = [near.format(r=0)]
    for r in range(rounds):
        steps += [move.format(r=r, s=r + 1), near.format(r=r + 1)]
    return f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INTEGER AS c, v AS m FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16),
{','.join(steps)}
SELECT vec_id, n{rounds}.c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY n{rounds}.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM n{rounds} JOIN c{rounds} ON c{rounds}.c = n{rounds}.c
"""


@query("op12_centroid_clustering", _sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, slices = cluster(table(spark, sf_dir, "embeddings"))
    found = settle(found)
    first = slices.select(F.length("slice").alias("n"), "block").where("block = 0").first()
    names = digests(slices, first["n"] // (8 * WIDTH) if first else 0)
    by = settle(found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")))  # k rows
    inertia = by.agg(F.sum("cluster_inertia")).first()[0]
    side = by.join(names, "cluster").withColumn("inertia", F.lit(inertia).cast("long"))
    return found.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
