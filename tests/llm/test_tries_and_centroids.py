"""Conversation tries and centroid clustering next to their SQL, on odd inputs and small bounds."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finfilings.llm import centroids, convtrie


def in_sql(sql, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    return con.sql(sql).to_arrow_table()


def same(frame, want):
    names = sorted(frame.columns)
    assert names == sorted(want.column_names)
    rows = lambda t: sorted((tuple(r[n] for n in names) for r in t.to_pylist()), key=lambda r: tuple((v is not None, v or 0) for v in r))
    assert rows(frame.toArrow()) == rows(want)


def talk(seed, n, distinct=6):
    """Conversations that share beginnings, some of them copies, with odd rows."""
    r = random.Random(seed)
    turns = [("user", f"t{k}" * r.randint(0, 4)) for k in range(distinct)] + [("assistant", "é😀"), (None, None), ("", "a")]
    copied = [r.choice(turns) for _ in range(12)]
    rows = []
    for c in range(n):
        own = list(copied) if c % 3 == 0 else [*copied[:r.randint(0, 12)], *(r.choice(turns) for _ in range(r.randint(0, 4)))]
        rows += [(c * (1 if c % 7 else 1000), k, *t) for k, t in enumerate(own)]
    rows += [(3, None, "user", "first"), (3, None, None, "tie"), (3, 4, "user", "tie"), (3, 4, "user", "tie"), (None, 0, "user", "nobody's")]
    rows += [(60_001, k, "user", "long" if k % 5 else None) for k in range(400)]
    rows += [(60_003 + 5 * j, k, "user", "long" if k % 5 or j else None) for j in range(3) for k in range(300)]
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def arrow(rows):
    kinds = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(kinds.items())})


@pytest.mark.parametrize("container", [40, 1 << 14])
def test_trie_is_that_of_the_sql_whatever_the_container(spark, container):
    rows = talk(4, 40)
    turns, convs = convtrie.rebuilt(spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("own")).withColumn("n", F.lit(1)).repartition(5))
    same(convtrie.prefix_trie(turns, convs, container), in_sql(convtrie.SQL, conversations=arrow(rows)))


def test_trie_of_one_turnless_and_of_no_conversation(spark):
    # h of conversation 4 is 1 or more where conversation 0 is absent: its turn may be passed over
    for rows in ([(4, 0, "user", "x")], [(0, 0, "user", "x"), (0, 1, "user", "x")], [(8, None, None, None)]):
        want = in_sql(convtrie.SQL, conversations=arrow(rows))
        for container in (1, 100):
            turns, convs = convtrie.rebuilt(spark.createDataFrame(rows, SCHEMA))
            same(convtrie.prefix_trie(turns, convs, container), want)
    turns, convs = convtrie.rebuilt(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))
    assert convtrie.prefix_trie(turns, convs).collect() == []


def test_ids_of_a_large_class_pass_through_the_digest_in_order(spark):
    import hashlib

    ids = [5 * k - 20_000 for k in range(9000)]
    turns = spark.createDataFrame([(i,) for i in ids], "conv_id long").select("conv_id", F.lit(1).cast("long").alias("pos"), F.lit(b"t").alias("tid"), F.lit(3).cast("long").alias("bytes"))
    got = {r["depth"]: r for r in convtrie.prefix_trie(turns, turns.select("conv_id")).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (got[1]["n_convs"], got[1]["conv_id"], got[0]["saved_tokens"], got[0]["n_leaves"]) == (9000, -20_000, 8999 * 3, 1)


def vectors(seed, n, dims=64):
    r = random.Random(seed)
    rows = [(k, [r.choice((r.uniform(-2, 2), 0.5, -1 / 3)) for _ in range(dims)]) for k in range(n)]
    rows += [(n + 1, rows[0][1])] * 40 + [(n + 2, rows[0][1][:-1]), (n + 3, None), (n + 4, [None] + rows[0][1][1:]), (n + 5, [float("nan")] + rows[0][1][1:]),
                                          (n + 6, [float("-inf")] + rows[0][1][1:]), (n + 7, []), (7, rows[7][1])]
    return rows


def op12(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("own")).withColumn("id", F.lit(0)).repartition(4)
    found, slices = centroids.cluster(frame, **options)
    return found.collect(), {r["cluster"]: r["centroid_sha256"] for r in centroids.digests(slices, min(16, len({x[0] for x in rows if x[1] and x[0] is not None}))).collect()}


@pytest.mark.parametrize("options", [{}, {"width": 5}, {"width": 64}])
def test_clusters_are_those_of_the_sql(spark, monkeypatch, options):
    monkeypatch.setattr(centroids, "CHUNK_NUMBERS", 1000)
    rows = vectors(2, 150)
    # a repeated id starts one centroid; the SQL has each id once
    want = in_sql(centroids._sql().replace("FROM embeddings", "FROM (SELECT DISTINCT * FROM embeddings)"),
                  embeddings=pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))}))
    want = {r["vec_id"]: (r["cluster"], r["distance"], r["centroid_sha256"]) for r in want.to_pylist()}
    found, names = op12(spark, rows, **options)
    # copies weigh in the means, so they are left out of this comparison but for one
    assert len(found) == 150 + 40 + 1
    single = [r for k, r in enumerate(rows) if k not in range(151, 190) and k != len(rows) - 1]
    found, names = op12(spark, single, **options)
    assert {r["vec_id"]: (r["cluster"], r["distance"], names[r["cluster"]]) for r in found} == want


def test_few_no_and_nameless_vectors(spark):
    ones = [1.0] * 64
    found, names = op12(spark, [(1, ones), (2, [2.0] * 64), (None, ones)])
    assert sorted((str(r["vec_id"]), r["distance"]) for r in found) == [("1", 0), ("2", 0), ("None", 0)] and len(names) == 2
    assert op12(spark, [(1, None)])[0] == [] and op12(spark, [(None, ones)])[0] == []
    with pytest.raises(Exception, match="64-bit"):
        op12(spark, [(1, [1e9] * 64)])
