"""Prefix trie of conversations, by burst tries.

A container holds the conversations that begin with one head, a sequence of turns; the first
one holds all.  A container of too many turns is burst: its conversations go on together as
far as they agree, and where they part each next turn makes a new head with a container of
its own.  Bursting is repeated until every container fits in a task, once a branching level
rather than once a turn.  The containers left are dealt to shards; a shard sorts a container's
suffixes and sweeps over them, a node for each turn in which a suffix leaves the one before.
What a container adds up to then goes to all heads above it.

Conversations of equal turns are one entry, so copies cannot make a container that never
bursts; a single conversation larger than a container is a chain of turns and stays a table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finfilings.llm.common import settle, small_side, stored, table
from finfilings.llm.registry import query

#: Turns of a container that is swept rather than burst, and of a shard, about.
CONTAINER = 1 << 14
#: Members of a class are joined by ranges of this many ids (a power of two) before they are hashed.
ID_BITS = 10

NOTHING = hashlib.sha256(b"").hexdigest()


def placed_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, tid, bytes, part_key`` by turn (stored, ``pos`` from 1), and ``conv_id, n``.

    The rows are sorted by ranges, so a conversation of very many turns is cut over tasks;
    each piece then learns how many turns stand before it.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    tid = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", tid.alias("tid"), F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tid"), F.monotonically_increasing_id()]
    rows = settle(rows.orderBy(*order).select("conv_id", "tid", "bytes", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("at")))
    pieces = rows.groupBy("conv_id", "piece").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    upto = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = settle(pieces.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))))
    counts = pieces.groupBy("conv_id").agg(F.sum("n").alias("n"))
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    return stored(rows.join(pieces.select("conv_id", "piece", "first", "before"), ["conv_id", "piece"]).select("conv_id", "piece", pos.alias("pos"), "tid", "bytes")), counts


def rebuilt(conversations: DataFrame, shared: int = 9, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, tid, bytes`` of the rebuilt conversations, and all ``conv_id``.

    Conversation c begins with the first h turns of conversation c - c % family, and goes on
    with its own turns after its first h, where h = crc32(c) % shared.
    """
    turns, counts = placed_turns(conversations)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    counts = settle(counts)
    known = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = settle(counts.select("conv_id", h, base).join(known, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))))
    # the pieces of a long conversation meet its row apart
    pieces = turns.select("conv_id", "piece").distinct().join(convs.select("conv_id", "h", "taken"), "conv_id")
    own = turns.join(pieces, ["conv_id", "piece"]).where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tid", "bytes")
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < shared)).select(F.col("conv_id").alias("base"), "pos", "tid", "bytes")
    begun = heads.join(convs.select("conv_id", "base", "h"), "base").where("pos <= h").select("conv_id", "pos", "tid", "bytes")
    return stored(own.unionByName(begun)), convs.select("conv_id")


def _hash_ends(batches):
    """One row a class out of its rows in order of their ids; the ids pass through the digest."""
    names = ("len", "x", "y")
    now, digest, seq, n, out = None, None, None, 0, []

    def ended():
        if now is not None:
            out.append((seq, n, now[0], digest.hexdigest()))

    def batch():
        seqs, counts, lengths, ends = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(counts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ends, pa.string())], names=["seq", "n", "len", "ends"])

    for rows in batches:
        for key, least, count, text in zip(zip(*(rows.column(c).to_pylist() for c in names)), rows.column("least").to_pylist(), rows.column("count").to_pylist(), rows.column("text")):
            if key != now:
                ended()
                now, digest, seq, n = key, hashlib.sha256(), least, 0
            else:
                digest.update(b",")
            digest.update(text.as_py().encode())
            n += count
        if len(out) >= 10_000:
            yield batch()
            out.clear()
    ended()
    yield batch()


def classes_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Conversations of equal turns: ``seq`` (the smallest id), ``n``, ``len``, ``ends`` (the
    digest of all ids).  Turns are combined with their places before the shuffle."""
    mark = lambda salt: F.xxhash64(F.lit(salt), "pos", "tid")
    rows = turns.select("conv_id", F.lit(1).alias("one"), mark(1).alias("x"), mark(2).alias("y")).unionByName(
        convs.select("conv_id", F.lit(0).alias("one"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y")))
    each = rows.groupBy("conv_id").agg(F.sum("one").alias("len"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")  # of one range of ids
    ranges = each.groupBy("len", "x", "y", F.shiftright("conv_id", ID_BITS).alias("range")).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("count"), ids.alias("text"))
    ordered = ranges.repartition("len", "x", "y").sortWithinPartitions("len", "x", "y", "range")
    return stored(ordered.mapInArrow(_hash_ends, "seq long, n long, len long, ends string"))


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent binary"


def _sweep(group: pa.Table) -> pa.Table:
    """All nodes of a shard's containers; a container's top node carries the head above it."""
    containers: dict[bytes, dict] = {}
    suffixes: dict[int, tuple[dict, list, list]] = {}
    order = group.sort_by([("seq", "ascending"), ("pos", "ascending")])
    for row in (r for b in order.to_batches(2000) for r in b.to_pylist()):
        if row["ends"] is not None:  # the top turn
            suffixes[row["seq"]] = (row, [], [row["bytes"]])
            containers.setdefault(row["head"], []).append(row["seq"])
        else:
            _, tids, sizes = suffixes[row["seq"]]
            tids.append(row["tid"]), sizes.append(row["bytes"])
    out: dict[str, list] = {c.split()[0]: [] for c in _NODE.split(", ")}
    for seqs in containers.values():
        seqs.sort(key=lambda s: suffixes[s][1])
        parent, depth, size, least, n, children, ends = [], [], [], [], [], [], []
        path, before = [], []
        top = suffixes[seqs[0]][0]
        for seq in seqs:
            row, tids, sizes = suffixes[seq]
            common = 0
            while path and common < min(len(tids), len(before)) and tids[common] == before[common]:
                common += 1
            del path[common + 1:]
            for k in range(len(path), len(tids) + 1):
                if path:
                    children[path[-1]] += 1
                parent.append(path[-1] if path else -1)
                path.append(len(depth))
                depth.append(top["depth"] + k), size.append(sizes[k]), least.append(seq), n.append(0), children.append(0), ends.append(NOTHING)
            n[path[-1]], least[path[-1]], ends[path[-1]] = row["n"], min(least[path[-1]], seq), row["ends"]
            before = tids
        leaves, saved = [0] * len(depth), [0] * len(depth)
        for k in range(len(depth) - 1, -1, -1):  # parents stand before their children
            leaves[k] += not children[k]
            saved[k] += (n[k] - 1) * size[k]
            if (p := parent[k]) >= 0:
                n[p], least[p] = n[p] + n[k], min(least[p], least[k])
                leaves[p], saved[p] = leaves[p] + leaves[k], saved[p] + saved[k]
        out["conv_id"] += least
        out["depth"] += depth
        out["parent_conv_id"] += [least[p] if p >= 0 else top["up"] for p in parent]
        out["n_convs"] += n
        out["n_children"] += children
        out["n_leaves"] += leaves
        out["saved_tokens"] += saved
        out["ends_sha256"] += ends
        out["parent"] += [top["parent"]] + [None] * (len(depth) - 1)
    kinds = {"ends_sha256": pa.string(), "parent": pa.binary()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})


def prefix_trie(turns: DataFrame, convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row a node of the trie over ``turns`` (``conv_id, pos, tid, bytes``, with ``pos``
    from 1 without gaps); ``convs`` names all conversations, those without turns as well.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null for the
    root), ``n_convs`` the members, ``n_children`` and ``n_leaves`` (childless nodes of the
    subtree) count nodes, ``saved_tokens`` adds (n_convs - 1) times the bytes of the last turn
    over the subtree, ``ends_sha256`` is the digest of the ids that end at the node.  Without
    conversations there is no node.
    """
    classes = classes_of(turns, convs)
    own = turns.withColumnRenamed("conv_id", "seq").join(classes.select("seq"), "seq", "left_semi")
    tops = classes.select("seq", F.lit(0).cast("long").alias("pos"), F.lit(b"").cast("binary").alias("tid"), F.lit(0).cast("long").alias("bytes"))
    steps = stored(own.select("seq", F.col("pos").cast("long").alias("pos"), "tid", F.col("bytes").cast("long").alias("bytes")).unionByName(tops))
    n_steps = steps.count()

    nowhere = F.array().cast("array<binary>")
    # settled, or joins on the one head of the first round would become joins without a key
    at = settle(classes.select("seq", "n", "len", "ends", F.lit(b"").cast("binary").alias("head"), F.lit(0).cast("long").alias("depth"),
                               F.lit(None).cast("long").alias("up"), nowhere.alias("path")))
    small, heads = [], []
    while True:
        big = settle(at.groupBy("head").agg(
            *[F.first(c).alias(c) for c in ("depth", "up", "path")], F.sum(F.col("len") - F.col("depth") + 1).alias("turns"),
            F.count("*").alias("k"), F.sum("n").alias("members"), F.min("seq").alias("least"),
        ).where(F.col("turns") > container))
        if big.isEmpty():
            small.append(at)
            break
        sizes = small_side(big.select("head", "k", "least", F.col("depth").alias("top")))
        small.append(at.join(sizes, "head", "left_anti"))
        burst = at.join(sizes.drop("top"), "head")
        # the first place where not all go on, or not alike
        beyond = burst.select("head", "seq", "depth", "k").join(steps, "seq").where("pos > depth")
        agree = beyond.groupBy("head", "pos").agg(F.count("*").alias("here"), F.first("k").alias("k"), F.min("tid").alias("one"), F.max("tid").alias("other"))
        parts = agree.groupBy("head").agg(F.min(F.when((F.col("here") < F.col("k")) | (F.col("one") != F.col("other")), F.col("pos"))).alias("stop"), F.max("pos").alias("last"))
        stops = settle(big.join(parts, "head", "left").withColumn("branch", F.coalesce(F.col("stop") - 1, "last", "depth")).drop("stop", "last"))
        burst = burst.join(small_side(stops.select("head", "branch")), "head")
        ended = burst.where("len = branch").select("head", "ends")  # one a head at most
        turn = F.unhex(F.md5(F.concat("head", "tid")))
        at = settle(burst.where("len > branch").join(steps.select("seq", "pos", "tid"), "seq").where("pos = branch + 1").select(
            "seq", "n", "len", "ends", turn.alias("head"), (F.col("branch") + 1).alias("depth"), F.col("least").alias("up"),
            F.concat("path", F.array("head")).alias("path")))
        kids = at.select(F.element_at("path", -1).alias("above"), "head").distinct().groupBy("above").agg(F.count("*").alias("kids")).withColumnRenamed("above", "head")
        heads.append(settle(stops.join(ended, "head", "left").join(kids, "head", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))))

    def union(frames: list[DataFrame]) -> DataFrame:
        while len(frames) > 1:
            frames = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2:]
        return frames[0]

    shards = max(1, n_steps // container)
    left = union(small).select("seq", "n", "len", "ends", "head", "depth", "up", F.try_element_at("path", F.lit(-1)).alias("parent"),
                               F.pmod(F.xxhash64("head"), F.lit(shards)).alias("shard"))
    only_top = lambda c: F.when(F.col("pos") == F.col("depth"), F.col(c)).alias(c)
    suffixes = left.join(steps, "seq").where("pos >= depth").select(
        "shard", "seq", "pos", "tid", "bytes", *[only_top(c) for c in ("n", "ends", "head", "up", "parent")], "depth")
    nodes = suffixes.groupBy("shard").applyInArrow(_sweep, _NODE)
    if not heads:
        return nodes.drop("parent")

    nodes, heads = stored(nodes), settle(union(heads))
    chain = settle(heads.select("head", "least", "depth", "branch", "members").join(steps.withColumnRenamed("seq", "least"), "least").where(
        "pos >= depth and pos <= branch").select("head", "pos", "bytes", "members"))
    owned = chain.groupBy("head").agg(F.sum((F.col("members") - 1) * F.col("bytes")).alias("chain_saved"))
    below = nodes.where("parent is not null").groupBy(F.col("parent").alias("head")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    weights = heads.select("head", "path", "kids").join(owned, "head").join(below, "head", "left").select(
        F.explode(F.concat("path", F.array("head"))).alias("head"), (F.coalesce("leaves", F.lit(0)) + (F.col("kids") == 0).cast("long")).alias("leaves"),
        (F.coalesce("saved", F.lit(0)) + F.col("chain_saved")).alias("saved"))
    totals = weights.groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).join(owned, "head")
    about = heads.drop("path", "turns", "k", "members").join(totals, "head")
    upward = Window.partitionBy("head").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = F.sum((F.col("members") - 1) * F.col("bytes")).over(upward)
    inner: dict[str, Column] = {
        "conv_id": F.col("least"), "depth": F.col("pos"),
        "parent_conv_id": F.when(F.col("pos") == F.col("depth"), F.col("up")).otherwise(F.col("least")), "n_convs": F.col("members"),
        "n_children": F.when(F.col("pos") == F.col("branch"), F.col("kids")).otherwise(1), "n_leaves": F.col("leaves"),
        "saved_tokens": F.col("saved") - F.col("chain_saved") + F.col("rest"),
        "ends_sha256": F.when(F.col("pos") == F.col("branch"), F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING),
    }
    tops = chain.withColumn("rest", rest).join(about, "head").select(*[c.alias(name) for name, c in inner.items()])
    return nodes.drop("parent").unionByName(tops)


SQL = """
WITH t AS (
  SELECT conv_id, m, b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS pos
  FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m, strlen(coalesce(text, '')) AS b
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(
    string_split(conv_id::VARCHAR, ''), lambda s: [ord(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS h FROM t),
r AS (
  SELECT conv_id, m, b, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS pos
  FROM (SELECT c.conv_id, 0 AS own, pos, m, b FROM c JOIN t ON t.conv_id = base AND pos <= h
        UNION ALL SELECT c.conv_id, 1, pos, m, b FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h)),
s AS (SELECT c.conv_id, coalesce(s, []) AS s FROM c LEFT JOIN (SELECT conv_id, list(m ORDER BY pos) AS s FROM r GROUP BY conv_id) x ON x.conv_id = c.conv_id),
p AS (SELECT conv_id, d, array_to_string(s[1:d], '') AS k, d = len(s) AS last FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
node AS (
  SELECT d, k, min(conv_id) AS id, count(*) AS n, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends FROM p GROUP BY d, k),
up AS (SELECT node.d, node.k, p.k AS above FROM node JOIN p ON p.conv_id = id AND p.d = node.d - 1),
w AS (
  SELECT node.*, coalesce(b, 0) AS b, coalesce(kids, 0) AS kids FROM node LEFT JOIN r ON r.conv_id = id AND r.pos = d
  LEFT JOIN (SELECT above, count(*) AS kids, d - 1 AS at FROM up GROUP BY above, d) x ON x.above = node.k AND x.at = node.d),
total AS (
  SELECT p.d, p.k, sum((n - 1) * b)::BIGINT AS saved, count(*) FILTER (kids = 0) AS leaves FROM w JOIN p ON p.conv_id = id AND p.d <= w.d GROUP BY p.d, p.k)
SELECT w.id AS conv_id, w.d AS depth, a.id AS parent_conv_id, w.n AS n_convs, w.kids AS n_children, leaves AS n_leaves, saved AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN total ON total.d = w.d AND total.k = w.k LEFT JOIN up ON up.d = w.d AND up.k = w.k LEFT JOIN node a ON a.k = up.above AND a.d = w.d - 1
"""


@query("op11_conversation_trie", SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls: a row without a conv_id belongs to no conversation; a null role or text is empty;
    a null turn comes first.  Rows of equal turn stand in the order of their digests, and rows
    that repeat are turns each."""
    conversations = table(spark, sf_dir, "conversations")
    turns, convs = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    return prefix_trie(turns, convs)
