"""Jaccard self-join of shingle sets, by prefixes of tokens and token combinations.

Tokens (shingles) are ordered by the number of documents they occur in, the rarest first.
Two sets that are similar enough agree on all but a few tokens, so they share something
among their first ones.  A token of few documents is indexed alone.  Frequent tokens are
dealt into classes, and pairs of one class are indexed: sets that share no pair of a class
share one token of it at most.  A prefix is extended until the tokens that it proves to be
missing, were nothing shared, would be too many.  With s tokens, of which n - k + 1 count
for a class of n prefix tokens indexed as k-combinations, that takes s - ceil(t·s) + 1.

Everything works on classes of equal sets, named by a digest, so copies meet as one.

1. One pass over the texts makes the sets.  A chunk of them is sorted and dealt out by
   token; each token's count over all chunks comes back to the chunk for tokens of more
   than one document, and the chunk's prefixes follow from that.  A token is counted
   within a chunk first, so a token of very many documents is one entry per chunk.
2. In each bucket of the index every set is compared with one of few rare tokens (a star).
3. Sets of a bucket that the links so far leave apart are compared pair by pair, each
   pair in the first bucket that it shares.  Sets already together need no further link,
   and as 1 - similarity is a metric, sets whose distances to the bucket's centre differ
   by more than a link spans cannot link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import Numbers, dropped, held, released, small_side, stored, table, texts_of, whole_text
from finfilings.llm.components import connected
from finfilings.llm.registry import query

#: A token of more documents is frequent.
RARE = 64
#: Buckets that a set remembers, to compare a pair in one of those it shares.
FIRST = 16
#: Tokens of a chunk, and of a group whose counts are added up, at least; both grow with
#: the square root of the corpus, so that their product keeps pace with it.
CHUNK, GROUP, GROWTH = 500_000, 500_000, 40

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of all words if they are fewer."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(held("numbers", Numbers).__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    got = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        got = mixed(got * _M1 + h[i:len(words) - k + 1 + i])
    return np.unique(got)


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def needed(size, percent: int):
    """Tokens that must be missing to rule out ``percent``: size - ceil(percent/100·size) + 1."""
    return size - (-(-percent * size // 100)) + 1


def _code(df: np.ndarray) -> np.ndarray:
    """Counts in a byte, in order; exact up to 128."""
    return np.where(df <= 128, df, np.minimum(255, 128 + np.ceil(4 * np.log2(np.maximum(df, 1) / 128)))).astype(np.uint8)


def _brackets(size: int, percent: int) -> list[int]:
    """Size brackets (powers of two) in which a set can meet another: its own, and the
    one below if a set there is similar enough."""
    own = size.bit_length() - 1
    return [own] if (-(-percent * size // 100)).bit_length() - 1 == own else [own, own - 1]


def prefix_keys(size: int, ids: np.ndarray, codes: np.ndarray, percent: int, rare: int = RARE) -> np.ndarray:
    """Index keys of a set of ``size`` tokens, of which ``ids`` (in order, with their count
    codes) occur in more than one document."""
    missing = needed(size, percent) - (size - len(ids))
    if missing <= 0:
        return np.empty(0, np.uint64)
    n_rare = int(np.searchsorted(codes, rare, "right"))
    keys = [mixed(ids[:min(n_rare, missing)])]
    missing -= n_rare
    frequent = ids[n_rare:]
    for bracket in _brackets(size, percent) if missing > 0 else ():
        classes = max(1, (1 << bracket) // 4)
        own = mixed(frequent + np.uint64(bracket)) % np.uint64(classes)
        again = np.ones(len(own), bool)
        again[np.unique(own, return_index=True)[1]] = False
        n = int(np.searchsorted(np.cumsum(again), missing)) + 1
        order = np.lexsort((frequent[:n], own[:n]))
        tokens, own = frequent[:n][order], own[:n][order]
        step = 1
        while step < n:  # pairs of one class at this distance
            same = own[step:] == own[:-step]
            if not same.any():
                break
            keys.append(mixed(mixed(tokens[:-step][same]) * _M2 + tokens[step:][same] + np.uint64(bracket)))
            step += 1
    return np.unique(np.concatenate(keys))


_DEALT = "p int, chunk long, ids array<{id}>, texts binary, sizes binary, names binary, reps binary, keys binary, counts binary, places binary"
_BACK = "chunk long, p int, ids array<{id}>, texts binary, sizes binary, names binary, reps binary, counts binary, places binary, keys binary, codes binary, shared binary, n int"


def _deal(width: int, parts: int, chunk_tokens: int, id_type: pa.DataType):
    """Sets of the documents of a chunk, as one row per group of tokens and one of the documents."""
    def rows(number, ids, texts, sets):
        names, reps, kept = [digest(s) if len(s) else b"\0" * 16 for s in sets], [], {}
        for k, name in enumerate(names):
            reps.append(kept.setdefault(name, k))
        own = sorted(set(reps))
        flat = np.concatenate([sets[k] for k in own])
        docs = np.repeat(np.array(own, np.uint16), [len(sets[k]) for k in own])
        part = ((flat >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        token = (part << np.uint64(32)) | (flat & np.uint64(0xFFFFFFFF))
        order = np.argsort(token, kind="stable")
        token, docs = token[order], docs[order]
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, int)
        token, counts = token[begin], np.diff(np.append(begin, len(docs))).astype("<u4")
        part = (token >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, int)
        out = {c: [] for c in ("p", "ids", "texts", "sizes", "names", "reps", "keys", "counts", "places")}

        def add(**cells):
            for c in out:
                out[c].append(cells.get(c))

        add(p=number % parts, ids=ids, texts=np.array(texts, "<i8").tobytes(), sizes=np.array([len(s) for s in sets], "<u4").tobytes(),
            names=b"".join(names), reps=np.array(reps, "<u2").tobytes(), counts=counts.tobytes(), places=docs.astype("<u2").tobytes())
        for a, b in zip(cut, [*cut[1:], len(token)]):
            add(p=int(part[a]), keys=token[a:b].astype("<u4").tobytes(), counts=counts[a:b].tobytes())
        n = len(out["p"])
        return pa.RecordBatch.from_arrays(
            [pa.array(out["p"], pa.int32()), pa.array([number] * n, pa.int64()), pa.array(out["ids"], pa.list_(id_type))]
            + [pa.array(out[c], pa.binary()) for c in ("texts", "sizes", "names", "reps", "keys", "counts", "places")],
            names=["p", "chunk", "ids", "texts", "sizes", "names", "reps", "keys", "counts", "places"],
        )

    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        ids, texts, sets, size = [], [], [], 0
        for batch in batches:
            for name, key, body in zip(*(texts_of(batch.column(c)) for c in ("id", "key", "body"))):
                tokens = shingles(body, width)
                ids.append(name), texts.append(key), sets.append(tokens)
                size += len(tokens)
                if size >= chunk_tokens or len(ids) == 60_000:
                    yield rows((task << 24) + k, ids, texts, sets)
                    ids, texts, sets, size, k = [], [], [], 0, k + 1
                    released()
        if ids:
            yield rows((task << 24) + k, ids, texts, sets)

    return run


def _count(group: pa.Table) -> pa.Table:
    """Adds up a group's tokens; each chunk gets back those of more than one document."""
    released()
    cells = {c: group.column(c).to_pylist() for c in ("keys", "counts")}
    rows = [k for k, x in enumerate(cells["keys"]) if x is not None]
    keys = [np.frombuffer(cells["keys"][k], "<u4") for k in rows]
    out: dict[str, list] = {c: [None] * group.num_rows for c in ("keys", "codes", "shared", "n")}
    if rows:
        flat, counts = np.concatenate(keys), np.concatenate([np.frombuffer(cells["counts"][k], "<u4") for k in rows])
        _, at = np.unique(flat, return_inverse=True)
        codes = _code(np.bincount(at, weights=counts)[at])
        begin = 0
        for k, own in zip(rows, keys):
            code = codes[begin:begin + len(own)]
            begin += len(own)
            shared = code > 1
            out["keys"][k], out["codes"][k], out["shared"][k] = own[shared].tobytes(), code[shared].tobytes(), np.packbits(shared).tobytes()
            out["n"][k] = len(own)
    head = [x is None for x in cells["keys"]]
    counts = pa.array([x if h else None for h, x in zip(head, cells["counts"])], pa.binary())
    same = [group.column(c) for c in ("ids", "texts", "sizes", "names", "reps")]
    return pa.Table.from_arrays(
        [group.column("chunk"), group.column("p"), *same, counts, group.column("places")]
        + [pa.array(out[c], pa.binary()) for c in ("keys", "codes", "shared")] + [pa.array(out["n"], pa.int32())],
        names=["chunk", "p", "ids", "texts", "sizes", "names", "reps", "counts", "places", "keys", "codes", "shared", "n"],
    )


def _index(percent: int, rare: int, id_type: pa.DataType):
    """A chunk's documents, and the index keys of its distinct sets."""
    def run(group: pa.Table) -> pa.Table:
        released()
        cells = {c: group.column(c).to_pylist() for c in group.column_names}
        head = next(k for k, x in enumerate(cells["names"]) if x is not None)
        sizes, names = np.frombuffer(cells["sizes"][head], "<u4").astype(int), cells["names"][head]
        names = [names[16 * k:16 * k + 16] for k in range(len(sizes))]
        counts = np.frombuffer(cells["counts"][head], "<u4")
        docs = np.frombuffer(cells["places"][head], "<u2")
        rows = sorted((k for k in range(group.num_rows) if k != head), key=lambda k: cells["p"][k])
        ids, codes, shared = [], [], []
        for k in rows:
            own = np.frombuffer(cells["keys"][k], "<u4").astype(np.uint64)
            ids.append(own | (np.uint64(cells["p"][k]) << np.uint64(32)))
            codes.append(np.frombuffer(cells["codes"][k], np.uint8))
            shared.append(np.frombuffer(cells["shared"][k], np.uint8))
        masks = [np.unpackbits(bits, count=cells["n"][k]).astype(bool) for k, bits in zip(rows, shared)]
        mask = np.concatenate(masks) if masks else np.empty(0, bool)
        ids = np.concatenate(ids) if ids else np.empty(0, np.uint64)
        codes = np.concatenate(codes) if codes else np.empty(0, np.uint8)
        runs = counts[mask].astype(int)
        keep = np.repeat(mask, counts)
        doc, token, code = docs[keep], np.repeat(ids, runs), np.repeat(codes, runs)
        order = np.lexsort((token, code, doc))
        doc, token, code = doc[order], token[order], code[order]
        reps = np.frombuffer(cells["reps"][head], "<u2")
        out_names, out_sizes, out_unique, out_keys = [], [], [], []
        own = np.unique(reps)
        for k, a, b in zip(own, np.searchsorted(doc, own, "left"), np.searchsorted(doc, own, "right")):
            if sizes[k]:
                keys = prefix_keys(int(sizes[k]), token[a:b], code[a:b], percent, rare)
                out_names += [names[k]] * len(keys)
                out_sizes.append(np.full(len(keys), sizes[k]))
                out_unique.append(np.full(len(keys), sizes[k] - (b - a)))
                out_keys.append(keys)
        n, m = len(sizes), len(out_names)
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
        none = pa.array([None] * m)
        return pa.Table.from_arrays([
            pa.concat_arrays([pa.array(cells["ids"][head], id_type), none.cast(id_type)]),
            pa.concat_arrays([pa.array(np.frombuffer(cells["texts"][head], "<i8")), none.cast(pa.int64())]),
            pa.array([x if s else None for x, s in zip(names, sizes)] + out_names, pa.binary()),
            pa.array(np.concatenate([sizes, join(out_sizes)]).astype(np.int64)),
            pa.array(np.concatenate([np.zeros(n, np.int64), join(out_unique)])),
            pa.concat_arrays([pa.array([None] * n, pa.int64()), pa.array(join([k.view(np.int64) for k in out_keys]))]),
            pa.array([True] * n + [False] * m),
        ], names=["id", "key", "name", "size", "alone", "sig", "document"])

    return run


def _common(batches):
    """How many tokens the sets of a pair share."""
    for batch in batches:
        shared = [
            len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
        ]
        union = [(len(x) + len(y)) // 8 - n for x, y, n in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), shared)]
        names = ["a", "b", "root_a", "root_b"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(shared, pa.int64()), pa.array(union, pa.int64())], names=[*names, "shared", "all"])


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
                    rare: int = RARE) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for each document.

    Documents link when the Jaccard similarity of their sets of ``width``-word shingles is
    ``percent`` / 100 at least (whole-number arithmetic); ``component_id`` is the smallest
    doc_id that links lead to.  ``kept`` marks one document of each component: that of the
    smallest doc_id (ties: the smaller ``text_key``, a hash of the text).

    Null and empty texts, and texts without a word, have no shingles and link with nothing;
    each is its own component.  A null doc_id is passed over in the minimum, and
    is kept only where a component has no other; the component of nulls is null.  Rows that
    repeat both id and text appear, and are marked, each.  An empty table gives none.
    """
    id_name = documents.schema[doc_id].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_name]
    texts = documents.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), whole_text(text).alias("body"))
    chars = texts.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("n")).first()["n"]
    grown = int(GROWTH * (chars / 6) ** 0.5)
    parts = max(1, -(-int(chars / 6) // max(GROUP, grown)))
    dealt = texts.mapInArrow(_deal(width, parts, max(CHUNK, grown), id_type), _DEALT.format(id=id_name))
    counted = dealt.groupBy("p").applyInArrow(_count, _BACK.format(id=id_name))
    indexed = stored(counted.groupBy("chunk").applyInArrow(_index(percent, rare, id_type), f"id {id_name}, key long, name binary, size long, alone long, sig long, document boolean"))

    entries = indexed.where("not document").groupBy("sig", "name").agg(F.first("size").alias("size"), F.min("alone").alias("alone"))
    # the set of the fewest rare tokens is nearest to the others
    bucket = entries.groupBy("sig").agg(F.count("*").alias("n"), F.min(F.struct("alone", "name", "size")).alias("lead")).where("n > 1").drop("n")
    entries = stored(entries.join(bucket, "sig"))

    def promising(sa: str, ua: str, sb: str, ub: str) -> Column:
        """Sizes, and what the tokens of one document only leave to share, allow the similarity."""
        most = F.least(F.col(sa) - F.col(ua), F.col(sb) - F.col(ub))
        return (100 + percent) * most >= percent * (F.col(sa) + F.col(sb))

    stars = stored(entries.where(F.col("name") != F.col("lead.name")).select(
        F.col("lead.name").alias("a"), F.col("name").alias("b"), "size", "alone", F.col("lead.size").alias("lead_size"), F.col("lead.alone").alias("lead_alone"),
    ).where(promising("size", "alone", "lead_size", "lead_alone")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    members = small_side(stored(entries.select("name").distinct()))

    def sets_of(batches):
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            found = [shingles(x, width) for x in texts_of(batch.column("body"))]
            yield pa.RecordBatch.from_arrays([
                pa.array([digest(s) if len(s) else None for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary()),
            ], names=["name", "tokens"])
        released()

    sets = stored(texts.select("body").mapInArrow(sets_of, "name binary, tokens binary").join(members, "name", "left_semi").groupBy("name").agg(F.first("tokens").alias("tokens")))

    def compared(pairs: DataFrame) -> DataFrame:
        first, second = (sets.select(F.col("name").alias(n), F.col("tokens").alias(t)) for n, t in (("a", "x"), ("b", "y")))
        joined = pairs.join(first, "a").join(second, "b").select("a", "b", "root_a", "root_b", "x", "y")
        return stored(joined.mapInArrow(_common, "a binary, b binary, root_a binary, root_b binary, shared long, all long"))

    similar = F.col("shared") * 100 >= F.col("all") * percent
    around = compared(stars.select("*", F.col("a").alias("root_a"), F.col("b").alias("root_b")))
    roots = connected(around.where(similar).select("a", "b"))
    far = 1 - F.col("shared") / F.col("all")
    away = around.select(F.col("a").alias("centre"), F.col("b").alias("name"), far.alias("far")).unionByName(
        around.select(F.col("b").alias("centre"), F.col("a").alias("name"), far.alias("far")))
    labelled = entries.select("sig", "name", "size", "alone", F.col("lead.name").alias("centre")).join(
        roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    apart = labelled.groupBy("sig").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("sig")
    opened = stored(labelled.join(apart, "sig", "left_semi").join(away, ["centre", "name"], "left").withColumn(
        "far", F.when(F.col("centre") == F.col("name"), 0.0).otherwise(F.col("far"))))
    # the smallest few of a set's open buckets: a pair is compared in the first that both remember
    few = opened.groupBy("name").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, FIRST).alias("few"))
    open_ = opened.join(few, "name")
    left, right = (open_.select("sig", *[F.col(c).alias(f"{c}_{s}") for c in ("name", "size", "alone", "root", "far", "few")]) for s in "ab")
    both = F.array_intersect("few_a", "few_b")
    pairs = left.join(right, "sig").where(
        (F.col("name_a") < F.col("name_b")) & (F.col("root_a") != F.col("root_b")) & promising("size_a", "alone_a", "size_b", "alone_b")
        & F.coalesce(F.abs(F.col("far_a") - F.col("far_b")) <= 1 - percent / 100 + 1e-9, F.lit(True))
        & ((F.size(both) == 0) | (F.array_min(both) == F.col("sig")))
    ).select(*[F.col(f"name_{c}").alias(c) for c in "ab"], "root_a", "root_b").distinct().join(stars, ["a", "b"], "left_anti")
    # what else links joins whole components, so only their roots go on
    across = compared(pairs)
    more = across.where(similar).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))

    rows = indexed.where("document").select("id", "key", "name", "size")
    placed = rows.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    if not more.isEmpty():
        joined = connected(more).select(F.col("node").alias("root"), F.col("root").alias("joined"))
        placed = placed.join(joined, "root", "left").withColumn("root", F.coalesce("joined", "root")).drop("joined")
    placed = stored(placed)
    for used in (indexed, entries, stars, sets, around, opened, across):
        dropped(used)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"), F.min(order).alias("lead"))
    return placed.join(least, "root", "left").select(
        F.col("id").alias("doc_id"), F.col("key").alias("text_key"), F.col("size").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("root").isNull() | order.eqNullSafe(F.col("lead"))).alias("kept"),
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') || least(3, len(w)) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach AS (WITH RECURSIVE r(d, e) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, y FROM r JOIN link ON r.e = x) SELECT d, min(e) AS e FROM r GROUP BY d)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, e AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN reach ON d = doc_id
"""


@query("op8_ngram_jaccard_join", SQL)
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(documents, width=3, percent=90).select("doc_id", "n_shingles", "component_id")
