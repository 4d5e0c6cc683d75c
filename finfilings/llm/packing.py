"""Packing of tokenised documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most a sequence's length.  Full pieces are sequences of
their own; the others are numbered by length, so that shards of bounded size all get the
same mixture.  In each shard a packing is a set of bins.  Islands of a few packings evolve
side by side, one task's work each: crossover takes the well-filled bins of one parent
whole, then those bins of the other that hold nothing twice, and puts what is displaced
back by best fit; the best of each island then moves on to the next one.  A shard whose
packing has reached the fewest bins that its tokens can have does not evolve further.
Bins that are not well filled give their pieces to a next round of shards, until the rest
fits in one shard, so what a shard wastes does not add up over shards.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finfilings.llm.common import held, released, settle, table, texts_of, whole_text
from finfilings.llm.registry import query
from finfilings.operators.numbering import number_rows

CAPACITY = 4096
#: The token after each document.
END = 1
#: Pieces of a shard; islands of a shard; packings of an island; children per generation.
SHARD, ISLANDS, PACKINGS, GENERATIONS, EPOCHS = 2_048, 3, 6, 8, 2
#: A bin is well filled with no more than this left, and stays as it is.
SLACK = 8
ROUNDS = 5
#: Words remembered by a tokenising worker.
WORDS = 400_000
#: Characters that it splits at a time, about.
TURN = 500_000

# Texts of these characters only are split here as the tokenizer splits them; they have one
# form under composition, and lower case changes each letter alone.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")


class Tokens:
    """Token ids of whole texts, one word at a time.

    The tokenizer splits a text into words, single digits and runs of marks, and gives each
    its own ids, so a word met before need not be tokenised again.  What is remembered is
    bounded: the first come stay, which are the most frequent.  A text with characters
    beyond Latin-1's, or with the string of a special token, is encoded as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of words.  They are encoded in one text and told apart by the tokens
        that end a word."""
        flat = np.array(self.tokenizer.encode(" ".join(parts), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) == len(parts):
            packed, at = flat.tobytes(), [0, *(4 * stops).tolist()]
            return {w: packed[x:y] for w, x, y in zip(parts, at, at[1:])}
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return {p: np.array(f.ids, "<u4").tobytes() for p, f in zip(parts, found)}

    def of(self, texts: list[str]) -> list[np.ndarray]:
        words = self.words
        split = [_SPLIT.findall(t.lower()) if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        new = list(set().union(*[own for own in split if own]).difference(words))
        words.update(self._encode(new))
        ids = []
        for text, own in zip(texts, split):
            if own is None:
                ids.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
            else:
                ids.append(np.frombuffer(b"".join(map(words.__getitem__, own)), "<u4"))
        if len(words) > WORDS:
            for word in new:
                del words[word]
        return ids


def pieces_of(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of each piece of each document.

    A document is its tokens and the end token; only one longer than ``capacity`` is cut,
    and all its pieces but the last are full.  Null and empty texts are the end token alone.
    """
    def run(batches):
        found = held(f"tokens {tokenizer}", lambda: Tokens(tokenizer))
        for batch in batches:
            names, bodies, begin = batch.column("id"), texts_of(batch.column("body")), 0
            while begin < batch.num_rows:
                texts, size = [], 0
                while begin + len(texts) < batch.num_rows and size < TURN:
                    texts.append(next(bodies))
                    size += len(texts[-1])
                rows, cells = [], {"piece": [], "start": [], "length": [], "crc": []}
                kept = []
                for k, own in enumerate(found.of(texts), begin):
                    own = np.append(own, np.uint32(END)).astype("<u4")
                    for piece, at in enumerate(range(0, len(own), capacity)):
                        part = own[at:at + capacity]
                        rows.append(k)
                        cells["piece"].append(piece)
                        cells["start"].append(at)
                        cells["length"].append(len(part))
                        cells["crc"].append(zlib.crc32(part.tobytes()))
                        if ids:
                            kept.append(part.astype("<i4"))
                arrays = [names.take(pa.array(rows, pa.int64())), pa.array(cells["piece"], pa.int32()), *(pa.array(cells[c], pa.int64()) for c in ("start", "length", "crc"))]
                if ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids)
                begin += len(texts)
        released()

    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(F.col(doc_id).alias("id"), whole_text(text).alias("body")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids)


def best_fit(lengths, order, capacity: int, bins: list[list[int]] | None = None, room: list[int] | None = None) -> list[list[int]]:
    """Puts items, in the given order, where the least room is left; opens bins as needed."""
    bins = [list(b) for b in bins or []]
    free = sorted((capacity - sum(lengths[i] for i in b), k) for k, b in enumerate(bins)) if room is None else room
    for i in order:
        size = lengths[i]
        at = bisect.bisect_left(free, (size, -1))
        if at == len(free):
            bins.append([i])
            bisect.insort(free, (capacity - size, len(bins) - 1))
        else:
            left, k = free.pop(at)
            bins[k].append(i)
            bisect.insort(free, (left - size, k))
    return bins


def fitness(lengths, bins, capacity: int) -> float:
    """Few bins first; of as many, uneven filling, which leaves room in one place."""
    return sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins)) - len(bins)


def crossover(lengths, one, other, capacity: int, rng: random.Random) -> list[list[int]]:
    """The well-filled bins of ``one``, the bins of ``other`` that repeat none of their items,
    and the displaced items by best fit, the longest first."""
    filled = sorted(one, key=lambda b: (-sum(lengths[i] for i in b), rng.random()))
    bins = [list(b) for b in filled[:rng.randint(len(filled) // 3, max(1, 3 * len(filled) // 4))]]
    there = {i for b in bins for i in b}
    for b in other:
        if there.isdisjoint(b):
            bins.append(list(b))
            there.update(b)
    displaced = sorted((i for i in range(len(lengths)) if i not in there), key=lambda i: -lengths[i])
    return best_fit(lengths, displaced, capacity, bins)


def mutated(lengths, bins, capacity: int, rng: random.Random) -> list[list[int]]:
    """Empties the least filled bin and a few others, and fills again in a shuffled order."""
    by_fill = sorted(range(len(bins)), key=lambda k: sum(lengths[i] for i in bins[k]))
    out = {by_fill[0], *rng.sample(by_fill, min(len(bins), 3))}
    items = [i for k in out for i in bins[k]]
    items.sort(key=lambda i: -lengths[i] * rng.uniform(0.8, 1.0))
    return best_fit(lengths, items, capacity, [b for k, b in enumerate(bins) if k not in out])


def evolve(lengths, packings, capacity: int, seed: int) -> list[list[list[int]]]:
    """One island for ``GENERATIONS``, best packing first; ends early at the fewest bins possible."""
    rng, least = random.Random(seed), -(-sum(lengths) // capacity)
    items = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    packings = [p for p in packings if p]
    while len(packings) < PACKINGS:
        noise = 0.0 if not packings else rng.uniform(0.02, 0.3)
        order = sorted(items, key=lambda i: -lengths[i] * (1 + noise * rng.random())) if noise else items
        packings.append(best_fit(lengths, order, capacity))
        if len(packings[-1]) <= least:
            return [packings[-1]]
    score = lambda p: fitness(lengths, p, capacity)
    packings.sort(key=score, reverse=True)
    for _ in range(GENERATIONS):
        if len(packings[0]) <= least:
            break
        one, other = rng.sample(packings[:max(2, PACKINGS // 2 + 1)], 2)
        children = [crossover(lengths, one, other, capacity, rng), crossover(lengths, other, one, capacity, rng), mutated(lengths, packings[0], capacity, rng)]
        packings = sorted(packings + children, key=score, reverse=True)[:PACKINGS]
    return packings


def _flat(bins, n: int) -> bytes:
    """A packing as the bin of each item."""
    at = np.empty(n, "<i4")
    for k, b in enumerate(bins):
        at[b] = k
    return at.tobytes()


def _bins(packed: bytes | None) -> list[list[int]] | None:
    if packed is None:
        return None
    at = np.frombuffer(packed, "<i4")
    order = np.argsort(at, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)] if len(at) else []


_STATE = "round int, shard long, island int, lengths array<int>, best binary, guest binary, n_bins int, least int"


def _evolved(states: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Every island of every shard that is not at its least; the others pass through."""
    def run(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            best, n_bins = [], []
            for r in pdf.itertuples(index=False):
                lengths = [int(x) for x in r.lengths]
                own = [_bins(x) for x in (r.best, r.guest) if x is not None]
                if own and len(own[0]) <= r.least:
                    got = own[0]
                else:
                    got = evolve(lengths, own, capacity, zlib.crc32(repr((r.round, r.shard, r.island, epoch)).encode()))[0]
                best.append(_flat(got, len(lengths)))
                n_bins.append(len(got))
            kept = {c: batch.column(c) for c in batch.schema.names}
            kept |= {"best": pa.array(best, pa.binary()), "guest": pa.nulls(batch.num_rows, pa.binary()), "n_bins": pa.array(n_bins, pa.int32())}
            yield pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))

    return states.mapInArrow(run, _STATE)


def _shards(pool: DataFrame, round_no: int, capacity: int) -> DataFrame:
    """Pieces ``number, length`` in shards; each has every so-many-th of the lengths in order."""
    n = pool.count()
    count = max(1, -(-n // SHARD))
    ordered = number_rows(pool.select("number", "length"), [F.desc("length"), F.col("number")], "place")
    return ordered.withColumn("shard", F.pmod("place", F.lit(count))).groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("length", "number")), asc=False).alias("items"),  # SHARD pieces
    ).select(F.lit(round_no).alias("round"), "shard", "items")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``capacity``) plus ``sequence_id`` and ``offset``.

    Pieces of one sequence have offsets without gaps from 0 and fit in ``capacity``.  Rows
    may repeat; each is packed for itself.  An empty table gives none.  Columns with one of
    the two names are replaced, others pass through.
    """
    pieces = pieces.drop("sequence_id", "offset")
    numbered = settle(pieces.withColumn("__number", F.monotonically_increasing_id()))  # fixed once written
    # full pieces are sequences as they are, below 0; others get (round, shard, bin)
    full = numbered.where(F.col("length") >= capacity).select(F.col("__number").alias("number"), (-1 - F.col("__number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = numbered.where(F.col("length") < capacity).select(F.col("__number").alias("number"), "length")
    placed = full
    for round_no in range(ROUNDS):
        shards = settle(_shards(pool, round_no, capacity))
        islands = shards.select(
            "round", "shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
            F.transform("items", lambda x: x.length.cast("int")).alias("lengths"), F.lit(None).cast("binary").alias("best"),
            F.lit(None).cast("binary").alias("guest"), F.lit(None).cast("int").alias("n_bins"),
            F.ceil(F.aggregate("items", F.lit(0).cast("long"), lambda s, x: s + x.length) / capacity).cast("int").alias("least"),
        )
        states = settle(_evolved(islands.where("island = 0"), capacity, 0))
        for epoch in range(1, EPOCHS + 1):
            # a shard at its least has one island; the others have all of them
            if epoch == 1:
                hard = states.where("n_bins > least").select("shard", F.col("best").alias("elite"))
                fresh = islands.where("island > 0").join(hard, "shard").withColumn("guest", F.when(F.col("island") == 1, F.col("elite"))).select(*states.columns)
                states = states.unionByName(fresh)
            else:
                # the best of each island moves to the next one
                moved = states.where("n_bins > least").select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("best").alias("elite"))
                states = states.join(moved, ["shard", "island"], "left").withColumn("guest", F.col("elite")).select(*states.columns)
            if states.where("n_bins is null or n_bins > least").isEmpty():
                break
            states = settle(_evolved(states, capacity, epoch))
        best = states.groupBy("shard").agg(F.min_by("best", F.struct("n_bins", "island")).alias("best"))
        rows = settle(shards.join(best, "shard").select("round", "shard", "items", "best").mapInPandas(
            _laid_out(capacity), "round int, shard long, bin int, number long, length long, offset long, room int"))
        # the fullest bins stay; in the last round, and in a single shard, all do
        single = shards.count() <= 1
        last = single or round_no == ROUNDS - 1
        stays = F.lit(True) if last else (F.col("room") <= SLACK)
        done = rows.where(stays).select("number", (F.lit(round_no).cast("long") * (1 << 56) + F.col("shard") * (1 << 16) + F.col("bin")).alias("sequence_id"), "offset")
        placed = placed.unionByName(done)
        if last:
            break
        pool = rows.where(~stays).select("number", "length")
    return numbered.join(placed.withColumnRenamed("number", "__number"), "__number").drop("__number")


def _laid_out(capacity: int):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                items, out = r.items, []
                for k, b in enumerate(_bins(r.best)):
                    offset, room = 0, capacity - sum(int(items[i]["length"]) for i in b)
                    for i in b:
                        size = int(items[i]["length"])
                        out.append((r.round, r.shard, k, int(items[i]["number"]), size, offset, room))
                        offset += size
                yield pd.DataFrame(out, columns=["round", "shard", "bin", "number", "length", "offset", "room"])

    return run


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(pieces_of(documents, public_tokenizers.path("word_bpe_49k.json")))
