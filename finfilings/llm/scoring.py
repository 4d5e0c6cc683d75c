"""Scores of a trigram language model that is held in Elias-Fano tries.

The model interpolates discounted counts: with c a count, T the number of distinct
followers and D the discount,

    p1(w)       = (c(w) + 1) / (N + V + 1)
    p2(w | b)   = (c(bw) - D) / c(b)  + D T(b) / c(b) * p1(w)
    p3(w | ab)  = (c(abw) - D) / c(ab) + D T(ab) / c(ab) * p2(w | b)

where an unseen context leaves the shorter one's probability.  A text begins after two begin
marks and stops with an end token, so the probabilities of all texts sum to one at most.

A trie holds the contexts of some middle words b: b's followers w and b's predecessors a,
then the followers of ``a b``, each as its *place among the followers of b*.  Every level
is one rising list (number of the parent, then of the child), found by successor search;
the begins of b's followers are a rising list of pointers.  Discounted probabilities and
weights are stored in 16 bits, on a scale of logarithms, rounded down.

1. Texts become blocks of about a million tokens.  A block's distinct words meet those of
   the other blocks by hash: they come back with their count and a short number.
2. A block's distinct trigrams go to the shard of their middle word, with their count in
   training texts and the documents that they stand in.  A middle word that is too frequent
   for one shard is split by the word before it; its followers are counted beforehand, in
   parts, and sent to each of these shards.
3. A shard adds the counts up, writes its levels to a file, maps it, and answers its rows.
4. The answers are added up by block, then by document.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import Numbers, crc_of, dropped, held, released, stored, table, texts_of, whole_text
from finfilings.llm.eliasfano import EliasFano, encode
from finfilings.llm.registry import query

#: Tokens of a block, and of a shard.
BLOCK, SHARD = 3 << 18, 3 << 19
#: Trigrams that a trie is asked for at a time: blocks' rows together, so that it is read through seldom.
LOOK = 1 << 18
#: Taken off each count of two or three words.
DISCOUNT = 0.75
#: Steps of a stored logarithm in a power of ten.
STEPS = 4096
#: A text is cut into words about this many bytes at a time.
SLICE_BYTES = 1 << 20
#: Numbers of words: not in the training texts, the begin mark, then the words.
UNKNOWN, BEGIN, FIRST = 0, 1, 2
#: Numbers of tokens in a block are packed in this many bits.
_BITS = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Hashes of the begin mark and of the end token.
_BEGIN_HASH, _END_HASH = np.uint64(0), np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    return (x ^ (x >> np.uint64(29))) * _M2 >> np.uint64(16)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0, compressed byte by byte: first all lowest bytes, and so on."""
    most = int(x.max()) if len(x) else 0
    width = max(1, -(-most.bit_length() // 8))
    planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpacked(cell) -> np.ndarray:
    """What ``packed`` was given, as 64-bit numbers."""
    cell = memoryview(cell)
    planes = np.frombuffer(zstandard.decompress(cell[1:]), np.uint8).reshape(cell[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :cell[0]] = planes.T
    return out.view("<i8").ravel()


def packed_steps(x: np.ndarray) -> bytes:
    """Numbers of which neighbours are near each other."""
    step = np.diff(x, prepend=0)
    return packed(np.where(step < 0, -2 * step - 1, 2 * step))


def unpacked_steps(cell) -> np.ndarray:
    step = unpacked(cell)
    return np.cumsum(np.where(step & 1, -(step + 1) // 2, step // 2))


def words_of(text: str) -> Iterator[list[bytes]]:
    """Words in bytes, lower-cased, some at a time; whole words only."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield (data if end - begin == len(data) else data[begin:end]).split()
        begin = end


# --- blocks -----------------------------------------------------------------------------

_BLOCKS = "block long, keys array<long>, ids array<{id}>, learn binary, segments binary, lengths binary, tokens binary, words binary, n long"


def _blocks(block_tokens: int, id_type: pa.DataType):
    """Documents as runs of token numbers.  A run begins with two tokens of context; a very
    long document is several runs, which may stand in several blocks."""
    def run(batches):
        task, block, row = TaskContext.get().partitionId(), 0, 0
        keys, ids, learn, segments, runs, size = [], [], [], [], [], 0

        def flush():
            words, tokens, times = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")  # the most frequent first
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words, tokens = words[order], rank[tokens]
            return pa.RecordBatch.from_arrays([
                pa.array([(task << 33) + block], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([ids], pa.list_(id_type)),
                *[pa.array([x], pa.binary()) for x in (
                    packed(np.array(learn)), packed(np.array(segments)), packed(np.array([len(r) for r in runs])), packed(tokens), words.astype("<u8").tobytes())],
                pa.array([size], pa.int64()),
            ], names=["block", "keys", "ids", "learn", "segments", "lengths", "tokens", "words", "n"])

        for batch in batches:
            for name, known, body in zip(*(texts_of(batch.column(c)) for c in ("id", "learn", "body"))):
                keys.append((task << 33) + row), ids.append(name), learn.append(int(known))
                context = np.array([_BEGIN_HASH, _BEGIN_HASH])
                for words in words_of(body):
                    h = np.fromiter(map(held("numbers", Numbers).__getitem__, words), np.uint64, len(words))
                    h[h < 2] += np.uint64(2)
                    runs.append(np.concatenate([context, h])), segments.append(len(keys) - 1)
                    context, size = runs[-1][-2:], size + len(h)
                    if size >= block_tokens:
                        yield flush()
                        released()
                        block += 1
                        keys, ids, learn, segments, runs, size = keys[-1:], ids[-1:], learn[-1:], [], [], 0
                runs.append(np.append(context, _END_HASH)), segments.append(len(keys) - 1)
                row, size = row + 1, size + 1
                if len(keys) >= 60_000:
                    yield flush()
                    block += 1
                    keys, ids, learn, segments, runs, size = [], [], [], [], [], 0
        if runs:
            yield flush()

    return run


class Block:
    """A block's tokens: ``t`` their numbers, ``d`` their documents; ``at`` are the places
    that are scored, all but the contexts."""

    def __init__(self, row: dict):
        self.learn = unpacked(row["learn"]).astype(bool)
        held("block", dict)  # nothing is kept of words met while texts were read
        self.t = unpacked(row["tokens"]).astype(np.int32)
        lengths = unpacked(row["lengths"])
        self.d = np.repeat(unpacked(row["segments"]).astype(np.int32), lengths)
        scored = np.ones(len(self.t), bool)
        begin = np.cumsum(lengths) - lengths
        scored[begin], scored[begin + 1] = False, False
        self.at = np.flatnonzero(scored)
        self.known = self.learn[self.d]


def _part(words: np.ndarray, parts: int) -> np.ndarray:
    """Part of a word's hash; rises with it."""
    return (((words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _cuts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of equal neighbours."""
    begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    return begin, np.append(begin[1:], len(x)).astype(np.int64) if len(begin) else begin


def _by_hash(words: np.ndarray) -> np.ndarray:
    """Places of the words in order of their hashes, the begin mark left out."""
    order = np.argsort(words)
    return order[np.count_nonzero(words == _BEGIN_HASH):]


# --- words ------------------------------------------------------------------------------


def _deal_words(parts: int):
    """A block's distinct words with their training counts, a row for each part."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, words = Block(row), np.frombuffer(row["words"], "<u8")
                counts = np.bincount(own.t[own.at][own.known[own.at]], minlength=len(words))
                order = _by_hash(words)
                words, counts = words[order], counts[order]
                part = _part(words, parts)
                cuts = list(zip(*_cuts(part)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(part[a]) for a, _ in cuts], pa.int32()), pa.array([row["block"]] * len(cuts), pa.int64()),
                    pa.array([words[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([packed(counts[a:b]) for a, b in cuts], pa.binary()),
                ], names=["part", "block", "words", "counts"])

    return run


_ANSWER = "part int, block long, numbers binary, counts binary, n long, v long, often array<struct<number:long,count:long>>"


def _number(parts: int, often: int):
    """Counts and numbers of a part's words, back to each block; and one row about the part.

    Numbers count up within a part, the most frequent words first, and interleave over the
    parts, so they are nearly dense and small for frequent words.
    """
    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        words = [np.frombuffer(x.as_buffer(), "<u8") for x in group.column("words")]
        counts = [unpacked(x.as_buffer()) for x in group.column("counts")]
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        known = total > 0
        rank = np.empty(len(total), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        numbers = np.where(known, rank * parts + part + FIRST, UNKNOWN)
        cells, begin = {"numbers": [], "counts": []}, 0
        for own in words:
            i = at[begin:begin + len(own)]
            begin += len(own)
            cells["numbers"].append(packed(numbers[i])), cells["counts"].append(packed(total[i]))
        most = [{"number": int(numbers[k]), "count": int(total[k])} for k in np.flatnonzero(total > often)]
        n = len(words)
        kind = pa.list_(pa.struct([("number", pa.int64()), ("count", pa.int64())]))
        return pa.Table.from_arrays([
            pa.array([part] * (n + 1), pa.int32()), pa.array([*group.column("block").to_pylist(), None], pa.int64()),
            pa.array([*cells["numbers"], None], pa.binary()), pa.array([*cells["counts"], None], pa.binary()),
            pa.array([None] * n + [int(total.sum())], pa.int64()), pa.array([None] * n + [int(known.sum())], pa.int64()),
            pa.array([None] * n + [most], kind),
        ], names=["part", "block", "numbers", "counts", "n", "v", "often"])

    return run


def _numbered(block: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with numbers and counts of its words in place of the hashes."""
    row = block.to_pylist()[0]
    rows = sorted(answers.select(["part", "numbers", "counts"]).to_pylist(), key=lambda r: r["part"])
    words = np.frombuffer(row["words"], "<u8")
    numbers, counts = np.full(len(words), BEGIN), np.zeros(len(words), np.int64)
    order = _by_hash(words)
    numbers[order] = np.concatenate([unpacked(r["numbers"]) for r in rows])
    counts[order] = np.concatenate([unpacked(r["counts"]) for r in rows])
    return block.drop(["words", "n"]).append_column("numbers", pa.array([packed(numbers)], pa.binary())).append_column(
        "counts", pa.array([packed(counts)], pa.binary()))


# --- trigrams ---------------------------------------------------------------------------


def _shard(middle: np.ndarray, before: np.ndarray, often: dict[int, int], shards: int) -> np.ndarray:
    """Shard of a middle word; frequent ones are spread by the word before."""
    out = mixed(middle.astype(np.uint64)) % np.uint64(shards)
    if often:
        names = np.array(sorted(often), np.int64)
        i = np.minimum(np.searchsorted(names, middle), len(names) - 1)
        hot = np.flatnonzero(names[i] == middle)
        split = np.array([often[int(k)] for k in names], np.uint64)[i[hot]]
        out[hot] = (out[hot] + mixed(before[hot].astype(np.uint64)) % split) % np.uint64(shards)
    return out.astype(np.int64)


_ROWS = ("shard int, block long, middle binary, before binary, word binary, counts binary, seen binary, places binary, docs binary, "
         "keys array<long>, ids array<{id}>, tokens binary, known binary, base binary, score binary")
_CELLS = ("middle", "before", "word", "counts", "seen", "places", "docs", "tokens", "known", "base", "score")


def _batch(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    column = lambda name, kind: pa.array([r.get(name) for r in rows], kind)
    names = ["shard", "block", *_CELLS[:7], "keys", "ids", *_CELLS[7:]]
    kinds = {"shard": pa.int32(), "block": pa.int64(), "keys": pa.list_(pa.int64()), "ids": pa.list_(id_type)}
    return pa.RecordBatch.from_arrays([column(n, kinds.get(n, pa.binary())) for n in names], names=names)


def _deal_trigrams(shards: int, often: dict[int, int], total: int, id_type: pa.DataType):
    """A block's distinct trigrams, a row for each shard, and a row about its documents.

    After a middle word that no training text holds, the probability is p1; that is added
    up here.
    """
    def run(batches):
        for row in (r for batch in batches for r in batch.to_pylist()):
            released()
            own, n_docs = Block(row), len(row["keys"])
            numbers, counts = unpacked(row["numbers"]), unpacked(row["counts"])
            at, d = own.at, own.d[own.at]
            token = own.t[at]
            logs = np.log10((counts + 1) / total)
            sums = lambda x, some=slice(None): np.bincount(d[some], weights=x, minlength=n_docs)
            fallen = (numbers == UNKNOWN)[own.t[at - 1]]
            rows = [{
                "shard": row["block"] % shards, "block": row["block"], "keys": row["keys"], "ids": row["ids"],
                "tokens": packed(np.bincount(d, minlength=n_docs)), "known": packed(sums(counts[token] > 0)),
                "base": sums(logs[token]).tobytes(), "score": sums(logs[token[fallen]], fallen).tobytes(),
            }]
            at, d = at[~fallen], d[~fallen]
            key = (own.t[at - 1].astype(np.uint64) << (_BITS + _BITS)) | (own.t[at - 2].astype(np.uint64) << _BITS) | own.t[at].astype(np.uint64)
            order = np.argsort(key, kind="stable")
            key, d = key[order], d[order]
            del order, at, token, logs, fallen
            begin, end = _cuts(key)
            key, places = key[begin], end - begin
            seen = np.add.reduceat(own.learn[d].astype(np.int64), begin) if len(begin) else begin
            own_counts = counts[key & _MASK]
            middle, before, word = (numbers[(key >> s) & _MASK] for s in (_BITS + _BITS, _BITS, np.uint64(0)))
            shard = _shard(middle, before, often, shards)
            order = np.lexsort((word, before, middle, shard))
            for a, b in zip(*_cuts(shard[order])):
                i = order[a:b]
                n = places[i]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[i], n)
                _, distinct = np.unique(word[i], return_index=True)
                rows.append({
                    "shard": int(shard[i[0]]), "block": row["block"], "middle": packed_steps(middle[i]), "before": packed_steps(before[i]),
                    "word": packed(word[i]), "counts": packed(own_counts[i[distinct]]), "seen": packed(seen[i]), "places": packed(n), "docs": packed(d[inner]),
                })
            del key, begin, middle, before, word, own_counts, shard, order, places, seen, d
            for k in range(0, len(rows), 16):
                yield _batch(rows[k:k + 16], id_type)
            del rows
        released()

    return run


def _deal_followers(often: dict[int, int]):
    """Followers of frequent middle words in a block's training texts: ``middle, part, word, seen``."""
    def run(batches):
        names = np.array(sorted(often), np.int64)
        for row in (r for batch in batches for r in batch.to_pylist()):
            own, numbers = Block(row), unpacked(row["numbers"])
            at = own.at[own.known[own.at]]
            middle, word = numbers[own.t[at - 1]], numbers[own.t[at]]
            i = np.minimum(np.searchsorted(names, middle), len(names) - 1)
            some = names[i] == middle
            pair, seen = np.unique((i[some].astype(np.int64) << 42) | word[some], return_counts=True)
            i, word = pair >> 42, pair & ((1 << 42) - 1)
            split = np.array([often[int(k)] for k in names])[i]
            part = (mixed(word.astype(np.uint64)) % split.astype(np.uint64)).astype(np.int64)
            order = np.lexsort((part, i))
            cuts = list(zip(*_cuts((i[order] << 20) | part[order])))
            for k in range(0, len(cuts), 64):
                some = [order[a:b] for a, b in cuts[k:k + 64]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(names[i[x[0]]]) for x in some], pa.int64()), pa.array([int(part[x[0]]) for x in some], pa.int64()),
                    pa.array([packed(word[x]) for x in some], pa.binary()), pa.array([packed(seen[x]) for x in some], pa.binary()),
                ], names=["middle", "part", "word", "seen"])

    return run


def _add_followers(group: pa.Table) -> pa.Table:
    """Adds the blocks' counts up."""
    words = [unpacked(x.as_buffer()) for x in group.column("word")]
    seen = np.concatenate([unpacked(x.as_buffer()) for x in group.column("seen")])
    word, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, weights=seen).astype(np.int64)
    return group.slice(0, 1).select(["middle", "part"]).append_column("word", pa.array([packed(word)], pa.binary())).append_column(
        "seen", pa.array([packed(total)], pa.binary()))


# --- tries ------------------------------------------------------------------------------

_VALUES = np.append(10.0 ** (-np.arange(65535) / STEPS), 0.0)


def quantised(p: np.ndarray) -> np.ndarray:
    """Probabilities as 16-bit logarithms, rounded down; 65535 stands for 0."""
    with np.errstate(divide="ignore"):
        return np.minimum(np.ceil(-np.log10(p) * STEPS - 1e-9), 65535).astype("<u2")


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers in four bytes where they fit."""
    return x.astype(np.int32) if not len(x) or int(x.max()) < 1 << 31 else x


def build(counted: list[np.ndarray], followers=None, discount: float = DISCOUNT) -> bytes:
    """The levels of a trie out of trigram counts ``middle, before, word, seen`` (repeats are
    added up); the list is emptied, so that none of them is kept meanwhile.

    ``followers`` are (middle, word, count) of middle words whose trigrams are here in part
    only; they stand instead of what the trigrams add up to.
    """
    seen, word, before, middle = (counted.pop() for _ in range(4))
    top = 1 + max((int(x.max()) for x in (before, word, *((followers[1],) if followers else ())) if len(x)), default=0)
    own, a = np.unique(middle, return_inverse=True)
    del middle
    a = a * np.int64(top) + before
    del before
    contexts, j = np.unique(a, return_inverse=True)
    del a
    j = j * np.int64(top) + word
    del word
    trigram, at = np.unique(j, return_inverse=True)
    del j
    count = np.bincount(at, weights=seen).astype(np.int64) if len(at) else np.empty(0, np.int64)
    del at, seen
    own, top = own.astype(np.int64), np.int64(top)
    j, last = _narrow(trigram // top), _narrow(trigram % top)
    del trigram
    head = _narrow(contexts // top)
    names = np.union1d(own, followers[0]) if followers else own
    host = np.searchsorted(names, own)  # of the trigrams' middle words among all
    contexts = encode(host[head] * top + contexts % top)
    key = host[head[j]] * top + last
    del head, last
    distinct = np.bincount(j)
    sums = np.bincount(j, weights=count)
    weight3, own3 = quantised(discount * distinct / sums), quantised((count - discount) / sums[j])
    del distinct, sums
    pair, times = key, count
    if followers:
        whole = ~np.isin(key // top, np.searchsorted(names, np.unique(followers[0])))
        pair, times = (np.concatenate(x) for x in ((key[whole], np.searchsorted(names, followers[0]) * top + followers[1]), (count[whole], followers[2])))
    del count
    bigram = np.sort(pair)
    bigram = bigram[_cuts(bigram)[0]]
    both = np.bincount(np.searchsorted(bigram, pair), weights=times, minlength=len(bigram)).astype(np.int64)
    del pair, times
    parent = bigram // top
    totals, kinds = np.bincount(parent, weights=both, minlength=len(names)), np.bincount(parent, minlength=len(names))
    weight2, own2 = quantised(discount * kinds / np.maximum(totals, 1)), quantised((both - discount) / totals[parent])
    del parent, both, totals
    begins, wide = np.cumsum(kinds) - kinds, 1 + int(kinds.max(initial=0))
    place = np.searchsorted(bigram, key) - begins[key // top]
    del key
    names, begins, bigram, trigram = encode(names), encode(begins), encode(bigram), encode(j * np.int64(wide) + place)
    tables = weight2, own2, weight3, own3
    out = [np.array([top, wide, *map(len, tables)], "<u8").tobytes(), names, begins, bigram, contexts, trigram]
    for x in tables:
        out.append(x.tobytes() + b"\0" * (-2 * len(x) % 8))
    return b"".join(out)


class Trie:
    """The levels in a buffer, such as a mapped file."""

    def __init__(self, buffer):
        self.top, self.wide, *sizes = (int(x) for x in np.frombuffer(buffer, "<u8", 6))
        offset, lists = 48, []
        for _ in range(5):
            lists.append(EliasFano(buffer, offset))
            offset = lists[-1].end
        self.names, self.begins, self.bigrams, self.contexts, self.trigrams = lists
        tables = []
        for n in sizes:
            tables.append(np.frombuffer(buffer, "<u2", n, offset))
            offset += 2 * n + (-2 * n % 8)
        self.weight2, self.own2, self.weight3, self.own3 = tables

    def probability(self, middle: np.ndarray, before: np.ndarray, word: np.ndarray, p1: np.ndarray) -> np.ndarray:
        """p3 of each word after ``before middle``; ``p1`` is its own probability."""
        # neighbours mostly share the middle word, and many the whole context: each is looked up once
        begin, end = _cuts(middle)
        own, seen = self.names.successor(middle[begin])
        first = np.zeros(len(own), np.int64)
        first[seen] = self.begins[own[seen]]
        run = np.repeat(np.arange(len(begin)), end - begin)
        out = p1.copy()
        at = np.flatnonzero(seen[run])
        if not len(at):
            return out
        a, first, word, before = own[run[at]], first[run[at]], word[at], before[at]
        i, follows = self.bigrams.successor(np.where(word < self.top, a * self.top + word, (a + 1) * self.top - 1))
        follows &= word < self.top
        p = _VALUES[self.weight2[a]] * p1[at]
        p[follows] += _VALUES[self.own2[i[follows]]]
        context = np.where(before < self.top, a * self.top + before, (a + 1) * self.top - 1)
        begin, end = _cuts(context)
        c, known = self.contexts.successor(context[begin])
        known &= before[begin] < self.top
        run = np.repeat(np.arange(len(begin)), end - begin)
        c, known = c[run], known[run]
        p[known] *= _VALUES[self.weight3[c[known]]]
        deep = np.flatnonzero(known & follows)
        t, there = self.trigrams.successor(c[deep] * self.wide + i[deep] - first[deep])
        p[deep[there]] += _VALUES[self.own3[t[there]]]
        out[at] = p
        return out


def mapped(levels: bytes) -> mmap.mmap:
    """The levels in a mapped file, which goes with the mapping."""
    with tempfile.TemporaryFile() as file:
        file.write(levels)
        file.flush()
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def _answer(total: int, discount: float, id_type: pa.DataType):
    """Builds a shard's trie and gives back each block's sums by document."""
    def run(group: pa.Table) -> pa.Table:
        is_head, is_follower = group.column("keys").is_valid().to_numpy(), group.column("block").is_null().to_numpy()
        rows = np.flatnonzero(~is_head & ~is_follower)

        def cell(name: str, k: int) -> np.ndarray:
            read = unpacked_steps if name in ("middle", "before") else unpacked
            return read(group.column(name)[int(k)].as_buffer())

        held("shard", dict)
        released()
        counted = [[], [], [], []]
        for k in rows:
            seen = cell("seen", k)
            learnt = seen > 0
            if learnt.any():
                for x, name in zip(counted, ("middle", "before", "word")):
                    x.append(_narrow(cell(name, k)[learnt]))
                counted[3].append(_narrow(seen[learnt]))
        for c in range(4):
            counted[c] = np.concatenate(counted[c]) if counted[c] else np.empty(0, np.int64)
        extra = np.flatnonzero(is_follower)
        followers = None
        if len(extra):
            words = [cell("word", k) for k in extra]
            names = np.concatenate([cell("middle", k) for k in extra])
            followers = (np.repeat(names, [len(w) for w in words]), np.concatenate(words), np.concatenate([cell("seen", k) for k in extra]))
        levels = build(counted, followers, discount)
        del followers
        trie = Trie(mapped(levels))
        del levels
        out, asked = [], []

        def answer():
            p = trie.probability(*(np.concatenate(x) for x in zip(*(x for _, x in asked))))
            end = np.cumsum([len(x[0]) for _, x in asked])
            for (k, _), own in zip(asked, np.split(p, end[:-1])):
                sums = np.bincount(cell("docs", k), weights=np.repeat(np.log10(own), cell("places", k)))
                some = np.flatnonzero(sums)
                out.append({"block": group.column("block")[k].as_py(), "docs": packed(some), "score": sums[some].tobytes()})
            asked.clear()

        for k in map(int, rows):
            word = cell("word", k)
            _, at = np.unique(word, return_inverse=True)
            asked.append((k, (cell("middle", k), cell("before", k), word, (cell("counts", k)[at] + 1) / total)))
            if sum(len(x[0]) for _, x in asked) >= LOOK:
                answer()
        if asked:
            answer()
        del trie
        released()
        heads = group.filter(pa.array(is_head)).drop(["shard", *(c for c in _CELLS[:7])])
        names = ["block", "docs", "score"]
        scores = pa.Table.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(names, (pa.int64(), pa.binary(), pa.binary()))], names=names)
        return pa.concat_tables([heads, scores], promote_options="default").select(["block", "keys", "ids", "tokens", "known", "base", "score", "docs"])

    return run


_PARTS = "block long, keys array<long>, ids array<{id}>, tokens binary, known binary, base binary, score binary, docs binary"


def _total(id_type: pa.DataType):
    """A block's documents with what all shards say."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(r for r in rows if r["keys"] is not None)
        score = np.frombuffer(head["score"]).copy()
        for r in rows:
            if r["keys"] is None:
                score[unpacked(r["docs"])] += np.frombuffer(r["score"])
        return pa.Table.from_arrays([
            pa.array(head["keys"], pa.int64()), pa.array(head["ids"], id_type), pa.array(unpacked(head["tokens"])), pa.array(unpacked(head["known"])),
            pa.array(np.frombuffer(head["base"])), pa.array(score),
        ], names=["key", "id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_texts(documents: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id", discount: float = DISCOUNT,
                block: int = BLOCK, shard: int = SHARD, often: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of each row of
    ``documents``, by a model of the rows that ``learn`` admits.

    ``score`` is the base-10 logarithm of the model's probability of the whole text,
    ``base_score`` that of its tokens one by one (p1).  Null and empty texts are one end token.
    Rows that repeat are scored each, and learnt from each; a null ``learn`` is no.  Without
    rows to learn from every token has probability 1.  An empty table gives none.
    A middle word of more than ``often`` tokens (by default a quarter of ``shard``, so that
    shards are even) is split.
    """
    often = max(1, shard // 4) if often is None else often
    rows = documents.select(F.col(doc_id).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), whole_text(text).alias("body"))
    id_name = rows.schema["id"].dataType.simpleString()
    id_type = rows.limit(0).select("id").toArrow().schema.field("id").type
    blocks = stored(rows.mapInArrow(_blocks(block, id_type), _BLOCKS.format(id=id_name)))
    tokens = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-tokens // shard))

    dealt = blocks.mapInArrow(_deal_words(shards), "part int, block long, words binary, counts binary")
    answers = stored(dealt.groupBy("part").applyInArrow(_number(shards, often), _ANSWER))
    found = answers.where("block is null")
    n, v = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    total = n + v + 1
    # at most 2^20 words hold more than a 2^20th of all tokens
    frequent = found.select(F.explode("often").alias("w")).where(F.col("w.count") > max(often, n >> 20)).select("w.*").collect()
    split = {r["number"]: -(-r["count"] // often) for r in frequent}
    numbered = stored(blocks.groupBy("block").cogroup(answers.where("block is not null").groupBy("block")).applyInArrow(
        _numbered, _BLOCKS.format(id=id_name).replace("words binary, n long", "numbers binary, counts binary")))

    dropped(blocks)
    dropped(answers)
    dealt = numbered.mapInArrow(_deal_trigrams(shards, split, total, id_type), _ROWS.format(id=id_name))
    if split:
        followers = numbered.mapInArrow(_deal_followers(split), "middle long, part long, word binary, seen binary")
        followers = followers.groupBy("middle", "part").applyInArrow(_add_followers, "middle long, part long, word binary, seen binary")
        dealt = dealt.unionByName(followers.mapInArrow(_to_shards(split, shards), "shard int, middle binary, word binary, seen binary"), allowMissingColumns=True)
    parts = dealt.groupBy("shard").applyInArrow(_answer(total, discount, id_type), _PARTS.format(id=id_name))
    sums = parts.groupBy("block").applyInArrow(_total(id_type), f"key long, id {id_name}, n_tokens long, n_known long, base_score double, score double")
    return sums.groupBy("key").agg(F.first("id").alias(doc_id), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]).select(
        doc_id, "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _to_shards(split: dict[int, int], shards: int):
    """The followers of a frequent word, to each shard that has some of its trigrams."""
    def run(batches):
        for row in (r for batch in batches for r in batch.to_pylist()):
            first = int(mixed(np.array([row["middle"]], np.uint64))[0] % np.uint64(shards))
            to = sorted({(first + k) % shards for k in range(split[row["middle"]])})
            cell = packed_steps(np.array([row["middle"]]))
            for k in range(0, len(to), 64):
                n = len(to[k:k + 64])
                yield pa.RecordBatch.from_arrays([
                    pa.array(to[k:k + 64], pa.int32()), pa.array([cell] * n, pa.binary()), pa.array([row["word"]] * n, pa.binary()), pa.array([row["seen"]] * n, pa.binary()),
                ], names=["shard", "middle", "word", "seen"])

    return run


def held_out() -> Column:
    """Rows whose id's crc32 leaves 2 when divided by 7; a null id is never learnt from."""
    return F.coalesce(crc_of(F.col("doc_id"), 7) == 2, F.lit(True))


@query("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score_texts(documents, ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
