"""Benchmark passages in documents, found with one Aho-Corasick automaton.

Texts are normalised to lower-case words between single spaces.  The automaton holds
runs of consecutive item words: an item shorter than a window is one run, a longer one
is covered by adjacent runs, short enough that every window contains one of them whole.
One scan of a document finds all runs; each is extended to both sides while the words
agree, and counts if it reaches a window's length.  Positions are word numbers, and are
mapped back to code points of the original text only for documents with a hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finfilings.llm.common import held, table, texts_of, whole_text
from finfilings.llm.registry import query

#: Consecutive words that make a window.
WINDOW = 13
#: Benchmark text that one automaton may hold; a larger benchmark is scanned for in turns.
BLOCK_BYTES = 4_000_000

# ASCII other than digits and letters separates words; bytes of other characters belong to them
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Matcher:
    """The automaton over one block of items ``(item_id, text)``."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        import ahocorasick

        self.window, self.items = window, [(i, words_of(t)) for i, t in items]
        self.automaton, runs = ahocorasick.Automaton(), {}
        step = (window + 1) // 2  # a window of 2·step−1 words or more holds a whole aligned run
        for k, (_, words) in enumerate(self.items):
            starts = [(0, len(words))] if len(words) < window else [(a, a + step) for a in range(0, len(words) - step + 1, step)]
            for a, b in starts:
                if b > a:
                    runs.setdefault(b" ".join(words[a:b]), (b - a, []))[1].append((k, a))
        for run, found in runs.items():
            self.automaton.add_word(f" {run.decode('latin-1')} ", found)
        if runs:
            self.automaton.make_automaton()
        self.empty = not runs

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word intervals inside item windows (end exclusive, maybe overlapping), and the items' ids."""
        if self.empty or not words:
            return [], set()
        line = f" {b' '.join(words).decode('latin-1')} "
        found, items, reached = [], set(), {}
        seen_to, number = 0, 0
        for end, (length, places) in self.automaton.iter(line):
            number += line.count(" ", seen_to, end)
            seen_to = end
            first = number - length  # words before the run: the separator at `end` is not counted
            for k, at in places:
                name, own = self.items[k]
                if reached.get((k, first - at), -1) >= first + length:
                    continue  # inside a stretch that was followed before
                a, b = 0, length
                if len(own) >= self.window:
                    while a > -at and first + a > 0 and own[at + a - 1] == words[first + a - 1]:
                        a -= 1
                    while at + b < len(own) and first + b < len(words) and own[at + b] == words[first + b]:
                        b += 1
                reached[k, first - at] = first + b
                if len(own) < self.window or b - a >= self.window:
                    found.append((first + a, first + b))
                    items.add(name)
        return found, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint intervals that cover the same positions."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[tuple[list[tuple[object, str]], bool]]:
    """The items in blocks of bounded size, and whether a block is the last; one block at
    a time passes through the driver."""
    rows = benchmark.select(F.col(item_id).cast("string"), whole_text(text)).distinct().toLocalIterator()
    block, size = [], 0
    for name, body in rows:
        if block and size + len(body) > block_bytes:
            yield block, False
            block, size = [], 0
        block.append((name, body))
        size += len(body)
    yield block, True


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_benchmark(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                   keep: list[str] | None = None) -> DataFrame:
    """``documents`` plus ``n_words, n_hit, hit_spans, hit_items``.

    ``hit_spans`` are ``struct<start,end>`` in code points of the original text (end
    exclusive), one per stretch of words inside occurrences of item windows; ``hit_items``
    are the ids (as strings, sorted) of the items that occur.  ``n_hit`` counts words.
    ``keep`` names the columns of ``documents`` to return, all by default.

    Null and empty texts, and texts without a word, have no words and no hits.  Items
    without a word, or with a null text, occur nowhere; items with a null id take part
    and appear as an empty id.  Repeated items count once, repeated documents each for
    itself.  Empty tables give empty results or no hits.  Columns of ``documents`` with
    one of the four names are replaced; others pass through unchanged.
    """
    added = ["n_words", "n_hit", "hit_spans", "hit_items"]
    keep = [c for c in (documents.columns if keep is None else keep) if c not in added]
    out, context = documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]), documents.sparkSession.sparkContext
    result = T.StructType([out.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ])
    # what one block found travels with the row to the scan for the next one
    travel = T.StructType(out.schema.fields + [T.StructField("__spans", T.BinaryType()), T.StructField("__items", T.ArrayType(T.StringType()))])

    for k, (block, last) in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        key = hashlib.sha256(repr((window, block)).encode("utf-8", "surrogatepass")).hexdigest()
        sent = context.broadcast(block)  # bounded by block_bytes

        def scan(batches, key=key, sent=sent, first=k == 0, last=last):
            for batch in batches:
                matcher, n = held(f"matcher {key}", lambda: Matcher(sent.value, window)), batch.num_rows
                earlier = [[None] * n] * 2 if first else [batch.column(c).to_pylist() for c in ("__spans", "__items")]
                cells: dict[str, list] = {c: [] for c in (*added, "__spans", "__items")}
                for body, packed, known in zip(texts_of(batch.column(text)), *earlier):
                    words = words_of(body or "")
                    spans, names = matcher.spans(words)
                    if packed:
                        spans = spans + [tuple(x) for x in np.frombuffer(packed, "<i8").reshape(-1, 2).tolist()]
                    spans = merged(spans)
                    names = sorted({*(known or ()), *("" if x is None else x for x in names)})
                    if last:
                        at = [m.span() for m in _WORD.finditer(body)] if spans else []
                        cells["n_words"].append(len(words))
                        cells["n_hit"].append(sum(b - a for a, b in spans))
                        cells["hit_spans"].append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in spans])
                        cells["hit_items"].append(names)
                    else:
                        cells["__spans"].append(np.array(spans, "<i8").tobytes())
                        cells["__items"].append(names)
                if last:
                    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "hit_spans": _SPANS, "hit_items": pa.list_(pa.string())}
                    same = keep
                else:
                    kinds = {"__spans": pa.binary(), "__items": pa.list_(pa.string())}
                    same = list(dict.fromkeys([*keep, text]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in same] + [pa.array(cells[c], kind) for c, kind in kinds.items()], names=[*same, *kinds],
                )

        out = out.mapInArrow(scan, result if last else travel)
    return out


def contaminated():
    """At least a twentieth of the words, and one at least, lies in item windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
gram AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, k, i FROM gram JOIN win USING (k, gram)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, k, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_benchmark_decontamination", SQL)
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(documents, table(spark, sf_dir, "benchmark").select("item_id", "text"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )
