"""Passages that occur more than once in a corpus, as runs of consecutive units.

A text is cut into units (lines, sentences); every run of consecutive units is hashed.
The hashes are counted over the corpus; of the runs that repeat, the first occurrence
(smallest doc_id, then position) stays and all others are cut out, overlapping runs
together.  Only the counting moves a row per run, of eight bytes.  The hashes that repeat
are marked in a bitmap of fixed size, and everything after it works on the runs that hit
it; what hits it by chance, more as a corpus grows, falls away when places are compared.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finfilings.llm.common import free_name, settle, small_side, stored, texts_of, whole_text

#: Bits of the bitmap of repeated hashes (16 MB), as a power of two.
MARKS = 27

#: A unit of a text: its content for comparison, its words, and the code points that go with it.
Unit = tuple[bytes, int, int, int]


def runs(units: list[Unit], least_units: int, least_words: int, placed: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Hashes (two 64-bit numbers) and cuts (start, end) of the shortest runs from each unit
    on that have ``least_units`` units and ``least_words`` words; no cuts unless ``placed``."""
    n = len(units)
    packed = b"".join([xxhash.xxh3_64_digest(u[0]) for u in units])
    words = [0]
    for u in units:
        words.append(words[-1] + u[1])
    hashes, ends, end = [], [], 0
    for i in range(n):
        end = max(end, i + least_units)
        while end <= n and words[end] - words[i] < least_words:
            end += 1
        if end > n:
            break
        hashes.append(xxhash.xxh3_128_digest(packed[8 * i:8 * end]))
        ends.append(end)
    found = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    if not placed:
        return found, None
    cuts = np.empty((len(ends), 2), np.int64)
    cuts[:, 0] = [u[2] for u in units[:len(ends)]]
    cuts[:, 1] = [units[end - 1][3] for end in ends]
    return found, cuts


def _merge(batches):
    """Cuts of a document, merged.  One that takes the last line takes the break before it."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for cuts in batch.column("cuts").to_pylist():
            merged: list[list] = []
            for a, b, last in sorted((c["start"], c["end"], c["last"]) for c in cuts):
                if merged and a <= merged[-1][1]:
                    merged[-1][1], merged[-1][2] = max(b, merged[-1][1]), last or merged[-1][2]
                else:
                    merged.append([a, b, last])
            out.append([{"start": max(0, a - last), "end": b} for a, b, last in merged])
        at = batch.schema.get_field_index("cuts")
        yield batch.set_column(at, "cuts", pa.array(out, kind))


def cut_repeats(documents: DataFrame, units: Callable[[str], list[Unit]], least_units: int, least_words: int = 0,
                text: str = "text", doc_id: str = "doc_id", separated: bool = False,
                unplaced: Callable[[str], list[Unit]] | None = None) -> DataFrame:
    """``documents`` with the text without repeated runs, plus ``cuts`` and ``first_ids``.

    ``cuts`` are the merged stretches cut from the original text (code points, end
    exclusive), null where nothing was; ``first_ids`` the documents that hold the first
    occurrences.  Which occurrence is first goes by doc_id, null before all others, then by
    position.  Rows equal in id and text are one document: all keep, or lose, the same.
    ``separated``: a cut that reaches the end takes the line break before it as well.
    ``unplaced`` gives the same units without their code points, for the counting.
    """
    counted = unplaced or units
    key, columns = F.xxhash64(F.col(doc_id), F.col(text)), documents.columns
    keyed = documents.select(F.col(doc_id).alias("id"), key.alias("key"), whole_text(text).alias("body")).where("body <> ''")

    def hashes_only(batches):
        for batch in batches:
            for body in texts_of(batch.column("body")):
                found = runs(counted(body), least_units, least_words, False)[0]
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy())], names=["h"])

    def placed(batches):
        """Runs that hit the bitmap; start, end and whether the last line goes, in one number."""
        bits = marks.value
        for batch in batches:
            hashes, spans, n = [], [], []
            for body in texts_of(batch.column("body")):
                h, c = runs(units(body), least_units, least_words)
                hit = (bits[(h[:, 0] >> 6) & (len(bits) - 1)] >> (h[:, 0] & 63)) & 1 == 1
                h, c = h[hit], c[hit]
                last = (c[:, 1] == len(body)) & (separated and body[-1] != "\n")
                hashes.append(h)
                spans.append(c[:, 0] << 32 | c[:, 1] << 1 | last)
                n.append(len(h))
            at = pa.array(np.repeat(np.arange(len(n)), n))
            if len(at):
                h = np.concatenate(hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("key").take(at), *(pa.array(np.ascontiguousarray(x)) for x in (h[:, 0], h[:, 1], np.concatenate(spans)))],
                    names=["id", "key", "h", "h2", "span"],
                )

    repeated = keyed.select("body").mapInArrow(_gathered(hashes_only), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    words = repeated.select(
        F.shiftright("h", 6).bitwiseAND((1 << MARKS - 6) - 1).alias("at"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"),
    ).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(MARKS - 6) rows
    bitmap = np.zeros(1 << MARKS - 6, np.int64)
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    marks = documents.sparkSession.sparkContext.broadcast(bitmap)
    id_type = documents.schema[doc_id].dataType.simpleString()
    places = stored(keyed.mapInArrow(_gathered(placed), f"id {id_type}, key long, h long, h2 long, span long"))
    place = F.struct("id", "key", "span")
    first = places.groupBy("h", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    span = F.col("span")
    cut = places.join(first, ["h", "h2"]).where(place != F.col("first")).groupBy("id", "key").agg(
        F.collect_set(F.struct(F.shiftright(span, 32).alias("start"), F.shiftright(span, 1).bitwiseAND((1 << 31) - 1).alias("end"), (span % 2 == 1).alias("last"))).alias("cuts"),
        F.array_sort(F.collect_set("first.id")).alias("first_ids"),
    )  # one document's own cuts
    cut = settle(cut.mapInArrow(_merge, f"id {id_type}, key long, cuts array<struct<start:bigint,end:bigint>>, first_ids array<{id_type}>"))
    own_key, cut_id, cut_key, cuts, first_ids = (free_name(documents, f"__{c}") for c in ("key", "cut_id", "cut_key", "cuts", "first_ids"))
    cut = small_side(cut.select(F.col("id").alias(cut_id), F.col("key").alias(cut_key), F.col("cuts").alias(cuts), F.col("first_ids").alias(first_ids)))
    marked = documents.withColumn(own_key, key)
    joined = marked.join(cut, marked[doc_id].eqNullSafe(F.col(cut_id)) & (F.col(own_key) == F.col(cut_key)), "left")
    # the pieces between the cuts, as start and end
    pieces = F.zip_with(
        F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c.end)),
        F.concat(F.transform(cuts, lambda c: c.start), F.array(F.length(text).cast("long"))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    rest = F.array_join(F.transform(pieces, lambda p: F.col(text).substr((p.a + 1).cast("int"), (p.b - p.a).cast("int"))), "")
    return joined.select(
        *[F.when(F.col(cuts).isNull(), F.col(text)).otherwise(rest).alias(text) if c == text else F.col(f"`{c}`") for c in columns if c not in ("cuts", "first_ids")],
        F.col(cuts).alias("cuts"), F.col(first_ids).alias("first_ids"),
    )


def _gathered(rows, least: int = 50_000):
    """The same batches of numbers, joined to larger ones."""
    def run(batches):
        held, size = [], 0
        for batch in rows(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= least:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return run


def n_cut(c: str = "cuts"):
    """Code points cut out."""
    return F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.end - x.start), F.lit(0).cast("long"))


