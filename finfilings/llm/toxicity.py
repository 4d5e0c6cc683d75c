"""Toxicity by logistic regression, trained with FTRL-proximal on hashed word n-grams.

Features are the distinct words, pairs of neighbours and pairs with one word between of
a text, hashed to a fixed number of places.  FTRL-proximal gives each place its own
learning rate and sets places of little evidence to zero, so the weights are a short
list of bounded size, which is what gets broadcast.  Shards of the labelled rows are
trained side by side; their states are averaged after each pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finfilings.llm.common import Numbers, crc_of, held, released, settle, small_side, table, texts_of, whole_text
from finfilings.llm.registry import query

#: Places that features are hashed to; bounds the size of the weights.
PLACES = 1 << 18
#: Labelled rows to train on, about; beyond that a part of them is drawn by a hash of the id.
MAX_ROWS = 24_000
#: Shards are as many as have SHARD_ROWS rows each, SHARDS at most.
SHARDS, SHARD_ROWS = 6, 4_000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.6, 1.0, 4.0, 0.2

_FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(text: str) -> np.ndarray:
    """Sorted places of a text's words, neighbours and pairs with a gap of one."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(held("numbers", Numbers).__getitem__, words), np.uint64, len(words))
    parts = [h, h[:-1] * _PAIR + (h[1:] ^ _SKIP), h[:-2] * _SKIP + (h[2:] ^ _PAIR)]
    return np.unique(np.concatenate(parts) >> np.uint64(46)).astype(np.int64)


assert PLACES == 1 << (64 - 46)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The FTRL-proximal solution: zero where |z| is within the L1 bound."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train_pass(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, int]]) -> None:
    """One pass over ``(places, label)``; place PLACES is the bias.  Changes z and n."""
    for places, label in rows:
        at = np.append(places, PLACES)
        w = weights_of(z[at], n[at])
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        grown = n[at] + g * g
        z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
        n[at] = grown


def fit(labelled: DataFrame, text: str = "text", label: str = "label", order: str = "order") -> dict[int, float]:
    """Weights by place (PLACES: the bias) from rows ``text, label (0/1), order (long)``.

    Rows with a null label take no part.  Beyond ``MAX_ROWS`` rows, those with the
    smallest share of ``order``'s hash are taken, so the same rows at each run.  Without
    rows the only weight is the bias, 0.
    """
    usable = labelled.where(F.col(label).isin(0, 1))
    total = usable.count()
    if not total:
        return {PLACES: 0.0}
    shards = max(1, min(SHARDS, total // SHARD_ROWS))
    share = F.pmod(F.xxhash64(F.lit("drawn"), F.col(order)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = usable.where(share < min(1.0, MAX_ROWS / total)).select(
        whole_text(text).alias("text"), F.col(label).cast("long").alias("label"),
        F.xxhash64(F.lit("shard"), F.col(order)).alias("turn"),
    )

    def turn_to_places(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array([features(x).astype("<i4").tobytes() for x in texts_of(batch.column("text"))], pa.binary()),
                batch.column("label"), batch.column("turn"),
            ], names=["places", "label", "turn"])

    # at most MAX_ROWS rows, dealt evenly: each shard fits in a task
    rows = settle(drawn.mapInArrow(turn_to_places, "places binary, label long, turn long").withColumn("shard", F.pmod("turn", F.lit(shards))))
    context = rows.sparkSession.sparkContext
    z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    for _ in range(PASSES):
        sent = context.broadcast((np.flatnonzero(n), z[n > 0], n[n > 0]))

        def train(pdf: pd.DataFrame) -> pd.DataFrame:
            at, z_at, n_at = sent.value  # of this pass: the states are collected before the next
            z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
            z[at], n[at] = z_at, n_at
            pdf = pdf.sort_values("turn")
            train_pass(z, n, [(np.frombuffer(p, "<i4"), y) for p, y in zip(pdf["places"], pdf["label"])])
            at = np.flatnonzero(n)
            return pd.DataFrame({"at": [at.astype("<i4").tobytes()], "z": [z[at].tobytes()], "n": [n[at].tobytes()]})

        states = rows.groupBy("shard").applyInPandas(train, "at binary, z binary, n binary").collect()  # SHARDS rows
        z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
        for s in states:
            at = np.frombuffer(s["at"], "<i4")
            z[at] += np.frombuffer(s["z"]) / len(states)
            n[at] += np.frombuffer(s["n"]) / len(states)
    w = weights_of(z, n)
    w[PLACES] = -z[PLACES] / ((BETA + np.sqrt(n[PLACES])) / ALPHA + L2)
    return {int(k): float(w[k]) for k in {*np.flatnonzero(w).tolist(), PLACES}}


def score(documents: DataFrame, weights: dict[int, float], text: str = "text", name: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """``documents`` plus the probability ``name`` (0 to 1) that the text is toxic.

    Null and empty texts have no features and get the probability that the bias alone
    gives.  Whole texts are scored, repeated rows alike.  A column that is called ``name``
    already is replaced; ``keep`` names the columns to return, all by default.
    """
    keep = [c for c in (documents.columns if keep is None else keep) if c != name]
    sent = documents.sparkSession.sparkContext.broadcast(weights)  # at most PLACES + 1 entries

    def run(batches):
        w = np.zeros(PLACES + 1)
        w[list(sent.value)] = list(sent.value.values())
        for batch in batches:
            total = [w[features(x or "")].sum() + w[PLACES] for x in texts_of(batch.column(text))]
            p = 1.0 / (1.0 + np.exp(-np.clip(np.array(total, float), -35, 35)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(p)], names=[*keep, name])
        released()

    frame = documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    return frame.mapInArrow(run, T.StructType([frame.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())]))


def labelled_texts(documents: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """``text, label, order`` of the documents that ``learn`` (a condition on doc_id) admits.

    Where the labels repeat a document, toxic wins; a repeated document counts for each row.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = small_side(settle(known))
    return documents.select("doc_id", "text").where(learn).join(known, "doc_id").select("text", "label", F.col("doc_id").alias("order"))


def held_out() -> F.Column:
    """Rows whose id's crc32 is a multiple of 5; a null id is never learnt from."""
    return F.coalesce(crc_of(F.col("doc_id"), 5) == 0, F.lit(True))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, x) for x in ("documents", "labels"))
    weights = fit(labelled_texts(documents, labels, ~held_out()))
    scored = score(documents.select("doc_id", "text"), weights, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
