"""Language of a text as a mixture: how much of each language, and which at all.

Each language has a distribution over hashed character trigrams, counted over all
documents it may learn from.  A document's trigrams are taken as drawn from a mixture of
languages; expectation-maximisation estimates the proportions.  The set of languages is
grown one at a time while the gain in log-likelihood exceeds the penalty for another
proportion.  The language with the largest proportion is the prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finfilings.llm.common import crc_of, table
from finfilings.llm.registry import query

#: Places that trigrams are hashed to, as a power of two.
BITS = 15
#: Languages that a model may hold; with BITS it bounds what is broadcast (64 MB).
MAX_LANGUAGES = 256
#: Log-likelihood that one more language must bring: so much, and so much per log of the text's length.
PENALTY, PENALTY_LOG = 4.0, 2.0
STEPS = 12
UNDETERMINED = "und"

_A, _B, _C = np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917)
_SPACE = np.uint32(32)


def trigrams(text: str) -> np.ndarray:
    """Places of the character trigrams of the lower-cased text; characters other than
    letters count as blanks, and a trigram with a blank in its middle is left out."""
    if not text:
        return np.empty(0, np.int64)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.where((c < 97) | ((c > 122) & (c < 170)), _SPACE, c)
    middle = c[1:-1] != _SPACE
    mixed = (c[:-2] * _A + c[1:-1] * _B + c[2:] * _C)[middle]
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * _A) >> np.uint32(32 - BITS)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit(texts: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log-probabilities ``[language, place]``, from all rows.

    Rows with a null text or language take no part.  Each task sends one array of counts
    per language, so a language with most of the rows is summed like any other.
    """
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for body, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name not in total:
                    if len(total) >= MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    total[name] = np.zeros(1 << BITS, np.int64)
                total[name] += np.bincount(trigrams(body), minlength=1 << BITS)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at]),
            ], names=["lang", "place", "n"])

    rows = texts.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))
    counted = rows.mapInArrow(count, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # at most one row per language and place: bounded whatever the corpus
    packed = counted.groupBy("lang").agg(F.collect_list(F.struct("place", "n")).alias("cells")).select(
        "lang", F.transform("cells", lambda x: x.place).alias("places"), F.transform("cells", lambda x: x.n).alias("counts"),
    ).limit(MAX_LANGUAGES + 1).toArrow()
    if packed.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    order = np.argsort(np.array(packed.column("lang").to_pylist(), dtype=object)) if packed.num_rows else []
    names, logs = [], []
    for k in order:
        counts = np.full(1 << BITS, 0.5)
        counts[np.array(packed.column("places")[int(k)].as_py(), np.int64)] += np.array(packed.column("counts")[int(k)].as_py(), float)
        names.append(packed.column("lang")[int(k)].as_py())
        logs.append(np.log(counts / counts.sum()))
    return names, np.array(logs, np.float32).reshape(len(names), 1 << BITS)


def _mix(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """EM for the proportions of the rows of ``p`` [language, gram]; also the log-likelihood,
    relative to a constant that all sets share."""
    share = np.full(len(p), 1 / len(p))
    for _ in range(STEPS):
        joint = share[:, None] * p
        share = (joint / joint.sum(0)) @ n
        share /= share.sum()
    return share, float(np.log(share @ p) @ n)


def mixture(places: np.ndarray, logs: np.ndarray) -> dict[int, float]:
    """Proportions by language, of the set that penalised likelihood selects."""
    at, n = np.unique(places, return_counts=True)
    # a language model sees the same gram again and again: counts beyond the first weigh less
    n = np.sqrt(n)
    own = logs[:, at].astype(float)
    top = own.max(0)
    p = np.exp(own - top)
    single = (own - top) @ n
    best = int(np.argmax(single))
    chosen, shares, reached = [best], np.ones(1), float(single[best])
    penalty = PENALTY + PENALTY_LOG * np.log1p(len(places))
    while len(chosen) < len(logs):
        options = []
        for k in range(len(logs)):
            if k not in chosen:
                got, value = _mix(p[[*chosen, k]], n)
                options.append((value, -k, got))
        value, k, got = max(options, key=lambda x: x[:2])
        if value - reached <= penalty:
            break
        chosen, shares, reached = [*chosen, -k], got, value
    return dict(zip(chosen, shares.tolist()))


def predict(documents: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``documents`` plus ``lang_pred, score, proportions``.

    ``proportions`` maps the selected languages to their shares; ``lang_pred`` has the
    largest (ties: the first by name) and ``score`` is its share.  A text that is null,
    empty or without a letter, and any text under a model without languages, is ``und``
    with score 0 and no proportions.  Whole texts count; repeated rows are judged alike.
    Columns with one of the three names are replaced; ``keep`` names those to return.
    """
    added = ["lang_pred", "score", "proportions"]
    keep = [c for c in (documents.columns if keep is None else keep) if c not in added]
    sent = documents.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES x 2**BITS numbers

    def run(batches):
        names, logs = sent.value
        for batch in batches:
            found, scores, shares = [], [], []
            for body in batch.column(text).to_pylist():
                mix = mixture(trigrams(body), logs) if names and has_letter(body) else {}
                best = max(mix, key=lambda k: (mix[k], -k), default=None)
                found.append(UNDETERMINED if best is None else names[best])
                scores.append(0.0 if best is None else min(1.0, mix[best]))
                shares.append([(names[k], v) for k, v in sorted(mix.items())])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=[*keep, *added],
            )

    frame = documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    fields = [frame.schema[c] for c in keep] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("proportions", T.MapType(T.StringType(), T.DoubleType())),
    ]
    return frame.mapInArrow(run, T.StructType(fields))


def held_out() -> F.Column:
    """Rows whose id's crc32 is 2 modulo 4; a null id is never learnt from."""
    return F.coalesce(crc_of(F.col("doc_id"), 4) == 2, F.lit(True))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(~held_out()))
    found = predict(documents.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
