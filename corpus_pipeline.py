"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``docs``, whatever they are beside ``doc_id`` and ``text``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm import decontam, jaccard, linededup, packing, toxicity
from finfilings.llm.common import free_name, settle, small_side, table
from finfilings.session import checkpoint_dir

#: Probability from which a document is rejected as toxic.
TOXIC = 0.5
TOKENIZER = "word_bpe_49k.json"


def _shielded(docs: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of these names out of the way, and how they are called now."""
    away = {c: f"__own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(away), away


def _restored(docs: DataFrame, like: DataFrame, away: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(f"`{away.get(c, c)}`").alias(c) for c in like.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below ``TOXIC``.  Null and empty texts are judged by the bias."""
    labels = table(spark, sf_dir, "labels")
    weights = toxicity.fit(toxicity.labelled_texts(docs, labels, ~toxicity.held_out()))
    return toxicity.score(docs, weights, name="__toxicity").where(F.col("__toxicity") < TOXIC).drop("__toxicity")


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which nothing is left go.  ``n_chars``,
    where there is such a column, follows the text."""
    own, away = _shielded(docs, {"cuts", "first_ids"})
    done = linededup.dedup_lines(own).where("cuts is null or trim(text) <> ''")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return _restored(done, docs, away)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    Of rows that repeat both id and text one stays.  Documents without words all stay.
    """
    found = settle(jaccard.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80))
    # names that no column of the documents has
    own_key, own_id, text_key = (free_name(docs, c) for c in ("__key", "__id", "__text_key"))
    keyed = docs.withColumn(own_key, F.xxhash64("text"))

    def matching(side: DataFrame, how: str) -> DataFrame:
        side = small_side(settle(side.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(text_key)).distinct()))
        return keyed.join(side, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(own_key) == F.col(text_key)), how)

    repeated = settle(found.where("kept and n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1"))
    gone = found.where("not kept").select("doc_id", "text_key")
    if repeated.isEmpty():
        return matching(gone, "left_anti").drop(own_key)
    once = matching(repeated, "left_semi").dropDuplicates(["doc_id", own_key])
    return matching(gone.unionByName(repeated.select("doc_id", "text_key")), "left_anti").unionByName(once).drop(own_key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    own, away = _shielded(docs, {"n_words", "n_hit", "hit_spans", "hit_items"})
    found = decontam.find_benchmark(own, table(spark, sf_dir, "benchmark"))
    return _restored(found.where(~decontam.contaminated()), docs, away)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    return packing.pack(packing.pieces_of(docs, tokenizer))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Neither the trained scores nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two of them is a table in the shared
    checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
