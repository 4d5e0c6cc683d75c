"""The queries next to their SQL, held-out figures, sentence runs against all runs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, duck
from finfilings.llm import pii, sentences
from finfilings.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = SF.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_languages_of_held_out_texts(spark):
    known = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op10_language_id"](spark, LARGER).join(known, "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_toxic_held_out_texts_score_above_clean_ones(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = QUERIES["op9_toxicity"](spark, LARGER).join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    good, bad = ([r["score"] for r in rows if r["toxic"] == k] for k in (0, 1))
    assert sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good)) > 0.75
    assert sum(x >= 0.5 for x in good) <= 0.03 * len(good)


def test_whole_model_of_the_corpus(spark):
    rows = QUERIES["op13_lm_scoring"](spark, SF).collect()
    assert len(rows) == 200 and len({r["train_tokens"] for r in rows}) == 1
    assert sum(r["score"] for r in rows if not r["held_out"]) > sum(r["base_score"] for r in rows if not r["held_out"])


def cut_plainly(docs):
    """Texts without what any but the first of equal runs covers; all runs of all texts are compared."""
    first, cuts = {}, {}
    for name, text in sorted({(n, t) for n, t in docs if t}, key=lambda d: (d[0] is not None, d[0])):
        units = sentences.sentences(text)
        for i in range(len(units)):
            end = i + sentences.SENTENCES
            while end <= len(units) and sum(u[1] for u in units[i:end]) < sentences.WORDS:
                end += 1
            if end > len(units):
                break
            run = tuple(u[0] for u in units[i:end])
            if run in first:
                cuts.setdefault((name, text), []).append((units[i][2], units[end - 1][3]))
            else:
                first[run] = name
    out = []
    for name, text in docs:
        gone = {k for a, b in cuts.get((name, text), ()) for k in range(a, b)}
        out.append((name, text if not gone else "".join(c for k, c in enumerate(text) if k not in gone)))
    return out


def test_sentence_runs_are_cut_as_if_all_were_compared(spark):
    r = random.Random(12)
    words = [f"w{k}" for k in range(40)]
    sentence = lambda: " ".join(r.choice(words) for _ in range(r.randint(2, 14))).capitalize() + r.choice([". ", "! ", "?\n", "\n"])
    shared = ["".join(sentence() for _ in range(r.randint(3, 8))) for _ in range(4)]
    docs = [(k, "".join(r.choice(shared) if r.random() < 0.3 else sentence() for _ in range(r.randint(1, 9)))) for k in range(60)]
    docs += [(100, shared[0]), (101, shared[0].upper()), (102, shared[0] + shared[0]), (103, None), (104, ""), (None, shared[1]), docs[3], (105, "Long. " * 3000 + shared[2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cuts", F.lit("own")).repartition(3)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] or "")
    got = sorted(((x["doc_id"], x["text"]) for x in sentences.dedup_sentences(frame).collect()), key=key)
    assert got == sorted(cut_plainly(docs), key=key)
    assert sentences.dedup_sentences(frame.limit(0)).count() == 0


def test_a_text_of_very_many_addresses_ends(spark):
    text = " ".join(f"user{k}@mail{k % 7}.example.org" for k in range(32_000))
    found = pii.found(F.col("text"), pii.STRICT[pii.EMAIL], pii.NEEDS["s", pii.EMAIL])
    spans = spark.createDataFrame([(text,)], "text string").select(found.alias("s")).first()["s"]
    assert len(spans) == 32_000 and all(text[s["start"]:s["end"]] == s["value"] for s in spans[::997]) and spans[-1]["end"] == len(text)
