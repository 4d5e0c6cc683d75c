"""Every stage of the corpus pipeline on odd rows, and the whole of it."""

import random

import pytest

import corpus_pipeline as pipeline

ODD = "doc_id long, text string, n_chars long, cuts string, first_ids int, n_hit int, hit_spans int, text_key int, score double, __id int, __key int"
rng = random.Random(21)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


PASSAGE = prose(60, 9001)
LINES = "\n".join(prose(8, 100 + k) for k in range(4))


def odd_rows():
    texts = [(k, prose(40 + k, k)) for k in range(30)]
    texts += [(k, f"{prose(20, k)} scum {prose(20, k + 1)}") for k in range(200, 206)]
    texts += [(50, prose(80, 500)), (51, prose(80, 500)), (52, prose(80, 500) + " tail"), (53, f"{LINES}\n{prose(9, 3)}"), (54, f"{prose(9, 4)}\n{LINES}")]
    texts += [(60, f"{prose(5, 5)} {PASSAGE} {prose(5, 6)}"), (70, None), (71, ""), (72, " \n"), (None, prose(30, 77)), (None, None), (50, prose(80, 500)), (80, prose(9_000, 8))]
    return [(name, text, None if text is None else len(text), "own", 1, 2, 3, 4, 0.5, 6, 7) for name, text in texts]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(4)
    marked = [(5000 + k, f"{prose(30, 5000 + k)} {r.choice(['scum', 'idiot'])} {prose(9, k)}" if k % 4 == 0 else prose(40, 5000 + k), int(k % 4 == 0)) for k in range(1200)]
    extra = [(name, text, len(text), "own", 1, 2, 3, 4, 0.5, 6, 7) for name, text, _ in marked]
    spark.createDataFrame(odd_rows() + extra, ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(name, 1, toxic) for name, _, toxic in marked], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("b1", PASSAGE), ("b2", None), ("b3", "few words")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def kept(df):
    return sorted((str(r["doc_id"]), r["text"]) if r["text"] is not None else (str(r["doc_id"]), "") for r in df.collect())


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_and_defined_rows(spark, tables, k):
    docs = spark.createDataFrame(odd_rows(), ODD).repartition(3)
    if k == 0:  # learns from labels of documents it is given
        docs = spark.read.parquet(f"{tables}/documents.parquet")
    name, stage = pipeline.STAGES[k]
    out = stage(spark, docs, tables)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    assert all(r["cuts"] == "own" and r["first_ids"] == 1 and r["n_hit"] == 2 and r["text_key"] == 4 and r["score"] == 0.5 and r["__id"] == 6 and r["__key"] == 7 for r in rows)
    assert {0, 80, 70, 71} <= set(ids) and None in ids
    if name == "toxicity":
        assert not any(200 <= (i or 0) < 206 for i in ids) and len([i for i in ids if i is not None and i < 200]) == 41
    if name == "line_dedup":
        texts = {r["doc_id"]: r["text"] for r in rows}
        assert texts[53].startswith(LINES) and texts[54] == prose(9, 4) and all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    if name == "ngram_jaccard_join":
        assert ids.count(50) == 1 and 51 not in ids and 52 not in ids and len(rows) == len(odd_rows()) - 3
    if name == "benchmark_decontamination":
        assert 60 not in ids and len(rows) == len(odd_rows()) - 1
    assert stage(spark, docs.limit(0), tables).count() == 0


def test_the_whole_pipeline_packs_what_its_stages_keep(spark, tables):
    found = pipeline.run(spark, tables).collect()
    ids = {r["doc_id"] for r in found}
    assert {0, 50, 70, 71, 80, None} <= ids and not ids & {51, 52, 60, *range(200, 206)}
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert pipeline.pack_sequences(spark, spark.createDataFrame([], "doc_id long, text string"), tables).count() == 0
