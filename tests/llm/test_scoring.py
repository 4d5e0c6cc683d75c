"""The language model: lists, tries, and scores next to a plain one."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finfilings.llm import eliasfano, scoring
from finfilings.llm.eliasfano import EliasFano, encode

DOCS = "doc_id long, text string, learn boolean"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 50), max_size=300), st.lists(st.integers(0, 1 << 51), max_size=50), st.integers(0, 40))
def test_lists_give_back_their_numbers_and_successors(numbers, asked, coarse):
    values = np.sort(np.array(numbers, np.int64)) >> coarse
    got = EliasFano(b"x" * 8 + encode(values), 8)
    assert (got[np.arange(len(values))] == values).all()
    asked = np.concatenate([np.array(asked, np.int64) >> coarse, values, values + 1])
    place, found = got.successor(asked)
    assert (place == np.searchsorted(values, asked)).all()
    assert found.tolist() == [x in set(values.tolist()) for x in asked.tolist()]


@pytest.mark.parametrize("part", [1, 7, 64, 1 << 14])
def test_successors_over_many_parts_of_a_list(monkeypatch, part):
    monkeypatch.setattr(eliasfano, "_PART", part)
    r = np.random.default_rng(part)
    for values in (np.sort(r.integers(0, 1 << 40, 500)), np.sort(r.integers(0, 60, 500)), np.repeat([3, 1 << 45], 40), np.arange(200)):
        got = EliasFano(encode(values))
        asked = r.permutation(np.concatenate([values, values - 1, values + 1, r.integers(0, 1 << 46, 50)]).clip(0))
        place, found = got.successor(asked)
        assert (place == np.searchsorted(values, asked)).all()
        assert (found == np.isin(asked, values)).all()


def test_a_list_is_searched_without_rounds_of_halving(monkeypatch):
    looks = []
    low = EliasFano._low
    monkeypatch.setattr(EliasFano, "_low", lambda self, i: looks.append(len(i)) or low(self, i))
    values = np.sort(np.random.default_rng(5).integers(0, 1 << 40, 4000)) // 1000 * 1000
    EliasFano(encode(values)).successor(np.tile(values, 10))
    assert sum(looks) < 2 * len(values)


def test_a_trie_is_built_in_little_memory():
    r = np.random.default_rng(8)
    n = 300_000
    counted = [(x ** 3 * 20_000).astype(np.int32) + 2 for x in r.random((3, n))] + [np.ones(n, np.int32)]
    tracemalloc.start()
    scoring.build(counted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * n


def plain(docs):
    """The same model over dictionaries, without rounding; rows are (id, text, learn)."""
    def tokens(text):
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x20\x09-\x0D]+", folded) + [None]

    c1, c2, c3 = Counter(), defaultdict(Counter), defaultdict(Counter)
    for _, text, learn in docs:
        if learn:
            run = ["<", "<"] + tokens(text)
            for a, b, w in zip(run, run[1:], run[2:]):
                c1[w] += 1
                c2[b][w] += 1
                c3[a, b][w] += 1
    n, v = sum(c1.values()), len(c1)
    p1 = lambda w: (c1[w] + 1) / (n + v + 1)

    def p(counts, context, w, rest):
        if context not in counts:
            return rest
        own = counts[context]
        return (max(own[w] - 0.75, 0) + 0.75 * len(own) * rest) / sum(own.values())

    out = []
    for name, text, _ in docs:
        run = ["<", "<"] + tokens(text)
        base = sum(math.log10(p1(w)) for w in run[2:])
        score = sum(math.log10(p(c3, (a, b), w, p(c2, b, w, p1(w)))) for a, b, w in zip(run, run[1:], run[2:]))
        out.append((name, len(run) - 2, sum(c1[w] > 0 for w in run[2:]), n, base, score))
    return out


def corpus(seed, n, words=60):
    r = random.Random(seed)
    names = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 4))) for _ in range(words)]
    text = lambda: " ".join(r.choice(names) if r.random() < 0.6 else "the of"[:3 + 3 * r.randint(0, 1)] for _ in range(r.randint(1, 60)))
    docs = [(k, text(), r.random() < 0.7) for k in range(n)]
    docs += [(n, None, True), (n + 1, "", False), (n + 1, "", False), (n + 2, " \t\n", True), (n + 3, "The of ÉÀ the", None), (None, docs[0][1], False),
             (n + 4, "unseen words only", False), (n + 5, "the of " * 3000, True), (n + 6, "lone", True), *docs[:3]]
    return docs


@pytest.mark.parametrize("options", [{}, {"block": 200, "shard": 300}, {"block": 150, "shard": 400, "often": 50}, {"block": 4000, "shard": 1000, "often": 200}])
def test_scores_are_those_of_a_plain_model(spark, monkeypatch, options):
    monkeypatch.setattr(scoring, "SLICE_BYTES", 300)
    docs = corpus(1, 120)
    frame = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("own")).withColumn("key", F.lit(1)).repartition(3)
    key = lambda r: (r[0] is not None, str(r[0]), r[1], r[4])
    got = sorted((tuple(r) for r in scoring.score_texts(frame, F.col("learn"), **options).collect()), key=key)
    want = sorted(plain(docs), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-6)
        # stored logarithms are rounded down, by three steps a token at most
        assert b[5] - 3 * b[1] / scoring.STEPS - 1e-6 <= a[5] <= b[5] + 1e-6


def test_probabilities_sum_to_one_at_most():
    r = np.random.default_rng(3)
    middle, before, word = r.integers(2, 9, 800), r.integers(1, 9, 800), r.integers(2, 40, 800) ** 2 % 37 + 2
    trie = scoring.Trie(scoring.mapped(scoring.build([middle, before, word, np.ones(800, np.int64)])))
    counts = np.bincount(word, minlength=60)
    p1 = (counts[2:] + 1) / (800 + (counts > 0).sum() + 1)
    outcomes = np.flatnonzero(counts)
    p1 = np.append((counts[outcomes] + 1) / (800 + len(outcomes) + 1), 1 / (800 + len(outcomes) + 1))
    names = np.append(outcomes, 0)
    for b in range(1, 12):
        for a in range(0, 12):
            p = trie.probability(np.full(len(names), b), np.full(len(names), a), names, p1)
            assert 0.995 < p.sum() <= 1 + 1e-9 and (p > 0).all()


def test_nothing_learnt_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", False), (2, None, None)], DOCS)
    assert [tuple(r) for r in scoring.score_texts(docs, F.col("learn")).orderBy("doc_id").collect()] == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert scoring.score_texts(docs.limit(0), F.col("learn")).collect() == []


def test_held_out_texts_are_likelier_under_the_model_than_word_by_word(spark):
    r = random.Random(9)
    names = [f"w{k}" for k in range(300)]
    following = {w: r.sample(names, 4) for w in names}

    def chain():
        w, out = r.choice(names), []
        for _ in range(r.randint(20, 80)):
            out.append(w)
            w = r.choice(following[w])
        return " ".join(out)

    docs = spark.createDataFrame([(k, chain(), k % 5 != 0) for k in range(400)], DOCS)
    rows = [x for x in scoring.score_texts(docs, F.col("learn")).collect() if x["doc_id"] % 5 == 0]
    assert sum(x["score"] for x in rows) > 0.5 * sum(x["base_score"] for x in rows)
    assert all(x["score"] > x["base_score"] for x in rows)
