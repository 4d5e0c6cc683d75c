"""Odd inputs: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from finfilings.llm import decontam, jaccard, language, linededup, packing, pii, sentences, topk, toxicity, urlfilter
from finfilings.llm.components import connected

DOCS = "doc_id long, text string"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


# personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def strict_spans(text):
    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    return [x[:1] + x[2:] for x in sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if ok(kind, m.group()))]


def test_strict_spans_are_those_of_the_plain_patterns(spark):
    r, alphabet = random.Random(1), "a1@.+- ()é9\n😀"
    texts = [None, "", "a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8 0255.01.2.3 256.1.1.1", "4111 1111 1111 1111", "+1 (743) 555-3824.", "9" * 30_000,
             "a" * 30_000 + "@b.c" * 3_000, "é😀 a@b.co", "+1" + " " * 20_000 + "2345678"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("spans", F.lit("own")).repartition(4)
    got = {x["doc_id"]: [(s["start"], pii.KINDS[s["kind"]], s["end"]) for s in x["spans"] if s["base"]] for x in pii.find_personal_data(docs).collect()}
    for k, t in enumerate(texts):
        assert got[k] == [(a, kind, b) for a, kind, b in strict_spans(t)], repr(t)[:200]


def test_personal_data_of_nothing(spark):
    assert pii.find_personal_data(spark.createDataFrame([], DOCS)).count() == 0
    assert pii.find_personal_data(spark.createDataFrame([(1, None), (1, "")], DOCS)).where("size(spans) = 0").count() == 2


def test_a_loose_number_is_added_where_the_votes_agree(spark):
    rows = [(k, f"call +1 ({200 + k % 700}) 555-{1000 + k}") for k in range(60)] + [(100, "call (201) 555-0199 now"), (101, "order 1234 567 8901")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(rows, DOCS)).collect()}
    assert [(s["start"], s["base"]) for s in got[100]] == [(5, False)]


# search

def test_top_k_is_exact(spark):
    r = np.random.RandomState(3)
    vectors = [(k, [float(x) for x in np.round(r.randn(6) * (1 + k % 3), 2)]) for k in range(700)]
    vectors += [(1000 + k, [0.5] * 6) for k in range(300)]  # ties
    vectors += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (None, [1.0] * 6), (2003, [1.0, 2.0]), (2004, [float("inf")] * 6), (2010, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("own")).repartition(5)
    got = [tuple(x) for x in topk.top_k(frame, frame.where("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect()]
    usable = {k: np.floor(np.array(v) * 1024).astype(object) for k, v in vectors if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(k for k in usable if k % 100 == 0):
        scores = sorted((-int(usable[q] @ v if len(v) else 0), k) for k, v in usable.items() if k != q and len(v) == len(usable[q]))[:10]
        want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(scores)]
    assert got == want


def test_top_k_over_waves_and_large_values(spark):
    r = np.random.RandomState(4)
    frame = spark.createDataFrame([(k, [float(x) for x in r.randn(4) * 1e12]) for k in range(60)], "vec_id long, embedding array<double>")
    before, topk.WAVE_NUMBERS = topk.WAVE_NUMBERS, 20
    try:
        got = topk.top_k(frame, frame.where("vec_id % 10 = 0"), 3)
        assert got.count() == 18 and got.where("score is null").count() == 0
    finally:
        topk.WAVE_NUMBERS = before
    assert topk.top_k(frame.limit(0), frame, 3).count() == 0


# packing

def test_packing_is_a_round_trip_without_gaps(spark):
    from tokenizers import Tokenizer

    texts = [None, "", prose(9_000, 1), "tab\tand no-break  Ünïcode \x1c sign", "it's \n\n<|endoftext|>, we'll"] + [prose(n, n) for n in range(20, 900, 30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.pieces_of(docs, tokenizer(), ids=True)
    packed = packing.pack(pieces.withColumn("offset", F.lit("own")))
    plain = Tokenizer.from_file(tokenizer())
    got = packed.collect()
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((x for x in got if x["doc_id"] == doc), key=lambda x: x["piece"])
        assert list(itertools.chain(*[x["ids"] for x in own]))[:len(ids)] == ids
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(x["length"] for x in got)
    assert len(by) <= -(-total // packing.CAPACITY) + 1
    assert packing.pack(pieces.limit(0)).count() == 0


def test_islands_beat_or_match_best_fit_decreasing():
    r = random.Random(2)
    lengths = [r.randint(900, 2400) for _ in range(120)]
    first = packing.best_fit(lengths, sorted(range(120), key=lambda i: -lengths[i]), 4096)
    best = packing.evolve(lengths, [], 4096, 1)[0]
    assert sorted(i for b in best for i in b) == list(range(120))
    assert all(sum(lengths[i] for i in b) <= 4096 for b in best) and len(best) <= len(first)


# benchmark passages

def brute_hits(text, items, window=13):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    words, hit, names = split(text), set(), set()
    for name, item in items:
        own = split(item)
        k = min(window, len(own))
        wins = {tuple(own[i:i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in wins:
                hit.update(range(i, i + k))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block", [4_000_000, 60])
def test_benchmark_words_are_those_of_all_windows(spark, block):
    r = random.Random(7)
    items = [(k, prose(r.choice([1, 2, 7, 12, 13, 14, 26, 40]), 900 + k % 9)) for k in range(24)] + [(50, None), (51, "?!"), (52, "a a a a a a a a a a a a a a a")]
    texts = [None, "", "...", "a " * 60, items[0][1].upper() + "!"]
    for k in range(60):
        body = prose(30, 5_000 + k).split()
        cut = items[r.randrange(24)][1].split()
        a = r.randrange(len(cut))
        texts.append(" ".join(body[:15] + cut[a:a + r.randint(1, 30)] + body[15:]).replace(" ", r.choice([" ", "-", "\n"])))
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("n_hit", F.lit("own"))
    found = decontam.find_benchmark(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    for x in found.collect():
        assert (x["n_words"], x["n_hit"], x["hit_items"]) == brute_hits(texts[x["doc_id"]], items)
        assert sum(len(decontam.words_of(texts[x["doc_id"]][s["start"]:s["end"]])) for s in x["hit_spans"]) == x["n_hit"]
    none = decontam.find_benchmark(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(texts)


# repeated lines and sentences

def test_lines_of_later_windows_go(spark):
    body = "one\ntwo\n\nthree\nfour"
    rows = [(2, f"x\n{body}\ny"), (1, body), (3, body), (4, "one\ntwo"), (5, None), (6, ""), (3, body), (None, "p\nq\nr"), (7, "s\np\nq\nr")]
    got = [tuple(x) for x in linededup.dedup_lines(spark.createDataFrame(rows, DOCS)).select("doc_id", "text").collect()]
    want = [(2, "x\ny"), (1, body), (3, ""), (4, "one\ntwo"), (5, None), (6, ""), (3, ""), (None, "p\nq\nr"), (7, "s")]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert linededup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_a_long_passage_goes_from_later_documents_wherever_it_starts(spark):
    passage = prose(70, 77)
    rows = [(k, f"{prose(40, k)}. {prose(5, k + 50)} {passage} {prose(6, k + 90)}. {prose(30, k + 200)}.") for k in range(8)] + [(20, None), (21, ""), (22, prose(300, 33_333))]
    frame = spark.createDataFrame(rows, DOCS).withColumn("cuts", F.lit("own")).repartition(3)
    got = {x["doc_id"]: x for x in sentences.dedup_sentences(frame).collect()}
    assert got[0]["text"] == rows[0][1] and got[20]["text"] is None and got[22]["text"] == rows[10][1]
    for k in range(1, 8):
        assert len(got[k]["text"]) < len(rows[k][1]) - len(passage) // 2 and list(got[k]["first_ids"]) == [0]
        assert prose(40, k) in got[k]["text"] and prose(30, k + 200) in got[k]["text"]


# URLs

def test_the_longest_rule_wins(spark):
    urls = [None, "", "no scheme", "http://A.example.COM/en/x?y#z", "https://www.example.com/en/", "http://example.com", "http://com/", "http://notexample.com/en/",
            "http://x.net/es/1", "http://x.net/de/", "http://a.b.c.net/fr/?q", "http:///en/", "http://h?x/en/", "http://x.com/a\nb", "http://u:p@example.com/en/1"]
    pages = spark.createDataFrame(list(enumerate(urls)) * 2, "page_id long, url string").withColumn("rule", F.lit("own"))
    got = {x["page_id"]: (x["host"], x["path"], x["rule"], x["verdict"]) for x in urlfilter.filter_urls(pages, urlfilter.rule_table(spark, urlfilter.RULES)).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[4][2:] == ("www.example.com/en/", "allow") and got[5] == ("example.com", "", None, "allow")
    assert got[6][2:] == ("com/", "allow") and got[7][2:] == ("com/", "allow") and got[8][2:] == ("net/es/", "block")
    assert got[9][2:] == (None, "allow") and got[10] == ("a.b.c.net", "/fr/", "net/fr/", "block") and got[11][0] == "" and got[12] == ("h", "", None, "allow")
    assert got[13][1] == "/a\nb" and got[14][:3] == ("u:p@example.com", "/en/1", "com/")
    empty = urlfilter.filter_urls(pages, spark.createDataFrame([], "verdict string, host string, path string"), default="block")
    assert {x["verdict"] for x in empty.collect()} == {"block"} and empty.count() == 2 * len(urls)


# near copies

def brute_components(rows, width, percent):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        k = min(width, len(words))
        return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()

    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), name) if x is not None), default=None)
    return sorted(((str(name), len(s), str(least[find(i)])) for i, ((name, _), s) in enumerate(zip(rows, sets))))


@pytest.mark.parametrize("width,percent,rare", [(3, 90, 64), (3, 90, 3), (5, 80, 3), (2, 50, 2)])
def test_components_are_those_of_all_pairs(spark, width, percent, rare):
    r, rows = random.Random(width * percent), []
    for g in range(14):
        base = prose(r.choice([3, 9, 12, 30, 60, 130, 260]), 40 + g).split()
        for _ in range(r.choice([1, 2, 8, 25])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                words[r.randrange(len(words))] = r.choice(VOCABULARY)
            rows.append((len(rows), " ".join(words).title() + r.choice(["", "\n"])))
    boiler = prose(25, 999)
    rows += [(1000 + k, f"{boiler} {prose(r.randint(0, 6), k)}") for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (None, "one"), (2003, "one")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("own")).repartition(3)
    got = jaccard.near_duplicates(frame, width, percent, rare=rare)
    assert sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in got.collect()) == brute_components(rows, width, percent)


def test_prefixes_of_similar_sets_share_a_key():
    r = np.random.RandomState(9)
    for trial in range(400):
        percent = int(r.choice([50, 80, 90]))
        n = int(r.randint(9, 400))
        base = r.choice(100_000, n, replace=False).astype(np.uint64)
        other = base[r.permutation(n)[:n - r.randint(0, max(1, n * (100 - percent) // 200))]]
        other = np.concatenate([other, 200_000 + r.choice(1_000, r.randint(0, max(1, n * (100 - percent) // 250)), replace=False).astype(np.uint64)])
        common = len(np.intersect1d(base, other))
        if 100 * common < percent * (len(base) + len(other) - common):
            continue
        code = lambda ids: np.where(ids >= 200_000, 1, 2 + ids % (1 if trial % 3 == 0 else 250)).astype(np.uint8) if trial % 2 else np.where(ids >= 200_000, 1, 200).astype(np.uint8)  # noqa: E731,B023

        def keys(ids):
            ids = ids[code(ids) > 1]  # the others occur nowhere else
            order = np.lexsort((ids, code(ids)))
            return ids[order], code(ids)[order]

        a, b = (jaccard.prefix_keys(len(s), *keys(s), percent) for s in (base, other))
        assert len(np.intersect1d(a, b)), (trial, percent, n)


def test_an_empty_table_has_no_components(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_connected_finds_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(300, 301), (301, 300), (5, 5), (None, 3)]
    got = {x["node"]: x["root"] for x in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 300: 300, 301: 300}


# classifiers

def test_toxicity_learns_words_and_scores_anything(spark):
    r = random.Random(3)
    bad = [f"{prose(30, k)} {r.choice(['scum', 'idiot'])} {prose(20, k + 7)}" if k % 4 == 0 else prose(50, k) for k in range(900)]
    rows = spark.createDataFrame([(t, int(k % 4 == 0), k) for k, t in enumerate(bad)] + [(None, 1, 1), ("x", None, 2)], "text string, label int, order long")
    weights = toxicity.fit(rows)
    assert len(weights) < 5_000
    docs = spark.createDataFrame([(1, "what an IDIOT, really"), (2, prose(400, 4)), (3, None), (4, ""), (5, "scum " * 20_000)], DOCS).withColumn("score", F.lit("own"))
    got = {x["doc_id"]: x["score"] for x in toxicity.score(docs, weights).collect()}
    assert got[1] > 0.5 and got[5] > 0.5 and got[2] < 0.5 and got[3] == got[4] < 0.5
    assert toxicity.score(docs.limit(0), weights).count() == 0
    assert toxicity.fit(rows.limit(0)) == {toxicity.PLACES: 0.0}


def test_language_mixtures(spark):
    words = {"xx": "abab cdcd baba dcdc acac bdbd".split(), "yy": "mnop ponm nmnm opop mopn nopm".split()}
    r = random.Random(8)
    say = lambda name, n: " ".join(r.choice(words[name]) for _ in range(n))
    rows = [(say(name, 60), name) for name in words for _ in range(20)] + [(None, "xx"), ("abc", None), ("", "xx")]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model[0] == ["xx", "yy"]
    docs = spark.createDataFrame([(1, say("xx", 40)), (2, f"{say('yy', 60)} {say('xx', 30)}"), (3, None), (4, ""), (5, "12 34 %"), (6, say("yy", 20_000))], DOCS)
    got = {x["doc_id"]: x for x in language.predict(docs.withColumn("score", F.lit("own")), model).collect()}
    assert got[1]["lang_pred"] == "xx" and got[1]["score"] == 1.0
    assert got[2]["lang_pred"] == "yy" and set(got[2]["proportions"]) == {"xx", "yy"} and 0.5 < got[2]["score"] < 0.9
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5)) and got[6]["lang_pred"] == "yy"
    assert language.predict(docs, language.fit(spark.createDataFrame([], "text string, lang string"))).where("lang_pred <> 'und'").count() == 0


def test_digests_do_not_depend_on_the_order_of_words_met():
    one = jaccard.digest(jaccard.shingles("A b c d", 3))
    assert one == jaccard.digest(jaccard.shingles("a B c\td", 3)) and len(one) == 16
    assert hashlib.blake2b(b"", digest_size=16).digest() == jaccard.digest(np.empty(0, np.uint64))
