"""Fitted operators: held-out accuracy, exact parts against brute force, and odd inputs."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readflow.llm import lang_id, quality, queries, toxicity

MODEL_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger(spark):
    return spark.read.parquet(f"{MODEL_SF}/documents.parquet"), spark.read.parquet(f"{MODEL_SF}/labels.parquet")


def test_language_query(spark, larger):
    lang = {r["doc_id"]: r["lang"] for r in larger[0].collect()}
    rows = queries.QUERIES["op1_language"](spark, MODEL_SF).collect()
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert [r["doc_id"] for r in rows if r["held_out"]] == [r["doc_id"] for r in held]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def brute_chances(scores, moves, start):
    """Sums over all label paths."""
    n, k = scores.shape
    weights = {p: math.exp(start[p[0]] + sum(scores[i][p[i]] for i in range(n)) + sum(moves[a][b] for a, b in itertools.pairwise(p))) for p in itertools.product(range(k), repeat=n)}
    total = sum(weights.values())
    single = np.array([[sum(w for p, w in weights.items() if p[i] == j) / total for j in range(k)] for i in range(n)])
    pairs = np.array([[sum(w * sum((p[i], p[i + 1]) == (a, b) for i in range(n - 1)) for p, w in weights.items()) / total for b in range(k)] for a in range(k)])
    return single, pairs, math.log(total)


def test_forward_backward():
    rnd = np.random.default_rng(3)
    lengths = np.array([3, 1, 5, 5, 2])
    scores, moves, start = rnd.normal(size=(16, 3)), rnd.normal(size=(3, 3)), rnd.normal(size=3)
    chances, pairs, total = lang_id.forward_backward(scores, lengths, moves, start)
    want = [brute_chances(s, moves, start) for s in np.split(scores, np.cumsum(lengths)[:-1])]
    assert np.allclose(chances, np.concatenate([w[0] for w in want]))
    assert np.allclose(pairs, sum(w[1] for w in want)) and np.isclose(total, sum(w[2] for w in want))


def test_code_switching(spark, larger):
    model = lang_id.fit(larger[0])
    texts = {r["lang"]: r["text"] for r in larger[0].filter("length(text) between 400 and 3000").orderBy("doc_id").collect()}
    halves = [lang_id.words_of(texts[k])[:40] for k in ("en", "de")]
    mixed = spark.createDataFrame([(" ".join(halves[0] + halves[1]),)], "t string")
    labels = mixed.select(lang_id.label_words(F.col("t"), model).alias("w"), lang_id.identify(F.col("t"), model).alias("i")).first()
    want = ["en"] * len(halves[0]) + ["de"] * len(halves[1])
    assert sum(a == b for a, b in zip(labels["w"], want)) >= 0.9 * len(want) and len(labels["w"]) == len(want)
    assert {m["lang"] for m in labels["i"]["mix"]} >= {"en", "de"}


def test_language_edges(edges, no_rows, larger):
    for model in (lang_id.fit(larger[0]), lang_id.fit(no_rows)):
        rows = edges.select("doc_id", "text", lang_id.identify(F.col("text"), model).alias("i"), lang_id.label_words(F.col("text"), model).alias("w")).collect()
        assert len(rows) == edges.count()
        for r in rows:
            letters = any(map(str.isalpha, r["text"] or ""))
            assert (r["i"]["lang"] in model.labels) if letters and model.labels else (r["i"]["lang"], r["i"]["score"], r["i"]["mix"]) == ("und", 0.0, [])
    assert lang_id.fit(edges).labels == ("de", "en", "fr")


def test_quality_query(spark, larger):
    label = {r["doc_id"]: r["quality"] for r in larger[1].collect()}
    rows = queries.QUERIES["op10_quality"](spark, MODEL_SF).collect()
    assert len(rows) == larger[0].count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert sum(r["predicted"] == label[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_tree_paths():
    dump = """Forest
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     If (feature 0 <= 0.75)
      Predict: 1.0
     Else (feature 0 > 0.75)
      Predict: 0.0
  Tree 1 (weight 1.0):
    Predict: 0.0
"""
    assert quality.tree_paths(dump, ["a", "b"]) == {
        (("a", "<=", 0.5),), (("a", "<=", 0.5), ("b", "<=", 2.0)), (("a", "<=", 0.5), ("b", ">", 2.0)),
        (("a", ">", 0.5),), (("a", "<=", 0.75), ("a", ">", 0.5)), (("a", ">", 0.75),)}


def test_quality_rules_are_fitted(spark):
    """Two kinds of text and labels for both: the forest has paths, and the rules made of them tell the kinds apart."""
    docs = spark.createDataFrame([(i, f"a plain line of {i} words" if i % 2 else "| $ | # " * (3 + i % 5)) for i in range(60)], "doc_id long, text string")
    model = quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")))
    rows = quality.classify(docs, model).collect()
    assert model.rules and all((r["quality_score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in rows)


def test_quality_edges(spark, edges, no_rows, larger):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 1), (4, 1, 0), (5, 0, 1), (8, 1, 0), (8, 0, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.filter("quality = 1"), labels.limit(0)):
        out = quality.classify(edges, quality.fit(edges, some))
        assert out.columns == [*edges.columns, "quality_score"] and out.filter("quality_score between 0 and 1").count() == edges.count()
    assert quality.classify(no_rows, quality.fit(no_rows, labels)).count() == 0
    with pytest.raises(ValueError):
        quality.classify(edges, quality.Rules(0.0, []), column="score")


def test_toxicity_query(spark, larger):
    label = {r["doc_id"]: r["toxic"] for r in larger[1].collect()}
    rows = queries.QUERIES["op8_toxicity"](spark, MODEL_SF).collect()
    assert len(rows) == larger[0].count() and all(0 <= r["severity"] <= 2 for r in rows)
    known = [r for r in rows if r["doc_id"] in label]
    assert all(label[r["doc_id"]] for r in known if r["toxic"])
    assert sum(r["toxic"] for r in known) >= 0.8 * sum(label.values())


def test_toxicity_held_out(larger):
    docs, labels = larger
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit(docs, labels.filter(half))
    rows = docs.join(labels.filter(~half), "doc_id").select("toxic", toxicity.severity(F.col("text"), model)["severity"].alias("s")).collect()
    bad = [r["s"] for r in rows if r["toxic"]]
    assert np.mean([r["s"] >= toxicity.REJECT for r in rows if not r["toxic"]]) <= 0.01 and np.mean(np.array(bad) >= toxicity.REJECT) >= 0.6


def test_ordinal_fit():
    rnd = np.random.default_rng(5)
    truth, cuts = np.array([2.5, -1.5, 0.0, 1.0]), np.array([0.5, 1.5, 3.0])
    index = [np.flatnonzero(rnd.random(4) < 0.5) for _ in range(6000)]
    z = np.array([truth[i].sum() for i in index]) + rnd.logistic(size=6000)
    w, found = toxicity.fit_ordinal(index, np.searchsorted(cuts, z), np.ones(6000), 4, 4)
    assert np.all(np.diff(found) > 0) and np.abs(w - truth).max() < 0.25 and np.abs(found - cuts).max() < 0.25


def test_toxicity_edges(spark, edges, no_rows):
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0), (5, 1), (6, 1), (8, 0), (8, None), (77, 1)], "doc_id long, toxic int")
    for some in (labels, labels.filter("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(edges, some)
        rows = edges.select(toxicity.severity(F.col("text"), model).alias("s")).collect()
        assert len(rows) == edges.count() and all(0 <= r["s"]["severity"] <= 2 for r in rows)
    assert no_rows.select(toxicity.severity(F.col("text"), model)).count() == 0
    assert all(r["s"]["severity"] == 0 for r in rows)


def test_model_features_are_those_of_training():
    words = {"alphabet", "alphabets", "alpine", "be"}
    every = toxicity.features_of(words)
    assert {"2^alph", "1^alpi", "2^alphabe", "be", "1^be"} <= every and "3^alph" not in every and "3^alp" not in every
    heads = {n: {"alph"} if n == 4 else set() for n in toxicity.HEADS}
    assert toxicity.features_of(words, heads) == words | {"1^alph", "2^alph"}


def test_language_of_texts_without_blanks(spark):
    rnd = np.random.default_rng(6)
    alphabets = {"ja": [chr(c) for c in range(0x3042, 0x3072)], "zh": [chr(c) for c in range(0x4E00, 0x4E40)]}

    def run(lang, n):
        return "".join(rnd.choice(alphabets[lang], n))

    model = lang_id.fit_texts([(k, lang_id.tokens_of(run(k, 200))) for k in alphabets for _ in range(20)], steps=20)
    text = run("zh", 90) + run("ja", 310)
    df = spark.createDataFrame([(text,), ("x" * 64 + " " + run("ja", 29),)], "t string")
    rows = df.select(lang_id.identify(F.col("t"), model).alias("i"), lang_id.label_words(F.col("t"), model).alias("w")).collect()
    assert rows[0]["i"]["lang"] == "ja" and {m["lang"] for m in rows[0]["i"]["mix"]} == {"ja", "zh"}
    assert rows[0]["w"][:3] == ["zh"] * 3 and rows[0]["w"][4:] == ["ja"] * 10 and len(rows[1]["w"]) == 4
    for body in (text, "a b", "y" * 30, "z" * 31):
        pieces = lang_id.tokens_of(body)
        assert "".join(pieces) == body.replace(" ", "") and max(map(len, pieces)) <= lang_id.LONGEST


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:02d}": [a + b + c for a in letters[i % 26] for b in letters[i // 26 * 8 : i // 26 * 8 + 8] for c in letters[:6]] for i in range(70)}
    rows = [(100 * i + j, " ".join(own[j::3]), k) for i, (k, own) in enumerate(words.items()) for j in range(4 if i < 64 else 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs)
    assert model.labels == tuple(words)
    found = docs.select("lang", lang_id.identify(F.col("text"), model)["lang"].alias("l")).filter("lang >= 'l64'").collect()
    assert len(found) == 18 and all(r["l"] == r["lang"] for r in found)
    assert lang_id.texts_each(64) == lang_id.SAMPLE and lang_id.texts_each(176) == 39 and lang_id.texts_each(10**6) == 1


def test_fit_in_parts(monkeypatch):
    rnd = np.random.default_rng(9)
    sample = [(k, ["".join(rnd.choice(list(a), 4)) for _ in range(60)]) for k, a in (("x", "abcde"), ("y", "cdefg")) for _ in range(8)]
    whole = lang_id.fit_texts(sample, steps=10)
    monkeypatch.setattr(lang_id, "CELLS", 300)
    parts = lang_id.fit_texts(sample, steps=10)
    assert np.allclose(whole.weights, parts.weights, atol=1e-4) and np.allclose(whole.moves, parts.moves, atol=1e-4) and whole.lexicon == parts.lexicon


def plain_features(word, lexicon):
    marked = f"^{word}$"
    names = [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3, 4)] + [marked[i : i + 3] for i in range(len(marked) - 2)]
    names += [f"w{word}", f"l{lexicon[word]}"] if word in lexicon else []
    names.append("d" if word.isdigit() else "n" if any(map(str.isdigit, word)) else "a" if word.isascii() else "u")
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % lang_id.BUCKETS for n in names]


def test_features_of_many_words():
    """All words at once give each word's features, in order, whatever its letters; no words give none."""
    words = ["a", "ab", "the", "über", "straße", "12", "x12", "１２", "漢字かな", "a😀b", "\ud800x", "zz", "l" * lang_id.LONGEST]
    lexicon = {"the": 5, "über": 2, "a": 15}
    for some in (words, words[::-1], words[3:4], []):
        flat, counts = lang_id.word_features(some, lexicon)
        assert [f.tolist() for f in np.split(flat, np.cumsum(counts))[:-1]] == [plain_features(w, lexicon) for w in some]


def test_chances_with_little_memory(monkeypatch, larger):
    """Words known before, new ones in several goes, and a memory that is dropped all give the same chances."""
    texts = [lang_id.tokens_of(r["text"] or "") for r in larger[0].orderBy("doc_id").limit(60).collect()]
    model = lang_id.fit_texts([(k, t) for k, t in zip("ab" * 30, texts) if t], steps=3)
    want = lang_id.Labeller(model).chances(texts)[0]
    monkeypatch.setattr(lang_id, "NEW_WORDS", 7)
    monkeypatch.setattr(lang_id, "MEMORY", 500)
    labeller = lang_id.Labeller(model)
    parts = [labeller.chances(texts[i : i + 10]) for i in range(0, 60, 10)]
    assert np.allclose(np.concatenate([p[0] for p in parts]), want, atol=1e-5) and sum(p[1].sum() for p in parts) == len(want)
