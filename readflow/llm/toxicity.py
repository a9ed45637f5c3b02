"""Toxicity: cumulative-link ordinal regression on sparse word features, giving an expected severity."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from readflow.llm.texts import bounded_sample, words_of
from readflow.session import materialize

SAMPLE = 5_000  # labelled rows of each label that are fitted on, at most
FEATURES = 1_000  # words with a weight, at most
MIN_DOCS = 4  # documents of the sample that hold a word
GRADES = 3  # 0: not toxic, 1 … GRADES - 1: toxic, by rising evidence
EVIDENCE = 1.6  # log-likelihood ratio a word needs, times the log of their number: of m words without a bearing some m^0.2 get there
RIDGE = 0.01
HEADS = (4, 5, 6, 7)  # lengths of the word beginnings that are features beside whole words
LEAST = (1, 2, 3)  # distinct words that share a beginning
STEPS = 400
REJECT = 0.5  # expected severity from which a document is rejected


class Model(NamedTuple):
    weights: dict[str, float]
    cuts: tuple[float, ...]  # ordered; P(grade <= k) = logistic(cuts[k] - weights of the words present)


def features_of(words: set[str], heads: dict[int, set[str]] | None = None) -> set[str]:
    """Distinct words, and beginnings of words by how many of the words have them.

    A beginning that several words share says more than one word, which catches inflected and
    compounded forms. With ``heads`` only those beginnings (by length) are looked for.
    """
    out = set(words)
    for n in HEADS:
        own = (w[:n] for w in words) if heads is None else (w[:n] for w in words if w[:n] in heads[n])
        for head, count in Counter(own).items():
            out.update(f"{least}^{head}" for least in LEAST if count >= least)
    return out


def feature_array(text: Column) -> Column:
    """``features_of`` per text; null gives none."""

    @F.arrow_udf("array<string>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted(features_of(set(words_of(t.as_py() or "")))) for t in batch], pa.list_(pa.string()))

    return features(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(text, y, scale) of at most ``rows`` rows per label; ``scale`` restores the labels' true shares.

    The keys are chosen from the label table; they are few by construction, so they are broadcast.
    """
    known = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("y")).filter("_id is not null and y is not null")
    chosen = bounded_sample(known, "y", rows, label, "_id")
    shares = known.groupBy("y").agg(F.count(F.lit(1)).alias("_all")).join(
        F.broadcast(chosen.groupBy("y").agg(F.count(F.lit(1)).alias("_some"))), "y").select("y", (F.col("_all") / F.col("_some")).alias("scale"))
    chosen = chosen.join(F.broadcast(shares), "y")
    return docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id").select("_id", "text", "y", "scale")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE,
        features: int = FEATURES, grades: int = GRADES) -> Model:
    """Fit on at most ``rows`` labelled documents of each label.

    Words and beginnings of words whose presence goes with the label beyond chance become features. If ``label`` has two
    values, the rows of 1 are graded by the summed log odds of their words, in equal parts, so that
    more and clearer words mean more severe; a label that is graded already is taken as it is. All
    thresholds share one weight per word. Without rows of both kinds nothing is learned: every text
    then has severity 0.
    """
    sample = labelled_sample(docs, labels, key, text, label, rows)
    sample = sample.select("_id", "y", "scale", feature_array(F.col("text")).alias("w"))
    sample = materialize(sample, "toxicity-sample")
    by_label = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = by_label.get(0, 0), sum(n for y, n in by_label.items() if y > 0)
    if not good or not bad:
        return Model({}, (math.inf,) * (grades - 1))
    held = sample.select((F.col("y") > 0).cast("int").alias("bad"), F.explode("w").alias("word"))
    counts = held.groupBy("word").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")).filter(F.col("b") + F.col("g") >= MIN_DOCS)
    counts = materialize(counts, "toxicity-words")
    least = EVIDENCE * math.log(max(counts.count(), 2))
    share = (F.col("b") + F.col("g")) / float(good + bad)

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    evidence = 2 * (part(F.col("b"), share * bad) + part(F.col("g"), share * good)
                    + part(bad - F.col("b"), (1 - share) * bad) + part(good - F.col("g"), (1 - share) * good))
    odds = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("g") + 0.5) / (good + 1))
    chosen = counts.select("word", odds.alias("odds"), evidence.alias("evidence")).filter(F.col("evidence") >= least)
    chosen = chosen.orderBy(F.desc("evidence"), "word").limit(features).collect()
    words = {r["word"]: i for i, r in enumerate(chosen)}
    rows_held = sample.select("y", "scale", F.array_intersect("w", F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")).alias("w"))
    collected = rows_held.collect()  # at most ``rows`` per label, each with at most ``features`` words
    index = [np.array(sorted(words[w] for w in r["w"]), np.int64) for r in collected]
    y = np.array([r["y"] for r in collected])
    if set(by_label) <= {0, 1}:
        odds = np.array([r["odds"] for r in chosen])
        score = np.array([odds[i].sum() for i in index])
        edges = np.quantile(score[y > 0], np.arange(1, grades - 1) / (grades - 1))
        y = np.where(y > 0, 1 + np.searchsorted(edges, score, "left"), 0)
    else:
        grades = max(grades, int(y.max()) + 1)
    weights, cuts = fit_ordinal(index, y, np.array([r["scale"] for r in collected]), len(words), grades)
    return Model(dict(zip(words, weights.tolist())), tuple(cuts.tolist()))


def fit_ordinal(index: list[np.ndarray], y: np.ndarray, scale: np.ndarray, width: int, grades: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts that maximise the penalised likelihood of grades ``y``; ``index`` lists the features of each row.

    The first cut is free and each next one lies above it by an exponential, so they stay in order.
    """
    owner = np.repeat(np.arange(len(index)), [len(i) for i in index])
    feature = np.concatenate(index) if len(index) else np.empty(0, np.int64)
    w, steps_up = np.zeros(width), np.zeros(grades - 1)
    share = np.cumsum(np.bincount(y, scale, grades))[:-1] / scale.sum()
    base = np.log((share + 1e-6) / (1 - share + 1e-6))
    steps_up[0] = base[0]
    steps_up[1:] = np.log(np.maximum(np.diff(base), 1e-2))
    scale = scale / scale.mean()
    momentum = [np.zeros_like(w), np.zeros_like(steps_up)]
    speed = [np.zeros_like(w), np.zeros_like(steps_up)]
    for step in range(1, steps + 1):
        rises = np.exp(steps_up[1:])
        cuts = steps_up[0] + np.concatenate(([0.0], np.cumsum(rises)))
        z = np.bincount(owner, w[feature], len(index))
        below = _logistic(np.concatenate((cuts, [np.inf]))[y] - z)
        above = _logistic(np.concatenate(([-np.inf], cuts))[y] - z)
        p = np.maximum(below - above, 1e-12)
        d_below, d_above = below * (1 - below) / p * scale, above * (1 - above) / p * scale
        dz = d_above - d_below
        dw = np.bincount(feature, dz[owner], width) - RIDGE * w
        d_cuts = np.bincount(y, d_below, grades)[:-1] - np.bincount(y, d_above, grades)[1:]
        d_up = np.concatenate(([d_cuts.sum()], np.cumsum(d_cuts[::-1])[::-1][1:] * rises))
        for k, (x, g) in enumerate(((w, dw), (steps_up, d_up))):
            momentum[k] = 0.9 * momentum[k] + 0.1 * g
            speed[k] = 0.99 * speed[k] + 0.01 * g * g
            x += 0.1 * (momentum[k] / (1 - 0.9**step)) / (np.sqrt(speed[k] / (1 - 0.99**step)) + 1e-9)
    return w, steps_up[0] + np.concatenate(([0.0], np.cumsum(np.exp(steps_up[1:]))))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def severity(text: Column, model: Model) -> Column:
    """Struct (severity, p_toxic, grade) per text: expected grade, chance of a grade above 0, likeliest grade.

    Each word counts once however often it stands, so a long text is not milder for its length.
    Null and empty texts hold no words and get what the thresholds alone say.
    """

    @F.arrow_udf(DataType.fromDDL("struct<severity:double,p_toxic:double,grade:int>"))
    def rated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, cuts = model.weights, np.array(model.cuts)
        known = weights.keys()
        heads = {n: {f.partition("^")[2] for f in known if "^" in f and len(f) == n + 2} for n in HEADS}
        for batch in batches:
            sums = [sum(map(weights.__getitem__, sorted(known & features_of(set(words_of(t.as_py() or "")), heads)))) for t in batch]
            above = 1 - _logistic(cuts[None, :] - np.array(sums, float).reshape(-1, 1))
            grades = np.diff(np.concatenate((np.ones((len(sums), 1)), above, np.zeros((len(sums), 1))), 1), axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(above.sum(1)), pa.array(above[:, 0].copy()), pa.array(np.argmax(-grades, 1).astype(np.int32))], ["severity", "p_toxic", "grade"])

    return rated(text)
