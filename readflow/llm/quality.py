"""Quality classifier: rules from tree paths over text statistics, lasso weights, one Spark column."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from readflow.llm.texts import bounded_sample
from readflow.session import materialize

SAMPLE = 4_000  # labelled rows of each label that are fitted on, at most
TREES, DEPTH = 16, 3
LASSO = 0.002
SEED = 7

Condition = tuple[str, str, float]  # statistic, "<=" or ">", bound


class Rules(NamedTuple):
    intercept: float
    rules: list[tuple[float, tuple[Condition, ...]]]


def _count(t: Column, sign: str) -> Column:
    return F.char_length(t) - F.char_length(F.replace(t, F.lit(sign), F.lit("")))


#: What the names of the columns of statistics begin with.
PREFIX = "_q_"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text that do not grow with its length; an empty or null text has 0 in all but ``chars``.

    ``chars`` is the logarithm of the length.
    """
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.char_length(t), F.lit(1)).cast("double")
    words = F.array_remove(F.split(t, r"\s+"), "")
    lines = F.split(t, "\n")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    return {
        "chars": F.log1p(F.char_length(t).cast("double")),
        "word_chars": n / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_words": F.log1p(n_words / F.size(lines)),
        "pipes": _count(t, "|") / n_words,
        "marks": sum((_count(t, c) for c in "#$%&*"), F.lit(0)) / n_words,
        "stops": (_count(t, ".") + _count(t, ",")) / n_words,
        "digits": F.regexp_count(t, F.lit("[0-9]")) / n,
        "beyond_ascii": (F.octet_length(t) - F.char_length(t)) / n,
    }


def with_statistics(df: DataFrame, text: str = "text", prefix: str = PREFIX) -> DataFrame:
    return df.withColumns({prefix + name: c.cast("double") for name, c in statistics(F.col(text)).items()})


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(y, scale, statistics) of at most ``rows`` labelled rows of each label; the chosen keys are few and broadcast."""
    known = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("y")).filter("_id is not null and y in (0, 1)")
    chosen = bounded_sample(known, "y", rows, label, "_id")
    shares = known.groupBy("y").agg(F.count(F.lit(1)).alias("_all")).join(
        F.broadcast(chosen.groupBy("y").agg(F.count(F.lit(1)).alias("_some"))), "y").select("y", (F.col("_all") / F.col("_some")).alias("scale"))
    few = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen.join(F.broadcast(shares), "y")), "_id")
    return with_statistics(few).drop("text")


def tree_paths(dump: str, names: list[str]) -> set[tuple[Condition, ...]]:
    """Every root-to-node path of a printed forest, as conditions; bounds of one statistic on a path are merged."""
    paths, held = set(), []
    for line in dump.splitlines():
        if m := re.fullmatch(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            held = [h for h in held if h[0] < len(m[1])] + [(len(m[1]), (names[int(m[3])], m[4], float(m[5])))]
            bounds: dict[tuple[str, str], float] = {}
            for _, (name, sign, bound) in held:
                old = bounds.get((name, sign))
                bounds[name, sign] = bound if old is None else (min if sign == "<=" else max)(old, bound)
            paths.add(tuple(sorted((name, sign, bound) for (name, sign), bound in bounds.items())))
        elif line.strip().startswith("Tree "):
            held = []
    return paths


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE) -> Rules:
    """Fit on at most ``rows`` labelled documents of each label (1: good, 0: not).

    A small random forest proposes conjunctions; all of its paths become 0/1 features, and a lasso
    logistic regression keeps few of them. Rows are weighted by the true shares of the labels.
    With one label only, the intercept alone tells it; with none, the chance is one half.
    """
    sample = materialize(labelled_sample(docs, labels, key, text, label, rows), "quality-sample")
    seen = {r["y"] for r in sample.select("y").distinct().collect()}
    if seen != {0, 1}:
        return Rules({(): 0.0, (0,): -10.0, (1,): 10.0}[tuple(seen)], [])
    names = [c for c in sample.columns if c.startswith(PREFIX)]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="y", weightCol="scale", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(vectors)
    paths = sorted(tree_paths(forest.toDebugString, names))
    if not paths:
        share = sample.agg((F.sum(F.col("y") * F.col("scale")) / F.sum("scale")).alias("p")).select(F.log(F.col("p") / (1 - F.col("p")))).first()[0]
        return Rules(share, [])
    ruled = sample.select("y", "scale", array_to_vector(F.array(*[_rule(p, PREFIX).cast("double") for p in paths])).alias("features"))
    lasso = LogisticRegression(labelCol="y", weightCol="scale", elasticNetParam=1.0, regParam=LASSO, maxIter=100, standardization=False).fit(ruled)
    weights = lasso.coefficients.toArray().tolist()
    return Rules(float(lasso.intercept), [(w, p) for w, p in zip(weights, paths) if w])


def _rule(path: tuple[Condition, ...], prefix: str) -> Column:
    named = [(F.col(prefix + n.removeprefix(PREFIX)), sign, bound) for n, sign, bound in path]
    return reduce(lambda a, b: a & b, [(c <= bound) if sign == "<=" else (c > bound) for c, sign, bound in named])


def score(model: Rules, prefix: str = PREFIX) -> Column:
    """The chance of label 1 as one expression over the columns of ``with_statistics`` with the same ``prefix``."""
    total = reduce(lambda a, b: a + b, [F.when(_rule(p, prefix), w).otherwise(0.0) for w, p in model.rules], F.lit(model.intercept))
    return 1 / (1 + F.exp(-total))


def classify(docs: DataFrame, model: Rules, text: str = "text", column: str = "quality_score") -> DataFrame:
    """``docs`` with ``column``: 0 to 1, higher where label 1 is likelier. Null and empty texts are scored by their statistics too."""
    if column in docs.columns:
        raise ValueError(f"there is a column {column} already")
    names, prefix = list(statistics(F.lit(""))), PREFIX
    while {(prefix + n).lower() for n in names} & {c.lower() for c in docs.columns}:
        prefix += "_"
    return with_statistics(docs, text, prefix).withColumn(column, score(model, prefix)).drop(*[prefix + n for n in names])
