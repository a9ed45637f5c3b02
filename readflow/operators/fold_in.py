"""Factors for what a factor model has not seen: articles from their features, readers from their readings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from readflow.operators.recommend import ALPHA, REGULARISATION
from readflow.session import materialize

RIDGE = 1.0
#: True for articles of which a model knows something.
KNOWN = "exists(factors, x -> x <> 0)"


def gramian(rows: DataFrame, vector: str, width: int) -> np.ndarray:
    """The sum of x·xᵀ over all rows, added up in a tree of tasks; its size depends on the width alone."""
    if rows.isEmpty():
        return np.zeros((width, width))
    plain = MLUtils.convertVectorColumnsFromML(rows.select(F.col(vector).alias("v")), "v")
    return RowMatrix(plain).computeGramianMatrix().toArray()


def feature_map(features: DataFrame, item_factors: DataFrame, ridge: float = RIDGE) -> np.ndarray:
    """The matrix that maps an article's features to its factors and bias with the least squared error plus ``ridge`` times its own square.

    ``features``: (page, features vector); ``item_factors``: (page, factors, bias), of which only articles with
    non-zero factors teach. One pass sums the products of features, factors and bias; the equations
    left are as large as the number of features, whatever the number of articles.
    """
    taught = features.join(item_factors.filter(KNOWN), "page").select(
        F.concat(vector_to_array("features"), F.col("factors"), F.array(F.coalesce("bias", F.lit(0.0)))).alias("row"),
        F.size(vector_to_array("features")).alias("width"))
    taught = materialize(taught.select("width", array_to_vector("row").alias("row")), "taught")
    sizes = taught.agg(F.min("width"), F.max("width"), F.max(F.size(vector_to_array("row")))).first()
    if sizes[0] is None:
        raise ValueError("no article has both features and factors")
    if sizes[0] != sizes[1]:
        raise ValueError(f"feature vectors of different lengths: {sizes[0]} and {sizes[1]}")
    width, products = sizes[0], gramian(taught, "row", sizes[2])
    return np.linalg.solve(products[:width, :width] + ridge * np.eye(width), products[:width, width:])


def map_residuals(features: DataFrame, item_factors: DataFrame, weights: np.ndarray, ridge: float = RIDGE) -> DataFrame:
    """(feature_idx, residual): what the normal equations of ``feature_map`` are off by at most, relative to their largest right side.

    Summed once more from the articles themselves: features times the error of each article's prediction.
    """
    rows = features.join(item_factors.filter(KNOWN), "page").select(
        vector_to_array("features").alias("x"), F.concat("factors", F.array(F.coalesce("bias", F.lit(0.0)))).alias("target"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors, targets, met = np.zeros(weights.shape), np.zeros(weights.shape), np.zeros(len(weights), bool)
        for batch in batches:
            x, t = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for c, n in ((0, len(weights)), (1, weights.shape[1])))
            errors += x.T @ (t - x @ weights)
            targets += x.T @ t
            met |= (x != 0).any(axis=0)
        at = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), *[pa.array(list(m[at]), pa.list_(pa.float64())) for m in (errors, targets)]], names=["feature_idx", "e", "t"])

    # One row per feature leaves a task, whatever the number of its articles.
    parts = rows.mapInArrow(add_up, "feature_idx int, e array<double>, t array<double>")
    weighted = parts.select("feature_idx", *[array_to_vector(c).alias(c) for c in ("e", "t")])
    sums = weighted.groupBy("feature_idx").agg(*[Summarizer.sum(F.col(c)).alias(c) for c in ("e", "t")])
    sums = sums.select("feature_idx", *[vector_to_array(c).alias(c) for c in ("e", "t")])
    table = features.sparkSession.createDataFrame([(i, (ridge * row).tolist()) for i, row in enumerate(weights)], "feature_idx int, pull array<double>")
    off = F.zip_with(F.coalesce("e", F.transform("pull", lambda _: F.lit(0.0))), "pull", lambda e, p: F.abs(e - p))
    largest = sums.agg(F.max(F.array_max(F.transform("t", F.abs)))).scalar()
    return table.join(sums, "feature_idx", "left").select("feature_idx", (F.array_max(off) / largest).alias("residual"))


def predicted(rows: DataFrame, weights: np.ndarray, schema: str, shape) -> DataFrame:
    """``shape(rows)``, whose second column is a feature array, with ``predicted``: what the map makes of it."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(weights))
            out = x @ weights
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, weights.shape[1], dtype=np.int32), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "predicted"])

    return shape(rows).mapInArrow(apply, f"{schema}, predicted array<double>")


def with_cold_items(item_factors: DataFrame, features: DataFrame, weights: np.ndarray) -> DataFrame:
    """(page, factors, bias, cold): the model's articles, and those it knows nothing of by their features.

    An article without factors, or with zeros only, that has features gets what the map makes of
    them; all others stay as they are.
    """
    known = item_factors.select("page", "factors", F.coalesce("bias", F.lit(0.0)).alias("bias"))
    cold = features.select("page", "features").join(known.filter(KNOWN), "page", "left_anti")
    rows = predicted(cold, weights, "page string, features_array array<double>", lambda df: df.select("page", vector_to_array("features").alias("features_array")))
    last = weights.shape[1]
    made = rows.select("page", F.slice("predicted", 1, last - 1).alias("factors"), F.element_at("predicted", -1).alias("bias"), F.lit(True).alias("cold"))
    made = materialize(made, "cold-items")
    return known.join(made.select("page"), "page", "left_anti").withColumn("cold", F.lit(False)).unionByName(made)


def fold_in_readers(readings: DataFrame, item_factors: DataFrame, reg: float = REGULARISATION, alpha: float = ALPHA) -> DataFrame:
    """(user_id, factors, bias, n, residual) for every reader in ``readings`` (user_id, page, score) by the model's own loss.

    With the articles fixed, a reader's factors x solve (YᵀY + Σ α·score·y·yᵀ + reg·n·I)·x = Σ (1 + α·score)·y over the
    ``n`` articles read; YᵀY is the same for all. Repeated pairs count with the sum of their scores;
    articles the model does not know and zero scores say nothing, and a reader with nothing else gets no row. ``residual`` is what the
    equations are off by at most. Rows are range-partitioned by reader and article, so a reader
    of very many articles is spread over many tasks: only the first and the last reader of a task can
    go on in another one, and only their sums are added up once more.
    """
    items = item_factors.filter(KNOWN).select("page", "factors")
    width = items.select(F.max(F.size("factors"))).first()[0] or 1
    shared = gramian(items.select(array_to_vector("factors").alias("v")), "v", width)
    scores = readings.groupBy("user_id", "page").agg(F.sum("score").alias("score")).filter("user_id is not null and score <> 0")
    rows = scores.join(items, "page").select("user_id", "page", F.col("score").cast("double").alias("score"), "factors")
    placed = rows.repartitionByRange("user_id", "page").sortWithinPartitions("user_id", "page").select("user_id", "score", "factors")

    def solved(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = sums[:, : width * width].reshape(-1, width, width) + shared + (reg * counts)[:, None, None] * np.eye(width)
        right = sums[:, width * width :]
        x = np.linalg.solve(left, right[..., None])[..., 0]
        return x, np.abs((left @ x[..., None])[..., 0] - right).max(1)

    def batch_of(keys: list, vectors: list, counts: list, residuals: list, done: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([v.tolist() for v in vectors], pa.list_(pa.float64())), pa.array(counts, pa.int64()),
             pa.array(residuals, pa.float64()), pa.array([done] * len(keys))], names=["user_id", "factors", "n", "residual", "done"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, open_key, held = True, None, None
        ready: list[tuple] = []
        for batch in batches:
            keys = np.array(batch.column(0).to_pylist(), dtype=object)
            score = alpha * batch.column(1).to_numpy(zero_copy_only=False)
            y = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if len(keys) else []
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                weighted = y[a:b] * score[a:b, None]
                sums = np.concatenate(((weighted.T @ y[a:b]).ravel(), (weighted + y[a:b]).sum(0)))
                if keys[a] == open_key:
                    held = (open_key, held[1] + sums, held[2] + b - a)
                    continue
                if held is not None and first:
                    yield batch_of([held[0]], [held[1]], [held[2]], [None], False)
                    first = False
                elif held is not None:
                    ready.append(held)
                open_key, held = keys[a], (keys[a], sums, b - a)
            if len(ready) * width * width > 1_000_000:
                yield finish(ready)
                ready = []
        if ready:
            yield finish(ready)
        if held is not None:
            yield batch_of([held[0]], [held[1]], [held[2]], [None], False)

    def finish(ready: list[tuple]) -> pa.RecordBatch:
        keys, sums, counts = zip(*ready)
        x, residuals = solved(np.array(sums), np.array(counts))
        return batch_of(list(keys), list(x), list(counts), residuals.tolist(), True)

    def conclude(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                sums = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                x, residuals = solved(sums, batch.column(2).to_numpy(zero_copy_only=False))
                yield batch_of(batch.column(0).to_pylist(), list(x), batch.column(2).to_pylist(), residuals.tolist(), True)

    schema = "user_id string, factors array<double>, n bigint, residual double, done boolean"
    made = materialize(placed.mapInArrow(gather, schema), "folded-in")
    parts = made.filter("not done").select("user_id", array_to_vector("factors").alias("v"), "n")
    whole = parts.groupBy("user_id").agg(Summarizer.sum(F.col("v")).alias("v"), F.sum("n").alias("n"))
    ends = whole.select("user_id", vector_to_array("v").alias("factors"), "n", F.lit(None).cast("double").alias("residual"), F.lit(False).alias("done"))
    rows = made.filter("done").unionByName(ends.mapInArrow(conclude, schema))
    return rows.select("user_id", "factors", F.lit(0.0).alias("bias"), "n", "residual")
