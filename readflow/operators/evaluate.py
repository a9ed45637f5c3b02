"""Ranking metrics of a factor model on held-out pairs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from readflow.operators.blocks import Items, Reducer, Users, item_blocks, map_blocks, meet, user_blocks
from readflow.operators.recommend import score_pairs
from readflow.session import materialize

POSITIVES_PER_CHUNK = 1024
ROWS_PER_RANK_BLOCK = 512
TILE = 512  # users whose scores of a block are made at once
SORTED_FROM = 32  # positives of a user for which a block's scores are sorted rather than counted one by one


def _count(mask: np.ndarray) -> np.ndarray:
    """True values per line; lines are a multiple of 8 long, and eight are added at once while no byte can overflow."""
    if mask.shape[1] > 8 * 255:
        return np.count_nonzero(mask, axis=1)
    return mask.view(np.uint64).sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=1, dtype=np.int64)


class _Reached(Reducer):
    """How many items reach the score of each positive, by the positive's place in its chunk.

    Items whose score in single precision is clear of the positive's are counted by it, the few others
    by their rounded score.
    """

    def __init__(self, row):
        self.row, self.own = row, Users(row)
        self.sizes = np.array([len(s) for s in row.own_scores])
        self.start = np.cumsum(self.sizes) - self.sizes
        self.scores = np.concatenate([np.asarray(s, dtype=np.float64) for s in row.own_scores])
        self.reached = np.zeros(len(self.scores), np.int64)
        self.order = np.argsort(-self.sizes, kind="stable")  # users with an nth positive stand together
        self.finite = bool(np.isfinite(self.scores).all())

    def add(self, row):
        block = Items.of(row)
        if not (self.own.near and block.near and self.finite):
            for k, s in enumerate(self.own.scores(slice(None), block)):
                s.sort()
                own = slice(self.start[k], self.start[k] + self.sizes[k])
                self.reached[own] += len(s) - np.searchsorted(s, self.scores[own], side="left")
            return
        for first in range(0, len(self.order), TILE):
            self._add_near(self.order[first : first + TILE], block)

    def _add_near(self, users, block):
        """Count for some users, those with the most positives first, in single precision."""
        scores, error = self.own.near_scores(users, block)
        sizes, start, mask, close = self.sizes[users], self.start[users], np.empty(scores.shape, bool), []
        many = int(np.searchsorted(-sizes, -SORTED_FROM, side="left"))

        def reaching(lines, limits):
            return _count(np.greater_equal(scores[lines], limits.astype(np.float32)[:, None], out=mask[lines]))

        def count(lines, at, over, some):
            self.reached[at] += over
            if len(near := np.flatnonzero(some != over)):
                close.append((lines[near], at[near]))

        for n in range(sizes[many] if many < len(users) else 0):
            lines = slice(many, int(np.searchsorted(-sizes, -n, side="left")))
            at = start[lines] + n
            own = self.scores[at]
            count(np.arange(lines.start, lines.stop), at, reaching(lines, own + error[lines]), reaching(lines, own - error[lines]))
        for line in range(many):
            at = np.arange(start[line], start[line] + sizes[line])
            s = np.sort(scores[line])
            over, some = (len(s) - np.searchsorted(s, (self.scores[at] + e).astype(np.float32), side="left") for e in (error[line], -error[line]))
            count(np.full(len(at), line), at, over, some)
        if close:
            self._tell(users, block, scores, error, *(np.concatenate(x) for x in zip(*close)))

    def _tell(self, users, block, scores, error, lines, at):
        """Count, of the items too close to the positives ``at`` to tell in single precision, those that reach them."""
        for part in range(0, len(at), 256):
            some, where = lines[part : part + 256], at[part : part + 256]
            own, wide, near = self.scores[where], error[some], scores[some]
            rows, cols = np.nonzero((near >= (own - wide).astype(np.float32)[:, None]) & (near < (own + wide).astype(np.float32)[:, None]))
            exact = self.own.of_pairs(users[some[rows]], cols, block)
            self.reached[where] += np.bincount(rows[exact >= own[rows]], minlength=len(where))

    def result(self):
        return pd.DataFrame({
            "user_id": np.repeat(np.asarray(self.row.users, dtype=object), self.sizes), "chunk": np.repeat(np.asarray(self.row.chunks), self.sizes),
            "place": np.arange(len(self.scores)) - np.repeat(self.start, self.sizes), "reached": self.reached})


def rank_positives(positives: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """0-based rank of each held-out pair among all items of the catalogue for its user.

    A positive ranks after every item that scores as high, itself not counted. Each cell of items
    only reports how many of its items reach the positive's score, and those counts add up, so the
    full ranking is never built. A user with many positives is spread over several chunks; only
    scores travel to the items, and the pages are joined by their place in the chunk afterwards.
    """
    pairs = positives.select("user_id", "page").distinct()
    scored = materialize(score_pairs(pairs, user_factors, item_factors), "positives")
    chunks = scored.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / POSITIVES_PER_CHUNK).alias("_chunks"))
    chunk = F.pmod(F.xxhash64("page"), F.col("_chunks")).alias("chunk")
    gathered = scored.join(chunks, "user_id").groupBy("user_id", chunk).agg(F.sort_array(F.collect_list(F.struct("page", "score"))).alias("p"))
    gathered = materialize(gathered, "positive-chunks")
    rows = gathered.select("user_id", "chunk", F.col("p.score").alias("own_scores")).join(user_factors.select("user_id", "factors"), "user_id")
    users = user_blocks(rows, {"own_scores": "own_scores", "chunk": "chunks"}, ROWS_PER_RANK_BLOCK)
    counts = map_blocks(meet(users, item_blocks(item_factors), once=True), "user_id string, chunk long, place int, reached long", _Reached)
    ranks = counts.groupBy("user_id", "chunk", "place").agg((F.sum("reached") - 1).alias("rank"))
    pages = gathered.select("user_id", "chunk", F.posexplode("p.page").alias("place", "page"))
    return pages.join(ranks, ["user_id", "chunk", "place"]).select("user_id", "page", "rank")


def user_metrics(ranks: DataFrame, n_items, k_values: Sequence[int] = (10,)) -> DataFrame:
    """Per user: positives, best rank, AUC, and for each k the hits and the DCG.

    With ranks r sorted upward the negatives above the i-th positive are r - i, so their sum needs
    no sort: it is sum(r) - m (m - 1) / 2.
    """
    gain = F.lit(1.0) / F.log2(F.col("rank") + F.lit(2.0))
    per_k = [c for k in k_values for c in (
        F.count_if(F.col("rank") < k).alias(f"hits_{k}"),
        F.coalesce(F.sum(F.when(F.col("rank") < k, gain)), F.lit(0.0)).alias(f"dcg_{k}"),
    )]
    sums = ranks.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("m"), F.sum("rank").alias("rank_sum"), F.min("rank").alias("best"), *per_k)
    negatives = n_items - F.col("m")
    above = F.col("rank_sum") - F.col("m") * (F.col("m") - 1) / 2
    auc = F.when(negatives == 0, F.lit(0.5)).otherwise(F.lit(1.0) - F.try_divide(above, F.col("m") * negatives))
    return sums.withColumn("auc", auc)


def metrics_by_k(
    positives: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k_values: Sequence[int] = (5, 10, 20), ranks: DataFrame | None = None,
) -> DataFrame:
    """precision, recall, F1, hit rate and NDCG at each k, with AUC and MRR, from one ranking pass.

    Means are over the users with at least one held-out pair. ``ranks`` are those of ``rank_positives`` with the same
    model, of these positives at least: a pair's rank does not depend on what else is held out.
    """
    if ranks is None:
        ranks = rank_positives(positives, user_factors, item_factors)
    else:
        ranks = ranks.join(positives.select("user_id", "page").distinct(), ["user_id", "page"], "left_semi")
    n_items = item_factors.agg(F.count(F.lit(1))).scalar()
    users = user_metrics(ranks, n_items, k_values)

    def at(k):
        m = F.col("m")
        ideal = F.aggregate(
            F.sequence(F.lit(1), F.least(F.lit(k), m.cast("int"))), F.lit(0.0),
            lambda acc, j: acc + F.lit(1.0) / F.log2(j + F.lit(1.0)))
        hits = F.col(f"hits_{k}")
        return F.struct(
            F.avg(hits / F.lit(float(k))).alias("precision"), F.avg(hits / m).alias("recall"),
            F.avg((hits > 0).cast("double")).alias("hit_rate"), F.avg(F.col(f"dcg_{k}") / ideal).alias("ndcg"))

    one = users.agg(
        F.count(F.lit(1)).alias("users"), F.avg("auc").alias("auc"),
        F.avg(F.lit(1.0) / (F.col("best") + 1)).alias("mrr"),
        F.array(*[F.struct(F.lit(k).alias("k"), at(k).alias("v")) for k in k_values]).alias("ks"))
    rows = one.select("users", "auc", "mrr", F.explode("ks").alias("e"))
    p, r = F.col("e.v.precision"), F.col("e.v.recall")
    return rows.select(
        F.col("e.k").alias("k"), "users", p.alias("precision"), r.alias("recall"), f1_score(p, r).alias("f1"),
        F.col("e.v.hit_rate").alias("hit_rate"), F.col("e.v.ndcg").alias("ndcg"), "auc", "mrr")


def f1_score(precision, recall):
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / (precision + recall))
