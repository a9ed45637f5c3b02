"""Recommendations from factor models and from content."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window as W, functions as F

from readflow.functions.vectors import dot
from readflow.operators.blocks import SCORE_DIGITS, Items, Reducer, Users, item_blocks, map_blocks, meet, user_blocks, with_seen
from readflow.operators.tfidf import unit_arrays
from readflow.session import materialize

N_COMPONENTS = 100
EPOCHS = 30
REGULARISATION = 1e-6
ALPHA = 1.0
SEED = 42


def train_factors(
    matrix: DataFrame, rank: int = N_COMPONENTS, iterations: int = EPOCHS, reg: float = REGULARISATION,
    alpha: float = ALPHA, seed: int = SEED, users: DataFrame | None = None, items: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fit implicit-feedback ALS on (user_id, page, user_idx, item_idx, score); return factor tables.

    ``users`` (user_id) and ``items`` (page) name the ids that the model must know; those without
    a pair in ``matrix`` get zero vectors, so they can be scored, ranked and evaluated as well.
    """
    ratings = matrix.select(F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("score").cast("float"))
    model = ALS(
        userCol="user_idx", itemCol="item_idx", ratingCol="score", implicitPrefs=True,
        rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, seed=seed,
    ).fit(ratings)

    def table(factors, index, key):
        names = matrix.select(F.col(index).cast("int").alias("id"), key).distinct()
        return factors.join(names, "id").select(
            key, F.col("features").cast("array<double>").alias("factors"), F.lit(0.0).alias("bias")
        )

    user_factors, item_factors = table(model.userFactors, "user_idx", "user_id"), table(model.itemFactors, "item_idx", "page")
    if users is not None:
        user_factors = for_all_ids(user_factors, users, "user_id", rank)
    if items is not None:
        item_factors = for_all_ids(item_factors, items, "page", rank)
    return materialize(user_factors, "user-factors"), materialize(item_factors, "item-factors")


def for_all_ids(factors: DataFrame, ids: DataFrame, key: str, rank: int) -> DataFrame:
    """Factors of every id in ``ids`` or ``factors``: zero vectors where a model has none."""
    known = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    zeros = F.array_repeat(F.lit(0.0), rank)
    return known.join(factors, key, "full").select(key, F.coalesce("factors", zeros).alias("factors"), F.coalesce("bias", F.lit(0.0)).alias("bias"))


def score_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Model score of given (user_id, page) pairs; pairs with an unknown side are left out."""
    users = user_factors.select("user_id", F.col("factors").alias("_u"))
    items = item_factors.select("page", F.col("factors").alias("_i"), F.col("bias").alias("_b"))
    score = F.round(dot(F.col("_u"), F.col("_i")) + F.col("_b"), SCORE_DIGITS)
    return pairs.join(items, "page").join(users, "user_id").withColumn("score", score).select(*pairs.columns, "score")


class _Ranges(Reducer):
    def __init__(self, row):
        self.users, self.own, self.n, self.total = row.users, Users(row), 0, 0.0
        self.lo, self.hi = np.inf, -np.inf

    def add(self, row):
        scores = self.own.scores(slice(None), Items.of(row))
        self.n += scores.shape[1]
        self.total = self.total + scores.sum(axis=1)
        self.lo, self.hi = np.minimum(self.lo, scores.min(axis=1)), np.maximum(self.hi, scores.max(axis=1))

    def result(self):
        return pd.DataFrame({"user_id": self.users, "n": self.n, "total": self.total, "lo": self.lo, "hi": self.hi})


def score_ranges(user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Score every catalogue item for every user; keep count, mean, smallest and largest score per user."""
    joined = meet(user_blocks(user_factors, {}), item_blocks(item_factors), once=True)
    parts = map_blocks(joined, "user_id string, n long, total double, lo double, hi double", _Ranges)
    return parts.groupBy("user_id").agg(
        F.sum("n").alias("n_items"),
        (F.sum("total") / F.sum("n")).alias("mean_score"),
        F.min("lo").alias("min_score"),
        F.max("hi").alias("max_score"),
    )


class _Best(Reducer):
    """Each user's best ``wanted`` items so far, and the range of all scores; ties go to the smaller page.

    By Cauchy's inequality no score of a block lies further from its biases than the user's length
    times the block's greatest. A user whose list is full, and whose range and last place lie beyond
    that, is left out of the product; a block that leaves out all users counts as ``skipped``. Where
    either side is zero the bound is the score itself, and the pages decide between ties.
    """

    ranged = True  # the smallest score is wanted as well
    flat_together = True

    def __init__(self, row):
        self.users, self.wanted = np.asarray(row.users, dtype=object), np.asarray(row.wanted)
        self.own, self.seen = Users(row), {}
        seen = getattr(row, "seen", None)
        for s in seen if seen is not None else ():
            self.seen.setdefault(s["item_block"], []).append((s["u"], s["i"]))
        self.lo, self.hi = np.full(len(self.users), np.inf), np.full(len(self.users), -np.inf)
        self.rows, self.raw, self.pages = np.empty(0, np.int64), np.empty(0), np.empty(0, object)
        self.skipped = 0
        self._ended()

    def _ended(self) -> None:
        """Each user's score of the last place, -inf while the list is not full, and the page there."""
        ends = np.searchsorted(self.rows, np.arange(len(self.users)), side="right")
        full = np.bincount(self.rows, minlength=len(self.users)) >= self.wanted
        self.last, self.page = np.full(len(self.users), -np.inf), np.full(len(self.users), None, object)
        self.last[full], self.page[full] = self.raw[ends[full] - 1], self.pages[ends[full] - 1]

    def _open(self, block: Items) -> np.ndarray:
        """The users for whom a block may change something; ``slack`` covers rounding."""
        reach = self.own.lengths * block.longest
        slack = 1e-9 * (1 + reach + block.bias) + 10.0**-SCORE_DIGITS
        closed = reach + block.high + slack < self.last
        exact = reach == 0
        low, high, first = np.round(block.low, SCORE_DIGITS), np.round(block.high, SCORE_DIGITS), block.pages[0]
        level = exact & (self.last >= high)
        closed[level] = self.last[level] > high[()]
        if first is not None:
            tied = np.flatnonzero(exact & (self.last == high))
            closed[tied] = [p is None or p < first for p in self.page[tied]]
        if self.ranged:
            closed &= np.where(exact, low >= self.lo, block.low - reach - slack > self.lo)
        return np.flatnonzero(~closed)

    def add(self, row):
        block = Items.of(row)
        taken = self._open(block)
        if not len(taken):
            self.skipped += 1
            return
        if block.flat:
            self._merge(block, *self._flatly(taken, block))
            return
        short = np.isneginf(self.last[taken]) if self.own.near and block.near else np.full(len(taken), True)
        found = [self._nearly(taken[~short], block), self._wholly(taken[short], block)]
        self._merge(block, *(np.concatenate(x) for x in zip(*found)))

    def _merge(self, block: Items, rows, cols, raw) -> None:
        """Take (user, column, score) into the users' lists."""
        if not len(rows):
            return
        mine = np.zeros(len(self.users), bool)
        mine[rows] = True
        rest = ~mine[self.rows]  # the lists of all other users stay as they are
        rows = np.concatenate((self.rows[~rest], rows))
        raw = np.concatenate((self.raw[~rest], raw))
        pages = np.concatenate((self.pages[~rest], block.pages[cols]))
        order = np.lexsort((-raw, rows))
        ordered = rows[order], raw[order]
        tied = (ordered[0][1:] == ordered[0][:-1]) & (ordered[1][1:] == ordered[1][:-1])
        if tied.any():  # pages are numbered in their order first: few differ where many tie
            number = {p: k for k, p in enumerate(sorted(set(pages), key=lambda p: (p is not None, p or "")))}
            order = np.lexsort((np.fromiter(map(number.__getitem__, pages), np.int64, len(pages)), -raw, rows))
        place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order], side="left")
        order = order[place < self.wanted[rows[order]]]
        rows, raw, pages = (np.concatenate((x[rest], y[order])) for x, y in ((self.rows, rows), (self.raw, raw), (self.pages, pages)))
        order = np.argsort(rows, kind="stable")
        self.rows, self.raw, self.pages = rows[order], raw[order], pages[order]
        self._ended()

    def _flatly(self, taken, block: Items):
        """``_wholly`` for items that have the same score for all users: the best of them are picked once."""
        unsound = taken[~self.own.sound[taken]]  # what is no number times 0 is no number
        self.lo[unsound] = self.hi[unsound] = np.nan
        taken, scores = taken[self.own.sound[taken]], np.round(block.biases, SCORE_DIGITS)
        best = np.argsort(-scores, kind="stable")  # pages rise with the column
        self.lo[taken] = np.minimum(self.lo[taken], scores.min())
        self.hi[taken] = np.maximum(self.hi[taken], scores.max())
        read = {}
        for name, places in block.places.items():
            for u, i in self.seen.get(name, ()):
                read.setdefault(u, []).append(places[i])
        free = taken[~np.isin(taken, list(read))] if read else taken
        keep = best[: int(self.wanted.max())]
        rows, cols = [np.repeat(free, len(keep))], [np.tile(keep, len(free))]
        for u in taken[np.isin(taken, list(read))].tolist() if read else ():
            some = best[: len(keep) + len(read[u])]
            cols.append(some[~np.isin(some, read[u])][: len(keep)])
            rows.append(np.full(len(cols[-1]), u))
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        raw = scores[cols]
        kept = raw > self.last[rows]
        tied = np.flatnonzero(raw == self.last[rows])
        kept[tied] = [p is None or (q is not None and p < q) for p, q in zip(block.pages[cols[tied]], self.page[rows[tied]])]
        return rows[kept], cols[kept], raw[kept]

    def _nearly(self, taken, block: Items):
        """``_wholly`` for users with full lists: single precision names the pairs that may enter a list or widen a range."""
        if not len(taken):
            return taken, taken, np.empty(0)
        scores, error = self.own.near_scores(taken, block)
        width = len(block.pages)
        floor = (self.last[taken] - error).astype(np.float32)
        lines = np.flatnonzero(scores.max(axis=1) >= floor)
        rows, cols = np.divmod(np.flatnonzero(scores[lines] >= floor[lines, None]), scores.shape[1])
        rows = lines[rows]
        crowded = np.bincount(rows, minlength=len(taken)) > width // 8  # of ties, most are passed over at once
        kept = ~crowded[rows]
        rows, cols = taken[rows[kept]], cols[kept]
        raw = self.own.of_pairs(rows, cols, block)
        np.maximum.at(self.hi, rows, raw)
        if self.ranged:
            scores = scores[:, :width]
            ceiling = (self.lo[taken] + error).astype(np.float32)
            lines = np.flatnonzero((scores.min(axis=1) <= ceiling) & ~crowded)
            under, at = np.nonzero(scores[lines] <= ceiling[lines, None])
            under = taken[lines[under]]
            np.minimum.at(self.lo, under, self.own.of_pairs(under, at, block))
        kept = raw >= self.last[rows]
        if seen := self.seen.get(block.item_block):
            u, i = np.array(seen).T
            kept &= ~np.isin(rows * width + cols, u * width + i)
        found = rows[kept], cols[kept], raw[kept]
        return found if not crowded.any() else [np.concatenate(x) for x in zip(found, self._wholly(taken[crowded], block))]

    def _wholly(self, taken, block: Items):
        """(user, column, score) of what may enter the users' lists, from all scores of the block; the range widens."""
        if not len(taken):
            return taken, taken, np.empty(0)
        scores = self.own.scores(taken, block)
        self.lo[taken] = np.minimum(self.lo[taken], scores.min(axis=1))
        self.hi[taken] = np.maximum(self.hi[taken], scores.max(axis=1))
        line = np.full(len(self.users), -1)
        line[taken] = np.arange(len(taken))
        for u, i in self.seen.get(block.item_block, ()):
            if line[u] >= 0:
                scores[line[u], i] = -np.inf
        width = scores.shape[1]
        keep = min(int(self.wanted.max()), width)
        floor = self.last[taken]  # nothing below a last place can enter
        short = np.flatnonzero(np.isneginf(floor))
        if len(short):
            floor[short] = np.partition(scores[short], width - keep, axis=1)[:, width - keep]
        rows, cols = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
        raw = scores[rows, cols]
        if len(rows) > keep * len(taken):  # pages rise with the column: of ties at the floor the first ones suffice
            tied = raw == floor[rows]
            nth = np.cumsum(tied)
            before = np.concatenate(([0], nth))[np.searchsorted(rows, rows, side="left")]
            kept = ~tied | (nth - before <= keep)
            rows, cols, raw = rows[kept], cols[kept], raw[kept]
        return taken[rows], cols, raw

    def result(self):
        bare = np.setdiff1d(np.arange(len(self.users)), self.rows)  # all items seen: only the range counts
        rows = np.concatenate((self.rows, bare))
        return pd.DataFrame({
            "user_id": self.users[rows], "page": np.concatenate((self.pages, np.full(len(bare), None, object))),
            "raw": np.concatenate((self.raw, np.full(len(bare), np.nan))), "lo": self.lo[rows], "hi": self.hi[rows], "n": self.wanted[rows]})


class _BestRaw(_Best):
    """Without the smallest score, so that long vectors alone decide where all scores are positive too."""

    ranged = False


def recommend_batch(
    requests: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    exclude_seen: DataFrame | None = None,
    scaled: bool = True,
) -> DataFrame:
    """Best ``n`` items of every request (user_id, n), as (user_id, rank, page, score).

    Scores are min-max scaled per user over the whole catalogue (0.5 when all are equal), or the
    model's own where ``scaled`` is off, which lets more of the catalogue be passed over. Unknown
    users get no rows. Ties go to the smaller page id. ``exclude_seen`` leaves out pairs already read.
    A request with ``n`` below 1 fails.
    """
    wanted = requests.groupBy("user_id").agg(F.max("n").cast("int").alias("n"))
    valid = F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit("n must be greater than 0")).cast("int"))
    asked = user_factors.join(wanted.withColumn("n", valid), "user_id").select("user_id", "factors", "n")
    return _best_items(asked, item_factors, exclude_seen, scaled)


def _best_items(asked: DataFrame, item_factors: DataFrame, exclude_seen: DataFrame | None, scaled: bool = True) -> DataFrame:
    """The ranking behind the requests; ``asked`` has one row (user_id, factors, n) per user."""
    candidates = _candidates(asked, item_factors, exclude_seen, scaled)
    user = W.partitionBy("user_id")
    ranked = candidates.withColumns({
        "_lo": F.min("lo").over(user), "_hi": F.max("hi").over(user),
        "rank": F.row_number().over(user.orderBy(F.desc_nulls_last("raw"), "page")),
    })
    score = F.col("raw") if not scaled else F.when(F.col("_hi") == F.col("_lo"), F.lit(0.5)).otherwise(
        (F.col("raw") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
    return ranked.filter((F.col("rank") <= F.col("n")) & F.col("raw").isNotNull()).select(
        "user_id", "rank", "page", score.alias("score"))


def _candidates(asked: DataFrame, item_factors: DataFrame, exclude_seen: DataFrame | None, scaled: bool = True) -> DataFrame:
    """The best ``n`` items of every user from each cell of items."""
    items = item_blocks(item_factors, by_norm=True)
    users = user_blocks(asked, {"n": "wanted"})
    if exclude_seen is not None:
        users = with_seen(users, items, exclude_seen)
    found = map_blocks(meet(users, items, once=True), "user_id string, page string, raw double, lo double, hi double, n int", _Best if scaled else _BestRaw)
    return found.withColumn("raw", F.nanvl("raw", F.lit(None).cast("double")))


def recommend_top_n(
    user_factors: DataFrame, item_factors: DataFrame, n: int = 10, exclude_seen: DataFrame | None = None, scaled: bool = True,
) -> DataFrame:
    """Best ``n`` items of every user of the model."""
    if n <= 0:
        raise ValueError("n must be greater than 0")
    return _best_items(user_factors.select("user_id", "factors", F.lit(n).alias("n")), item_factors, exclude_seen, scaled)


def recommend_nested(recommendations: DataFrame) -> DataFrame:
    """One row per user with its ranked list of (page, score)."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "page", "score")))
    return recommendations.groupBy("user_id").agg(
        F.transform(ranked, lambda r: F.struct(r["page"].alias("page"), r["score"].alias("score"))).alias("predictions"))


def content_profiles(scores: DataFrame, features: DataFrame) -> DataFrame:
    """(user_id, features): sum of the vectors of the pages read, weighted by the user's score of each."""
    read = scores.join(features.select("page", "features"), "page")
    total = Summarizer.metrics("sum").summary(F.col("features"), F.col("score"))
    return read.groupBy("user_id").agg(total.alias("s")).select("user_id", F.col("s.sum").alias("features"))


def content_factors(scores: DataFrame, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles and articles as unit vectors, so that the block scorer's dot product is their cosine.

    Both are written once, because the scorer reads them twice: to count and to pack them.
    """
    users = unit_arrays(content_profiles(scores, features), "user_id")
    items = unit_arrays(features, "page").withColumn("bias", F.lit(0.0))
    return materialize(users, "profiles"), materialize(items, "articles")


def content_recommend(scores: DataFrame, features: DataFrame, n: int = 10, exclude_seen: bool = False) -> DataFrame:
    """Best ``n`` articles by cosine with the user's profile; articles nobody read take part."""
    users, items = content_factors(scores, features)
    return recommend_top_n(users, items, n, scores if exclude_seen else None)
