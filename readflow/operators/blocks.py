"""Scoring users against a whole catalogue in bounded blocks.

Users and items are packed into blocks of about ``ROWS_PER_BLOCK`` vectors. Every user block meets
every item block once, as one matrix product inside a task; what leaves the task is only what the
caller reduces it to (best n, counts, ranges), never the pairs.

Blocks meet in square cells: both sides are copied along the other side's cells and joined on the
cell, so a cell is one bounded join key, and each side is shuffled once per cell width of the other
instead of once per block. Cells are few while blocks are few, so that the copies grow no faster than
the rows, until a cell holds ``CELL_BYTES`` of the items; the cluster plays no part in it. A user
block meets the item blocks of a cell one after the other, and its result is merged on the way: it
leaves the task once per cell. Vectors go to the reducing task once per cell and side: a head row without
vectors stands before the blocks of either side, the join's row of a head and a block carries the
block, and the rows of two blocks only name them. Blocks are never broadcast: Spark goes by the size of the files, and
a catalogue of zero vectors is a thousand times its files once it is packed and copied.

Scores are compared in single precision first; those within its error of a decision, and those that are kept, are
computed again in double precision, so the results are those of double precision.

Items may be packed by the length of their vectors. Blocks are dealt to the cells in turn, so each
cell begins with long vectors, and a reducer that knows its users' last places can pass over blocks
whose vectors are too short to change them.
"""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from readflow.functions.columns import with_row

ROWS_PER_BLOCK = 1024
CELL = 512  # blocks of items in a cell, at most
CELL_BYTES = 256 << 20  # of items' vectors in a cell, at most
CELL_WORK = 5e10  # multiplications of a cell, below which it is not divided
USER_CELLS, ITEM_CELLS = 4, 16  # as many on a side, before cells get larger
SCORE_DIGITS = 9  # scores closer than this are ties
NORM_CLASSES = 64  # classes of vector lengths, at most
CLASSES_PER_HALVING = 4  # of them, between a length and its half
HEAD = -1  # the block without vectors that stands before all others of its side in a cell
LONGEST = 1e12  # vectors and biases beyond that are scored in double precision only


@dataclass(frozen=True)
class Blocks:
    """Packed rows, and one row (blocks, dims): their number and the length of a vector.

    ``seen`` are places of pairs (user_block, item_block, u, i), where users have any. ``ordered``
    blocks are met in their order.
    """

    df: DataFrame
    shape: DataFrame
    seen: DataFrame | None = None
    ordered: bool = False

    @property
    def count(self) -> Column:
        return self.shape.select("blocks").scalar()


def _shape(df: DataFrame, rows: int) -> DataFrame:
    blocks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows)).cast("bigint")
    return df.agg(blocks.alias("blocks"), F.coalesce(F.max(F.size("factors")), F.lit(1)).alias("dims"))


def _norm_class(items: DataFrame) -> DataFrame:
    """Items with ``_class``: 0 for the longest vectors, one more for every quarter of a halving, the last for all others."""
    square = F.aggregate("factors", F.lit(0.0), lambda acc, x: acc + x * x)
    sized = items.withColumn("_norm", F.sqrt(F.coalesce(square, F.lit(0.0))))
    peak = sized.agg(F.max("_norm")).scalar()
    steps = F.when(F.col("_norm") > 0, F.floor(CLASSES_PER_HALVING * F.log2(peak / F.col("_norm"))))
    return sized.withColumn("_class", F.least(F.coalesce(steps, F.lit(NORM_CLASSES)), F.lit(NORM_CLASSES - 1)).cast("int")).drop("_norm")


def _by_norm(items: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Items with ``item_block``, long vectors in low blocks, and the shape. A class is dealt over its blocks by hash: nothing is sorted."""
    classed = _norm_class(items)
    counts = classed.groupBy("_class").agg(
        F.ceil(F.count(F.lit(1)) / rows).cast("bigint").alias("_blocks"), F.max(F.size("factors")).alias("dims"))
    shape = counts.agg(F.greatest(F.lit(1), F.coalesce(F.sum("_blocks"), F.lit(1))).cast("bigint").alias("blocks"), F.coalesce(F.max("dims"), F.lit(1)).alias("dims"))
    # At most NORM_CLASSES rows: one map from class to (first block, blocks) goes to every row.
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("_class", "_blocks"))).alias("classes"))
    before = F.aggregate(
        F.filter("_of.classes", lambda c: c["_class"] < F.col("_class")), F.lit(0).cast("bigint"), lambda acc, c: acc + c["_blocks"])
    own = F.element_at(F.filter("_of.classes", lambda c: c["_class"] == F.col("_class")), 1)["_blocks"]
    placed = with_row(classed, listed, "_of").withColumn("item_block", before + F.pmod(F.xxhash64("page"), own))
    return placed.drop("_of", "_class"), shape


def item_blocks(items: DataFrame, rows: int = ROWS_PER_BLOCK, by_norm: bool = False) -> Blocks:
    """Items (page, factors, bias), pages unique → one row per block, sorted by page inside.

    ``by_norm`` puts vectors of like length into one block, the longest into block 0.
    """
    if by_norm:
        placed, shape = _by_norm(items, rows)
    else:
        shape = _shape(items, rows)
        placed = items.withColumn("item_block", F.pmod(F.xxhash64("page"), shape.select("blocks").scalar()))
    fields = F.struct("page", F.col("factors").alias("f"), F.col("bias").alias("b"))
    packed = placed.groupBy("item_block").agg(F.sort_array(F.collect_list(fields)).alias("m"))
    return Blocks(packed.select(
        "item_block", F.col("m.page").alias("pages"), F.flatten("m.f").alias("item_matrix"), F.col("m.b").alias("biases"),
    ), shape, ordered=by_norm)


def user_blocks(users: DataFrame, columns: dict[str, str], rows: int = ROWS_PER_BLOCK) -> Blocks:
    """Users (user_id, factors, …) → one row per block; ``columns`` maps further columns to list names."""
    shape = _shape(users, rows)
    key = F.xxhash64(*[c for c in ("user_id", "chunk") if c in users.columns])
    fields = F.struct("user_id", F.col("factors").alias("f"), *columns)
    packed = users.groupBy(F.pmod(key, shape.select("blocks").scalar()).alias("user_block")).agg(F.sort_array(F.collect_list(fields)).alias("m"))
    return Blocks(packed.select(
        "user_block", F.col("m.user_id").alias("users"), F.flatten("m.f").alias("user_matrix"),
        *[F.col(f"m.{c}").alias(name) for c, name in columns.items()],
    ), shape)


def with_seen(users: Blocks, items: Blocks, pairs: DataFrame) -> Blocks:
    """User blocks with the places of their users' pairs; ``meet`` gathers them per user block and cell."""
    by_user = users.df.select("user_block", F.posexplode("users").alias("u", "user_id"))
    by_page = items.df.select("item_block", F.posexplode("pages").alias("i", "page"))
    placed = pairs.select("user_id", "page").distinct().join(by_user, "user_id").join(by_page, "page")
    return Blocks(users.df, users.shape, placed.select("user_block", "item_block", "u", "i"))


def meet(users: Blocks, items: Blocks, once: bool = False) -> DataFrame:
    """One row per (user block, item block), with the cell they meet in, by the item block inside a user block of a cell.

    A row carries those ``seen`` pairs of its user block that lie in its cell, and no others. With ``once``, which is what
    ``map_blocks`` takes, only rows with a ``HEAD`` on the other side carry what a block holds; they come first.
    """
    shape = users.shape.first()  # one row, as that of the items
    sides, dims = {"user": shape["blocks"], "item": items.shape.first()["blocks"]}, shape["dims"]
    work, size = ROWS_PER_BLOCK**2 * dims, ROWS_PER_BLOCK * 8 * dims

    def n_cells(side: str, cells: int, most: int) -> int:
        wanted = max(math.floor(math.sqrt(CELL_WORK / work)), -(-sides[side] // cells))
        return -(-sides[side] // max(1, min(wanted, most)))

    # A task holds a cell's items and a single user block at a time: only the items' side is bounded by what memory holds, and
    # where that makes more cells of them, fewer of the users are enough to go round, and fewer copies of the items.
    many = {"item": n_cells("item", ITEM_CELLS, min(CELL, CELL_BYTES // size))}
    many["user"] = n_cells("user", min(USER_CELLS, -(-USER_CELLS * ITEM_CELLS // many["item"])), sides["user"])

    def cell_of(side: str) -> Column:  # dealt in turn, so that low blocks begin every cell
        return F.pmod(F.col(f"{side}_block"), F.lit(many[side]))

    def every(side: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(many[side] - 1).cast("bigint")))

    def cells(side: DataFrame, own: str, other: str) -> DataFrame:
        return side.withColumns({f"{own}_cell": cell_of(own), f"{other}_cell": every(other)})

    own = cells(users.df, "user", "item")
    if users.seen is not None:
        seen = users.seen.groupBy("user_block", cell_of("item").alias("item_cell")).agg(F.collect_list(F.struct("item_block", "u", "i")).alias("seen"))
        own = own.join(seen, ["user_block", "item_cell"], "left")
    met = cells(items.df, "item", "user")
    held = [[c for c in side.columns if c not in ("user_cell", "item_cell", "user_block", "item_block")] for side in (own, met)]
    if once:
        heads = users.df.sparkSession.range(1).select(every("user").alias("user_cell")).select("user_cell", every("item").alias("item_cell"))
        own, met = (side.unionByName(heads.withColumn(f"{name}_block", F.lit(HEAD).cast("bigint")), True) for side, name in ((own, "user"), (met, "item")))
    joined = _in_order(own, "user").join(_in_order(met, "item").hint("merge"), ["user_cell", "item_cell"])
    if not once:
        return joined
    kept = [F.when(F.col(f"{other}_block") == HEAD, F.col(c)).alias(c) for columns, other in zip(held, ("item", "user")) for c in columns]
    return joined.filter(f"user_block <> {HEAD} or item_block <> {HEAD}").select(
        "user_cell", "item_cell", "user_block", "item_block", "user_place", "item_place", *kept)


def _in_order(side: DataFrame, name: str) -> DataFrame:
    """The join's own shuffle and sort, with the block as one more key; ``…_place`` is there because Spark drops a sort right under a join.

    The number of partitions is fixed: small cells may be much work, and a split cell would part blocks from their heads.
    """
    parts = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = side.repartition(parts, "user_cell", "item_cell").sortWithinPartitions("user_cell", "item_cell", f"{name}_block")
    return dealt.withColumn(f"{name}_place", F.monotonically_increasing_id())


@dataclass(frozen=True)
class Row:
    """What a row of ``meet`` holds of its item block."""

    item_block: int
    pages: np.ndarray
    item_matrix: np.ndarray
    biases: np.ndarray


class Items:
    """One item block: pages, a vector per line, biases; and what bounds its scores, worked out once."""

    def __init__(self, row):
        self.item_block, self.pages = row.item_block, np.asarray(row.pages, dtype=object)
        self.matrix = np.asarray(row.item_matrix, dtype=np.float64).reshape(len(self.pages), -1 if len(row.item_matrix) else 0)
        self.biases = np.asarray(row.biases, dtype=np.float64)
        self.longest = np.linalg.norm(self.matrix, axis=1).max()
        if self.longest == 0 and not self.matrix.any():
            self.matrix = np.broadcast_to(0.0, self.matrix.shape)  # a catalogue of zero vectors takes no memory
        self.low, self.high = self.biases.min(), self.biases.max()
        self.bias = max(abs(self.low), abs(self.high))
        self.near = bool(self.longest <= LONGEST and self.bias <= LONGEST)
        self.flat = bool(self.longest == 0 and np.isfinite(self.biases).all())  # all users give an item the same score
        self.places = {self.item_block: np.arange(len(self.pages))}

    @classmethod
    def of(cls, row) -> Items:
        return row if isinstance(row, cls) else cls(row)

    @classmethod
    def together(cls, blocks: list[Items]) -> Items:
        """Flat blocks as one, in order of their pages; ``places`` tells where the rows of each have gone."""
        pages = np.concatenate([b.pages for b in blocks])
        order = np.array(sorted(range(len(pages)), key=lambda k: (pages[k] is not None, pages[k] or "")))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        whole = cls(Row(blocks[0].item_block, pages[order], np.empty(0), np.concatenate([b.biases for b in blocks])[order]))
        ends = np.cumsum([len(b.pages) for b in blocks])
        whole.places = {b.item_block: place[end - len(b.pages) : end] for b, end in zip(blocks, ends)}
        return whole


class Users:
    """The vectors of a user block, a line each, in both precisions, and their lengths."""

    def __init__(self, row):
        self.matrix = np.asarray(row.user_matrix, dtype=np.float64).reshape(len(row.users), -1)
        self.lengths = np.linalg.norm(self.matrix, axis=1)
        self.sound = np.isfinite(self.matrix).all(axis=1)
        self.near = bool(self.lengths.max() <= LONGEST)
        self.single = self.matrix.astype(np.float32) if self.near else None

    def scores(self, taken, block: Items) -> np.ndarray:
        """Rounded scores (users × items)."""
        return scores_of(self.matrix[taken], block.matrix, block.biases)

    def near_scores(self, taken, block: Items) -> tuple[np.ndarray, np.ndarray]:
        """Scores in single precision, columns filled up with -inf to a multiple of 8, and how far each user's may lie from the rounded ones.

        A sum of d products, in any order, lies within (d + 2) 2^-24 of |u| |i|, and the conversions of
        factors, bias and thresholds add a few such parts.
        """
        n, dims = block.matrix.shape
        wide = np.zeros((-(-n // 8) * 8, dims), np.float32)
        wide[:n] = block.matrix
        biases = np.full(len(wide), -np.inf, np.float32)
        biases[:n] = block.biases
        scores = self.single[taken] @ wide.T
        scores += biases
        return scores, (dims + 10) * 2.0**-24 * (self.lengths[taken] * block.longest + block.bias) + 2 * 10.0**-SCORE_DIGITS

    def of_pairs(self, rows: np.ndarray, cols: np.ndarray, block: Items) -> np.ndarray:
        """Rounded scores of single pairs."""
        return np.round(np.einsum("ij,ij->i", self.matrix[rows], block.matrix[cols]) + block.biases[cols], SCORE_DIGITS)


def scores_of(u: np.ndarray, i: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """Rounded score matrix (users × items)."""
    scores = u @ i.T
    scores += biases
    return np.round(scores, SCORE_DIGITS, out=scores)


class Reducer(ABC):
    """What is kept of a user block while it meets the item blocks of a cell.

    ``flat_together``: the flat blocks of a cell come as one, in place of the first of them.
    """

    flat_together = False

    @abstractmethod
    def __init__(self, row): ...

    @abstractmethod
    def add(self, row) -> None:
        """Take one more item block, as a row or as ``Items``."""

    @abstractmethod
    def result(self) -> pd.DataFrame: ...


def map_blocks(joined: DataFrame, schema: str, reducer: type[Reducer]) -> DataFrame:
    """Reduce the rows of ``meet(…, once=True)``; a user block's rows of one cell follow each other, and leave as one result.

    A task holds the item blocks of one cell and a single user block.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, blocks, at, held, whole = None, {}, None, None, False
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.user_cell, row.item_cell) != cell:
                    cell, blocks, whole = (row.user_cell, row.item_cell), {}, not reducer.flat_together
                if row.user_block == HEAD:
                    blocks[row.item_block] = Items(row)
                    continue
                if row.item_block == HEAD:
                    if held is not None:
                        yield held.result()
                    at, held = (*cell, row.user_block), reducer(row)
                    continue
                if at != (*cell, row.user_block):
                    raise RuntimeError("a user block came without its vectors")
                if not whole:
                    whole, flat = True, [b for b in blocks.values() if b.flat]
                    blocks |= {b.item_block: None for b in flat}
                    if flat:
                        blocks[flat[0].item_block] = Items.together(flat)
                if (block := blocks[row.item_block]) is not None:
                    held.add(block)
        if held is not None:
            yield held.result()

    return joined.mapInPandas(run, schema)
