"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readflow.llm.texts import broadcast_if_small
from readflow.session import materialize

BITS, TABLES = 64, 4
SUB = BITS // TABLES  # bits of a substring
_MASK = np.uint64((1 << SUB) - 1)
#: The rotations are learned on at most about so many vectors, and so many numbers in all.
SAMPLE, SAMPLE_NUMBERS = 20_000, 4_000_000
ROUNDS = 30  # of alternating between codes and rotation
#: Queries whose neighbours are looked up among all rows, to see how far their codes are apart.
PILOTS = 64
#: Share of the pilots' neighbours that the Hamming radius must hold.
RECALL = 0.999
#: Numbers (rows times dimension) that a cell of the index holds on average.
CELL = 1 << 20
SEED = 20240311


def learn_rotation(sample: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, matrix): columns of the matrix give the bits of a centred row by their sign.

    The principal directions of the sample are rotated so that rows lie as close to the corners of
    the cube as they can: codes and rotation are improved in turn. With fewer directions than bits,
    further rotations from other starts give the rest.
    """
    mean = sample.mean(0)
    centred = sample - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    directions = directions[:, ::-1][:, :bits]
    flat, width, out = centred @ directions, directions.shape[1], []
    for turn in range(-(-bits // width)):
        rotation, _ = np.linalg.qr(np.random.default_rng([SEED, width, turn]).standard_normal((width, width)))
        for _ in range(ROUNDS):
            corners = np.where(flat @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(flat.T @ corners)
            rotation = u @ v
        out.append(directions @ rotation)
    return mean, np.concatenate(out, 1)[:, :bits]


def lifted(vectors: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Rows with one more component, so that the nearest by angle is the one with the largest inner product.

    A stored vector, divided by the ``longest`` length, is filled up to length 1; a query has length 1 and 0 there.
    """
    large = np.abs(vectors).max(1, keepdims=True)
    units = vectors / large
    norms = np.sqrt((units * units).sum(1, keepdims=True))
    units = units / norms
    share = np.ones_like(norms) if query else np.minimum(norms * (large / longest), 1.0)
    return np.concatenate((units * share, np.sqrt(1 - share * share)), 1)


def codes_of(rows: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The codes of lifted rows as unsigned 64-bit numbers."""
    mean, matrix = model
    bits = (rows - mean) @ matrix > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def table_radii(radius: int, tables: int = TABLES) -> list[int]:
    """Per table how far substrings may be apart (-1: the table is not needed), so that codes within ``radius`` meet in some table.

    If every substring were farther apart than that, the whole codes would be: the first ``radius % tables + 1``
    tables allow ``radius // tables``, the others one less.
    """
    each, rest = divmod(radius, tables)
    return [each if t <= rest else each - 1 for t in range(tables)]


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products summed in the order of the components, so that equal vectors have equal scores wherever they lie."""
    return np.cumsum(rows * query, 1)[:, -1]


def best_of(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the ``k`` best different ids, by score and then id; ``rough`` holds inner products to within rounding."""
    slack = 1e-9 * (np.abs(rough).max() if len(rough) else 0.0)
    take = k
    while True:
        if len(rough) > take:
            some = np.flatnonzero(rough >= np.partition(rough, len(rough) - take)[len(rough) - take] - slack)
        else:
            some = np.arange(len(rough))
        scores = _exact(query, vectors[some])
        order = np.lexsort((ids[some], -scores))
        _, first = np.unique(ids[some][order], return_index=True)
        if len(first) >= k or len(some) == len(rough):
            order = order[np.sort(first)[:k]]
            return some[order], scores[order]
        take *= 4


class CellIndex:
    """The rows of one cell of one table: ids, codes and vectors."""

    def __init__(self, table: int, radii: list[int], radius: int, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray):
        self.table, self.radii, self.radius = table, radii, radius
        self.ids, self.codes, self.vectors = ids, codes, vectors

    def within(self, codes: np.ndarray) -> np.ndarray:
        """Which rows each query finds here: substring and code are near enough, and no earlier table has found the row already."""
        differ = codes[:, None] ^ self.codes[None, :]
        found = np.bitwise_count(differ) <= self.radius
        for t in range(self.table + 1):
            near = np.bitwise_count((differ >> np.uint64(SUB * t)) & _MASK).astype(np.int8) <= self.radii[t]
            found &= near if t == self.table else ~near
        return found

    def search(self, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query ids, row ids, scores): per query the ``k`` best of the rows it finds here."""
        step = max(1, 1_000_000 // max(1, len(self.ids)))
        for first in range(0, len(ids), step):
            some = slice(first, first + step)
            found = self.within(codes[some]) & (ids[some][:, None] != self.ids[None, :])
            rough = vectors[some] @ self.vectors.T
            for q in np.flatnonzero(found.any(1)):
                own = np.flatnonzero(found[q])
                places, scores = best_of(vectors[first + q], self.ids[own], self.vectors[own] if len(own) < len(self.ids) else self.vectors, rough[q, own], k)
                yield np.full(len(places), ids[first + q]), self.ids[own][places], scores


FOUND = "query_id bigint, vec_id bigint, score double"


def _search_cells(batches: Iterator[pa.RecordBatch], radii: list[int], radius: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell, stored rows before queries: (t, dim, cell, part, asks, id, code, v)."""
    cell, held, index = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1 if len(keys) else []
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            if a == b:
                continue
            t, dim, *_, asks = keys[a].tolist()
            if (here := tuple(keys[a, :4].tolist())) != cell:
                cell, held, index = here, [], None
            ids = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False)
            codes = batch.column(6).slice(a, b - a).to_numpy(zero_copy_only=False).view(np.uint64)
            own = (ids, codes, _vectors(batch.column(7).slice(a, b - a), dim))
            if not asks:
                held.append(own)
            elif held or index:
                if index is None:
                    index, held = CellIndex(t, radii, radius, *(np.concatenate(x) for x in zip(*held))), []
                out.extend(index.search(*own, k))
        if out:
            columns = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])


def usable(rows: DataFrame, key: str, vector: str, asks: Column) -> DataFrame:
    """(id, v, dim, asks) of the rows that can take part: key and vector not null, components finite, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(fine).select(
        F.col(key).cast("bigint").alias("id"), v.alias("v"), F.size(v).alias("dim"), F.coalesce(asks, F.lit(False)).alias("asks"))


def length(v: Column) -> Column:
    """The length of a vector; large and small components do not overflow."""
    large = F.array_max(F.transform(v, lambda x: F.abs(x).cast("double")))
    return large * F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x / large) * (x / large)))


def coded(rows: DataFrame) -> DataFrame:
    """``usable`` rows with their ``code``, by rotations learned on a bounded sample: one per dimension that the sample
    holds 100 times or more, random ones for others. Written once."""
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("d"), F.max(length(F.col("v"))).alias("longest")).first()
    longest = min(counts["longest"] or 1.0, np.finfo(np.float64).max)
    wanted = max(100, min(SAMPLE, SAMPLE_NUMBERS // max(counts["d"] or 1, 1)))
    picked = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted / max(counts["n"], 1)))
    by_dim: dict[int, list] = {}
    for r in rows.filter(picked).select("v", "dim").limit(wanted + wanted // 4).toLocalIterator():
        by_dim.setdefault(r["dim"], []).append(r["v"])
    models = {d: learn_rotation(lifted(np.array(vs, np.float64), longest, False)) for d, vs in by_dim.items() if len(vs) >= 100}

    def model_of(dim: int) -> tuple[np.ndarray, np.ndarray]:
        if dim not in models:
            return np.zeros(dim + 1), np.random.default_rng([SEED, dim]).standard_normal((dim + 1, BITS))
        return models[dim]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            codes = np.zeros(len(dims), np.uint64)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                vectors = _vectors(batch.column(1).take(pa.array(own)), int(d))
                for query in (False, True):
                    some = asks[own].astype(bool) == query
                    if some.any():
                        codes[own[some]] = codes_of(lifted(vectors[some], longest, query), model_of(int(d)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.view(np.int64))], names=[*batch.schema.names, "code"])

    # a query is also a row that others may find, with another code
    sides = rows.withColumn("asks", F.explode(F.when(F.col("asks"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    kind = rows.schema["v"].dataType.simpleString()
    return materialize(sides.mapInArrow(encode, f"id bigint, v {kind}, dim int, asks boolean, code bigint"), "codes")


def pilot_radius(codes: DataFrame, k: int, recall: float = RECALL, pilots: int = PILOTS) -> int:
    """The Hamming radius that holds ``recall`` of the true neighbours of some queries, each compared with every row."""
    order = F.xxhash64(F.lit(SEED), "id")
    asked = codes.filter("asks").orderBy(order, "id", "code").limit(pilots).select("id", "dim", "code", "v").collect()
    if not asked:
        return 0

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, dims, code = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            for d in {r["dim"] for r in asked} & set(dims.tolist()):
                own = np.flatnonzero(dims == d)
                vectors = _vectors(batch.column(3).take(pa.array(own)), d)
                for p, r in enumerate(asked):
                    if r["dim"] == d:
                        apart = np.bitwise_count(code[own].view(np.uint64) ^ np.uint64(r["code"] & ((1 << 64) - 1)))
                        rows = np.stack([_exact(np.array(r["v"], np.float64), vectors), ids[own].astype(np.float64), apart.astype(np.float64)], 1)
                        rows = np.concatenate([rows[ids[own] != r["id"]], best.get(p, np.empty((0, 3)))])
                        best[p] = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:k]]
        for p, rows in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), p, np.int32)), pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int64)), pa.array(rows[:, 2].astype(np.int32))],
                names=["p", "score", "id", "apart"])

    found = codes.filter("not asks").select("id", "dim", "code", "v").mapInArrow(compare, "p int, score double, id bigint, apart int")
    ranked = found.withColumn("r", F.row_number().over(W.partitionBy("p").orderBy(F.desc("score"), "id"))).filter(F.col("r") <= k)
    apart = sorted(r["apart"] for r in ranked.select("apart").collect())  # at most pilots * k
    return apart[math.ceil(recall * len(apart)) - 1] if apart else BITS


def search(codes: DataFrame, asking: DataFrame, radius: int, k: int, cell: int = CELL) -> DataFrame:
    """(query_id, vec_id, score): for the queries ``asking`` the ``k`` best of all rows whose codes lie within ``radius``.

    The codes are cut into ``TABLES`` substrings, each with an index of its own: cells by the first bits of
    the substring, so many that a cell holds ``cell`` numbers on average. A query probes the cells within
    the table's radius; in a cell it takes the rows whose substring and code are near enough. A cell of
    twice as many rows or more is cut into parts that are probed alike. Each row is reranked once,
    by its vector.
    """
    radii = table_radii(radius)
    stored = codes.filter("not asks")
    numbers = stored.agg(F.sum("dim")).first()[0] or 0
    bits = min(SUB, max(0, math.ceil(math.log2(max(numbers, 1) / cell))))
    used = [t for t in range(TABLES) if radii[t] >= 0]

    own_cell = F.expr(f"cast(shiftrightunsigned(code, t * {SUB} + {SUB - bits}) & {(1 << bits) - 1} as int)")
    homes = stored.withColumn("t", F.explode(F.array(*[F.lit(t) for t in used]))).withColumn("cell", own_cell)
    sizes = homes.groupBy("t", "dim", "cell").agg(F.ceil(F.sum("dim") / (2 * cell)).cast("int").alias("parts"))
    sizes = broadcast_if_small(sizes, "code-cells")
    spread = F.pmod(F.xxhash64("id", "code", "v"), F.col("parts")).cast("int")
    homes = homes.join(sizes, ["t", "dim", "cell"]).select("t", "dim", "cell", spread.alias("part"), F.lit(False).alias("asks"), "id", "code", "v")
    every = F.sequence(F.lit(0), F.lit((1 << bits) - 1))
    probes = None
    for t in used:
        masks = F.filter(every, lambda m: F.bit_count(m) <= radii[t])
        own = asking.withColumn("t", F.lit(t)).withColumn("cell", own_cell)
        own = own.withColumn("cell", F.explode(F.transform(masks, lambda m: F.col("cell").bitwiseXOR(m))))
        probes = own if probes is None else probes.unionByName(own)
    probes = probes.join(sizes, ["t", "dim", "cell"]).select(
        "t", "dim", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "id", "code", "v")
    keys = ["t", "dim", "cell", "part"]
    placed = homes.unionByName(probes).repartition(*keys).sortWithinPartitions(*keys, "asks")
    found = placed.mapInArrow(lambda b: _search_cells(b, radii, radius, k), FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, asks: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL, cell: int = CELL) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` rows with the largest inner product found for every row that ``asks``.

    Every row but those of the query's own key is a candidate, in double precision; ties go to the smaller
    key. Only vectors of one length are compared; vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do null keys. Rows that share a key are one item, whose
    score is its best. A query finds all codes within a radius set by ``pilot_radius``; queries that
    find fewer than ``k`` rows search on with larger radii until they have them or have seen all
    there are. An empty table gives an empty one. Other columns are not read.
    """
    codes = coded(usable(rows, key, vector, asks))
    asking = codes.filter("asks")
    radius, found = pilot_radius(codes, k, recall), None
    there = codes.filter("not asks").groupBy("dim").agg(F.count_distinct("id").alias("there"))
    while True:
        own = materialize(search(codes, asking, radius, k, cell), "nearest")
        found = own if found is None else found.join(asking.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(own)
        if radius >= BITS:
            return found
        met = own.groupBy("query_id").agg(F.count(F.lit(1)).alias("met"))
        short = asking.join(met, F.col("id") == F.col("query_id"), "left").join(there, "dim")
        short = short.filter(F.coalesce("met", F.lit(0)) < F.least(F.lit(k), F.col("there") - 1)).select(*asking.columns)
        asking = materialize(short, "short")
        if asking.isEmpty():
            return found
        radius = min(BITS, radius + max(1, (BITS - radius + 1) // 2)) if radius < BITS - 4 else BITS
