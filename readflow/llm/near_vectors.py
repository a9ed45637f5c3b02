"""Embedding near-duplicates by collision counting over one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from readflow.llm.graph import components
from readflow.session import materialize

COSINE = 0.9
CELL = 1024  # vectors that a cell holds on average
MAX_CELL = 4096  # vectors a cell may hold before it is cut into parts that meet pair by pair
SAMPLE = 20_000  # vectors, at most about, whose medians place the cuts
PILOTS = 256  # directions in which the sample's spread around the medians is measured
CROWDED = 0.95  # share of the sampled vectors of a dimension whose neighbours are parted no more often than planned for
SPILL = 0.15  # half-width of the window that a vector keeps around itself at a cut
PROJECTIONS, WINDOW = 32, 0.6  # projections counted in a cell, and the half-width of a window
TABLE_RECALL, COUNT_RECALL = 0.97, 0.995  # chances that a pair at the threshold is met in a cell, and passes the count
PLAIN_RANGE = (1e-60, 1e60)  # largest components whose squares, and products of squares, are doubles
SEED = 20240229


def _gap(cosine: float) -> float:
    """Standard deviation of the difference of two unit vectors' projections on a standard normal direction."""
    return math.sqrt(2 - 2 * cosine)


def table_plan(vectors: int, cosine: float = COSINE, cell: int = CELL, parted: float = 0.0) -> tuple[int, int]:
    """(tables, cuts per table): cells of about ``cell`` vectors, and tables enough for ``TABLE_RECALL`` at the threshold.

    A cut parts a pair only if both windows end on their own side of it, which has a chance of about
    φ(0)·E[(|Δ| − 2·SPILL)+] for a cut at the median of vectors in all directions. ``parted`` is that
    chance as measured (``parted_chances``); it counts where it is larger, as it is for vectors that
    share a direction.
    """
    cuts = max(0, math.ceil(math.log2(max(vectors, 1) / cell)))
    s, z = _gap(cosine), 2 * SPILL / _gap(cosine)
    excess = 2 * s * (math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * 0.5 * math.erfc(z / math.sqrt(2)))
    together = (1 - max(parted, excess / math.sqrt(2 * math.pi))) ** cuts
    tables = 1 if cuts == 0 else math.ceil(math.log(1 - TABLE_RECALL) / math.log(1 - together))
    return tables, cuts


def parted_chances(leans: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Per vector (row of values less medians, a column per direction) the mean chance that a cut parts it from a partner at the threshold.

    The partner's value differs by a normal number of deviation ``_gap``, and a pair is parted if both
    lie more than ``SPILL`` from the cut, on different sides.
    """
    far = np.abs(leans)
    z = (far + SPILL) / (_gap(cosine) * math.sqrt(2))
    return np.where(far > SPILL, 0.5 * _erfc(z), 0.0).mean(1)


def _erfc(z: np.ndarray) -> np.ndarray:
    """erfc for z >= 0, to 1e-6: interpolated in a table."""
    return np.interp(z, _ERFC_AT, _ERFC, right=0.0)


_ERFC_AT = np.linspace(0, 6, 6001)
_ERFC = np.array([math.erfc(x) for x in _ERFC_AT])


def count_threshold(cosine: float = COSINE, projections: int = PROJECTIONS, window: float = WINDOW) -> int:
    """The largest count that a pair at the threshold reaches with a chance of ``COUNT_RECALL``."""
    p = math.erf(window / _gap(cosine) / math.sqrt(2))
    below, count = 0.0, 0
    while count < projections:
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > 1 - COUNT_RECALL:
            break
        count += 1
    return count


def _directions(dim: int, n: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, salt, dim]).standard_normal((dim, n))


def _unit(arrays: pa.Array, dim: int) -> np.ndarray:
    x = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cell_codes(units: np.ndarray, medians: np.ndarray, tables: int, cuts: int) -> list[list[int]]:
    """Per vector the cells it belongs to: in each table the sides of its cuts, both where its window crosses one."""
    n, dim = units.shape
    if not cuts:
        return [[0]] * n
    lean = (units @ _directions(dim, tables * cuts, 0) - medians).reshape(n, tables, cuts)
    out = []
    for own in lean:
        codes = []
        for t in range(tables):
            some = [1]
            for v in own[t]:
                sides = (0, 1) if abs(v) <= SPILL else (int(v > 0),)
                some = [2 * c + s for c in some for s in sides]
            codes += [(t << 48) + c for c in some]
        out.append(sorted(codes))
    return out


def collisions(units: np.ndarray, window: float = WINDOW, projections: int = PROJECTIONS) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts of a block of rows against all): in how many projections a vector lies in another's window.

    Each projection is sorted once; a window is then a range of ranks, and a vector is inside if its
    rank is.
    """
    n, dim = units.shape
    values = units @ _directions(dim, projections, 1)
    ranks, low, width = (np.empty((projections, n), np.uint16) for _ in range(3))
    for j in range(projections):
        order = np.argsort(values[:, j], kind="stable")
        ranks[j, order] = np.arange(n)
        ordered = values[order, j]
        low[j] = np.searchsorted(ordered, values[:, j] - window, "left")
        width[j] = np.searchsorted(ordered, values[:, j] + window, "right") - low[j]
    step = max(1, 1_000_000 // max(n, 1))
    for first in range(0, n, step):
        counts = np.zeros((min(step, n - first), n), np.uint8)
        for j in range(projections):
            counts += (ranks[j][None, :] - low[j, first : first + step, None]) < width[j, first : first + step, None]
        yield first, counts


def linked_pairs(units: np.ndarray, side: np.ndarray | None, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j that pass the count and whose cosine is ``cosine`` or more; with ``side`` only pairs between the sides."""
    least, found = count_threshold(cosine), []
    for first, counts in collisions(units):
        i, j = np.nonzero(counts >= least)
        i += first
        keep = i < j
        if side is not None:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        for part in range(0, len(i), 100_000):
            a, b = i[part : part + 100_000], j[part : part + 100_000]
            near = np.einsum("nd,nd->n", units[a], units[b]) >= cosine
            found.append((a[near], b[near]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _first_shared(codes: np.ndarray, a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the first cell that both vectors belong to; ``codes`` is sorted per row and padded with -1."""
    out = np.empty(len(a), bool)
    step = max(1, min(20_000, 16_000_000 // codes.shape[1] ** 2))
    for part in range(0, len(a), step):
        x, y = codes[a[part : part + step]], codes[b[part : part + step]]
        shared = (x[:, :, None] == y[:, None, :]).any(2) & (x >= 0)
        out[part : part + step] = np.where(shared, x, np.iinfo(np.int64).max).min(1) == cell
    return out


def _cell_links(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Per vector with links in a cell: (a: its class, cid, links: their weight, b: a class it is tied to).

    Rows come sorted by cell. A pair counts in the first cell that holds both, so that no link is
    counted twice; only one row per vector leaves the cell, however many links it has.
    """
    cell, rows = None, []

    def links():
        dim, code, i, j = cell
        part, rep, cid, weight, codes, vectors = (pa.concat_arrays([r.column(c) for r in rows]) for c in range(4, 10))
        n = len(rep)
        rep, cid, weight = (x.to_numpy() for x in (rep, cid, weight))
        side = None if i == j else (part.to_numpy() == j).astype(np.int8)
        a, b = linked_pairs(_unit(vectors, dim), side, cosine)
        held = codes.to_pylist()
        padded = np.full((n, max(map(len, held))), -1, np.int64)
        for k, own in enumerate(held):
            padded[k, : len(own)] = own
        mine = _first_shared(padded, a, b, code) if len(a) else np.empty(0, bool)
        a, b = a[mine], b[mine]
        sums = np.zeros(n, np.int64)
        np.add.at(sums, a, weight[b])
        np.add.at(sums, b, weight[a])
        tie = np.arange(n)
        np.minimum.at(tie, b, a)  # every vector but the first of its ties points to an earlier one
        some = np.flatnonzero(sums > 0)
        ends = [(rep[some], cid[some], sums[some], rep[tie[some]])]
        more = np.flatnonzero(tie[b] != a)  # links that the single pointers miss: spanned by a local search
        if len(more):
            root = tie.copy()
            while (root != root[root]).any():
                root = root[root]
            extra = []
            for x, y in zip(a[more].tolist(), b[more].tolist()):
                p, q = root[x], root[y]
                if p != q:
                    root[root == max(p, q)] = min(p, q)
                    extra.append((x, y))
            if extra:
                x, y = np.array(extra).T
                ends.append((rep[x], cid[x], np.zeros(len(x), np.int64), rep[y]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*ends)], names=["a", "cid", "links", "b"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in range(4))))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != cell:
                if rows and sum(r.num_rows for r in rows) > 1:
                    yield links()
                cell, rows = keys[at], []
            rows.append(batch.slice(at, end - at))
            at = end
    if rows and sum(r.num_rows for r in rows) > 1:
        yield links()


def in_range(v: Column) -> Column:
    """``v`` where it has a direction, null where it is empty or zero or holds null or non-finite components.

    Squares of components beyond some 1e154 leave the doubles, and those below 1e-162 vanish. Vectors
    whose largest component lies outside ``PLAIN_RANGE`` are divided by the power of two below it,
    which loses no digit of the components that count.
    """
    sizes = F.transform(v, lambda x: F.abs(x))
    whole = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    peak = F.array_max(sizes)
    plain = peak.between(*PLAIN_RANGE)
    # Two factors: the inverse of a subnormal power of two is no double.
    half = F.floor(F.log2(peak) / 2)
    rest = F.floor(F.log2(peak)) - half
    scaled = F.transform(v, lambda x: x * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), -rest))
    return F.when(whole & (peak > 0), F.when(plain, v).otherwise(scaled))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """Per vector: key (bigint), n_links, component_id, kept.

    1. Equal vectors are one class with a weight.
    2. Cells: each table cuts the classes at the medians of a few projections (from a bounded sample;
       all classes are placed). A class whose window around its own value crosses a cut goes to both
       sides. The number of cuts follows the number of classes, the number of tables follows from
       the recall wanted and from how crowded the sample is around its medians (``table_plan``). A cell of more than ``MAX_CELL`` classes is cut into parts
       by hash, and every pair of parts is compared, so a cluster is never cut short.
    3. In a cell, many projections are sorted, collisions in query-centred windows are counted per
       pair, and pairs that reach the calibrated count are verified by their cosine in doubles.

    Links may be missed with a small chance (by design below 5 % at the threshold itself, less for
    closer pairs); none is reported below it. With one cell per table nothing is cut. Vectors that
    are null, empty, zero, or hold null or non-finite components (``in_range``), and rows with a null key link
    with nothing: 0 links, their own key as component. Vectors of different dimensions never
    link. Repeated rows are vectors of their own that share a key. Other columns are not read.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(F.col("id").isNotNull(), in_range(F.col("v"))))
    classes = rows.filter(F.col("v").isNotNull()).groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = materialize(classes.select("rep", F.xxhash64("v").alias("cid"), "weight", F.size("v").alias("dim"), "v"), "vector-classes")
    total = classes.count()
    tables, cuts = table_plan(total, cosine, cell)
    spark = vectors.sparkSession
    medians: dict[int, np.ndarray] = {}
    if cuts:
        chosen = classes.filter(F.pmod(F.xxhash64(F.lit(SEED), "cid"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / total))))
        chosen = materialize(chosen.select("dim", "v"), "vector-sample")
        centre = _medians(chosen, PILOTS, 2)
        chances = chosen.mapInArrow(lambda b: _parted(b, centre, cosine), "dim int, parted double")
        crowded = chances.groupBy("dim").agg(F.percentile("parted", F.lit(CROWDED)).alias("p")).agg(F.max("p").alias("p")).first()["p"]
        tables, cuts = table_plan(total, cosine, cell, crowded or 0.0)
        medians = _medians(chosen, tables * cuts, 0)
    placed = classes.mapInArrow(
        lambda b: _placed(b, medians, tables, cuts), "dim int, rep bigint, cid bigint, weight bigint, codes array<bigint>, v array<double>")
    placed = placed.withColumn("code", F.explode("codes"))
    sizes = placed.groupBy("dim", "code").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    sizes = materialize(sizes.select("dim", "code", F.ceil(F.col("m") / MAX_CELL).cast("int").alias("c")), "cell-sizes")
    cells = placed.join(sizes, ["dim", "code"]).withColumn("part", F.pmod("cid", F.col("c")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    cells = cells.select("dim", "code", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep", "cid", "weight", "codes", "v")
    cells = cells.repartition("dim", "code", "i", "j").sortWithinPartitions("dim", "code", "i", "j", "cid")
    links = materialize(cells.mapInArrow(lambda b: _cell_links(b, cosine), "a bigint, cid bigint, links bigint, b bigint"), "vector-links")
    counted = links.groupBy(F.col("a").alias("rep"), "cid").agg(F.sum("links").alias("near"))
    same = rows.filter(F.col("v").isNotNull()).join(classes.filter("weight > 1").select("v", "rep"), "v").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    tied = components(links.select("a", "b").unionByName(same))
    per_class = classes.select("v", "rep", "cid", "weight").join(counted, ["rep", "cid"], "left").select("v", (F.col("weight") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    linked = rows.filter(F.col("v").isNotNull()).join(per_class, "v").select("id", "n_links")
    alone = rows.filter(F.col("v").isNull()).select("id", F.lit(0).cast("bigint").alias("n_links"))
    return (
        linked.unionByName(alone).join(tied, F.col("id") == F.col("node"), "left")
        .select(F.col("id").alias(key), "n_links", F.coalesce("root", "id").alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(dims == dim)))


def _medians(sample: DataFrame, n: int, salt: int) -> dict[int, np.ndarray]:
    """Per dimension the medians of the sample in ``n`` directions."""
    values = sample.mapInArrow(lambda b: _projected(b, n, salt), "dim int, p array<double>")
    middle = values.select("dim", F.posexplode("p").alias("at", "x")).groupBy("dim", "at").agg(F.median("x").alias("m"))
    out: dict[int, np.ndarray] = {}
    for r in middle.collect():  # one row per dimension and direction
        out.setdefault(r["dim"], np.zeros(n))[r["at"]] = r["m"]
    return out


def _parted(batches: Iterator[pa.RecordBatch], centre: dict[int, np.ndarray], cosine: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, own in _by_dim(batch):
            leans = _unit(own.column("v"), dim) @ _directions(dim, PILOTS, 2) - centre[dim]
            yield pa.RecordBatch.from_arrays([own.column("dim"), pa.array(parted_chances(leans, cosine))], names=["dim", "parted"])


def _projected(batches: Iterator[pa.RecordBatch], n: int, salt: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, own in _by_dim(batch):
            values = _unit(own.column("v"), dim) @ _directions(dim, n, salt)
            yield pa.RecordBatch.from_arrays([own.column("dim"), pa.array(values.tolist(), pa.list_(pa.float64()))], names=["dim", "p"])


def _placed(batches: Iterator[pa.RecordBatch], medians: dict[int, np.ndarray], tables: int, cuts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, own in _by_dim(batch):
            codes = cell_codes(_unit(own.column("v"), dim), medians.get(dim, np.zeros(tables * cuts)), tables, cuts)
            names = ("dim", "rep", "cid", "weight", "codes", "v")
            columns = {n: own.column(n) for n in names if n != "codes"} | {"codes": pa.array(codes, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=list(names))
