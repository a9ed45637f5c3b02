"""Blocks that meet: what travels, in which order, and scores in single precision against plain ones."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from readflow.operators import blocks, evaluate, recommend
from readflow.plans import catalog
from readflow.session import materialize, scratch


def model(spark, n_users=30, n_items=90):
    vector = F.array(F.col("id") % 7 - 3.0, F.sin("id"), F.cos("id") * 2)
    users = spark.range(n_users).select(F.col("id").cast("string").alias("user_id"), vector.alias("factors"), F.lit(0.0).alias("bias"))
    items = spark.range(n_items).select(F.concat(F.lit("p"), "id").alias("page"), vector.alias("factors"), (F.col("id") % 5 * 0.1).alias("bias"))
    return materialize(users, "users"), materialize(items, "items")


@pytest.mark.parametrize("cell", [512, 2])
def test_vectors_travel_once_per_cell(spark, monkeypatch, cell):
    """Rows of two blocks hold no vectors; a user block meets its items in order, long vectors first, and both come before."""
    monkeypatch.setattr(blocks, "CELL", cell)
    users, items = model(spark)
    sides = blocks.user_blocks(users.withColumn("n", F.lit(3)), {"n": "wanted"}, rows=8), blocks.item_blocks(items, 8, by_norm=True)
    n_users, n_items = (side.df.count() for side in sides)
    rows = blocks.meet(*sides, once=True).withColumn("part", F.spark_partition_id()).collect()
    cells = {(r.user_cell, r.item_cell) for r in rows}
    assert sum(r.user_matrix is not None for r in rows) == n_users * len({c for _, c in cells})
    assert sum(r.item_matrix is not None for r in rows) == n_items * len({c for c, _ in cells})
    assert sum(r.user_matrix is r.item_matrix is None for r in rows) == n_users * n_items
    for part in {r.part for r in rows}:
        places = [(r.user_cell, r.item_cell, r.user_block, r.item_block) for r in rows if r.part == part]
        assert places == sorted(places)


def test_item_blocks_are_met_in_their_order(spark):
    """Long vectors fill the lists first, so that blocks of short ones can be passed over."""
    users, items = model(spark, n_items=400)
    met = blocks.meet(blocks.user_blocks(users, {}, rows=8), blocks.item_blocks(items, 8, by_norm=True))
    rows = [(r.part, r.user_cell, r.item_cell, r.user_block, r.item_block) for r in met.withColumn("part", F.spark_partition_id()).collect()]
    assert rows == sorted(rows)


def unit(rng, n, d):
    x = rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1)[:, None]


def item_rows(vectors, size, biases):
    return [SimpleNamespace(item_block=k // size, pages=[f"p{j:05}" for j in range(k, min(k + size, len(vectors)))], item_matrix=vectors[k : k + size].ravel(), biases=biases[k : k + size])
            for k in range(0, len(vectors), size)]


@pytest.mark.parametrize("scale", [1.0, 1e-7, 1e9, 1e14])
@pytest.mark.parametrize("positives", [3, 60])
def test_ranks_in_single_precision_are_those_of_double(scale, positives):
    """Copies of items and items that differ in the last digits tell nothing apart in single precision."""
    rng = np.random.default_rng(positives)
    items = unit(rng, 700, 24)
    items[300:400] = items[:100]
    items[400:500] = items[:100] + 3e-9 * rng.standard_normal((100, 24))
    u, biases = unit(rng, 40, 24) * scale, np.repeat([0.0, 0.25], 350) * scale
    scores = np.round(u @ items.T + biases, 9)
    own = [scores[k, rng.integers(0, 700, rng.integers(1, positives + 1))] for k in range(40)]
    held = evaluate._Reached(SimpleNamespace(users=[str(k) for k in range(40)], user_matrix=u.ravel(), own_scores=own, chunks=[0] * 40))
    for row in item_rows(items, 101, biases):
        held.add(row)
    exact = np.concatenate([np.round(np.einsum("j,ij->i", u[k], items) + biases, 9) for k in range(40) for _ in own[k]]).reshape(-1, 700)
    wanted = np.concatenate(own)[:, None]
    least, most = (((exact + d * (1e-9 + 1e-15 * scale)) >= wanted).sum(1) for d in (-1.5, 1.5))  # two sums may round to neighbours
    assert ((least <= held.reached) & (held.reached <= most)).all() and (scale != 1 or np.median(most - least) <= 2)


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e14])
@pytest.mark.parametrize("kind", ["_Best", "_BestRaw"])
def test_best_in_single_precision_are_those_of_double(kind, scale):
    rng = np.random.default_rng(5)
    items = np.round(unit(rng, 1500, 16), 3)  # scores with few digits: sums in any order round alike
    items[700:760] = items[:60]
    u = np.round(unit(rng, 50, 16), 3) * scale
    biases = np.repeat([0.0, 0.125, 0.0], 500) * scale
    scores = np.round(u @ items.T + biases, 9)
    seen = [SimpleNamespace(u=int(k), i=int(i) % 128, item_block=int(i) // 128) for k in range(50) for i in np.argsort(-scores[k])[:4]]
    held = getattr(recommend, kind)(SimpleNamespace(users=[str(k) for k in range(50)], user_matrix=u.ravel(), wanted=[7] * 50, seen=[vars(s) for s in seen]))
    for row in item_rows(items, 128, biases):
        held.add(row)
    out = held.result()
    for k in range(50):
        gone = {s.item_block * 128 + s.i for s in seen if s.u == k}
        want = sorted((-s, f"p{j:05}") for j, s in enumerate(scores[k]) if j not in gone)[:7]
        mine = out[out.user_id == str(k)]
        assert np.allclose(-mine.raw, [s for s, _ in want], rtol=1e-14, atol=1e-9) and (scale > 1 or list(mine.page) == [p for _, p in want])
        assert kind == "_BestRaw" or (np.isclose(mine.lo, scores[k].min(), rtol=1e-14).all() and np.isclose(mine.hi, scores[k].max(), rtol=1e-14).all())


def test_both_runs_rank_their_pairs_together(spark, sf, monkeypatch):
    """Two runs of one model need one ranking: a pair's rank does not depend on what else is held out."""
    ranked, plain = [], evaluate.rank_positives
    monkeypatch.setattr(evaluate, "rank_positives", lambda *a: ranked.append(plain(*a)) or ranked[-1])
    with scratch(spark):
        runs = catalog.QUERIES["monitoring_runs"](spark, sf)
        assert len(ranked) == 1 and runs.count() == 2


def test_flat_blocks_come_as_one():
    """Items without a vector score alike for all users: a cell of them costs a user block one step, not one a block."""
    rng = np.random.default_rng(3)
    pages, biases = [f"p{k}" for k in rng.permutation(900)], rng.integers(0, 3, 900) / 4
    rows = [SimpleNamespace(item_block=k // 100, pages=sorted(pages[k : k + 100]), item_matrix=np.zeros(400), biases=biases[k : k + 100]) for k in range(0, 900, 100)]
    seen = [{"u": 3, "i": i, "item_block": b} for b in range(9) for i in range(0, 100, 2)]
    users = SimpleNamespace(users=[str(k) for k in range(20)], user_matrix=rng.standard_normal(80), wanted=[5] * 19 + [2], seen=seen)
    whole = blocks.Items.together([blocks.Items(r) for r in rows])
    assert whole.flat and list(whole.pages) == sorted(pages) and all(whole.pages[whole.places[r.item_block][7]] == r.pages[7] for r in rows)
    one, each = recommend._Best(users), recommend._Best(users)
    one.add(whole)
    for row in rows:
        each.add(row)
    out = one.result()
    assert out.equals(each.result())
    for u in (0, 3, 19):
        items = [(-b, p) for r in rows for i, (p, b) in enumerate(zip(r.pages, r.biases)) if u != 3 or i % 2]
        assert [(-s, p) for p, s in zip(out.page[out.user_id == str(u)], out.raw[out.user_id == str(u)])] == sorted(items)[: users.wanted[u]]


def test_a_task_meets_flat_blocks_once(spark):
    steps = spark.sparkContext.accumulator(0)

    class Counting(recommend._Best):
        def add(self, row):
            steps.add(1)
            super().add(row)

    users, items = model(spark)
    items = items.withColumn("factors", F.when(F.col("page") < "p2", F.col("factors")).otherwise(F.array_repeat(F.lit(0.0), 3)))
    sides = blocks.user_blocks(users.withColumn("n", F.lit(3)), {"n": "wanted"}, rows=8), blocks.item_blocks(items, 8, by_norm=True)
    found = blocks.map_blocks(blocks.meet(*sides, once=True), "user_id string, page string, raw double, lo double, hi double, n int", Counting)
    assert found.count() == 3 * 30
    with_vectors = sum(any(r.item_matrix) for r in sides[1].df.collect())
    assert steps.value == sides[0].df.count() * (with_vectors + 1) < sides[0].df.count() * sides[1].df.count()


def test_more_cells_of_items_ask_for_fewer_of_users(spark, monkeypatch):
    """User blocks pass through a task one by one: what memory holds bounds the items' side, and does not multiply their copies."""
    users, items = model(spark, n_users=64, n_items=160)
    monkeypatch.setattr(blocks, "CELL_WORK", 1.0)

    def cells(size):
        monkeypatch.setattr(blocks, "CELL_BYTES", size * blocks.ROWS_PER_BLOCK * 8 * 3)
        met = blocks.meet(blocks.user_blocks(users, {}, rows=4), blocks.item_blocks(items, rows=2))
        rows = met.select("user_cell", "item_cell").distinct().collect()
        return len({r.user_cell for r in rows}), len({r.item_cell for r in rows})

    assert cells(100) == (4, 16) and cells(2) == (2, 40) and cells(1)[0] == 1
