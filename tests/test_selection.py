"""Radix selection against a plain sort; what a row may gather."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readflow.operators import blocks, distributions, recommend, scaling, selection
from readflow.session import materialize

DOUBLES = [-math.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 1.0, math.nextafter(1.0, 2.0), 1e300, math.inf]


def values(spark, xs, kind, **how):
    return selection.stored_values(spark.createDataFrame([(x,) for x in xs], f"x {kind}"), "x", **how)


@pytest.mark.parametrize("counted, digit", [(True, 12), (False, 3)])
def test_every_rank(spark, counted, digit, monkeypatch):
    monkeypatch.setattr(selection, "DIGIT", digit)  # three bits: many rounds
    rng = random.Random(5)
    longs = [rng.choice([-(1 << 63), (1 << 63) - 1, -1, 0, 1, 4095, 4096, rng.getrandbits(62)]) for _ in range(60)] + [None]
    doubles = DOUBLES * 3 + [rng.gauss(0, 1) for _ in range(40)] + [None]
    for xs, kind in ((longs, "bigint"), (doubles, "double")):
        want = sorted(x for x in xs if x is not None)
        found = selection.select_ranks(values(spark, xs, kind, counted=counted), list(range(len(want))))
        assert [found[i] for i in range(len(want))] == [float(x) for x in want]


def test_not_a_number_comes_last(spark):
    found = selection.select_ranks(values(spark, [math.nan, 3.0, math.inf], "double"), [0, 1, 2])
    assert found[0] == 3.0 and found[1] == math.inf and math.isnan(found[2])


def test_equal_and_no_values(spark):
    same = values(spark, [7] * 50, "int")
    assert same.table.count() == 1 and selection.select_quantiles(same, [0.0, 0.3, 1.0]) == [7.0] * 3
    empty = spark.createDataFrame([(None,)], "x double")
    assert selection.select_quantiles(selection.stored_values(empty, "x"), [0.5]) == [None]
    assert distributions.box_plot(empty, "x").count() == 0
    assert [tuple(r) for r in distributions.quantile_bins(empty, "x").collect()] == [(1, None, None, 0)]
    assert distributions.median_of(empty, "x").first()[0] is None


def test_quantiles_against_spark(spark):
    df = spark.range(20_001).select((F.pow(F.rand(3) - 0.4, 5) * 1e6).alias("x"), F.floor(F.pow(F.rand(4), 4) * 3000).alias("k"))
    df = df.persist()
    probabilities = [i / 10 for i in range(11)]
    for name in ("x", "k"):
        want = df.agg(F.percentile(name, probabilities)).first()[0]
        assert selection.select_quantiles(selection.stored_values(df, name), probabilities) == pytest.approx(want, rel=1e-12)


def test_shared_digits_are_not_counted(spark, monkeypatch):
    """Keys that differ in nine bits take one round, whatever their size and however many rows one of them has."""
    shifts, plain = [], selection.F.shiftright
    monkeypatch.setattr(selection.F, "shiftright", lambda c, n: shifts.append(n) or plain(c, n))
    monkeypatch.setattr(selection, "DIGIT", 9)
    base = 10_000_000_000 >> 9 << 9
    xs = [base + 9] * 600 + [base + i for i in range(500)]
    assert selection.select_quantiles(values(spark, xs, "bigint"), [0.5]) == [base + 9.0]
    assert shifts == [9, 0]


def test_seen_pairs_stay_in_their_cell(spark, monkeypatch):
    """A user who has read everything costs a cell only that cell's pairs; none is lost."""
    monkeypatch.setattr(blocks, "CELL", 2)
    vectors = F.array(F.lit(1.0), F.lit(0.5))
    users = blocks.user_blocks(spark.range(20).select(F.col("id").cast("string").alias("user_id"), vectors.alias("factors")), {}, rows=8)
    items = blocks.item_blocks(spark.range(90).select(F.concat(F.lit("p"), "id").alias("page"), vectors.alias("factors"), F.lit(0.0).alias("bias")), rows=8)
    pairs = spark.range(90).select(F.lit("3").alias("user_id"), F.concat(F.lit("p"), "id").alias("page"))
    pairs = pairs.unionByName(spark.createDataFrame([("5", "p1"), ("5", "p1"), ("9", "unknown")], "user_id string, page string"))
    rows = blocks.meet(blocks.with_seen(users, items, pairs), items).collect()
    held = {(r.user_block, r.item_cell): r.seen for r in rows}
    assert len(rows) == len({(r.user_block, r.item_block) for r in rows}) == users.df.count() * items.df.count()
    assert all(s.item_block % 6 == cell for (_, cell), seen in held.items() for s in seen or ())
    assert sum(len(seen or ()) for seen in held.values()) == 91


def varied_model(spark, n_users=60, n_items=2_000, bias=0.0):
    """Lengths from 1 to some 10,000, and zero vectors; scores of both signs."""
    def gaussian(salt, n):
        return F.array(*[F.randn(salt + k) for k in range(n)])
    users = spark.range(n_users).repartition(2).select(F.concat(F.lit("u"), "id").alias("user_id"), gaussian(1, 8).alias("f"), "id")
    users = users.select("user_id", F.when(F.col("id") == 0, F.array_repeat(F.lit(0.0), 8)).otherwise(F.col("f")).alias("factors"), F.lit(0.0).alias("bias"))
    items = spark.range(n_items).repartition(3).select(F.concat(F.lit("p"), "id").alias("page"), gaussian(50, 8).alias("f"), "id")
    length = F.when(F.col("id") % 50 == 0, F.lit(0.0)).otherwise(F.pow(F.lit(0.99), F.col("id") % 900) * 10_000)
    items = items.select("page", F.transform("f", lambda x: x * length).alias("factors"), (bias * (F.col("id") % 7)).alias("bias"))
    return materialize(users, "users"), materialize(items, "items")


def plain_best(users, items, n, seen=()):
    u, i = users.collect(), items.collect()
    scores = np.round(np.array([r.factors for r in u]) @ np.array([r.factors for r in i]).T + np.array([r.bias for r in i]), 9)
    out = {}
    for r, own in zip(u, scores):
        kept = sorted((-s, q.page) for s, q in zip(own, i) if (r.user_id, q.page) not in seen)[:n]
        out[r.user_id] = [(p, own.min(), own.max(), -s) for s, p in kept]
    return out


@pytest.mark.parametrize("bias", [0.0, 300.0])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_the_norm_bound_changes_nothing(spark, monkeypatch, bias, threshold):
    monkeypatch.setattr(blocks.item_blocks, "__defaults__", (64, False))
    monkeypatch.setattr(blocks.user_blocks, "__defaults__", (16,))
    monkeypatch.setattr(blocks, "CELL", 8)
    users, items = varied_model(spark, bias=bias)
    seen = spark.createDataFrame([("u1", f"p{k}") for k in range(0, 2_000, 3)] + [("u2", "p1")], "user_id string, page string")
    want = plain_best(users, items, 7, {(r.user_id, r.page) for r in seen.collect()})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for scaled in (True, False):
            rows = recommend.recommend_top_n(users, items, 7, exclude_seen=seen, scaled=scaled).orderBy("user_id", "rank").collect()
            found = {}
            for r in rows:
                found.setdefault(r.user_id, []).append((r.page, r.score))
            assert {k: [p for p, _ in v] for k, v in found.items()} == {k: [p for p, *_ in v] for k, v in want.items()}
            for k, v in found.items():
                for (_, score), (_, lo, hi, raw) in zip(v, want[k]):
                    assert score == pytest.approx(raw if not scaled else 0.5 if hi == lo else (raw - lo) / (hi - lo), abs=1e-9)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kind, least", [("_Best", 0.5), ("_BestRaw", 0.5)])
def test_blocks_of_short_vectors_are_skipped(spark, kind, least):
    users, items = varied_model(spark)
    packed = blocks.user_blocks(users.filter("user_id <> 'u0'").withColumn("n", F.lit(5)), {"n": "wanted"}, rows=16)
    met = blocks.meet(packed, blocks.item_blocks(items, 64, by_norm=True)).toPandas()
    skipped = 0
    for _, own in met.sort_values(["user_block", "item_block"]).groupby("user_block"):
        held = None
        for row in own.itertuples(index=False):
            held = held or getattr(recommend, kind)(row)
            held.add(row)
        skipped += held.skipped
    assert least * len(met) < skipped < len(met)


def test_blocks_by_length(spark):
    """Every page is in one block, no block is longer than wanted by much, and lengths fall from block to block by class."""
    _, items = varied_model(spark)
    packed = blocks.item_blocks(items, 64, by_norm=True)
    rows = sorted(packed.df.collect(), key=lambda r: r.item_block)
    assert packed.shape.first().blocks >= len(rows) and sum(len(r.pages) for r in rows) == len({p for r in rows for p in r.pages}) == 2_000
    longest = [np.linalg.norm(np.array(r.item_matrix).reshape(len(r.pages), -1), axis=1).max() for r in rows]
    shortest = [np.linalg.norm(np.array(r.item_matrix).reshape(len(r.pages), -1), axis=1).min() for r in rows]
    assert all(b <= a * 2**0.25 * (1 + 1e-9) or a == 0 for a, b in zip(shortest, longest[1:]))
    none = blocks.item_blocks(items.limit(0), 64, by_norm=True)
    assert none.df.count() == 0 and none.shape.first().blocks == 1
    zero = blocks.item_blocks(items.withColumn("factors", F.array(F.lit(0.0))), 64, by_norm=True)
    assert zero.shape.first().blocks == 32 and zero.df.select(F.sum(F.size("pages"))).first()[0] == 2_000


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(scaling, "MAX_LABELS", 3)
    df = spark.createDataFrame([(x,) for x in "abcda"], "label string")
    assert scaling.label_index(df.filter("label <> 'd'"), "label").count() == 3
    with pytest.raises(Exception, match="more than 3 labels"):
        scaling.label_index(df, "label").collect()


def test_blocks_are_not_broadcast(spark):
    """Vectors alike take next to no room in files, and all of it once they are packed."""
    users, items = varied_model(spark)
    zeros = materialize(items.withColumn("factors", F.array_repeat(F.lit(0.0), 8)), "zeros")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        plan = blocks.meet(blocks.user_blocks(users, {}), blocks.item_blocks(zeros))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_ties_of_a_zero_catalogue_are_passed_over(spark):
    """Pages the model knows nothing of all score alike: few rows are held, and blocks of later pages are skipped."""
    users, items = varied_model(spark, n_users=20, n_items=1_200)
    known = F.substring("page", 2, 9).cast("int") < 3
    items = materialize(items.withColumn("factors", F.when(known, F.col("factors")).otherwise(F.array_repeat(F.lit(0.0), 8))), "mostly-zeros")
    want = plain_best(users, items, 7)
    got = {}
    for r in recommend.recommend_top_n(users, items, 7).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.page)
    assert got == {k: [p for p, *_ in v] for k, v in want.items()}
    packed = blocks.user_blocks(users.withColumn("n", F.lit(7)), {"n": "wanted"}, rows=32)
    met = blocks.meet(packed, blocks.item_blocks(items, 64, by_norm=True)).toPandas().sort_values("item_block")
    held = recommend._Best(met.iloc[0])
    for row in met.itertuples(index=False):
        held.add(row)
    assert held.skipped > 0 and len(held.rows) == 7 * 20


def test_copies_of_wide_blocks_grow_like_their_rows(spark):
    """A catalogue four times as large, of wide vectors, is cut into as many cells; the users' copies are no more."""
    def cells(n):
        side = spark.range(n * 8).select("id", F.col("id").cast("string").alias("k"), F.array_repeat(F.lit(1.0), 3_000).alias("factors"), F.lit(0.0).alias("bias"))
        users, items = materialize(side.filter("id < 16").withColumnRenamed("k", "user_id"), "users"), materialize(side.withColumnRenamed("k", "page"), "items")
        met = blocks.meet(blocks.user_blocks(users, {}, rows=8), blocks.item_blocks(items, rows=8))
        return len({r.item_cell for r in met.select("item_cell").collect()})
    assert cells(16) <= blocks.ITEM_CELLS and cells(64) <= blocks.ITEM_CELLS
