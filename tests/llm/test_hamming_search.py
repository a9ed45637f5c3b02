"""Neighbours by multi-index hashing against brute force."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from readflow.llm import hamming_search, queries


def plain(ids, vectors, asks, k=20):
    """query -> [(id, score)] by comparing with every other row, products summed in order."""
    ids, out = np.array(ids), {}
    for q in np.flatnonzero(asks):
        scores = np.cumsum(vectors * vectors[q], 1)[:, -1]
        order = np.lexsort((ids, -scores))
        out[ids[q]] = [(int(ids[i]), float(scores[i])) for i in order if ids[i] != ids[q]][:k]
    return out


def found_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def frame(spark, ids, vectors, kind="double"):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], f"vec_id long, embedding array<{kind}>").repartition(4)


def recall(found, want):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in own}) for q, own in want.items())
    return hits / sum(map(len, want.values()))


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    assert found_of(queries.QUERIES["op13_neighbours"](spark, sf)) == plain(ids, vectors, np.array(ids) % 20 == 0)


@pytest.mark.parametrize("shape", ["even", "clusters", "lengths", "copies", "few_dimensions"])
def test_recall(spark, shape):
    """Many cells and parts, more queries than pilots; every neighbour found has its exact score, in order."""
    rng = np.random.default_rng(5)
    n, d = 4000, 24
    x = rng.standard_normal((n, d))
    if shape == "clusters":
        x = x[rng.integers(0, 40, n)] + 0.3 * x
    if shape == "lengths":
        x *= rng.lognormal(0, 1, (n, 1))
    if shape == "copies":
        x[rng.random(n) < 0.35] = x[0]
    if shape == "few_dimensions":
        x = x[:, :3]
    ids = np.arange(n)
    found = found_of(hamming_search.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0, cell=1 << 12))
    want = plain(ids, x, ids % 20 == 0)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.98
    for q, own in found.items():
        assert own == sorted(own, key=lambda p: (-p[1], p[0]))
        assert all(s == float(np.cumsum(x[i] * x[q])[-1]) for i, s in own)


def test_radius_holds_less_when_asked_for_less(spark):
    """With a smaller radius the search leaves rows out, and still finds what lies within it."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((60, 32))[rng.integers(0, 60, 3000)] + 0.25 * rng.standard_normal((3000, 32))
    ids = np.arange(3000)
    codes = hamming_search.coded(hamming_search.usable(frame(spark, ids, x), "vec_id", "embedding", F.col("vec_id") % 20 == 0))
    wide, narrow = hamming_search.pilot_radius(codes, 20, 1.0), hamming_search.pilot_radius(codes, 20, 0.95)
    assert narrow <= wide < hamming_search.BITS
    code = {(r["id"], r["asks"]): r["code"] for r in codes.select("id", "asks", "code").collect()}
    apart = lambda q, i: ((code[q, True] ^ code[i, False]) & (1 << 64) - 1).bit_count()
    found = found_of(hamming_search.search(codes, codes.filter("asks"), narrow, 3000, cell=1 << 12))
    for q in ids[::20]:
        assert {i for i, _ in found.get(q, [])} == {i for i in ids if i != q and apart(q, i) <= narrow}
    assert recall({q: v[:20] for q, v in found.items()}, plain(ids, x, ids % 20 == 0)) >= 0.9


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 64), st.lists(st.integers(0, 16), min_size=4, max_size=4))
def test_pigeonhole(radius, apart):
    met = any(a <= r for a, r in zip(apart, hamming_search.table_radii(radius)))
    assert met or sum(apart) > radius


def test_odd_vectors(spark):
    """Nulls, zeros, non-finite and empty vectors, other lengths, huge and tiny ones, one key with several vectors, repeated rows."""
    rows = [(None, [1.0, 2.0]), (0, None), (20, []), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
            (120, [1.0, 1.0]), (1, [1e150, 1e150]), (2, [1e-150, 0.0]), (3, [2.0, 1.0]), (3, [1.0, 5.0]), (3, [1.0, 5.0]), (4, [1.0, 2.0, 3.0]), (140, [3.0, 2.0, 1.0]),
            (160, [4.0]), (5, [-1.0, -1.0])]
    schema = "vec_id long, embedding array<double>, n int, cell string, t string, score string"
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], schema).repartition(3)
    found = found_of(hamming_search.nearest(df, F.col("vec_id") % 20 == 0, k=3))
    assert found == {120: [(1, 2e150), (3, 6.0), (2, 1e-150)], 140: [(4, 10.0)]}
    everything = found_of(hamming_search.nearest(df, F.col("vec_id") % 20 == 0))
    assert everything[120] == [(1, 2e150), (3, 6.0), (2, 1e-150), (5, -2.0)]
    assert found_of(hamming_search.nearest(df.limit(0), F.col("vec_id") % 20 == 0)) == {}
    assert found_of(hamming_search.nearest(df, F.lit(False))) == {}


def test_best_of_keeps_ties_in_order():
    vectors = np.array(list(itertools.repeat([1.0, 0.0], 50)) + [[2.0, 0.0]])
    ids = np.arange(51)[::-1].copy()
    ids[3] = ids[4]
    places, scores = hamming_search.best_of(np.array([1.0, 1.0]), ids, vectors, vectors @ np.ones(2), 4)
    assert ids[places].tolist() == [0, 1, 2, 3] and scores.tolist() == [2.0, 1.0, 1.0, 1.0]
