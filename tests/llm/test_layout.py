"""Packing and sharding: round trips, gapless places, bounds."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from readflow.llm import packing, queries, sharding


def check_packing(rows, ids, capacity=packing.CAPACITY):
    """``ids``: key -> list of id lists. Pieces give the ids back, and sequences are filled without gaps or overlaps."""
    by_key = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        by_key[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: len(v) for k, v in by_key.items()} == {k: sum(-(-len(x) // capacity) for x in v) for k, v in ids.items()}
    for key, own in by_key.items():
        want = Counter((n, n * capacity, len(p), zlib.crc32(np.array(p, "<u4").tobytes()))
                       for code in ids[key] for n, p in enumerate(code[i : i + capacity] for i in range(0, len(code), capacity)))
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) == want
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places), sum(r["length"] for r in rows)


def ids_of(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    out = defaultdict(list)
    for r in documents.select("doc_id", "text").collect():
        out[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    return out


def test_pack_query(spark, sf, documents):
    bins, total = check_packing(queries.QUERIES["op3_packing"](spark, sf).collect(), ids_of(documents))
    assert bins <= 1.01 * -(-total // packing.CAPACITY) + 1


def test_pack_edges(edges, no_rows):
    check_packing(packing.pack(edges).collect(), ids_of(edges))
    assert packing.pack(no_rows).count() == 0


@pytest.mark.parametrize("text", ["á ́b", "x\x1cy\x85z　q\xa0r", "It's we'll 'S <|endoftext|> a<|startoftext|>b", "İΣ ΑΣ ß K", "ÀÉ Straße... ÿÝ!? µm ªº x×y ÷ 'Re A's don't. (quoted) end&&& a\u00ad", "\r\n\t a", "1234 a1b2", "  ", "ñ̃​·é"])
def test_ids_by_parts(text):
    path = public_tokenizers.path(packing.TOKENIZER)
    whole = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.TextIds(path).of([text])[0], "<u4").tolist() == whole


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 9), max_size=20))
def test_plan(counts):
    bins = packing.plan_bins(counts, 60)
    packed = Counter()
    for n, held in bins:
        assert n > 0 and sum(length * each for length, each in held) <= 60
        for length, each in held:
            packed[length] += n * each
    assert packed == Counter({k: v for k, v in counts.items() if v})


def fewest_bins(sizes, capacity):
    """By trying every place of every piece."""
    best = len(sizes)

    def place(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(sizes):
            best = len(gaps)
            return
        for gap in sorted({g for g in gaps if g >= sizes[i]}):
            at = gaps.index(gap)
            place(i + 1, gaps[:at] + [gap - sizes[i]] + gaps[at + 1 :])
        place(i + 1, gaps + [capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=9))
def test_plan_against_the_optimum(sizes):
    bins, least = sum(n for n, _ in packing.plan_bins(Counter(sizes), 60)), fewest_bins(sizes, 60)
    assert least <= bins <= least + 1
    if all(3 * s > 60 for s in sizes):
        assert bins == least


def test_plan_is_grouped():
    bins = packing.plan_bins({n: 10**9 for n in range(1, 2049)})
    total = 10**9 * 2048 * 2049 // 2
    assert sum(n for n, _ in bins) <= 1.002 * total / 2048 and len(bins) < 10_000


def test_shard_query(spark, sf, documents):
    rows = queries.QUERIES["op9_sharding"](spark, sf).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_tree_moves_only_where_weights_change(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.regular_tree(32)
    heavier = [x._replace(weight=2.0) if x.shard == 5 else x for x in tree]
    rows = keys.select(sharding.shard_of(F.col("k"), tree).alias("a"), sharding.shard_of(F.col("k"), heavier).alias("b")).collect()
    counts = Counter(r["a"] for r in rows)
    assert min(counts.values()) > 500 and max(counts.values()) < 760
    region, rack = (lambda s: s // 8), (lambda s: s // 4)
    for r in rows:
        if r["a"] != r["b"]:
            assert region(r["b"]) == region(5)  # nothing moves but into the region of the changed leaf, or inside it
            assert region(r["a"]) != region(5) or rack(r["b"]) == rack(5)
    assert 1.6 < sum(r["b"] == 5 for r in rows) / counts[5] < 2.4


def test_shard_edges(edges, no_rows):
    rows = sharding.shard_documents(edges, sharding.regular_tree(3)).collect()
    assert len(rows) == edges.count() and all(r["grown_shard"] is None for r in rows)
    assert sharding.shard_documents(no_rows, sharding.regular_tree(3)).count() == 0
