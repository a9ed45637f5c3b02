"""Jaccard links, signatures and components against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from readflow.llm import graph, jaccard
from readflow.llm.texts import ascii_lower


def plain_set(text):
    w = [x for x in jaccard.BLANKS.split(ascii_lower(text or "")) if x]
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def plain_components(rows, percent=90):
    """rows: (key, text); rows with one key are one node."""
    sets = [(k, plain_set(t)) for k, t in rows]
    root = {k: k for k, _ in sets if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return [(k, len(s), None if k is None else find(k)) for k, s in sets]


def near_copies(seed, groups=14, copies=9):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randint(1, 3) for _ in range(rnd.choice([1, 2, 3, 5, 9, 14, 30, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 20))):
                at = rnd.randrange(len(own))
                own[at : at + 1] = rnd.choice([[], ["new%d" % rnd.randrange(99)], [own[at], "x"]])
            rows.append(" ".join(own))
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,cell", [(1, 2_000_000), (2, 60)])
def test_components(spark, seed, cell):
    rows = near_copies(seed) + [(2000, None), (2001, ""), (None, "a b c d"), (2002, "a b c d"), (2003, "A  B\tc D"), (2004, "dup"), (2004, "dup"), (2005, "Dup")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = jaccard.link_components(docs, cell=cell).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, (type(out[0])(*x) for x in plain_components(rows)))) or \
        sorted(map(tuple, out), key=repr) == sorted(plain_components(rows), key=repr)


def test_edges(edges, no_rows):
    out = [tuple(r) for r in jaccard.link_components(edges).collect()]
    assert sorted(out, key=repr) == sorted(plain_components([(r["doc_id"], r["text"]) for r in edges.collect()]), key=repr)
    assert jaccard.link_components(no_rows).count() == 0
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(k) for k, _, c in out if k is None or k == c)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10**9))
def test_linked_sets_share_a_signature(size, seed):
    rnd = np.random.default_rng(seed)
    a = np.unique(jaccard._mix(rnd.integers(0, 2**62, size).astype(np.uint64)))
    gone, new = rnd.integers(0, size // 9 + 2), rnd.integers(0, size // 9 + 2)
    b = np.unique(np.concatenate([a[gone:], jaccard._mix(rnd.integers(0, 2**62, new).astype(np.uint64))]))
    common = len(np.intersect1d(a, b))
    if len(b) and 100 * common >= 90 * (len(a) + len(b) - common):
        keys = [{(level, k) for level, ks in jaccard.signatures(x) for k in ks.tolist()} for x in (a, b)]
        assert keys[0] & keys[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=12), st.sampled_from([50, 80, 90, 100]))
def test_divide_skip(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    lists = jaccard.InvertedLists(arrays, percent)
    for q, s in enumerate(sets):
        want = {d for d, t in enumerate(sets) if d != q and 100 * len(s & t) >= percent * len(s | t)}
        assert set(lists.search(q, lambda c: np.zeros(len(c), bool))) == want


@pytest.mark.parametrize("seed", range(4))
def test_graph(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (-7, 2**62)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    out = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, out)) == sorted((x, find(x)) for x in nodes)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_kept(rows, width, percent):
    """Keys that are the smallest of their component; keys are unique and not null."""
    sets, root = [], {k: k for k, _ in rows}
    for k, text in rows:
        w = [x for x in jaccard.BLANKS.split(ascii_lower(text or "")) if x]
        sets.append((k, {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k for k in root if find(k) == k}


def appended_copies():
    """Texts whose copies have about an eighth of new words at the end: a similarity of 0.88."""
    rnd = random.Random(8)
    rows = []
    for size in (24, 60, 300, 900):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        rows += [" ".join(base), " ".join(base + [f"n{rnd.randrange(10**6)}" for _ in range(size * 40 // 300)])]
    return [(10_000 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("cell", [2_000_000, 300])
def test_copies_of_the_stage(spark, cell):
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(5))] + appended_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain_kept(rows, 5, 80)
    assert {k for k in want if k >= 10_000} == {10_000, 10_002, 10_004, 10_006} and want != plain_kept(rows, 3, 90)
    assert {r["doc_id"] for r in jaccard.keep_one(docs, cell=cell).collect()} == want


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10**9), st.sampled_from([50, 80, 90]))
def test_linked_sets_share_a_signature_at_any_percent(size, seed, percent):
    rnd = np.random.default_rng(seed)
    a = np.unique(jaccard._mix(rnd.integers(0, 2**62, size).astype(np.uint64)))
    most = int(size * (100 / percent - 1)) + 1
    gone = int(rnd.integers(0, most + 1))
    new = int(rnd.integers(0, max(1, most - gone) + 1))
    b = np.unique(np.concatenate([a[gone:], jaccard._mix(rnd.integers(0, 2**62, new).astype(np.uint64))]))
    common = len(np.intersect1d(a, b))
    if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
        keys = [{(level, k) for level, ks in jaccard.signatures(x, percent) for k in ks.tolist()} for x in (a, b)]
        assert keys[0] & keys[1]


def test_strangers_share_no_signature():
    """At 80 % no part is so weak that sets without a common gram meet in it."""
    rnd = np.random.default_rng(2)
    keys = [{(level, k) for level, ks in jaccard.signatures(np.unique(jaccard._mix(rnd.integers(0, 2**62, 300).astype(np.uint64))), 80) for k in ks.tolist()} for _ in range(60)]
    assert sum(len(keys[i] & keys[j]) > 0 for i in range(60) for j in range(i)) <= 60


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAzZÀßİıK é\x85\x1c\x1f 　\t\n\x0b\x0c\r \x00"), max_size=40))
def test_shingles_know_ascii_only(text):
    """Only A-Z are lowered and only ASCII blanks part words; every distinct gram has one hash, in order."""
    for some in (text, text.upper() + " " + text):
        plain = jaccard.shingle_set(" ".join(w for w in jaccard.BLANKS.split(ascii_lower(some)) if w))
        found = jaccard.shingle_set(some)
        assert found.tolist() == plain.tolist() == sorted(set(found.tolist())) and len(found) == len(plain_set(some))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters() | st.sampled_from("AZßİıKÀ\ud800"), max_size=40))
def test_ascii_lower(text):
    assert ascii_lower(text) == "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_hopeless_candidates_are_not_probed(percent):
    """Enough grams in common for the smaller set, but not for the larger one's size: known before any long list is probed."""
    share = jaccard.needed(100, percent) + 3
    sets = [np.arange(100, dtype=np.uint64), np.arange(100 - share, 100 - share + 10_000 // percent, dtype=np.uint64)]
    asked = []
    assert not list(jaccard.InvertedLists(sets, percent).search(0, lambda c: asked.extend(c.tolist()) or np.zeros(len(c), bool)))
    assert not asked


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10**9), st.sampled_from([50, 80, 90]))
def test_sets_of_one_class_share_a_signature_of_that_class(size, seed, percent):
    rnd = np.random.default_rng(seed)
    a = np.unique(jaccard._mix(rnd.integers(0, 2**62, size).astype(np.uint64)))
    gone, new = rnd.integers(0, int(size * (100 / percent - 1)) // 2 + 2, 2)
    b = np.unique(np.concatenate([a[gone:], jaccard._mix(rnd.integers(0, 2**62, new).astype(np.uint64))]))
    common = len(np.intersect1d(a, b))
    if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
        (one, x), (other, y) = (jaccard.signatures(s, percent)[0] for s in (a, b))
        assert abs(one - other) <= 1 and (one != other or set(x.tolist()) & set(y.tolist()))


def test_sets_of_one_class_meet_once(spark, monkeypatch):
    """Near copies of one size class have two levels in common, but are read and searched in one block only."""
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = [(k, " ".join(base[:k] + [f"n{k}"] + base[k + 1 :])) for k in range(0, 200, 20)]
    cells, stored = [], jaccard.broadcast_if_small
    monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df, name: cells.append(stored(df, name)) or cells[-1])
    out = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out)) == [(k, 198, 0) for k, _ in rows]
    assert sorted(r["rep"] for r in cells[0].collect()) == [k for k, _ in rows]


def text_batches(texts, rows):
    return (pa.RecordBatch.from_arrays([pa.array(texts[i : i + rows])], names=["text"]) for i in range(0, len(texts), rows))


@pytest.mark.parametrize("rows", [1000, 7])
def test_signatures_take_ten_bytes_and_tie_all_that_share_one(rows):
    """In one slice or over many, the ties make the components that the signatures themselves make."""
    texts = [t for _, t in near_copies(3)] + [None, ""]
    made = [r for b in jaccard._signature_rows(text_batches(texts, rows), 5, 80) for r in b.to_pylist()]
    sets = {s.tobytes(): s for s in (jaccard.shingle_set(t, 5) for t in texts) if len(s)}
    nodes = {k: jaccard._nodes(xxhash.xxh3_128_intdigest(k) >> 64, len(s), 80) for k, s in sets.items()}
    owners = {}
    for k, s in sets.items():
        for node, (_, keys) in zip(nodes[k], jaccard.signatures(s, 80)):
            for key in keys.tolist():
                owners.setdefault(key, set()).add(node)
    held = sum(len(r["lines"] or b"") for r in made)
    assert held == 10 * len(owners) if rows == 1000 else held <= 10 * sum(map(len, owners.values()))
    assert all(len({r["part"] for r in made}) <= jaccard.KEY_PARTS and (r["lines"] is None) != (r["ties"] is None) for r in made)
    made.sort(key=lambda r: r["part"])
    pairs = [(r["a"], r["b"]) for b in jaccard._shared_signatures([pa.RecordBatch.from_pylist(made, schema=pa.schema(
        [("part", pa.int32()), ("lines", pa.binary()), ("ties", pa.binary())]))]) for r in b.to_pylist()]

    def roots(edges):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in edges:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {x: find(x) for x in root if find(x) != x}

    assert roots(pairs) == roots((a, min(own)) for own in owners.values() for a in own) and pairs


def test_no_table_holds_the_signatures(spark, monkeypatch):
    """A document is some hundred signatures: stored and dealt out as rows of their own they are most of the disk."""
    docs = [(k, f"{' '.join(f'w{k}x{i}' for i in range(300))}") for k in range(40)]
    rows, stored = [], jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: rows.append(stored(df, name)) or rows[-1])
    assert jaccard.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).count() == 40
    assert rows and max(df.count() for df in rows) <= 2 * 40
