"""Spelling variants against plain edit distance on every pair."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from readflow.llm import queries, spelling


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    """word -> (form, root, n, n_near, form_n) by comparing all pairs."""
    found = {}
    for w, n in counts.items():
        own = sorted((x for x in counts if near(w, x)), key=lambda x: (-counts[x], x))
        form = own[0] if own and counts[own[0]] >= 2 * n else None
        found[w] = (form, n, len(own), counts[form] if form else None)
    roots = {}
    for w in found:
        at = w
        while found[at][0]:
            at = found[at][0]
        roots[w] = at
    return {w: (f, roots[w], n, k, m) for w, (f, n, k, m) in found.items()}


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def by_word(rows):
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def some_words(n, letters="abeinrst", seed=3):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(5, 7))) for _ in range(n)}
    return {w: rng.choice([3, 4, 6, 9, 13, 40, 100]) for w in sorted(words)}


def test_query(spark, sf, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = by_word(queries.QUERIES["op12_spelling"](spark, sf).collect())
    counts = plain_words(rows)
    assert set(found) == set(counts) and all(found[w][2] == n for w, n in counts.items())
    want = plain(counts)
    assert found == want and any(v[0] for v in want.values())


def test_cells_in_parts(spark):
    """Dense words, cells cut into parts of a few words, and accented, very long and odd ones."""
    counts = some_words(700) | {"größe": 9, "grösse": 4, "große": 3, "grösze": 3, "x" * 3000: 3, "x" * 2999: 9, "x" * 2998 + "y": 3, "ééééé": 5, "éééé": 20}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    for cell in (4, spelling.CELL):
        assert by_word(spelling.variants(words, cell=cell).collect()) == plain(counts)


def test_trie_against_all_pairs():
    """In a cell, whose words agree in the upper counts, and with nothing spent there."""
    words = list(some_words(900, "etaoin", 7))
    cell = max(map(_vector, words), key=lambda v: sum(_vector(w) == v for w in words))
    words = [w for w in words if _vector(w) == cell]
    n = np.arange(len(words)) % 11 + 3
    found = spelling.near_in_cell(words * 2, np.concatenate((n, n)), np.arange(2 * len(words)) < len(words), np.zeros(2 * len(words), np.int64))
    counts = {w: sum(near(w, x) for x in words) for w in words}
    assert len(words) > 9 and {w: k for w, k, *_ in found} == {w: k for w, k in counts.items() if k}


def _vector(word):
    return tuple(sum(c in g for c in word) for g in spelling.GROUPS[: spelling.UPPER])


def test_groups_are_apart():
    letters = "".join(spelling.GROUPS)
    assert len(set(letters)) == len(letters) and set("abcdefghijklmnopqrstuvwxyz") <= set(letters)


def test_edges(spark, edges, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    counted = spelling.count_words(queries.misspelled_runs(edges))
    assert {r["word"]: r["n"] for r in counted.collect()} == plain_words(rows)
    assert by_word(spelling.variants(counted).collect()) == plain(plain_words(rows))
    assert spelling.variants(spelling.count_words(queries.misspelled_runs(no_rows))).count() == 0
