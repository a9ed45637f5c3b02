"""Benchmark windows against a plain search."""

import hashlib

import pytest

from readflow.llm import decontaminate, queries
from readflow.llm.texts import words_of

ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, "..."), (None, "has no id but ten words one two three four"),
         (5, "ONE two; three four five six seven eight nine ten"), (5, "short item again here")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, items string")


def plain(text, items):
    words = words_of(text or "")
    hit, found = set(), set()
    for key, body in items:
        own = words_of(body or "")
        size = min(10, len(own))
        if key is None or not size:
            continue
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(key))
    return len(words), len(hit), sorted(found)


def test_against_plain_search(spark, items, edges):
    texts = [(100, "x one two three four five six seven eight nine ten eleven y SHORT, item short item z"), (101, "one two three four five six seven eight nine"),
             (102, "short item again here"), (103, "nine ten eleven short"), (104, "one two three four five six seven eight nine ten one two three four five six seven eight nine ten")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").unionByName(edges.select("doc_id", "text"))
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == docs.count()
    want = sorted((repr(r["doc_id"]), *plain(r["text"], ITEMS)) for r in docs.collect())
    assert sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in rows) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in rows)
    kept = decontaminate.remove_documents(docs, items)
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in docs.collect() if not plain(r["text"], ITEMS)[1])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, items).collect()}
    assert cut[103] == texts[3][1] and cut[100].split() == ["x", "y", "z"] and cut[101] == texts[1][1]
    assert all(plain(t, ITEMS)[1] == 0 for k, t in cut.items() if k != 104)


def test_extra_columns_stay(edges, items):
    assert decontaminate.remove_documents(edges, items).columns == edges.columns
    assert decontaminate.remove_spans(edges, items).columns == edges.columns


def test_empty_tables(no_rows, edges, items):
    assert decontaminate.contamination(no_rows, items).count() == 0
    rows = decontaminate.contamination(edges, items.limit(0)).collect()
    assert len(rows) == edges.count() and not any(r["contaminated"] for r in rows)
    assert hashlib.sha256(b"").hexdigest()  # what the query gives for no items
    assert decontaminate.remove_documents(edges, items.limit(0)).count() == edges.count()


def test_shuffled_set(edges, items, monkeypatch):
    want = sorted(map(repr, decontaminate.contamination(edges, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(repr, decontaminate.contamination(edges, items).collect())) == want


def test_blocks_of_words(edges, items, monkeypatch):
    want = sorted(map(repr, decontaminate.contamination(edges, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK", 3)
    assert sorted(map(repr, decontaminate.contamination(edges, items).collect())) == want


def test_one_scan_and_narrow_rows(spark, items):
    """All window sizes come from one scan, and no exchange moves words."""
    docs = spark.createDataFrame([(1, "short item", "x")], "doc_id long, text string, w string")
    scan = decontaminate._hashed_windows(docs, "doc_id", "text", list(range(1, 11)))
    assert scan.columns == ["doc", "text_hash", "at", "size", "h"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Union" not in plan and "Python" not in plan
    assert sorted((r["at"], r["size"]) for r in scan.collect()) == [(0, 1), (0, 2), (1, 1)]


def test_equal_hashes_are_compared(spark, items, monkeypatch):
    """Windows with one hash are told apart by their words."""
    monkeypatch.setattr(decontaminate.F, "xxhash64", lambda *c: decontaminate.F.lit(7).cast("bigint"))
    texts = [(1, "one two"), (2, "a short item b"), (3, None)]
    rows = decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["items"]) for r in rows) == [(1, 0, []), (2, 2, ["2"]), (3, 0, [])]


def test_items_without_an_id_count(spark, items, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    texts = [(1, "it has no id but ten words one two three four"), (2, "short item, has no id but ten words one two three four"), (3, "has no id but ten words"), (4, "short item")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert {k: (r["n_hit"], r["items"], r["contaminated"]) for k, r in rows.items()} == {
        1: (10, [], True), 2: (12, ["2"], True), 3: (0, [], False), 4: (2, ["2"], True)}
    assert {r["doc_id"] for r in decontaminate.remove_documents(docs, items).collect()} == {3}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = db.execute(queries.ORACLES["op5_decontaminate"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op5_decontaminate"](spark, str(tmp_path)).collect())) == sorted(want)
