"""The corpus pipeline, stage by stage, against plain versions."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline  # noqa: E402
import test_decontaminate  # noqa: E402
import test_jaccard  # noqa: E402
import test_layout  # noqa: E402
from readflow.llm import decontaminate, quality, secret_scan  # noqa: E402


@pytest.fixture(scope="module")
def staged(spark, sf):
    """Documents before the first stage and after each; the texts of the first 60 fill a third of the rows again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, made := stage(spark, docs, sf)))
        docs = spark.createDataFrame(made.collect(), made.schema)
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_toxic_documents_go(spark, sf, staged):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, after = map(by_id, staged[0])
    gone = set(before) - set(after)
    assert gone and all(labels.get(k, 1) for k in gone) and all(after[k] == before[k] for k in after)


def test_one_of_each_group_stays(staged):
    before, after = map(by_id, staged[1])
    assert set(after) == test_jaccard.plain_kept([(k, r["text"]) for k, r in before.items()], 5, 80) and all(after[k] == before[k] for k in after)


def test_contaminated_documents_go(spark, sf, staged):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = map(by_id, staged[2])
    assert set(after) == {k for k, r in before.items() if not test_decontaminate.plain(r["text"], items)[1]}


def test_secrets_are_redacted(staged):
    before, after = map(by_id, staged[3])
    assert set(before) == set(after) and staged[3][1].columns == staged[0][0].columns and staged[3][1].dtypes == staged[0][0].dtypes
    for k, r in after.items():
        assert r["text"] == secret_scan.redact(before[k]["text"]) and r["n_chars"] == len(r["text"])


def test_packing_is_whole(staged):
    docs, packed = staged[4]
    test_layout.check_packing(packed.collect(), test_layout.ids_of(docs))


def test_run(spark, sf, staged):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).drop("sequence_id", "offset").collect())) == sorted(map(tuple, staged[4][1].drop("sequence_id", "offset").collect()))


def test_stages_on_odd_rows(spark, sf, edges, no_rows):
    for docs in (edges, no_rows):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            if docs is edges:
                assert out.filter(F.col("text").isNull()).count() == 1
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_copies_at_five_words_and_four_fifths(spark, sf):
    rows = test_jaccard.appended_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(by_id(corpus_pipeline.drop_near_copies(spark, docs, sf))) == {10_000, 10_002, 10_004, 10_006}


def test_columns_named_like_helpers(spark, sf):
    """Columns that the stages and operators use themselves are kept as they are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20).selectExpr(
        "*", "doc_id _gone_", "text _doc_", "lang _text_hash_", "source _spans_", "n_chars _q_chars", "lang _severity")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and {(r["doc_id"], r["_gone_"]) for r in out.collect()} <= {(r["doc_id"], r["doc_id"]) for r in docs.collect()}
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontaminate.remove_spans(docs, items).columns == docs.columns
    model = quality.Rules(0.5, [])
    scored = quality.classify(docs, model)
    assert scored.columns == [*docs.columns, "quality_score"]
    assert {r["doc_id"]: r["_q_chars"] for r in scored.collect()} == {r["doc_id"]: r["n_chars"] for r in docs.collect()}
