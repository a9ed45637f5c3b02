"""What grows or comes later: batches, run documents, reader states, readers and articles a model has not seen."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from readflow.operators import fold_in, history, readers, skew
from readflow.plans import incremental
from readflow.sources import files, models

COLUMNS = "user_id string, page string, ts double, clicks int, time_on_page_ms long, scroll_pct double, visits int"


def readings(spark, rows):
    return spark.createDataFrame([(u, p, float(t), 1, 1000, 1.0, 1) for u, p, t in rows], COLUMNS)


def values(df):
    return sorted((repr(r["user_id"]), r["page"], r["ts"], r["time_since_last"], r["first_interaction"]) for r in df.collect())


DAY = 86_400
BATCHES = {
    "a": [("u", "p", 10 * DAY), ("u", "q", 11 * DAY), ("v", "p", 12 * DAY), (None, "p", 10 * DAY), ("w", "p", 20 * DAY)],
    "b": [("u", "p", 13 * DAY), ("u", "q", 13 * DAY + 5), ("x", "p", 10 * DAY)],  # after what is stored, and a new reader on an old date
    "c": [("u", "z", 10 * DAY + 7), ("v", "a", 12 * DAY), (None, "q", 9 * DAY), ("w", "q", 21 * DAY)],  # late, equal times, no id
}


def test_batches_equal_one_load(spark, tmp_path):
    layer, state = str(tmp_path / "layer"), str(tmp_path / "state")
    loaded = []
    for batch in ("a", "b", "c", "b", "c"):
        incremental.load_readings(readings(spark, BATCHES[batch]), layer, state, batch)
        if batch not in loaded:
            loaded.append(batch)
        whole = readings(spark, [r for b in loaded for r in BATCHES[b]])
        assert values(incremental.read_readings(spark, layer, state)) == values(history.with_user_times(history.with_temporal(whole)))


def test_a_batch_may_be_replaced(spark, tmp_path):
    layer, state = str(tmp_path / "layer"), str(tmp_path / "state")
    for batch, rows in (("a", BATCHES["a"]), ("b", BATCHES["b"]), ("b", [("u", "p", 11 * DAY + 1)])):
        incremental.load_readings(readings(spark, rows), layer, state, batch)
    whole = readings(spark, [*BATCHES["a"], ("u", "p", 11 * DAY + 1)])
    assert values(incremental.read_readings(spark, layer, state)) == values(history.with_user_times(whole))


def test_untouched_dates_keep_their_files(spark, tmp_path):
    layer, state = str(tmp_path / "layer"), str(tmp_path / "state")
    incremental.load_readings(readings(spark, BATCHES["a"]), layer, state, "a")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "layer").rglob("*.parquet")}
    incremental.load_readings(readings(spark, [("w", "q", 22 * DAY)]), layer, state, "b")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "layer").rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    found = {r["ts"]: r["time_since_last"] for r in incremental.read_readings(spark, layer, state).filter("user_id = 'w'").collect()}
    assert found == {20.0 * DAY: 0.0, 22.0 * DAY: 2.0 * DAY}


def test_counts_of_batches_add_up(spark, tmp_path):
    rows = [("a", Vectors.sparse(3, {0: 2.0})), ("b", Vectors.sparse(3, {0: 1.0, 2: 1.0})), ("c", Vectors.dense([0.0, 0.0, 0.0]))]
    df = spark.createDataFrame(rows, ["page", "raw_features"])
    path = str(tmp_path / "counts")
    assert incremental.load_parts(spark, path, incremental.total_counts) is None
    for batch, part in (("one", "page = 'a'"), ("two", "page <> 'a'"), ("two", "page <> 'a'")):
        incremental.save_part(incremental.document_counts(df.filter(part)), path, batch)
    counts = incremental.load_parts(spark, path, incremental.total_counts)
    assert {r["feature_idx"]: r["n"] for r in counts.collect()} == {-1: 3, 0: 2, 2: 1}
    weighed = {r["page"]: r["features"].toArray() for r in incremental.weigh(df, counts, 3).collect()}
    assert np.allclose(weighed["b"], [np.log(4 / 3), 0, np.log(4 / 2)]) and not weighed["c"].any()
    incremental.save_part(incremental.document_counts(df.filter("page = 'x'")), path, "two")
    assert {r["feature_idx"]: r["n"] for r in incremental.load_parts(spark, path, incremental.total_counts).collect()} == {-1: 1, 0: 1}


def test_a_run_is_written_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    run = spark.createDataFrame([("r/1 ü", "2024-01-01", "ok")], "run_id string, created_at string, status string")
    assert models.append_run(run, path) and not models.append_run(run, path)
    assert models.append_run(run.withColumn("run_id", F.lit("r2")), path)
    assert sorted(r["run_id"] for r in models.read_runs(spark, path).collect()) == ["r/1 ü", "r2"]
    for wrong in (run.limit(0), run.unionByName(run), run.withColumn("run_id", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            models.append_run(wrong, path)
    assert models.read_runs(spark, path).count() == 2


def test_date_range_reads_its_folders_only(spark, tmp_path):
    rows = history.with_temporal(readings(spark, [("u", "p", t * 3600) for t in range(0, 24 * 70, 5)]))
    files.write_partitioned(rows, str(tmp_path / "layer"))
    table = files.read_table(spark, str(tmp_path / "layer"))
    part = table.filter(files.date_range("1970-01-30T12:00:00", "1970-02-03T01:00:00+00:00"))
    assert sorted(r["ts"] for r in part.collect()) == [t * 3600.0 for t in range(0, 24 * 70, 5) if 29.5 * 24 <= t < 33 * 24 + 1]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len({f.rsplit("/", 1)[0] for f in part.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) == 4
    assert table.filter(files.date_range()).count() == table.count()


def test_reader_states_merge(spark):
    rows = history.with_temporal(readings(spark, [(f"u{i % 700}", f"p{i % 3}", i * 1000) for i in range(5000)] + [(None, "p0", 5.0)]))
    index = skew.dense_index(rows, "user_id", "user_idx").withColumn("user_idx", F.col("user_idx") * 97)  # several buckets
    states = readers.daily_readers(rows, index, ["page"])
    got = {(r["page"], r["start"]): r["unique_users"] for r in readers.readers_per_window(states, ["page"], "month").collect()}
    start = F.trunc(F.make_date("year", "month", "day"), "month").alias("start")
    want = {(r["page"], r["start"]): r["n"] for r in rows.groupBy("page", start).agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got == want
    near = {(r["page"], r["start"]): r["unique_users"] for r in readers.estimated_readers(readers.daily_sketches(rows, ["page"]), ["page"], "month").collect()}
    assert all(abs(near[k] - n) <= 0.05 * n + 2 for k, n in want.items())


def plain_fold_in(y, reads, reg, alpha):
    shared, out = y.T @ y, {}
    for user, own in reads.items():
        rows, c = y[[i for i, _ in own]], alpha * np.array([s for _, s in own])
        left = shared + rows.T @ (rows * c[:, None]) + reg * len(own) * np.eye(y.shape[1])
        out[user] = np.linalg.solve(left, rows.T @ (1 + c))
    return out


def test_fold_in_of_hot_and_unknown_readers(spark):
    """One reader holds most rows and spans many tasks; pages without factors, zero scores and missing ids say nothing."""
    rng = np.random.default_rng(2)
    y = rng.standard_normal((400, 5))
    items = spark.createDataFrame([(f"p{i}", v.tolist(), 0.0) for i, v in enumerate(y)] + [("zero", [0.0] * 5, 0.0)], "page string, factors array<double>, bias double")
    reads = {"hot": [(i, 1.0 + i % 3) for i in range(400)], **{f"u{k}": [(int(i), 2.0) for i in rng.choice(400, 3, replace=False)] for k in range(40)}}
    rows = [(u, f"p{i}", s) for u, own in reads.items() for i, s in own]
    rows += [("none", "zero", 1.0), ("none", "unknown", 1.0), (None, "p1", 1.0), ("silent", "p1", 0.0)]
    df = spark.createDataFrame(rows, "user_id string, page string, score double").repartition(6)
    found = {r["user_id"]: r for r in fold_in.fold_in_readers(df, items, 0.1, 2.0).collect()}
    want = plain_fold_in(y, reads, 0.1, 2.0)
    assert set(found) == set(want)
    for u, x in want.items():
        assert np.allclose(found[u]["factors"], x) and found[u]["n"] == len(reads[u]) and found[u]["residual"] < 1e-8
    assert fold_in.fold_in_readers(df.limit(0), items).count() == 0


def test_feature_map(spark):
    rng = np.random.default_rng(4)
    x, true = rng.standard_normal((50, 4)), rng.standard_normal((4, 3))
    features = spark.createDataFrame([(f"p{i}", Vectors.dense(v)) for i, v in enumerate(x)], ["page", "features"])
    factors = x @ true
    items = spark.createDataFrame([(f"p{i}", f[:2].tolist(), float(f[2])) for i, f in enumerate(factors[:30])] + [("p40", [0.0, 0.0], 0.0), ("bare", [1.0, 2.0], 3.0)],
                                  "page string, factors array<double>, bias double")
    weights = fold_in.feature_map(features, items, ridge=1e-9)
    assert np.allclose(weights, true, atol=1e-6)
    rows = {r["page"]: r for r in fold_in.with_cold_items(items, features, weights).collect()}
    assert set(rows) == {f"p{i}" for i in range(50)} | {"bare"} and {p for p, r in rows.items() if r["cold"]} == {f"p{i}" for i in range(30, 50)}
    assert all(np.allclose([*rows[f"p{i}"]["factors"], rows[f"p{i}"]["bias"]], factors[i]) for i in range(50))
    assert max(r["residual"] for r in fold_in.map_residuals(features, items, weights, 1e-9).collect()) < 1e-9
    with pytest.raises(ValueError):
        fold_in.feature_map(features, items.limit(0))


def test_map_residuals_sum_inside_tasks(spark):
    """No row per article and feature: a task gives one row per feature; features nobody has are off by nothing."""
    rows = spark.range(40).repartition(3).select(F.concat(F.lit("p"), "id").alias("page"), F.col("id").cast("double").alias("x"))
    features = rows.select("page", array_to_vector(F.array("x", F.lit(0.0), F.lit(1.0))).alias("features"))
    items = rows.select("page", F.array(F.col("x") * 2, F.col("x") - 1).alias("factors"), F.lit(None).cast("double").alias("bias"))
    out = fold_in.map_residuals(features, items, fold_in.feature_map(features, items))
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    found = {r.feature_idx: r.residual for r in out.collect()}
    assert sorted(found) == [0, 1, 2] and max(found.values()) < 1e-12
