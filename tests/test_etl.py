"""The whole job from CSV files, twice."""

import pytest
from pyspark.sql import functions as F

from readflow.plans import etl
from readflow.sources import files, models, tables


def test_job_twice_gives_the_same_rows(spark, sf, tmp_path):
    history, articles, root = (str(tmp_path / n) for n in ("history", "articles", "lake"))
    files.write_csv(tables.raw_history(spark, sf), history)
    raw = tables.raw_articles(spark, sf).select("page", "url", "issued", "modified", "title", "body", "caption")
    undated = raw.withColumn("issued", F.when(F.col("page") == "7", "unknown").otherwise(F.col("issued")))
    files.write_csv(undated, articles)

    def run(run_id, created, **options):
        return etl.run(spark, history, articles, root, run_id, created, as_of=tables.AS_OF, rank=4, iterations=2, **options)

    layout = run("first", "2024-02-01T00:00:00")
    counted = ("interactions", "items", "interactions_normalized", "tfidf", "matrix", "user_features", "item_features")
    sizes = {n: files.read_table(spark, getattr(layout, n)).count() for n in counted}
    assert sizes["interactions"] == 1000 and sizes["tfidf"] == 200 and sizes["item_features"] == 200
    assert files.read_table(spark, layout.tfidf).filter("year is null").count() == 1

    run("second", "2024-02-02T00:00:00")
    assert sizes == {n: files.read_table(spark, getattr(layout, n)).count() for n in counted}
    runs = models.read_runs(spark, layout.runs)
    assert models.latest_run(runs).first()["run_id"] == "second"
    assert files.is_complete(spark, layout.interactions, layout.matrix) and not files.is_complete(spark, root + "/none")
    assert files.read_table(spark, layout.analyses + "/reads_by_hour").agg(F.sum("count")).first()[0] == 1000

    latest = models.latest_run(runs).first()
    assert sum(latest["user_histogram"]) == 15 and sum(latest["item_histogram"]) == 200
    assert 0 <= latest["score_stability"]["ks"] <= 1 and latest["item_interactions"]["min"] == 0.0


def test_partition_overwrite_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 1, 2)], "x int, year int, month int, day int")
    files.write_partitioned(df, path)
    files.write_partitioned(df.filter("day = 2").withColumn("x", F.lit(9)), path, replace="dynamic")
    assert sorted(r["x"] for r in files.read_table(spark, path).collect()) == [1, 9]
    files.write_partitioned(df.filter("day = 1"), path)
    assert files.read_table(spark, path).count() == 1


def test_scratch_tables_can_be_dropped(spark):
    from readflow.session import materialize, scratch, scratch_path

    def left(path):
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    with scratch(spark):
        outer = materialize(spark.range(3), "three").inputFiles()[0]
        with scratch(spark):
            inner = materialize(spark.range(4), "four").inputFiles()[0]
        assert left(outer) and not left(inner)
    assert not left(outer)
    kept = materialize(spark.range(2), "two")
    assert kept.count() == 2 and scratch_path(spark, "x") != scratch_path(spark, "x")


class Session:
    """A session of which only the settings are asked for."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_clusters_need_a_shared_folder():
    from readflow.session import scratch_path

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_path(Session(spark_master=master), "x")
    assert scratch_path(Session(spark_master="yarn", spark_checkpoint_dir="s3://b/c"), "x").startswith("s3://b/c/readflow/x-")
    assert scratch_path(Session(spark_master="local[4]"), "x")


def test_large_csv_files_are_split(spark, sf, tmp_path):
    path = str(tmp_path / "history")
    files.write_csv(tables.raw_history(spark, sf).coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split, whole = (files.read_history(spark, path, multi_line=m) for m in (False, True))
        assert split.rdd.getNumPartitions() > 1 and whole.rdd.getNumPartitions() == 1
        assert split.exceptAll(whole).count() == 0 and split.count() == whole.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sampled_training_keeps_a_train_part_and_all_ids(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    pairs = spark.range(4000).select(
        (F.col("id") % 200).alias("user_idx"), (F.col("id") % 97).alias("item_idx"), (1 + F.col("id") % 5).cast("double").alias("score"))
    pairs = pairs.distinct().withColumns({"user_id": F.concat(F.lit("u"), "user_idx"), "page": F.concat(F.lit("p"), "item_idx")})
    vectors = array_to_vector(F.array(F.col("id").cast("double"), F.lit(1.0)))
    items = spark.range(100).select(F.concat(F.lit("p"), "id").alias("page"), vectors.alias("features"))
    layout = etl.Layout(str(tmp_path))
    users, pages = etl.train(spark, pairs, items, layout, "r", "2024-02-01T00:00:00", sample_ratio=0.1, rank=3, iterations=2, alpha=2.0)
    assert users.count() == 200 and pages.count() == 100
    run = models.latest_run(models.read_runs(spark, layout.runs)).first()
    held = run["dataset_info"]
    assert held["n_train_interactions"] > 2.5 * held["n_test_interactions"] > 0 and held["n_features"] == 2
    assert run["hyperparameters"]["alpha"] == 2.0 and float(run["model_summary"]["training_time"]) > 0
    assert run["model_summary"]["parameters"] == str(300 * 4)


def test_cold_ids_are_evaluated(spark):
    from readflow.operators import evaluate, recommend

    users = spark.createDataFrame([("a", [1.0, 0.0], 0.0)], "user_id string, factors array<double>, bias double")
    items = spark.createDataFrame([("p", [1.0, 0.0], 0.0), ("q", [0.5, 0.0], 0.0)], "page string, factors array<double>, bias double")
    held = spark.createDataFrame([("a", "p"), ("cold", "p"), ("a", "new")], "user_id string, page string")
    full = recommend.for_all_ids(users, held, "user_id", 2), recommend.for_all_ids(items, held, "page", 2)
    assert evaluate.metrics_by_k(held, *full, [1]).first()["users"] == 2
    ranks = {(r["user_id"], r["page"]): r["rank"] for r in evaluate.rank_positives(held, *full).collect()}
    assert ranks == {("a", "p"): 0, ("cold", "p"): 2, ("a", "new"): 2}


def test_bucketed_layers_join_in_place(spark, sf):
    from readflow.operators import analytics
    from readflow.plans import catalog
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with catalog.co_located(spark, sf) as (reads, dates):
            out = analytics.recency_of_counts(reads, dates)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
            assert "Exchange" not in plan[plan.index("SortMergeJoin") :] and "Bucketed: true" in plan
            assert {r["page"] for r in reads.collect()} and sum(r["access_count"] for r in out.collect()) > 0
            name = spark.sql("show tables").filter("tableName like 'layer_%'").count()
        assert name == 2 and spark.sql("show tables").filter("tableName like 'layer_%'").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
