"""Hand-computed cases per operator."""

import math

import pytest
from pyspark.sql import Window as W, functions as F

from readflow.functions import scoring
from readflow.functions.columns import lenient_long, md5_number
from readflow.operators import analytics, distributions, evaluate, gold, history, items, monitor, recommend, scaling, skew, tfidf
from readflow.sources import models
from readflow.sources.schemas import RAW_HISTORY
from readflow.plans import training

AS_OF = 1706745600


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW_HISTORY)


def test_explode_pads_trims_and_drops(spark):
    df = history.explode_history(raw(
        spark,
        (" u1 ", "Logged", " a, b ,c", "1000, 2000, 3000", "1, x, 3", "10, 20", "1.5, 2, 3", "1, 2, 3"),
        ("u2", "Logged", None, "1", "1", "1", "1", "1"),
        ("u3", None, "", "5000", "7.9", "1", "1", "1"),
    ))
    assert table(df, "user_id", "page", "ts", "clicks", "time_on_page_ms", "scroll_pct", "visits") == sorted([
        ("u1", "a", 1.0, 1, 10, 1.5, 1), ("u1", "b", 2.0, None, 20, 2.0, 2), ("u1", "c", 3.0, 3, None, 3.0, 3),
        ("u3", "", 5.0, 7, 1, 1.0, 1)], key=repr)


def test_history_quality(spark):
    df = history.history_quality(raw(
        spark, ("u1", "L", "a, b", "1, 2", "1", "1", "1", "1"), ("u2", "L", None, "1", "1", "1", "1", "1")))
    assert tuple(df.first()) == (2, 1, 1)


def test_explode_validation(spark):
    df = spark.createDataFrame([(" u", "Logged", " a, b ,"), ("v", "Logged", None)], "userId string, userType string, history string")
    assert table(history.explode_validation(df), "user_id", "page") == [("u", "a"), ("u", "b")]


def test_lenient_long(spark):
    df = spark.createDataFrame([("12",), (" 5 ",), ("3.7",), ("-2.9",), ("x",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(lenient_long(F.col("s"))).collect()] == [12, 5, 3, -2, None, None, None]


def interactions(spark, rows):
    return spark.createDataFrame(rows, "user_id string, page string, ts double")


def test_user_times(spark):
    df = interactions(spark, [("a", "p", 100.0), ("b", "q", 50.0), ("a", "r", 7300.0), ("a", "s", 7300.0), ("b", "t", 90.0), ("a", "z", 7400.0)])
    out = history.with_user_times(df, 10000)
    assert table(out, "user_id", "page", "time_since_last", "first_interaction", "time_since_first") == [
        ("a", "p", 0.0, 100.0, 9900.0), ("a", "r", 7200.0, 100.0, 9900.0), ("a", "s", 0.0, 100.0, 9900.0), ("a", "z", 100.0, 100.0, 9900.0),
        ("b", "q", 0.0, 50.0, 9950.0), ("b", "t", 40.0, 50.0, 9950.0)]


def test_hot_users_are_spread_and_equal_plain_windows(spark, sf, request):
    from readflow.sources import tables
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a thousand rows would make one part
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    df = tables.interactions(spark, sf)
    user = F.col("user_id").cast("int")
    # A hot user inside one hour, readers without an id, readings without a time.
    hot = df.withColumn("user_id", F.when(user < 4, "hot").when(user >= 6, F.col("user_id"))).withColumn(
        "ts", F.when(F.col("user_id") == "hot", AS_OF - F.col("ts") % 3600).when(F.col("clicks") < 6, F.col("ts")))
    out = history.with_user_times(hot, AS_OF)
    group = W.partitionBy("user_id").orderBy("ts", *history.TIE_BREAK)
    plain = hot.withColumn("time_since_last", F.coalesce(F.col("ts") - F.lag("ts").over(group), F.lit(0.0)))
    plain = plain.withColumn("first_interaction", F.min("ts").over(W.partitionBy("user_id")))
    plain = plain.withColumn("time_since_first", F.lit(AS_OF) - F.col("first_interaction"))
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    parts = skew.in_range_parts(hot, "user_id", "ts").groupBy("user_id", "_part").count().filter("user_id is null or user_id = 'hot'")
    assert parts.groupBy("user_id").count().filter("count > 1").count() == 2


def test_scores(spark):
    df = spark.createDataFrame([(2, 100, 50.0), (None, 1, 1.0)], "clicks int, time_on_page_ms long, scroll_pct double")
    assert [r[0] for r in df.select(scoring.interaction_score()).collect()] == [41.0, None]
    ages = spark.createDataFrame([(float(AS_OF),), (AS_OF - 86400.0,), (AS_OF + 43200.0,), (AS_OF + 86400.0,)], "ts double")
    assert [r[0] for r in ages.select(scoring.recency_weight("ts", AS_OF)).collect()] == [1.0, 0.5, 2.0, None]


def test_time_weight(spark):
    df = spark.createDataFrame([("a", 10), ("a", 30), ("b", 40), ("c", None)], "page string, time_on_page_ms long")
    assert table(history.with_time_weight(df).distinct(), "page", "avg_time_on_page", "time_weight") == [
        ("a", 20.0, 0.5), ("a", 20.0, 0.5), ("b", 40.0, 1.0), ("c", None, None)]
    zero = spark.createDataFrame([("a", 0)], "page string, time_on_page_ms long")
    assert history.with_time_weight(zero).first()["time_weight"] is None


def test_item_dates(spark):
    df = spark.createDataFrame([
        ("a", "2024-01-30 12:00:00+00:00", "2024-02-01 12:00:00+00:00"), ("b", "soon", None), ("c", "2024-02-03 12:00:00", "2024-01-31 00:00:00"),
    ], "page string, issued string, modified string")
    out = items.silver_items(df.withColumns({"url": F.lit("u"), "body": F.lit("b"), "caption": F.lit("c")}), AS_OF)
    assert "body" not in out.columns
    assert table(out, "page", "days_since_published", "days_since_modified", "year", "month", "day") == [
        ("a", 1, 0, 2024, 1, 30), ("b", None, None, None, None, None), ("c", -2, 1, 2024, 2, 3)]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.0), (3.0, 5.0, -1.0), (None, 5.0, -2.0)], "a double, b double, c double")
    assert table(scaling.minmax_scale(df, ["a", "b", "missing"]), "a", "b") == [(0.0, 0.5), (1.0, 0.5), (None, 0.5)]
    assert [r[0] for r in scaling.log_scale(df, ["c", "missing"]).select("c").collect()] == [0.0, None, None]


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",), ("d",), ("d",), ("d",), (None,)], "user_type string")
    assert table(scaling.label_index(df, "user_type"), "user_type", "index") == [("a", 2.0), ("b", 1.0), ("c", 3.0), ("d", 0.0)]
    assert scaling.index_labels(df).filter("user_type = 4").count() == 1
    many = spark.range(3000).select(F.concat(F.lit("l"), (F.col("id") % 1000).cast("string")).alias("user_type"))
    assert scaling.label_index(many, "user_type").agg(F.max("index")).first()[0] == 999.0
    labels = spark.createDataFrame([("b", 0.0)], "user_type string, index double")
    assert sorted(r[0] for r in scaling.index_labels(df, labels=labels).collect()) == [0.0, 0.0] + [1.0] * 6
    plan = scaling.index_labels(df, labels=labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_clean_text_and_terms(spark):
    df = spark.createDataFrame([
        ("1", "Olá  <b>MUNDO</b>\n\thttps://x.y/z www.a.b 😀 fim"), ("2", None), ("3", "😀"), ("4", "de de casa"),
    ], "page string, title string")
    clean = tfidf.with_clean_text(df)
    assert table(clean, "page", "cleaned_text") == [("1", "olá mundo fim"), ("2", ""), ("3", ""), ("4", "de de casa")]
    assert table(tfidf.term_counts(clean), "page", "term", "tf") == [
        ("1", "fim", 1), ("1", "mundo", 1), ("1", "olá", 1), ("4", "casa", 1), ("4", "de", 2)]
    assert ("4", "de") not in table(tfidf.term_rows(clean, stop_words=tfidf.PORTUGUESE_STOP_WORDS), "page", "term")
    weights = tfidf.tfidf_terms(clean).filter("term = 'de'").first()
    assert weights["df"] == 1 and math.isclose(weights["tfidf"], 2 * math.log(5 / 2))


@pytest.mark.parametrize("hashing", ["murmur3", "md5"])
def test_hashed_totals_equal_token_totals(spark, sf, hashing):
    from readflow.plans import catalog
    clean = catalog.cleaned(spark, sf)
    out = tfidf.hashed_tfidf(clean, hashing=hashing)
    hashed = tfidf.features_long(out, "page", "raw_features").groupBy("page").agg(F.sum("value").cast("bigint").alias("n"))
    plain = tfidf.term_rows(clean, stop_words=tfidf.PORTUGUESE_STOP_WORDS).groupBy("page").agg(F.count("*").alias("n"))
    assert hashed.exceptAll(plain).count() == 0 and plain.exceptAll(hashed).count() == 0


def test_saved_text_model_gives_the_same_vectors(spark, sf, tmp_path):
    from pyspark.ml import PipelineModel
    from readflow.plans import catalog
    clean = catalog.cleaned(spark, sf)
    tfidf.hashed_model(clean).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(clean)
    a = tfidf.features_long(loaded, "page")
    b = tfidf.features_long(tfidf.hashed_tfidf(clean), "page")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_interaction_matrix(spark):
    df = spark.createDataFrame([
        ("u", "a", 1.0), ("u", " a ", 2.0), ("u", "b", 0.0), ("v", "b", -1.0), ("v", "x", 5.0), ("", "a", 1.0), (None, "a", 1.0), ("v", "a", None), ("v", "b", 4.0),
    ], "user_id string, page string, adjusted_score double")
    catalogue = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "page string")
    out = gold.interaction_matrix(df, catalogue)
    assert table(out, "user_id", "page", "score") == [("u", "a", 3.0), ("v", "b", 4.0)]
    assert {r["user_idx"] for r in out.collect()} == {0, 1}


def test_indexes_are_dense(spark):
    df = spark.range(5000).select((F.col("id") * 7 - 900).alias("k"))
    by_hash = skew.dense_index(df, "k", "i").repartition(3)
    assert by_hash.select("i").distinct().count() == 5000 and by_hash.agg(F.max("i")).first()[0] == 4999
    ordered = skew.ordered_index(df, "k", "i")
    assert ordered.filter("k != i * 7 - 900").count() == 0
    odd = spark.createDataFrame([(k,) for k in (*range(1000), 10**15, -9 * 10**18, 9 * 10**18)], "k long")
    assert [r["i"] for r in skew.ordered_index(odd, "k", "i").orderBy("k").collect()] == list(range(1003))
    one = skew.ordered_index(df.limit(1), "k", "i").collect()
    assert [r["i"] for r in one] == [0]


def test_compact_items(spark):
    inter = spark.createDataFrame([(0, 10, 1.0), (4, 30, 2.0)], "user_idx long, item_idx long, score double")
    feats = spark.createDataFrame([(10, 0, .1), (20, 0, .2), (30, 1, .3)], "item_idx long, feature_idx int, value double")
    i, f = gold.compact_items(inter, feats)
    assert table(i, "user_idx", "item_idx", "score") == [(0, 0, 1.0), (4, 1, 2.0)]
    assert table(f, "item_idx", "feature_idx", "value") == [(0, 0, .1), (1, 1, .3)]


def test_split_and_sample_do_not_depend_on_partitions(spark):
    pairs = spark.range(3000).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 50).cast("string").alias("page"))
    train, test = gold.train_test_split(pairs, 0.2)
    assert train.intersect(test).count() == 0 and train.count() + test.count() == 3000
    assert 450 < test.count() < 750
    again = gold.train_test_split(pairs.repartition(17), 0.2)[1]
    assert test.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        gold.with_split(pairs, 1.0)
    with pytest.raises(ValueError):
        gold.hash_sample(pairs, 0)
    assert gold.hash_sample(pairs, 1.0).count() == 3000


def test_samples_are_split_in_the_same_shares(spark):
    pairs = spark.range(200_000).select(F.col("id").cast("string").alias("user_id"), F.lit("p").alias("page"))
    assert 50 < gold.hash_sample(pairs, 0.0004).count() < 115
    assert 40 < 200_000 - gold.hash_sample(pairs, 0.9996).count() < 125
    train, test = gold.train_test_split(gold.hash_sample(pairs, 0.1), 0.2)
    assert 15_400 < train.count() < 16_700 and 3_700 < test.count() < 4_300


def factors(spark, name, vectors, bias=0.0):
    return spark.createDataFrame([(k, v, bias) for k, v in vectors.items()], f"{name} string, factors array<double>, bias double")


@pytest.fixture
def small_model(spark):
    users = factors(spark, "user_id", {"u": [1.0, 0.0], "v": [0.0, 1.0]})
    pages = factors(spark, "page", {"article1": [.8, .3], "article2": [.6, .3], "article3": [.4, .3], "article4": [.2, .3]})
    return users, pages


def test_recommend_scales_and_breaks_ties(spark, small_model):
    out = recommend.recommend_top_n(*small_model, 2)
    got = [(u, r, p, round(s, 6)) for u, r, p, s in table(out, "user_id", "rank", "page", "score")]
    assert got == [("u", 1, "article1", 1.0), ("u", 2, "article2", 0.666667), ("v", 1, "article1", 0.5), ("v", 2, "article2", 0.5)]


def test_recommend_requests(spark, small_model):
    ask = spark.createDataFrame([("u", 1), ("v", 9), ("nobody", 3)], "user_id string, n int")
    out = recommend.recommend_batch(ask, *small_model)
    assert {(r["user_id"], r["n"]) for r in out.groupBy("user_id").agg(F.count("*").alias("n")).collect()} == {("u", 1), ("v", 4)}
    nested = {r["user_id"]: r["predictions"] for r in recommend.recommend_nested(out).collect()}
    assert [p["page"] for p in nested["v"]] == ["article1", "article2", "article3", "article4"]
    with pytest.raises(Exception, match="greater than 0"):
        recommend.recommend_batch(spark.createDataFrame([("u", 0)], "user_id string, n int"), *small_model).collect()
    with pytest.raises(ValueError):
        recommend.recommend_top_n(*small_model, 0)


def test_recommend_leaves_out_seen(spark, small_model):
    seen = spark.createDataFrame([("u", "article1"), *[("v", f"article{i}") for i in range(1, 5)]], "user_id string, page string")
    out = recommend.recommend_top_n(*small_model, 2, exclude_seen=seen)
    assert [(u, p) for u, p in table(out, "user_id", "page")] == [("u", "article2"), ("u", "article3")]


def test_many_blocks_equal_one(spark, sf, monkeypatch):
    from readflow.operators import blocks
    from readflow.sources import tables
    users, pages = tables.factor_model(spark, sf)
    positives = gold.train_test_split(tables.interactions(spark, sf).select("user_id", "page").distinct())[1]
    def both():
        return table(recommend.recommend_top_n(users, pages, 5), "user_id", "rank", "page"), table(
            evaluate.rank_positives(positives, users, pages), "user_id", "page", "rank")
    one = both()
    monkeypatch.setattr(blocks.item_blocks, "__defaults__", (40, False))
    monkeypatch.setattr(blocks.user_blocks, "__defaults__", (70,))
    monkeypatch.setattr(evaluate, "ROWS_PER_RANK_BLOCK", 3)
    monkeypatch.setattr(evaluate, "POSITIVES_PER_CHUNK", 2)
    monkeypatch.setattr(blocks, "CELL", 2)
    assert both() == one
    n_users = users.count()
    cells = -(-blocks.item_blocks(pages, 40, by_norm=True).shape.first().blocks // 2)
    asked = users.select("user_id", "factors", F.lit(5).alias("n"))
    seen = tables.interactions(spark, sf).select("user_id", "page")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert cells > 2 and recommend._candidates(asked, pages, None).count() == 5 * n_users * cells
        plan = recommend._candidates(asked, pages, seen)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInPandas") == 1 and "Exchange" not in plan[plan.index("MapInPandas") : plan.index("SortMergeJoin")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_als_finds_the_users_own_cluster(spark):
    rows = [(f"u{u}", f"p{p}", u, p, 5.0) for u in range(20) for p in range(12) if u % 2 == p % 2 and (u + p) % 5]
    matrix = spark.createDataFrame(rows, "user_id string, page string, user_idx long, item_idx long, score double")
    out = recommend.recommend_top_n(*recommend.train_factors(matrix, rank=4, iterations=8, reg=0.01), 4)
    assert out.filter("int(substr(user_id, 2)) % 2 != int(substr(page, 2)) % 2").count() == 0


def ranks(spark, rows):
    return spark.createDataFrame(rows, "user_id string, page string, rank long")


def test_metrics_perfect_and_tied(spark, small_model):
    users, pages = small_model
    top = spark.createDataFrame([("u", "article1"), ("u", "article2")], "user_id string, page string")
    row = evaluate.metrics_by_k(top, users, pages, (2,)).first().asDict()
    assert row == {"k": 2, "users": 1, "precision": 1.0, "recall": 1.0, "f1": 1.0, "hit_rate": 1.0, "ndcg": 1.0, "auc": 1.0, "mrr": 1.0}
    tied = spark.createDataFrame([("v", "article1")], "user_id string, page string")
    assert table(evaluate.rank_positives(tied, users, pages), "user_id", "page", "rank") == [("v", "article1", 3)]
    assert evaluate.metrics_by_k(tied, users, pages, (2,)).first()["auc"] == 0.0


def test_metric_values_on_the_survey_model(spark):
    """The published regression values of the survey's fixture: 150 users, 100 items, sf0.01."""
    from readflow.sources import tables
    d = "/root/testdata/sf0.01"
    e = tables.table(spark, d, "embeddings")
    vector = F.col("embedding").cast("array<double>").alias("factors")
    pages = e.filter("vec_id < 100").select(F.col("vec_id").cast("string").alias("page"), vector, (F.col("label") * 0.01).alias("bias"))
    users = e.filter("vec_id between 100 and 249").select((F.col("vec_id") - 100).cast("string").alias("user_id"), vector, F.lit(0.0).alias("bias"))
    pairs = tables.interactions(spark, d).select("user_id", "page").distinct()
    test = pairs.filter(md5_number(F.concat_ws("|", "user_id", "page", F.lit("42"))) % 1000 < 200)  # the fixture's own split
    assert test.count() == 1455
    row = evaluate.metrics_by_k(test, users, pages, (10,)).first()
    got = [round(row[m], 6) for m in ("precision", "recall", "auc", "mrr", "ndcg")]
    assert got == [0.095333, 0.102576, 0.509673, 0.239659, 0.1036]


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4, 4, 10)], "x double")
    assert [r["count"] for r in distributions.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 2, 2, 0, 1]
    same = distributions.histogram(df.select(F.lit(3.0).alias("x")), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == [0, 0, 7, 0] and same[0]["low"] == 2.5


def test_quantile_bins(spark):
    ties = spark.createDataFrame([(v,) for v in [1] * 8 + [2, 9]], "x long")
    bins = distributions.quantile_bins(ties, "x").orderBy("bin").collect()
    assert sum(r["count"] for r in bins) == 10 and bins[0]["low"] == 1.0 and bins[-1]["high"] == 9.0
    last = distributions.cumulative_share(distributions.quantile_bins(ties, "x")).orderBy(F.desc("bin")).first()
    assert last["cumulative_pct"] == 100.0
    constant = distributions.quantile_bins(ties.select(F.lit(4).cast("long").alias("x")), "x").collect()
    assert [(r["bin"], r["low"], r["high"], r["count"]) for r in constant] == [(1, 4.0, 4.0, 10)]


def test_median_and_ks(spark):
    odd = spark.createDataFrame([(float(x),) for x in (5, 1, 9)], "x double")
    even = spark.createDataFrame([(float(x),) for x in (5, 1, 9, 6)], "x double")
    assert distributions.median_of(odd, "x").first()[0] == 5.0 and distributions.median_of(even, "x").first()[0] == 5.5
    assert distributions.two_sample_ks(even, even, "x").first()["ks"] == 0.0
    assert distributions.two_sample_ks(even, even.select((F.col("x") + 100).alias("x")), "x").first()["ks"] == 1.0


def test_gini(spark):
    equal = spark.createDataFrame([(3,), (3,), (3,)], "n long")
    assert abs(monitor.gini(equal, "n").first()["gini"]) < 1e-12
    skewed = spark.createDataFrame([(0,), (0,), (0,), (8,)], "n long")
    assert monitor.gini(skewed, "n").first()["gini"] == 0.75


def test_popularity_bands(spark):
    df = spark.createDataFrame([(n,) for n in (1, 10, 11, 100, 101, 10000, 10001)], "unique_users long")
    assert [(r["band"], r["count"]) for r in analytics.popularity_bands(df).collect()] == [
        ("1-10", 2), ("11-100", 2), ("101-1000", 1), ("1001-10000", 1), ("10001+", 1)]


def test_runs_are_selected_by_their_own_time(spark, small_model, tmp_path):
    path = str(tmp_path / "runs")
    pairs = spark.range(40).select(F.concat(F.lit("u"), (F.col("id") % 2).cast("string")).alias("x"), F.concat(F.lit("article"), (1 + F.col("id") % 4).cast("string")).alias("page"))
    pairs = pairs.select(F.when(F.col("x") == "u0", "u").otherwise("v").alias("user_id"), "page").distinct()
    items_ = small_model[1].select("page")
    for run, created in (("new", "2024-02-01T00:00:00"), ("old", "2024-01-01T00:00:00")):
        models.append_run(training.run_document(pairs, items_, *small_model, run_id=run, created_at=created), path)
    models.append_run(training.failed_run(spark, "broken", "2024-03-01T00:00:00", "boom"), path)
    runs = models.read_runs(spark, path)
    assert models.latest_run(runs).first()["run_id"] == "new"
    assert [r["run_id"] for r in models.list_runs(runs).collect()] == ["new", "old"]
    assert models.select_run(runs, "broken").first()["error"] == "boom"
    row = models.latest_run(runs).first()
    assert row["dataset_info"]["n_items"] == 4 and set(row["performance_metrics"]) >= {"precision@10", "recall@5", "auc", "mrr"}


def test_factor_tables_survive_a_round_trip(spark, small_model, tmp_path):
    models.save_factors(*small_model, str(tmp_path / "m"))
    users, pages = models.load_factors(spark, str(tmp_path / "m"))
    assert table(users, "user_id", "factors") == table(small_model[0], "user_id", "factors")
    assert pages.count() == 4
