"""Train, evaluate and describe a model run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from readflow.functions.columns import with_row
from readflow.operators import evaluate, gold, monitor
from readflow.sources import schemas


def run_document(
    pairs: DataFrame,
    items: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    run_id: str,
    created_at: str,
    model_summary: dict[str, str] | None = None,
    hyperparameters: dict[str, float] | None = None,
    test_ratio: float = 0.2,
    seed: int = 42,
    sample_size: float = 100.0,
    evaluation_ratio: float = 1.0,
    n_features: int | Column = 0,
    sizes: DataFrame | None = None,
    k_values: tuple[int, ...] = (5, 10, 20),
    ranks: DataFrame | None = None,
) -> DataFrame:
    """One row with everything monitored about a model on the split of ``pairs``.

    All parts are one-row aggregates read as scalar subqueries of one query. ``n_features`` is the
    number of content features, ``sizes`` the one row of ``model_sizes``, ``ranks`` the ranks of held-out pairs
    where they are known already (``evaluate.metrics_by_k``).
    """
    marked = gold.with_split(pairs, test_ratio, seed)
    train, test = marked.filter("not is_test"), marked.filter("is_test")
    if evaluation_ratio < 1:
        test = gold.hash_sample(test, evaluation_ratio, seed, "evaluate")
    n_users = pairs.agg(F.countDistinct("user_id")).scalar()
    n_items = items.agg(F.countDistinct("page")).scalar()

    def metric_map(df: DataFrame, key: str, value: str):
        entries = F.collect_list(F.struct(F.col(key), F.col(value)))
        return df.agg(F.map_from_entries(entries).alias("m")).scalar()

    norms = metric_map(
        monitor.embedding_stats(user_factors, item_factors).select(F.explode(F.array(
            F.struct(F.concat("side", F.lit("_embedding_norm_mean")).alias("k"), F.col("norm_mean").alias("v")),
            F.struct(F.concat("side", F.lit("_embedding_norm_std")).alias("k"), F.col("norm_std").alias("v")))).alias("e")).select("e.*"),
        "k", "v")
    ranked = evaluate.metrics_by_k(test, user_factors, item_factors, k_values, ranks)
    per_k = ranked.select(F.explode(F.flatten(F.array(
        F.array(*[F.struct(F.concat(F.lit(f"{m}@"), F.col("k").cast("string")).alias("k"), F.col(m).alias("v"))
                  for m in ("precision", "recall", "f1", "hit_rate", "ndcg")]),
        F.when(F.col("k") == k_values[0], F.array(*[F.struct(F.lit(m).alias("k"), F.col(m).alias("v")) for m in ("auc", "mrr")]))
        .otherwise(F.array().cast("array<struct<k:string,v:double>>")),
    ))).alias("e")).select("e.*")

    def literals(values: dict, kind: str):
        pairs_ = [F.lit(x) for kv in values.items() for x in kv]
        return (F.create_map(*pairs_) if pairs_ else F.create_map()).cast(f"map<string,{kind}>")

    def picked(row, names, kind):
        return F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"{row}.{n}").cast(kind))])

    base = with_row(pairs.sparkSession.range(1), monitor.split_stats(marked, n_users, n_items), "sizes")
    base = with_row(base, monitor.coverage_stats(train, n_users, n_items), "coverage")
    return base.select(
        F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at"), F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"),
        (literals(model_summary or {}, "string") if sizes is None else F.map_concat(
            literals(model_summary or {}, "string"), sizes.select(F.col("sizes").cast("map<string,string>")).scalar())).alias("model_summary"),
        literals(hyperparameters or {}, "double").alias("hyperparameters"),
        metric_map(per_k, "k", "v").alias("performance_metrics"),
        picked("sizes", ["total_interactions", "train_interactions", "test_interactions", "interactions_per_user",
                       "interactions_per_item", "sparsity"], "double").alias("interaction_distribution"),
        picked("coverage", ["user_coverage", "item_coverage", "cold_start_users", "cold_start_items"], "double").alias("model_stability"),
        norms.alias("embedding_stats"),
        metric_map(monitor.feature_importance(item_factors), "feature", "importance").alias("feature_importance"),
        F.create_map(
            F.lit("n_users"), F.col("sizes.n_users"), F.lit("n_items"), F.col("sizes.n_items"), F.lit("n_features"), (n_features if isinstance(n_features, Column) else F.lit(n_features)).cast("bigint"),
            F.lit("n_train_interactions"), F.col("sizes.train_interactions"), F.lit("n_test_interactions"), F.col("sizes.test_interactions"),
        ).alias("dataset_info"),
        F.lit(sample_size).alias("sample_size"),
    )


def model_sizes(user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """One row, a map: numbers of user and item vectors, and of the values they hold."""
    def size(df):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("factors") + 1).alias("v"))

    both = with_row(with_row(user_factors.sparkSession.range(1), size(user_factors), "u"), size(item_factors), "i")
    return both.select(F.create_map(
        F.lit("user_vectors"), F.col("u.n"), F.lit("item_vectors"), F.col("i.n"), F.lit("parameters"), F.col("u.v") + F.col("i.v")).alias("sizes"))


def width_of(items: DataFrame, vectors: str) -> Column:
    """The length of the items' feature vectors, as a scalar; 0 without items."""
    from pyspark.ml.functions import vector_to_array

    return items.select(F.size(vector_to_array(F.col(vectors))).alias("w")).agg(F.coalesce(F.max("w"), F.lit(0))).scalar()


def with_full_monitoring(
    run: DataFrame, scores: DataFrame, items: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
    test_ratio: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Add to a run how interactions are distributed, how scores differ between train and test, and
    the mean size of each factor component. ``scores`` holds (user_id, page, score)."""
    train, test = gold.train_test_split(scores, test_ratio, seed)
    users, pages = scores.select("user_id").distinct(), items.select("page").distinct()
    totals = monitor.interaction_distribution(scores, users, pages)
    bins = monitor.interaction_histograms(scores, users, pages)

    def numbers(df: DataFrame):
        names = [n for n in df.columns if n != "side"]
        return df.select(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])).scalar()

    def counts(side):
        listed = F.sort_array(F.collect_list(F.struct("bin", "count")))
        return bins.filter(F.col("side") == side).agg(listed.alias("l")).select("l.count").scalar()

    components = None
    for name, factors in (("item_embeddings", item_factors), ("user_embeddings", user_factors)):
        part = monitor.mean_abs_components(factors).select(F.concat(F.lit(f"{name}_"), F.col("component").cast("string")).alias("k"), "value")
        components = part if components is None else components.unionByName(part)
    return run.withColumns({
        "score_stability": numbers(monitor.score_stability(train, test, user_factors, item_factors)),
        "user_interactions": numbers(totals.filter("side = 'user'")),
        "item_interactions": numbers(totals.filter("side = 'item'")),
        "user_histogram": counts("user"), "item_histogram": counts("item"),
        "component_means": components.agg(F.map_from_entries(F.collect_list(F.struct("k", "value")))).scalar(),
    })


def failed_run(spark: SparkSession, run_id: str, created_at: str, error: str) -> DataFrame:
    """The row recorded for a run that failed; the caller raises the error as well."""
    values = {"run_id": run_id, "created_at": created_at, "status": "error", "error": error}
    return spark.range(1).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schemas.RUNS])
