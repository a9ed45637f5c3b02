"""Every operator as a named query over the benchmark tables, with the DuckDB text it must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from readflow.functions import scoring
from readflow.functions.columns import md5_number, round_doubles, with_row
from readflow.operators import analytics, distributions, evaluate, fold_in, gold, history, items as articles, monitor, readers, recommend, scaling, skew, tfidf
from readflow.plans import incremental, training
from readflow.plans.sql import CTES, histogram_sql, md5_number as md5_sql, quantile_bins_sql, share, sql
from readflow.session import configure, materialize, scratch_path
from readflow.sources import files, models, tables
from readflow.sources.tables import AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MID_RUN = 1705363200  # 2024-01-16 00:00:00 UTC


def query(oracle: str | None = None, digits: int = 6):
    """Register a function as a query of its own name; doubles but ``ts`` are rounded."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(configure(spark), sf_dir), digits, skip=("ts",))

        QUERIES[fn.__name__] = run
        if oracle is not None:
            ORACLES[fn.__name__] = oracle if oracle.startswith("with ") else sql(oracle)
        return fn
    return register


def silver(spark, d):
    return history.enrich(tables.interactions(spark, d), AS_OF)


def stored_silver(spark, d):
    """The silver layer as a written table, as the batch pipeline leaves it for the steps after."""
    return materialize(silver(spark, d), "silver")


def normalized(spark, d):
    labels = scaling.label_index(tables.interactions(spark, d), "user_type")
    return scaling.normalize_interactions(stored_silver(spark, d), labels)


def temporal(spark, d):
    return history.with_temporal(tables.interactions(spark, d))


def silver_items(spark, d):
    return articles.silver_items(tables.raw_articles(spark, d), AS_OF)


def cleaned(spark, d):
    return tfidf.with_clean_text(tables.raw_articles(spark, d).select("page", "title"))


def vectors(spark, d):
    return tfidf.item_features(tfidf.hashed_tfidf(cleaned(spark, d), hashing="md5", keep=["page"]))


def pairs(spark, d):
    return tables.interactions(spark, d).select("user_id", "page").distinct()


def user_item_scores(spark, d):
    return materialize(gold.user_item_scores(normalized(spark, d), tables.catalogue(spark, d)), "scores")


def id_counts(spark, d):
    """Numbers of users and catalogue pages, as scalars."""
    users = tables.interactions(spark, d).agg(F.countDistinct("user_id")).scalar()
    return users, tables.catalogue(spark, d).agg(F.countDistinct("page")).scalar()


# --- silver -----------------------------------------------------------------------------------

@query("select user_id, page, ts, round(adjusted_score, 6) adjusted_score from silver")
def adjusted_score(spark, d):
    return silver(spark, d).select("user_id", "page", "ts", "adjusted_score")


@query("""select user_id, cast(rank as int) as rank, page, round(score, 6) score from (
    select user_id, page, sum(adjusted_score) score,
    row_number() over (partition by user_id order by sum(adjusted_score) desc, page) as rank from silver group by 1, 2) where rank <= 10""")
def top_pages(spark, d):
    return analytics.top_pages(silver(spark, d))


@query("select user_id, page, ts, round(interaction_score, 6) interaction_score from silver")
def interaction_score(spark, d):
    return tables.interactions(spark, d).select("user_id", "page", "ts", scoring.interaction_score().alias("interaction_score"))


@query("select user_id, page, ts, round(recency_weight, 6) recency_weight from silver")
def recency_weight(spark, d):
    return tables.interactions(spark, d).select("user_id", "page", "ts", scoring.recency_weight("ts", AS_OF).alias("recency_weight"))


@query("select user_id, page, ts, round(avg_time_on_page, 6) avg_time_on_page, round(time_weight, 6) time_weight from weighted")
def time_weight(spark, d):
    return history.with_time_weight(tables.interactions(spark, d)).select("user_id", "page", "ts", "avg_time_on_page", "time_weight")


@query("select user_id, page, ts, hour, dayofweek, year, month, day from temporal")
def temporal_features(spark, d):
    return temporal(spark, d).select("user_id", "page", "ts", "hour", "dayofweek", "year", "month", "day")


@query("select user_id, page, ts, round(time_since_last, 6) time_since_last from user_times")
def time_since_last(spark, d):
    return history.with_user_times(tables.interactions(spark, d), AS_OF).select("user_id", "page", "ts", "time_since_last")


@query("""select user_id, page, ts, round(first_interaction, 3) first_interaction, round(time_since_first, 3) time_since_first from user_times""", digits=3)
def time_since_first(spark, d):
    return history.with_user_times(tables.interactions(spark, d), AS_OF).select("user_id", "page", "ts", "first_interaction", "time_since_first")


@query("""select user_id, user_type, page, (epoch_us(e.ts) // 1000) / 1000 ts, clicks, time_on_page_ms, round(scroll_pct, 6) scroll_pct, visits
    from (select epoch_us(ts) / 1e6 ets, ts, user_id uid from events) e
    join inter i on i.ts = e.ets and i.user_id = cast(e.uid as varchar)""")
def explode_history(spark, d):
    return history.explode_history(tables.raw_history(spark, d))


@query("""select count(*) histories, count(*) filter (user_id % 7 = 0) dropped, count(*) filter (user_id % 7 <> 0 and user_id % 5 = 1 and n > 1) padded
    from (select user_id, count(*) n from events group by user_id, event_id // 1024)""")
def history_quality(spark, d):
    """Histories of which some lost a whole list, and some the last value of one."""
    raw, user = tables.raw_history(spark, d), F.col("userId").cast("bigint")
    short = F.regexp_replace("numberOfClicksHistory", r",\s*[^,]*$", "")
    damaged = raw.withColumns({
        "history": F.when(user % 7 != 0, F.col("history")),
        "numberOfClicksHistory": F.when(user % 5 == 1, short).otherwise(F.col("numberOfClicksHistory"))})
    return history.history_quality(damaged)


@query("select page, days_since_published, days_since_modified, year, month, day from items")
def item_dates(spark, d):
    return silver_items(spark, d).select("page", "days_since_published", "days_since_modified", "year", "month", "day")


# --- sources and sinks ------------------------------------------------------------------------

@query("""select user_id, user_type, page, (epoch_us(e.ts) // 1000) / 1000 ts, clicks, time_on_page_ms, round(scroll_pct, 6) scroll_pct, visits
    from (select epoch_us(ts) / 1e6 ets, ts, user_id uid from events) e
    join inter i on i.ts = e.ets and i.user_id = cast(e.uid as varchar)""")
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "history-csv")
    files.write_csv(tables.raw_history(spark, d), path)
    return history.explode_history(files.read_history(spark, path))


@query("select page, title, cast(year(issued) as int) as year, cast(month(issued) as int) as month, cast(day(issued) as int) as day from articles")
def articles_csv_roundtrip(spark, d):
    path = scratch_path(spark, "articles-csv")
    source = tables.raw_articles(spark, d)
    names = ["page", "url", "issued", "modified", "title", "body", "caption"]
    files.write_csv(source.select(names), path)
    return articles.silver_items(files.read_articles(spark, path), AS_OF).select("page", "title", "year", "month", "day")


@query("select user_id, page, ts, year, month, day from temporal")
def partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "interactions")
    files.write_partitioned(temporal(spark, d), path)
    return files.read_table(spark, path).select("user_id", "page", "ts", "year", "month", "day")


@query("""select hour, count(*) reads, count(*) filter (i.page is not null) known from temporal t left join (select page from items where year = 2023) i using (page)
    where year = 2024 and month = 1 group by hour""")
def sql_views(spark, d):
    files.register_views(temporal(spark, d), silver_items(spark, d))
    return spark.sql("""select hour, count(*) as reads, count_if(a.page is not null) as known
        from interactions i left join (select page from items where year = 2023) a on a.page = i.page
        where i.year = 2024 and i.month = 1 group by hour""")


# --- layers that grow -------------------------------------------------------------------------

def in_two_batches(spark, d):
    """Readings of the first half of the month but for some that come late, then the rest; the second batch is loaded twice."""
    layer, state = scratch_path(spark, "silver"), scratch_path(spark, "reader-times")
    rows = materialize(tables.interactions(spark, d), "readings")
    first = (F.col("ts") < MID_RUN) & (md5_number(F.col("page")) % 10 != 0)
    for batch, part in (("first", rows.filter(first)), ("second", rows.filter(~first)), ("second", rows.filter(~first))):
        incremental.load_readings(part, layer, state, batch)
    return incremental.read_readings(spark, layer, state, AS_OF)


@query("select user_id, page, ts, year, month, day, round(time_since_last, 6) time_since_last, round(time_since_first, 3) time_since_first from user_times")
def incremental_user_times(spark, d):
    rows = in_two_batches(spark, d).select("user_id", "page", "ts", "year", "month", "day", "time_since_last", "time_since_first")
    return rows.withColumn("time_since_first", F.round("time_since_first", 3))


@query("select page, feature_idx, round(w, 6) as value from vectors")
def incremental_features(spark, d):
    """Document frequencies counted in two batches, stored, and added up for the weights of all articles."""
    path = scratch_path(spark, "document-counts")
    frequencies = materialize(tfidf.hashed_frequencies(cleaned(spark, d), hashing="md5").select("page", "raw_features"), "frequencies")
    odd = md5_number(F.col("page")) % 2 == 1
    for batch, part in (("even", ~odd), ("odd", odd), ("odd", odd)):
        incremental.save_part(incremental.document_counts(frequencies.filter(part)), path, batch)
    counts = incremental.load_parts(spark, path, incremental.total_counts)
    return tfidf.features_long(incremental.weigh(frequencies, counts, tfidf.N_FEATURES), "page")


@query("""select user_id, page, ts, year, month, day from temporal
    where ts >= epoch(timestamp '2024-01-09 06:30:00') and ts < epoch(timestamp '2024-01-20 18:00:00')""")
def date_range(spark, d):
    path = scratch_path(spark, "interactions")
    files.write_partitioned(temporal(spark, d), path)
    rows = files.read_table(spark, path).filter(files.date_range("2024-01-09T06:30:00", "2024-01-20T18:00:00"))
    return rows.select("user_id", "page", "ts", "year", "month", "day")


def stored_daily_readers(spark, d, keys):
    rows = temporal(spark, d)
    return materialize(readers.daily_readers(rows, skew.dense_index(rows, "user_id", "user_idx"), keys), "daily-readers")


@query("""select page, cast(date_trunc('week', t) as date)::varchar start, count(distinct user_id) unique_users from temporal group by 1, 2""")
def weekly_readers_per_page(spark, d):
    rows = readers.readers_per_window(stored_daily_readers(spark, d, ["page"]), ["page"], "week")
    return rows.withColumn("start", F.col("start").cast("string"))


@query("""select user_type, cast(date_trunc('month', t) as date)::varchar start, count(distinct user_id) unique_users from temporal group by 1, 2""")
def monthly_readers_by_type(spark, d):
    rows = readers.readers_per_window(stored_daily_readers(spark, d, ["user_type"]), ["user_type"], "month")
    return rows.withColumn("start", F.col("start").cast("string"))


@query("select cast(date_trunc('week', t) as date)::varchar start, true close from temporal group by 1")
def weekly_readers_estimated(spark, d):
    """Sketches of days, merged to weeks, lie within 5 % of the true count."""
    rows = temporal(spark, d)
    sketches = materialize(readers.daily_sketches(rows, []), "sketches")
    true = rows.groupBy(F.trunc(F.make_date("year", "month", "day"), "week").alias("start")).agg(F.count_distinct("user_id").alias("n"))
    joined = readers.estimated_readers(sketches, [], "week").join(true, "start")
    return joined.select(F.col("start").cast("string").alias("start"), (F.abs(F.col("unique_users") - F.col("n")) <= 1 + 0.05 * F.col("n")).alias("close"))


# --- analyses ---------------------------------------------------------------------------------

@query("select * from reads")
def reads_per_user(spark, d):
    return analytics.reads_per_user(tables.interactions(spark, d))


@query("select hour, count(*) count from temporal group by hour")
def reads_by_hour(spark, d):
    return analytics.reads_by_hour(temporal(spark, d))


@query("select dayofweek, hour, count(*) count from temporal group by dayofweek, hour")
def reads_by_weekday_hour(spark, d):
    return analytics.reads_by_weekday_hour(temporal(spark, d))


@query("select year, month, day, count(*) count, year || '-' || month || '-' || day as label from temporal group by year, month, day")
def reads_by_day(spark, d):
    return analytics.reads_by_day(temporal(spark, d))


@query("select year, month, day, user_id, count(*) visits from temporal group by year, month, day, user_id")
def visits_per_user_day(spark, d):
    return analytics.visits_per_user_day(temporal(spark, d))


@query("select year, month, day, count(distinct user_id) unique_users, strftime(make_date(year, month, day), '%Y-%m-%d') date from temporal group by year, month, day")
def daily_active_users(spark, d):
    return analytics.daily_active_users(temporal(spark, d)).withColumn("date", F.col("date").cast("string"))


@query("""select strftime(t, '%Y-%m-%d') date, user_type, count(*) count,
    round(count(*) / cast(sum(count(*)) over (partition by strftime(t, '%Y-%m-%d')) as double), 6) share from temporal group by 1, 2""")
def user_type_by_day(spark, d):
    return analytics.user_type_by_day(temporal(spark, d))


@query("select * from access")
def recency_access(spark, d):
    return analytics.recency_access(tables.interactions(spark, d), silver_items(spark, d))


LAYER_BUCKETS = 32


@contextmanager
def co_located(spark, d):
    """Reads per page and article dates as two tables of equal buckets by page. Reads are summed first: no page is hot."""
    names = [f"layer_{uuid.uuid4().hex}" for _ in range(2)]
    reads = tables.interactions(spark, d).groupBy("page").agg(F.count(F.lit(1)).alias("reads"))
    dates = silver_items(spark, d).select("page", "year", "month", "day", "days_since_published")
    try:
        yield [files.write_bucketed(df, name, scratch_path(spark, "layer"), ["page"], LAYER_BUCKETS) for name, df in zip(names, (reads, dates))]
    finally:
        for name in names:
            spark.sql(f"drop table if exists {name}")


@query("select item_year, item_month, item_day, days_since_published, access_count from access")
def recency_access_bucketed(spark, d):
    """Recency over stored layers: pages meet where they lie, and only counts per date are shuffled."""
    with co_located(spark, d) as (reads, dates):
        return materialize(analytics.recency_of_counts(reads, dates), "recency")


@query("select days_since_published, cast(sum(access_count) as bigint) access_count from access group by 1")
def recency_curve(spark, d):
    return analytics.recency_curve(analytics.recency_access(tables.interactions(spark, d), silver_items(spark, d)))


@query("select * from buyers")
def users_per_item(spark, d):
    return analytics.users_per_item(tables.purchases(spark, d))


@query("select page, count(distinct user_id) unique_users from inter group by page")
def users_per_item_exploded(spark, d):
    return analytics.users_per_item_exploded(tables.raw_history(spark, d))


@query("""select cast(band_order as int) band_order, band, count(*) count from (select case when unique_users <= 10 then '1-10' when unique_users <= 100 then '11-100'
    when unique_users <= 1000 then '101-1000' when unique_users <= 10000 then '1001-10000' else '10001+' end band,
    case when unique_users <= 10 then 0 when unique_users <= 100 then 1 when unique_users <= 1000 then 2 when unique_users <= 10000 then 3 else 4 end band_order
    from (select unique_users from buyers union all select count(distinct user_id) from inter group by page)) group by 1, 2""")
def popularity_bands(spark, d):
    """Articles bought by few and articles read by many."""
    bought, read = (analytics.users_per_item(t(spark, d)) for t in (tables.purchases, tables.interactions))
    return analytics.popularity_bands(bought.unionByName(read))


@query("select count(*) n_rows, true in_bounds from inter")
def clicks_time_sample(spark, d):
    """A random tenth of the readings; its size must lie within five standard deviations of a tenth."""
    rows = tables.interactions(spark, d)
    some = analytics.clicks_time_sample(rows, 0.1).agg(F.count(F.lit(1)).alias("k"))
    n = F.col("n_rows")
    return with_row(rows.agg(F.count(F.lit(1)).alias("n_rows")), some, "_some").select(
        "n_rows", (F.abs(F.col("_some.k") - n * 0.1) <= 5 * F.sqrt(n * 0.09)).alias("in_bounds"))


@query("""select page, round(avg_time_ms, 9) avg_time_ms, round(avg_clicks, 9) avg_clicks, round(avg_scroll_pct, 9) avg_scroll_pct,
    round(avg_score, 9) avg_score, round(avg_time_min, 9) avg_time_min from engagement""", digits=9)
def engagement_by_item(spark, d):
    return analytics.engagement_by_item(scored(spark, d))


def scored(spark, d):
    return tables.interactions(spark, d).withColumn("interaction_score", scoring.interaction_score())


@query("select round(corr(clicks, time_on_page_ms), 6) correlation from inter")
def clicks_time_corr(spark, d):
    return analytics.clicks_time_corr(tables.interactions(spark, d))


@query("select 'user' kind, user_id id from inter union select 'page', page from inter")
def distinct_users_items(spark, d):
    return analytics.distinct_users_items(tables.interactions(spark, d))


@query("select distinct user_id from inter order by user_id limit 5")
def preview_ids(spark, d):
    return analytics.preview(tables.interactions(spark, d), "user_id")


@query("select distinct page from inter where page not in (select page from labelled)")
def uncovered_items(spark, d):
    return gold.uncovered_items(tables.interactions(spark, d), tables.labelled_catalogue(spark, d))


# --- distributions ----------------------------------------------------------------------------

@query("select * from " + histogram_sql("reads", "reads", 30))
def histogram_reads(spark, d):
    return distributions.histogram(analytics.reads_per_user(tables.interactions(spark, d)), "reads", 30)


@query("select * from " + histogram_sql("(select count(*) visits from temporal group by year, month, day, user_id)", "visits", 30))
def histogram_visits(spark, d):
    return distributions.histogram(analytics.visits_per_user_day(temporal(spark, d)), "visits", 30)


@query("select * from " + histogram_sql("access", "days_since_published", 50))
def histogram_recency(spark, d):
    access = analytics.recency_access(tables.interactions(spark, d), silver_items(spark, d))
    return distributions.histogram(access, "days_since_published", 50)


@query("select * from " + histogram_sql("buyers", "unique_users", 50))
def histogram_overlap(spark, d):
    return distributions.histogram(analytics.users_per_item(tables.purchases(spark, d)), "unique_users", 50)


@query("""select cast(count(*) as bigint) n, cast(min(reads) as double) minimum, cast(max(reads) as double) maximum,
    cast(min(reads) filter (reads between lo and hi) as double) whisker_low, cast(max(reads) filter (reads between lo and hi) as double) whisker_high,
    cast(count(*) filter (not reads between lo and hi) as bigint) outliers, round(any_value(q[1]), 6) q1, round(any_value(q[2]), 6) median,
    round(any_value(q[3]), 6) q3, round(any_value(lo), 6) fence_low, round(any_value(hi), 6) fence_high
    from reads, (select q, q[1] - 1.5 * (q[3] - q[1]) lo, q[3] + 1.5 * (q[3] - q[1]) hi from (select quantile_cont(cast(reads as double), [0.25, 0.5, 0.75]) q from reads))""")
def boxplot_reads(spark, d):
    return distributions.box_plot(analytics.reads_per_user(tables.interactions(spark, d)), "reads")


@query("select bin, round(low, 6) low, round(high, 6) high, count from " + quantile_bins_sql("buyers", "unique_users") + " where count > 0")
def popularity_deciles(spark, d):
    bins = distributions.quantile_bins(analytics.users_per_item(tables.purchases(spark, d)), "unique_users")
    return bins.filter("count > 0")


@query("""select bin, round(low, 6) low, round(high, 6) high, count, cast(trunc(low) as bigint) || '-' || cast(trunc(high) as bigint) as label,
    round(sum(count) over (order by bin) / cast(sum(count) over () as double) * 100, 6) cumulative_pct from """ + quantile_bins_sql("reads", "reads"))
def interaction_deciles(spark, d):
    return distributions.cumulative_share(distributions.quantile_bins(analytics.reads_per_user(tables.interactions(spark, d)), "reads"))


@query(" union all ".join(f"""select '{y}' y, round(regr_slope({y}, avg_time_min), 6) slope, round(regr_intercept({y}, avg_time_min), 6) intercept,
    round(regr_r2({y}, avg_time_min), 6) r2, cast(regr_count({y}, avg_time_min) as bigint) n from engagement""" for y in ("avg_clicks", "avg_scroll_pct", "avg_score")))
def engagement_trend(spark, d):
    return distributions.linear_trend(
        analytics.engagement_by_item(scored(spark, d)), "avg_time_min", ["avg_clicks", "avg_scroll_pct", "avg_score"])


@query("""select 'time_on_page_ms' y, round(regr_slope(time_on_page_ms, clicks), 6) slope, round(regr_intercept(time_on_page_ms, clicks), 6) intercept,
    round(regr_r2(time_on_page_ms, clicks), 6) r2, cast(regr_count(time_on_page_ms, clicks) as bigint) n from inter""")
def clicks_time_trend(spark, d):
    return distributions.linear_trend(tables.interactions(spark, d), "clicks", ["time_on_page_ms"])


# --- normalisation and text -------------------------------------------------------------------

@query("select user_id, page, ts, " + ", ".join(f"round({c}, 6) {c}" for c in scaling.LOG_COLUMNS) + " from logged")
def log_normalize(spark, d):
    return scaling.log_scale(silver(spark, d)).select("user_id", "page", "ts", *scaling.LOG_COLUMNS)


@query("select user_type, index from labels_by_count")
def index_user_type(spark, d):
    return scaling.label_index(tables.interactions(spark, d), "user_type")


_NORMALIZED = ["user_type", *scaling.LOG_COLUMNS, *scaling.MINMAX_COLUMNS]


@query("select user_id, page, ts, " + ", ".join(f"round({c}, 6) as {c}" for c in _NORMALIZED) + " from norm")
def normalize_interactions(spark, d):
    return normalized(spark, d).select("user_id", "page", "ts", *_NORMALIZED)


@query("select page, round(days_since_published, 6) days_since_published, round(days_since_modified, 6) days_since_modified from item_norm")
def normalize_items(spark, d):
    return scaling.normalize_items(silver_items(spark, d)).select("page", *scaling.ITEM_COLUMNS)


@query("select page, cleaned_text from clean")
def clean_text(spark, d):
    return cleaned(spark, d).select("page", "cleaned_text")


@query("select * from term_counts")
def token_counts(spark, d):
    return tfidf.term_counts(cleaned(spark, d))


@query("select page, term, count(*) tf from kept_terms group by page, term")
def stopword_filter(spark, d):
    return tfidf.term_counts(cleaned(spark, d), stop_words=tfidf.PORTUGUESE_STOP_WORDS)


@query("""select page, term, tf, df, round(idf, 6) idf, round(tf * idf, 6) tfidf from term_counts join
    (select term, count(*) df, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) idf from term_counts group by term) using (term)""")
def tfidf_terms(spark, d):
    return tfidf.tfidf_terms(cleaned(spark, d))


@query()
def tfidf_hashed(spark, d):
    return tfidf.features_long(tfidf.hashed_tfidf(cleaned(spark, d), keep=["page"]), "page")


@query("""select page, cast(count(term) as double) tokens, true within_terms from catalogue left join kept_terms using (page) group by page""")
def tfidf_hashed_totals(spark, d):
    """What must hold whatever the hash: frequencies add up to the kept tokens, in at most as many buckets as terms."""
    frequencies = vector_to_array(F.col("raw_features"))
    rows = tfidf.hashed_frequencies(cleaned(spark, d))
    buckets = F.size(F.filter(frequencies, lambda x: x > 0))
    return rows.select("page", F.aggregate(frequencies, F.lit(0.0), lambda a, x: a + x).alias("tokens"), (buckets <= F.size(F.array_distinct("filtered"))).alias("within_terms"))


# --- gold -------------------------------------------------------------------------------------

@query("select 'user' kind, user_id id, user_idx idx from user_idx union all select 'page', page, item_idx from item_idx")
def dense_index(spark, d):
    users, pages = gold.id_maps(tables.interactions(spark, d), tables.catalogue(spark, d))
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("user_idx").alias("idx")).unionByName(
        pages.select(F.lit("page").alias("kind"), F.col("page").alias("id"), F.col("item_idx").alias("idx")))


@query("select o_custkey, cast(dense_rank() over (order by o_custkey) - 1 as bigint) idx from (select distinct o_custkey from orders)")
def ordered_index(spark, d):
    return skew.ordered_index(tables.table(spark, d, "orders"), "o_custkey", "idx")


@query("""select count(*) pages_read, count(l.page) pages_known, round(avg(case when l.page is null then 0.0 else 1.0 end), 6) coverage
    from (select distinct page from inter) p left join labelled l using (page)""")
def page_coverage(spark, d):
    return gold.page_coverage(tables.interactions(spark, d), tables.labelled_catalogue(spark, d))


@query("select user_id, page, user_idx, item_idx, round(score, 6) score from scores join user_idx using (user_id) join item_idx using (page)")
def interaction_matrix(spark, d):
    return gold.interaction_matrix(normalized(spark, d), tables.catalogue(spark, d))


@query("""select (select count(*) from inter) n_rows, (select count(distinct user_id) from inter) n_users, (select count(*) from catalogue) n_items,
    count(*) n_pairs, round(min(score), 6) min_score, round(max(score), 6) max_score,
    round(count(*) / ((select cast(count(distinct user_id) as double) from inter) * (select count(*) from catalogue)), 6) density from scores""")
def interaction_profile(spark, d):
    return gold.interaction_profile(normalized(spark, d), tables.catalogue(spark, d))


@query("select user_id, " + ", ".join(f"round({c}, 9) {c}" for c in scaling.USER_VECTOR_COLUMNS) + " from user_means", digits=9)
def user_features(spark, d):
    return gold.user_features(normalized(spark, d))


@query("select user_id, " + ", ".join(
    f"round(case when max({c}) over () = min({c}) over () then 0.5 else ({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()) end, 9) f{i}"
    for i, c in enumerate(scaling.USER_VECTOR_COLUMNS)) + " from user_means", digits=9)
def user_feature_vectors(spark, d):
    v = gold.user_feature_vectors(gold.user_features(normalized(spark, d)))
    return v.select("user_id", *[F.col("user_features")[i].alias(f"f{i}") for i in range(len(scaling.USER_VECTOR_COLUMNS))])


@query("""select page, count(w) nonzero, round(coalesce(sum(w), 0), 6) total, round(coalesce(sqrt(sum(w * w)), 0), 6) length
    from catalogue left join vectors using (page) group by page""")
def item_features(spark, d):
    arrays = vectors(spark, d).select("page", tfidf.vector_to_array("features").alias("v"))
    def total(f):
        return F.aggregate("v", F.lit(0.0), f)
    return arrays.select(
        "page", F.size(F.filter("v", lambda x: x != 0)).cast("bigint").alias("nonzero"),
        total(lambda a, x: a + x).alias("total"), F.sqrt(total(lambda a, x: a + x * x)).alias("length"))


@query("select page, feature_idx, round(w, 6) as value from vectors")
def features_long(spark, d):
    return tfidf.features_long(vectors(spark, d), "page")


@query("select page, title from articles where page in (select page from inter)")
def items_with_interactions(spark, d):
    return gold.items_with_interactions(tables.raw_articles(spark, d).select("page", "title"), tables.interactions(spark, d))


@query("""select l_orderkey user_idx, cast(dense_rank() over (order by l_partkey) - 1 as bigint) item_idx, l_quantity score, p_size as part_size
    from lineitem join part on p_partkey = l_partkey""")
def compact_items(spark, d):
    lines = tables.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("user_idx"), F.col("l_partkey").alias("item_idx"), F.col("l_quantity").alias("score"))
    parts = tables.table(spark, d, "part").select(F.col("p_partkey").alias("item_idx"), F.col("p_size").alias("part_size"))
    interactions, features = gold.compact_items(lines, parts)
    return interactions.join(features, "item_idx").select("user_idx", "item_idx", "score", "part_size")


@query(f"select user_id, page from pairs where {share(0.1, 'sample')}")
def hash_sample(spark, d):
    return gold.hash_sample(pairs(spark, d), 0.1)


@query(f"select user_id, page, cast(is_test as int) is_test from split where {share(0.1, 'sample')}")
def sampled_split(spark, d):
    """A sample of a tenth, split again: its test part is a fifth of it."""
    return gold.with_split(gold.hash_sample(pairs(spark, d), 0.1), 0.2).select("user_id", "page", F.col("is_test").cast("int").alias("is_test"))


@query("select user_id, page, cast(is_test as int) is_test from split")
def train_test_split(spark, d):
    train, test = gold.train_test_split(pairs(spark, d))
    return train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))


@query(f"select user_id, page, ts, case when ts >= {MID_RUN} then 'later' else 'earlier' end part from inter")
def temporal_split(spark, d):
    earlier, later = gold.temporal_split(tables.interactions(spark, d), MID_RUN)
    return earlier.select("user_id", "page", "ts", F.lit("earlier").alias("part")).unionByName(
        later.select("user_id", "page", "ts", F.lit("later").alias("part")))


# --- recommendation ---------------------------------------------------------------------------

@query("""select user_id, count(*) n_items, round(avg(score), 6) mean_score, round(min(score), 6) min_score, round(max(score), 6) max_score
    from all_scores group by user_id""")
def score_all_items(spark, d):
    return recommend.score_ranges(*tables.factor_model(spark, d))


@query("select user_id, page, round(score, 6) score from pairs join all_scores using (user_id, page)")
def score_pairs(spark, d):
    return recommend.score_pairs(pairs(spark, d), *tables.factor_model(spark, d))


@query("select user_id, cast(rank as int) as rank, page, round((score - lo) / (hi - lo), 6) score from scaled_scores where rank <= 10")
def recommend_top_n(spark, d):
    return recommend.recommend_top_n(*tables.factor_model(spark, d), 10)


@query("select user_id, cast(rank as int) as rank, page, round(score, 6) score from scaled_scores where rank <= 10")
def recommend_top_scores(spark, d):
    """The model's own scores: no range is wanted, so short vectors can be passed over."""
    return recommend.recommend_top_n(*tables.factor_model(spark, d), 10, scaled=False)


@query("""select user_id, cast(row_number() over (partition by user_id order by score desc, page) as int) as rank, page, round((score - lo) / (hi - lo), 6) score
    from scaled_scores where (user_id, page) not in (select (user_id, page) from pairs)
    qualify row_number() over (partition by user_id order by score desc, page) <= 10""")
def recommend_unseen(spark, d):
    return recommend.recommend_top_n(*tables.factor_model(spark, d), 10, exclude_seen=tables.interactions(spark, d))


@query("select user_id, cast(rank as int) as rank, page, round((score - lo) / (hi - lo), 6) score from scaled_scores join requests using (user_id) where rank <= n")
def recommend_batch(spark, d):
    return recommend.recommend_batch(tables.requests(spark, d), *tables.factor_model(spark, d))


@query("select user_id, string_agg(page, ',' order by rank) pages, cast(count(*) as int) n from scaled_scores join requests using (user_id) where rank <= n group by user_id")
def recommend_nested(spark, d):
    nested = recommend.recommend_nested(recommend.recommend_batch(tables.requests(spark, d), *tables.factor_model(spark, d)))
    return nested.select("user_id", F.array_join("predictions.page", ",").alias("pages"), F.size("predictions").alias("n"))


@query("select user_id, feature_idx, round(w, 5) as value from profiles", digits=5)
def content_profile(spark, d):
    return tfidf.features_long(recommend.content_profiles(user_item_scores(spark, d), vectors(spark, d)), "user_id")


@query("""select user_id, cast(rank as int) as rank, page, round((score - lo) / (hi - lo), 6) score from (
    select *, min(score) over w lo, max(score) over w hi, row_number() over (partition by user_id order by score desc, page) as rank
    from (select user_id, page, round(coalesce(s, 0), 9) score from (select distinct user_id from profiles) cross join catalogue left join
        (select p.user_id, v.page, sum(p.w / pn * v.w / vn) s from profiles p join vectors v using (feature_idx)
         join (select user_id, sqrt(sum(w * w)) pn from profiles group by 1) a using (user_id)
         join (select page, sqrt(sum(w * w)) vn from vectors group by 1) b on b.page = v.page group by 1, 2) using (user_id, page))
    window w as (partition by user_id)) where rank <= 10""")
def content_recommend(spark, d):
    return recommend.content_recommend(user_item_scores(spark, d), materialize(vectors(spark, d), "vectors"), 10)


def als_recommendations(spark, d):
    """The model of the reference settings over all users and the whole catalogue."""
    pages = tables.catalogue(spark, d)
    matrix = materialize(gold.interaction_matrix(normalized(spark, d), pages), "matrix")
    users = tables.interactions(spark, d).select("user_id").distinct()
    return recommend.recommend_top_n(*recommend.train_factors(matrix, users=users, items=pages), 10)


@query()
def als_recommend(spark, d):
    return als_recommendations(spark, d)


@query("""select user_id, cast(least(10, (select count(*) from catalogue)) as bigint) n, true ranks, true scores, true known
    from (select distinct user_id from inter)""")
def als_recommend_shape(spark, d):
    """Every user gets ten articles of the catalogue, ranked 1 to 10, with scores from 0 to 1 that do not rise."""
    pages = tables.catalogue(spark, d).select(F.col("page").alias("_known")).distinct()
    rows = als_recommendations(spark, d).join(pages, F.col("page") == F.col("_known"), "left")
    listed = F.array_sort(F.collect_list(F.struct("rank", "score", "page")))
    per_user = rows.groupBy("user_id").agg(listed.alias("l"), F.count(F.lit(1)).alias("n"), F.every(F.col("_known").isNotNull()).alias("known"))
    falling = F.aggregate("l", F.struct(F.lit(1.0).alias("s"), F.lit(True).alias("ok")), lambda a, x: F.struct(
        x["score"].alias("s"), (a["ok"] & (x["score"] <= a["s"]) & (x["score"] >= 0)).alias("ok")), lambda a: a["ok"])
    return per_user.select("user_id", "n", (F.col("l.rank") == F.sequence(F.lit(1), F.col("n").cast("int"))).alias("ranks"), falling.alias("scores"), "known")


# --- what a model has not seen ------------------------------------------------------------------

def hashed_pairs(spark, d):
    """Two features per page, so that the equations of the feature map can be solved by hand."""
    return tfidf.item_features(tfidf.hashed_tfidf(cleaned(spark, d), hashing="md5", n_features=2, keep=["page"]))


_TWO_FEATURES = f"""with two as (select page, {md5_sql("term")} % 2 b, count(*) tf from kept_terms group by 1, 2),
idfs as (select b, ln(((select count(*) from catalogue) + 1.0) / (count(*) + 1.0)) w from two group by b),
x as (select page, coalesce(sum(tf * w) filter (b = 0), 0) x0, coalesce(sum(tf * w) filter (b = 1), 0) x1 from catalogue left join two using (page) left join idfs using (b) group by page),
taught as (select page, x0, x1, list_append(i, b) y from x join item_factors using (page)),
sums as (select sum(x0 * x0) + 1.0 a, sum(x0 * x1) b, sum(x1 * x1) + 1.0 c from taught),
sides as (select j, sum(x0 * y[j]) p, sum(x1 * y[j]) q from taught, unnest(range(1, len(y) + 1)) t(j) group by j),
solution as (select j, (c * p - b * q) / (a * c - b * b) m0, (a * q - b * p) / (a * c - b * b) m1 from sides, sums)"""


@query("select * from (" + _TWO_FEATURES + """
select page, page not in (select page from item_factors) cold, round(sum(case when j <= n then z end), 5) total, round(max(case when j > n then z end), 5) bias
from (select page, j, x0 * m0 + x1 * m1 z, (select max(len(i)) from item_factors) n from x, solution where page not in (select page from item_factors)
  union all select page, unnest(range(1, len(i) + 2)), unnest(list_append(i, b)), len(i) from item_factors) group by page)""", digits=5)
def cold_item_factors(spark, d):
    """Factors of pages the model has no vector for, by a map learned from two features of those it has."""
    features, (_, factors) = materialize(hashed_pairs(spark, d), "features"), tables.factor_model(spark, d)
    rows = fold_in.with_cold_items(factors, features, fold_in.feature_map(features, factors))
    return rows.select("page", "cold", F.aggregate("factors", F.lit(0.0), lambda a, x: a + x).alias("total"), "bias")


@query(f"select cast(i as int) feature_idx, cast(0 as double) residual, true solved from range({tfidf.N_FEATURES}) r(i)")
def feature_map_residuals(spark, d):
    """The map of all features satisfies its normal equations, feature by feature, and gives cold pages factors."""
    features, (_, factors) = materialize(vectors(spark, d), "features"), tables.factor_model(spark, d)
    weights = fold_in.feature_map(features, factors)
    cold = fold_in.with_cold_items(factors, features, weights).filter("cold").join(tfidf.features_long(features, "page").select("page").distinct(), "page")
    solved = cold.agg(F.coalesce(F.every(F.expr(fold_in.KNOWN)), F.lit(True))).scalar()
    return fold_in.map_residuals(features, factors, weights).withColumn("solved", solved)


def two_factors(spark, d):
    """The first two factors of every vector, so that a reader's equations can be solved by hand."""
    return tables.factor_model(spark, d)[1].withColumn("factors", F.slice("factors", 1, 2))


def clicks_per_page(spark, d):
    return tables.interactions(spark, d).select("user_id", "page", (1 + F.col("clicks")).alias("score"))


@query(f"""select user_id, n, round((a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12), 5) first, round((a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12), 5) as second
from (select user_id, count(*) n, s11 + sum(c * y1 * y1) + count(*) * {recommend.REGULARISATION} a11, s12 + sum(c * y1 * y2) a12,
  s22 + sum(c * y2 * y2) + count(*) * {recommend.REGULARISATION} a22, sum((1 + c) * y1) b1, sum((1 + c) * y2) b2
  from (select user_id, page, sum(1 + clicks) c from inter group by all) join (select page, i[1] y1, i[2] y2 from item_factors) using (page),
  (select sum(i[1] * i[1]) s11, sum(i[1] * i[2]) s12, sum(i[2] * i[2]) s22 from item_factors) group by user_id, s11, s12, s22)""", digits=5)
def fold_in_readers(spark, d):
    """Factors of readers who came after training, two per reader."""
    rows = fold_in.fold_in_readers(clicks_per_page(spark, d), two_factors(spark, d))
    return rows.select("user_id", "n", F.col("factors")[0].alias("first"), F.col("factors")[1].alias("second"))


@query("select user_id, count(distinct page) n, cast(0 as double) residual from inter join item_factors using (page) group by user_id")
def fold_in_residuals(spark, d):
    """Readers' factors of full width satisfy their equations; readers of unknown pages only have none."""
    return fold_in.fold_in_readers(clicks_per_page(spark, d), tables.factor_model(spark, d)[1]).select("user_id", "n", "residual")


# --- evaluation -------------------------------------------------------------------------------

def held_out(spark, d):
    return gold.train_test_split(pairs(spark, d))[1]


def metric_rows(spark, d, k=(5, 10, 20)):
    return evaluate.metrics_by_k(held_out(spark, d), *tables.factor_model(spark, d), k)


@query("select * from metrics")
def metrics_by_k(spark, d):
    return metric_rows(spark, d)


def _cold_sql():
    """The metrics with zero vectors for every third user and every fourth page of the fixed model."""
    text = sql("select * from metrics")
    for name, vector, rest, n in (("user_factors", "u", "", 3), ("item_factors", "i", "b", 4)):
        known, gone = CTES[name], f"vec_id % {n} = 0"
        head = f"select cast(vec_id as varchar) {'user_id' if vector == 'u' else 'page'}, case when {gone} then list_transform(embedding, lambda x: cast(0 as double)) else "
        body = "cast(list_reverse(embedding) as double[]) end u" if vector == "u" else f"cast(embedding as double[]) end i, case when {gone} then cast(0 as double) else label * cast(0.01 as double) end {rest}"
        text = text.replace(known, f"{head}{body} from embeddings")
    return text


@query(_cold_sql())
def cold_start_metrics(spark, d):
    """Users and pages that training did not meet count like all others."""
    users, items = tables.factor_model(spark, d)
    warm = users.filter(F.col("user_id").cast("bigint") % 3 != 0), items.filter(F.col("page").cast("bigint") % 4 != 0)
    full = recommend.for_all_ids(warm[0], users, "user_id", 64), recommend.for_all_ids(warm[1], items, "page", 64)
    return evaluate.metrics_by_k(held_out(spark, d), *full)


@query("select user_id, page, cast(r as bigint) as rank from ranks")
def test_ranks(spark, d):
    return evaluate.rank_positives(held_out(spark, d), *tables.factor_model(spark, d))


def _metric(name):
    def run(spark, d):
        return metric_rows(spark, d, (10,)).select(name)
    run.__name__ = {"precision": "precision_at_k", "recall": "recall_at_k", "ndcg": "ndcg_at_k", "hit_rate": "hit_rate_at_k"}.get(name, name)
    return query(f"select {name} from metrics where k = 10".replace("select precision", 'select precision as "precision"'))(run)


for _name in ("precision", "recall", "auc", "ndcg", "mrr", "hit_rate"):
    _metric(_name)


# --- monitoring -------------------------------------------------------------------------------

def _score_parts(spark, d):
    return user_item_scores(spark, d), tables.interactions(spark, d).select("user_id").distinct(), tables.catalogue(spark, d).distinct()


@query(" union all ".join(f"""select '{side}' side, round(avg(total), 6) mean, round(quantile_cont(total, 0.5), 6) median, round(stddev_pop(total), 6) std,
    round(min(total), 6) min, round(max(total), 6) max from {side}_totals""" for side in ("user", "item")))
def interaction_distribution(spark, d):
    return monitor.interaction_distribution(*_score_parts(spark, d))


@query("select * from " + histogram_sql("user_totals", "total", 50, "user") + " union all select * from " + histogram_sql("item_totals", "total", 50, "item"))
def interaction_histograms(spark, d):
    return monitor.interaction_histograms(*_score_parts(spark, d))


def split_rows(spark, d):
    return monitor.split_stats(gold.with_split(pairs(spark, d)), *id_counts(spark, d))


@query("""select *, round(train_interactions / cast(n_users as double), 6) interactions_per_user, round(train_interactions / cast(n_items as double), 6) interactions_per_item,
    round(1 - train_interactions / (cast(n_users as double) * n_items), 6) sparsity from split_sizes""")
def split_stats(spark, d):
    return split_rows(spark, d)


@query("""select round(u / cast(n_users as double), 6) user_coverage, round(i / cast(n_items as double), 6) item_coverage,
    n_users - u cold_start_users, n_items - i cold_start_items from split_sizes,
    (select count(distinct user_id) u, count(distinct page) i from split where not is_test)""")
def coverage_stats(spark, d):
    return monitor.coverage_stats(gold.train_test_split(pairs(spark, d))[0], *id_counts(spark, d))


@query("""select 'user' side, round(avg(sqrt(list_inner_product(u, u))), 6) norm_mean, round(stddev_pop(sqrt(list_inner_product(u, u))), 6) norm_std from user_factors
    union all select 'item', round(avg(sqrt(list_inner_product(i, i))), 6), round(stddev_pop(sqrt(list_inner_product(i, i))), 6) from item_factors""")
def embedding_stats(spark, d):
    return monitor.embedding_stats(*tables.factor_model(spark, d))


_IMPORTANCE = """(select 'feature_' || (c - 1) feature, avg(abs(v)) / sum(avg(abs(v))) over () importance
    from (select unnest(i) v, unnest(range(1, 65)) c from item_factors) group by c)"""


@query(f"select feature, round(importance, 6) importance from {_IMPORTANCE}")
def feature_importance(spark, d):
    return monitor.feature_importance(tables.factor_model(spark, d)[1])


@query(f"select feature, round(importance, 6) importance from {_IMPORTANCE} order by importance desc, feature limit 20")
def top_features(spark, d):
    return monitor.top_features(monitor.feature_importance(tables.factor_model(spark, d)[1]))


@query("""select 'item_embeddings' source, cast(c - 1 as int) component, round(avg(abs(v)), 6) as value from (select unnest(i) v, unnest(range(1, 65)) c from item_factors) group by c
    union all select 'user_embeddings', cast(c - 1 as int), round(avg(abs(v)), 6) from (select unnest(u) v, unnest(range(1, 65)) c from user_factors) group by c
    union all select 'item_features', feature_idx, round(abs(sum(w) / (select count(*) from catalogue)), 6) from vectors group by feature_idx
    union all select 'user_features', feature_idx, round(abs(sum(w) / (select count(distinct user_id) from profiles)), 6) from profiles group by feature_idx""")
def feature_column_means(spark, d):
    users, pages = tables.factor_model(spark, d)
    features, scores = materialize(vectors(spark, d), "vectors"), user_item_scores(spark, d)
    profiles = recommend.content_profiles(scores, features)
    n_users = scores.agg(F.countDistinct("user_id")).scalar()
    return monitor.feature_column_means(
        users, pages, tfidf.features_long(features, "page"), id_counts(spark, d)[1], tfidf.features_long(profiles, "user_id"), n_users)


@query("""select count(*) filter (not is_test) n_train, round(avg(score) filter (not is_test), 6) train_mean, round(stddev_pop(score) filter (not is_test), 6) train_std,
    count(*) filter (is_test) n_test, round(avg(score) filter (is_test), 6) test_mean, round(stddev_pop(score) filter (is_test), 6) test_std,
    round(max(abs(ft - fs)), 6) ks from (select *,
        count(*) filter (not is_test) over o / cast(count(*) filter (not is_test) over () as double) ft,
        count(*) filter (is_test) over o / cast(count(*) filter (is_test) over () as double) fs
        from split join all_scores using (user_id, page) window o as (order by score range between unbounded preceding and current row))""")
def score_ks(spark, d):
    train, test = gold.train_test_split(pairs(spark, d))
    return monitor.score_stability(train, test, *tables.factor_model(spark, d))


@query("""select count(*) n_items, round(2 * sum(k * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*), 6) gini from
    (select v, cast(row_number() over (order by v) as double) k from (select cast(count(*) as double) v from purchases group by page))""")
def item_gini(spark, d):
    return monitor.item_gini(tables.purchases(spark, d))


@query("""select round(total_interactions / cast(n_users as double), 6) interactions_over_users, round(total_interactions / cast(n_items as double), 6) interactions_over_items,
    round(test_interactions / cast(n_users as double), 6) test_over_users, round(1 - 2 * train_interactions / cast(n_items as double), 6) density_index,
    round(test_interactions / cast(train_interactions as double), 6) test_over_train from split_sizes""")
def dashboard_ratios(spark, d):
    return monitor.dashboard_ratios(split_rows(spark, d))


def _runs(spark, d):
    """Two runs, stored with the newer one first: readings up to mid-January, and all readings."""
    path = scratch_path(spark, "runs")
    users, pages = tables.factor_model(spark, d)
    everything = tables.interactions(spark, d)
    vectors_of_model = pages.select(array_to_vector("factors").alias("features"))
    runs = [(run_id, day, gold.temporal_split(everything, cutoff)[0].select("user_id", "page").distinct())
            for run_id, cutoff, day in (("full", AS_OF, "2024-02-01"), ("half", MID_RUN, "2024-01-16"))]
    # The model is the same in both, so the pairs that either holds out are ranked once.
    held = reduce(DataFrame.unionByName, [gold.train_test_split(known)[1] for *_, known in runs])
    ranks = materialize(evaluate.rank_positives(held, users, pages), "ranks")
    for run_id, day, known in runs:
        models.append_run(training.run_document(
            known, tables.catalogue(spark, d), users, pages, run_id=run_id, created_at=f"{day}T00:00:00",
            model_summary={"model_type": "fixed"}, hyperparameters={"rank": 64.0, "alpha": 1.0, "seed": 42.0},
            n_features=training.width_of(vectors_of_model, "features"), sizes=training.model_sizes(users, pages), ranks=ranks), path)
    return models.read_runs(spark, path)


def _run_columns(runs):
    return runs.select(
        "run_id", "created_at", "status",
        *[F.col("performance_metrics")[m].alias(n) for m, n in (("precision@10", "precision_10"), ("recall@10", "recall_10"), ("auc", "auc"), ("ndcg@10", "ndcg_10"), ("mrr", "mrr"))],
        F.col("model_stability")["user_coverage"].alias("user_coverage"), F.col("embedding_stats")["item_embedding_norm_mean"].alias("item_norm"),
        F.size("feature_importance").alias("n_importances"), F.col("model_summary")["model_type"].alias("model_type"),
        F.col("model_summary")["parameters"].cast("bigint").alias("parameters"),
        *[F.col("hyperparameters")[c].alias(c) for c in ("rank", "alpha", "seed")],
        *[F.col("dataset_info")[c].alias(c) for c in ("n_users", "n_items", "n_features", "n_train_interactions", "n_test_interactions")])


def _run_sql(run_id, day, cutoff):
    before = CTES["inter"]
    text = sql(f"""select '{run_id}' run_id, '{day}T00:00:00' created_at, 'ok' status, m."precision" precision_10, m.recall recall_10, m.auc, m.ndcg ndcg_10, m.mrr,
        round((select count(distinct user_id) from split where not is_test) / cast(n_users as double), 6) user_coverage,
        (select round(avg(sqrt(list_inner_product(i, i))), 6) from item_factors) item_norm, cast(64 as int) n_importances,
        'fixed' model_type, (select cast(2 * 65 * count(*) as bigint) from embeddings) parameters, cast(64 as double) as rank, cast(1 as double) alpha, cast(42 as double) seed,
        n_users, n_items, cast(64 as bigint) n_features, train_interactions n_train_interactions, test_interactions n_test_interactions
        from split_sizes, (select * from metrics where k = 10) m""")
    return "(" + text.replace(before, f"select * from ({before}) where ts < {cutoff}") + ")"


@query(_run_sql("full", "2024-02-01", AS_OF) + " union all " + _run_sql("half", "2024-01-16", MID_RUN))
def monitoring_runs(spark, d):
    return _run_columns(models.list_runs(_runs(spark, d)))


@query(_run_sql("full", "2024-02-01", AS_OF))
def latest_run(spark, d):
    return _run_columns(models.latest_run(_runs(spark, d)))
