"""Shared parts of the DuckDB texts the queries are checked against."""

from __future__ import annotations

import re

from readflow.functions.columns import SHARE_DIGITS
from readflow.functions.text import BLANKS_PATTERN, DISALLOWED_PATTERN, PORTUGUESE_STOP_WORDS, TAG_PATTERN, URL_PATTERN
from readflow.operators.scaling import ITEM_COLUMNS, LOG_COLUMNS, MINMAX_COLUMNS, USER_VECTOR_COLUMNS
from readflow.operators.tfidf import N_FEATURES
from readflow.sources.tables import AS_OF


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def minmax(column: str, source: str) -> str:
    lo, hi = f"(select min({column}) from {source})", f"(select max({column}) from {source})"
    return (f"case when {column} is null then null when {hi} = {lo} then cast(0.5 as double) "
            f"else (cast({column} as double) - {lo}) / cast({hi} - {lo} as double) end")


def md5_number(text: str, digits: int = 8) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {digits}) as bigint)"


def share(ratio: float, purpose: str, seed: int = 42) -> str:
    return md5_number(f"concat_ws('|', user_id, page, '{purpose}', '{seed}')", SHARE_DIGITS) + f" < {int(ratio * 16**SHARE_DIGITS)}"


def dense(source: str, key: str, index: str) -> str:
    return (f"select {key}, cast(row_number() over (order by substr(md5({key}), 1, 4), {key}) - 1 as bigint) {index} "
            f"from (select distinct {key} from {source})")


_cleaned = "title"
for _pattern, _by in ((URL_PATTERN, ""), (TAG_PATTERN, ""), (DISALLOWED_PATTERN, ""), (BLANKS_PATTERN, " ")):
    _cleaned = f"regexp_replace({_cleaned}, {quoted(_pattern)}, {quoted(_by)}, 'g')"
_stop = ", ".join(quoted(w) for w in PORTUGUESE_STOP_WORDS)
_logs = ", ".join(f"ln(1 + cast({c} as double)) {c}" for c in LOG_COLUMNS)
_scaled = ", ".join(f"{minmax(c, 'logged')} as {c}" for c in MINMAX_COLUMNS)
_item_logs = ", ".join(f"ln(1 + cast({c} as double)) {c}" for c in ITEM_COLUMNS)
_item_scaled = ", ".join(f"{minmax(c, 'item_logs')} as {c}" for c in ITEM_COLUMNS)
_user_means = ", ".join(f"avg({c}) {c}" for c in USER_VECTOR_COLUMNS if c != "user_type")

# Each name may use the names above it.
CTES: dict[str, str] = {
    "inter": """select cast(user_id as varchar) user_id,
        case when user_id % 3 = 0 then 'Logged' else 'Non-Logged' end user_type,
        json_extract_string(props, '$.k') page, epoch_us(ts) / 1e6 ts, cast(event_id % 7 as int) clicks,
        cast(round(value * 100) * 10 as bigint) time_on_page_ms, least(value, cast(100 as double)) scroll_pct,
        cast(1 + event_id % 3 as int) visits from events""",
    "purchases": """select cast(o_custkey as varchar) user_id, cast(l_partkey as varchar) page,
        epoch_us(o_orderdate) / 1e6 ts, cast(l_quantity as int) clicks, cast(l_linenumber * 1000 as bigint) time_on_page_ms,
        l_discount * 1000 scroll_pct from orders join lineitem on o_orderkey = l_orderkey""",
    "temporal": """select *, cast(hour(t) as int) as hour, cast(dayofweek(t) + 1 as int) as dayofweek, cast(year(t) as int) as year,
        cast(month(t) as int) as month, cast(day(t) as int) as day
        from (select *, make_timestamp(cast(floor(ts) as bigint) * 1000000) t from inter)""",
    "user_times": f"""select *, coalesce(ts - lag(ts) over (partition by user_id order by ts, page, clicks, time_on_page_ms, scroll_pct, visits), 0) time_since_last,
        min(ts) over (partition by user_id) first_interaction, {AS_OF} - min(ts) over (partition by user_id) time_since_first from temporal""",
    "means": "select page, avg(time_on_page_ms) avg_time_on_page from inter group by page",
    "weighted": """select u.*, avg_time_on_page, avg_time_on_page / (select max(avg_time_on_page) from means) time_weight
        from user_times u left join means using (page)""",
    "silver": f"""select *, interaction_score * recency_weight * time_weight adjusted_score from (select *,
        clicks * cast(0.5 as double) + time_on_page_ms * cast(0.3 as double) + scroll_pct * cast(0.2 as double) interaction_score,
        cast(1 as double) / (1 + ({AS_OF} - ts) / 86400) recency_weight from weighted)""",
    "labels_by_count": """select user_type, cast(row_number() over (order by count(*) desc, user_type) - 1 as double) as index
        from inter group by user_type""",
    "logged": f"select user_id, page, ts, index user_type, clicks, scroll_pct, visits, hour, dayofweek, first_interaction, {_logs} "
              "from silver join labels_by_count using (user_type)",
    "norm": f"select user_id, page, ts, user_type, {', '.join(LOG_COLUMNS)}, {_scaled} from logged",
    "articles": """select cast(doc_id as varchar) page, text title,
        timestamp '2023-12-01 00:00:00' + to_hours(cast(doc_id % 720 as int)) issued,
        timestamp '2023-12-01 00:00:00' + to_hours(cast(doc_id % 720 + doc_id % 48 as int)) modified from documents""",
    "items": f"""select *, cast(trunc(({AS_OF} - epoch(issued)) / 86400) as int) days_since_published,
        cast(trunc(({AS_OF} - epoch(modified)) / 86400) as int) days_since_modified,
        cast(year(issued) as int) as year, cast(month(issued) as int) as month, cast(day(issued) as int) as day from articles""",
    "item_logs": f"select page, {_item_logs} from items",
    "item_norm": f"select page, {_item_scaled} from item_logs",
    "catalogue": "select cast(doc_id as varchar) page from documents",
    "labelled": "select cast(doc_id as varchar) page from labels",
    "clean": f"select page, trim(lower({_cleaned})) cleaned_text from articles",
    "words": "select page, unnest(string_split(cleaned_text, ' ')) term from clean",
    "terms": "select page, term from words where term <> ''",
    "kept_terms": f"select page, term from terms where term not in ({_stop})",
    "term_counts": "select page, term, count(*) tf from terms group by page, term",
    "buckets": f"select page, cast({md5_number('term')} % {N_FEATURES} as int) feature_idx, count(*) tf from kept_terms group by 1, 2",
    "bucket_idf": "select feature_idx, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) idf from buckets group by 1",
    "vectors": "select page, feature_idx, tf * idf w from buckets join bucket_idf using (feature_idx) where tf * idf <> 0",
    "user_idx": dense("inter", "user_id", "user_idx"),
    "item_idx": dense("catalogue", "page", "item_idx"),
    "scores": """select user_id, page, sum(adjusted_score) score from norm
        where user_id <> '' and page <> '' and adjusted_score > 0 and page in (select page from catalogue) group by 1, 2""",
    "pairs": "select distinct user_id, page from inter",
    "split": f"select user_id, page, {share(0.2, "split")} is_test from pairs",
    "user_means": f"select user_id, arg_min(user_type, ts) user_type, {_user_means} from norm group by user_id",
    "user_factors": "select cast(vec_id as varchar) user_id, cast(list_reverse(embedding) as double[]) u from embeddings",
    "item_factors": "select cast(vec_id as varchar) page, cast(embedding as double[]) i, label * cast(0.01 as double) b from embeddings",
    "all_scores": "select user_id, page, round(list_inner_product(u, i) + b, 9) score from user_factors cross join item_factors",
    "scaled_scores": """select user_id, page, score, min(score) over w lo, max(score) over w hi,
        row_number() over (partition by user_id order by score desc, page) as rank from all_scores window w as (partition by user_id)""",
    "requests": "select cast(c_custkey as varchar) user_id, cast(1 + c_nationkey % 10 as int) n from customer",
    "ranks": """select user_id, page, r from (select user_id, page,
        count(*) over (partition by user_id order by score desc range between unbounded preceding and current row) - 1 r from all_scores)
        join (select user_id, page from split where is_test) using (user_id, page)""",
    "n_items": "select count(*) n from item_factors",
    "per_user": """select user_id, count(*) m, min(r) best, sum(greatest(r - i, 0)) above,
        count(*) filter (r < 5) h5, count(*) filter (r < 10) h10, count(*) filter (r < 20) h20,
        coalesce(sum(1 / log2(r + 2.0)) filter (r < 5), 0) d5, coalesce(sum(1 / log2(r + 2.0)) filter (r < 10), 0) d10,
        coalesce(sum(1 / log2(r + 2.0)) filter (r < 20), 0) d20
        from (select *, row_number() over (partition by user_id order by r, page) - 1 i from ranks) group by user_id""",
    "ideal": "select m, k, sum(1 / log2(j + 1.0)) g from (select distinct m from per_user), (select unnest([5, 10, 20]) k), "
             "(select unnest(range(1, 21)) j) where j <= least(m, k) group by m, k",
    "at_k": """select k, m, best, above, case k when 5 then h5 when 10 then h10 else h20 end hits,
        case k when 5 then d5 when 10 then d10 else d20 end / g ndcg from per_user join ideal using (m)""",
    "metrics": """select cast(k as int) k, count(*) users, round(avg(hits / cast(k as double)), 6) as precision, round(avg(hits / m), 6) recall,
        round(case when avg(hits) = 0 then 0 else 2 * avg(hits / cast(k as double)) * avg(hits / m) / (avg(hits / cast(k as double)) + avg(hits / m)) end, 6) f1,
        round(avg(case when hits > 0 then 1.0 else 0.0 end), 6) hit_rate, round(avg(ndcg), 6) ndcg,
        round(avg(1 - above / cast(m * ((select n from n_items) - m) as double)), 6) auc, round(avg(1.0 / (best + 1)), 6) mrr
        from at_k group by k""",
    "reads": "select user_id, count(*) reads from inter group by user_id",
    "buyers": "select page, count(distinct user_id) unique_users from purchases group by page",
    "access": """select i.year item_year, i.month item_month, i.day item_day, days_since_published, cast(count(*) as bigint) access_count
        from inter join items i using (page) group by 1, 2, 3, 4""",
    "engagement": """select page, avg(time_on_page_ms) avg_time_ms, avg(clicks) avg_clicks, avg(scroll_pct) avg_scroll_pct, avg(interaction_score) avg_score,
        avg(time_on_page_ms) / 60000 avg_time_min from silver group by page
        having avg(time_on_page_ms) > 0 and avg(time_on_page_ms) < 500000 and avg(clicks) < 500""",
    "user_totals": "select user_id, round(coalesce(sum(score), 0), 6) total from user_idx left join scores using (user_id) group by user_id",
    "item_totals": "select page, round(coalesce(sum(score), 0), 6) total from item_idx left join scores using (page) group by page",
    "split_sizes": """select count(*) total_interactions, count(*) filter (not is_test) train_interactions, count(*) filter (is_test) test_interactions,
        (select count(*) from user_idx) n_users, (select count(*) from item_idx) n_items from split""",
    "profiles": "select user_id, feature_idx, sum(score * w) w from scores join vectors using (page) group by 1, 2",
}


def sql(body: str) -> str:
    """``body`` preceded by the named parts it uses, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{name} as ({CTES[name]})" for name in CTES if name in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body


def histogram_sql(source: str, column: str, bins: int, side: str = "") -> str:
    """Equal-width bins with numpy's treatment of edges."""
    tag = f"{quoted(side)} side, " if side else ""
    return f"""(with v as (select cast({column} as double) x from {source}),
        e as (select min(x) - case when min(x) = max(x) then 0.5 else 0 end lo,
                     max(x) + case when min(x) = max(x) then 0.5 else 0 end hi from v),
        w as (select lo, (hi - lo) / {bins}.0 w from e),
        g as (select x, lo, w, least(cast(floor((x - lo) / w) as bigint), {bins - 1}) g from v, w),
        c as (select g - case when x < lo + g * w then 1 else 0 end
              + case when x >= lo + (g + 1) * w and g < {bins - 1} then 1 else 0 end b, count(*) n from g group by 1)
        select {tag}cast(i as int) bin, round(lo + i * w, 6) low, round(lo + (i + 1) * w, 6) high, coalesce(n, 0) count
        from (select unnest(range({bins})) i) cross join w left join c on b = i)"""


def quantile_bins_sql(source: str, column: str) -> str:
    """CTE body with (bin, low, high, count) between the distinct deciles."""
    return f"""(with v as (select cast({column} as double) x from {source}),
        q as (select distinct unnest(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) e from v),
        b as (select row_number() over (order by e) bin, e low, lead(e) over (order by e) high from q)
        select cast(bin as int) bin, low, high, count(x) count from b
        left join v on (x > low or (bin = 1 and x = low)) and x <= high where high is not null group by 1, 2, 3)"""
