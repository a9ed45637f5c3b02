"""The training-data operators as named queries over the benchmark tables, with DuckDB texts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from readflow.llm import conversations, decontaminate, hamming_search, jaccard, lang_id, licenses, near_vectors, packing, quality, secret_scan, sharding, spelling, toxicity
from readflow.llm.texts import crc_mod, lowered
from readflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_words(text: str, pattern: str = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"


@query()
def op1_language(spark, d):
    docs = table(spark, d, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = lang_id.fit(docs.filter(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), lang_id.identify(F.col("text"), model).alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.mix")


@query()
def op2_licenses(spark, d):
    rows = table(spark, d, "documents").select("doc_id", licenses.license_scan(F.col("text")).alias("scan"))
    places = F.col("scan.places")
    return rows.select(
        "doc_id", "scan.n_words", F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places)["first"].cast("bigint").alias("first_word"), F.array_max(places)["first"].cast("bigint").alias("last_word"),
        licenses.labels_of(places).alias("base_labels"), licenses.labels_of(places, F.col("scan.spans")).alias("labels"),
        licenses.scan_score(F.col("scan")).alias("score"), F.col("scan.spans").alias("spans"))


@query()
def op3_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query(rf"""
with recursive words as (select doc_id, list_filter({sql_words("text", "[^\\x20\\x09-\\x0D]+")}, lambda x: x <> '') w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(0, len(w) - 2), lambda i: array_to_string(w[i + 1 : i + 3], ' '))) end s from words),
grams as (select doc_id, len(s) n, unnest(s) g from sets),
pairs as (select a.doc_id a, b.doc_id b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select doc_id a, doc_id b from sets union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a)
select sets.doc_id, cast(len(s) as bigint) n_shingles, min(b) component_id from sets join reach on sets.doc_id = reach.a group by sets.doc_id, s""")
def op4_jaccard_join(spark, d):
    return jaccard.link_components(table(spark, d, "documents"), width=3, percent=90)


@query(f"""
with item_words as (select item_id, {sql_words("text")} w from benchmark),
sized as (select item_id, w, least(len(w), 10) size from item_words where len(w) > 0),
grams as (select distinct item_id, size, array_to_string(w[a + 1 : a + size], ' ') gram
          from sized, unnest(range(0, len(w) - size + 1)) t(a)),
doc_words as (select doc_id, {sql_words("text")} w from documents),
windows as (select doc_id, a, size, array_to_string(w[a + 1 : a + size], ' ') gram
            from doc_words, (select distinct size from grams), unnest(range(0, greatest(len(w) - size + 1, 0))) t(a)),
found as (select doc_id, a, windows.size, item_id from windows join grams on windows.gram = grams.gram and windows.size = grams.size),
covered as (select doc_id, count(distinct a + d) n_hit from found, unnest(range(0, size)) t(d) group by doc_id),
named as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
          from (select distinct doc_id, cast(item_id as varchar) item from found) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, n_hit is not null contaminated
from doc_words left join covered using (doc_id) left join named using (doc_id)""")
def op5_decontaminate(spark, d):
    rows = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", (F.size("items") + F.col("unnamed").cast("int")).cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query()
def op6_secrets(spark, d):
    rows = table(spark, d, "documents").select("doc_id", secret_scan.secret_spans(F.col("text")).alias("found"))
    found = F.col("found")
    return rows.select(
        "doc_id", *[secret_scan.count_of(found, k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.span_list(found, secret_scan.BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_list(found).alias("spans"),
        F.coalesce(F.array_max(F.transform(found, lambda s: s["bits"])), F.lit(0.0)).alias("most_bits"))


@query("""
with recursive sized as (select vec_id, cast(embedding as double[]) v, list_max(list_transform(cast(embedding as double[]), lambda x: abs(x))) peak from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
fit as (select vec_id, case when peak between 1e-60 and 1e60 then v else list_transform(v, lambda x: x / peak) end v from sized where peak > 0),
pairs as (select a.vec_id a, b.vec_id b from fit a join fit b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (select vec_id a, vec_id b from embeddings union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a),
roots as (select a vec_id, min(b) component_id from reach group by a),
counts as (select a vec_id, count(*) n from pairs group by a)
select vec_id, cast(coalesce(n, 0) as bigint) n_links, component_id, vec_id = component_id kept
from embeddings join roots using (vec_id) left join counts using (vec_id)""")
def op7_near_vectors(spark, d):
    return near_vectors.near_duplicates(table(spark, d, "embeddings"))


@query()
def op8_toxicity(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels"))
    rows = docs.select("doc_id", toxicity.severity(F.col("text"), model).alias("s"))
    return rows.select("doc_id", "s.severity", "s.p_toxic", "s.grade", (F.col("s.severity") >= toxicity.REJECT).alias("toxic"))


@query()
def op9_sharding(spark, d):
    rows = sharding.shard_documents(table(spark, d, "documents"), sharding.regular_tree(16), sharding.regular_tree(17))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op10_quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = quality.fit(docs, labels.filter(crc_mod(F.col("doc_id"), 5) != 0))
    scored = quality.classify(docs.select("doc_id", "text"), model, column="score")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: crc32 in SQL: the table of remainders, and the sum over a list of bytes.
SQL_CRC_TABLE = """crc_steps as (select i, 0 k, i c from range(256) r(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_steps where k < 8),
crc_table as (select list(c order by i) crcs from crc_steps where k = 8)"""


def sql_crc(text: str) -> str:
    """crc32 of a text of ASCII and Latin-1 letters, in a query that reads ``crc_table``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x))"
    octets = f"flatten(list_transform({codes}, lambda x: case when x < 128 then [x] else [192 + (x >> 6), 128 + (x & 63)] end))"
    start = f"list_concat([4294967295], list_transform({octets}, lambda x: cast(x as bigint)))"
    return f"xor(list_reduce({start}, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"


def _sql_add(cost: str, edits: str, way: str) -> str:
    """A way in SQL is its cost in ten digits and then its audit, so that the least text is the answer."""
    return f"printf('%010d', cast({way}[1:10] as bigint) + {cost}) || '{edits}' || {way}[11:]"


def _sql_inserts(state: int) -> str:
    """The cheapest of going on from ``state`` at once, after one inserted row and after two."""
    one = conversations.NEXT[state]
    return f"least(w{state}, {_sql_add('5', 'I', f'w{one}')}, {_sql_add('10', 'II', f'w{conversations.NEXT[one]}')}) v{state}"


def _sql_edits(state: int) -> str:
    """The cheapest of deleting, keeping and reroling a row in ``state``."""
    to = conversations.NEXT[state]
    keep = f"when initial = '{' sua'[to]}' then {_sql_add('extra', 'K', f'v{to}')}"
    if state == conversations.START:
        keep += f" when initial = 's' then {_sql_add('extra', 'K', 'v1')}"
    stay = f"least({_sql_add('1 + extra', 'R', f'v{to}')}, case {keep} end)"
    return f"least({_sql_add('2', 'D', f'v{state}')}, case when not must_go then {stay} end) w{state}"


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of each row: dropped, emptied, cut off, repeated, given the role of a user."""
    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault")).filter("fault <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query(f"""
with recursive {SQL_CRC_TABLE},
hashed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {sql_crc("(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))")} % 20 fault from conversations, crc_table),
hurt as (select conv_id, turn, case fault when 4 then 'user' else role end as role,
  case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hashed, unnest(range(case fault when 3 then 2 else 1 end)) c(copy) where fault <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) body from hurt),
seen as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 again,
  lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) pair, count(*) over (partition by conv_id) size from placed),
turns as (select conv_id, i, size, role, text, turn, left(role, 1) initial, body = '' blank, body <> '' and again duplicate,
  body <> '' and not again and right(body, 1) not in ('.', '!', '?') truncated, body = '' or again must_go,
  case when right(body, 1) not in ('.', '!', '?') then 5 else 0 end extra, coalesce(pair not in ('su', 'ua', 'au'), false) illegal from seen),
ways as (select conv_id, size i, '0000000000' v0, '0000000010II' v1, '0000000005I' v2, '0000000000' v3 from turns where i = size
  union all select conv_id, i - 1, {", ".join(map(_sql_inserts, range(4)))}
  from (select conv_id, ways.i, {", ".join(map(_sql_edits, range(4)))} from ways join turns using (conv_id, i))),
best as (select conv_id, cast(v0[1:10] as bigint) as cost, v0[11:] audit from ways where i = 0),
edits as (select conv_id, j, audit[j] edit, count(*) filter (audit[j] <> 'I') over (partition by conv_id order by j) i
  from best, unnest(range(1, len(audit) + 1)) t(j)),
kept as (select conv_id, j, edit, role, case edit when 'I' then '' else text end as text,
  row_number() over (partition by conv_id order by j) k from edits left join turns using (conv_id, i) where edit <> 'D'),
led as (select *, first_value(edit = 'K' and left(role, 1) = 's') over (partition by conv_id order by k) system_first from kept),
mended as (select conv_id, string_agg(case when edit = 'K' then role when (k - cast(system_first as int)) % 2 = 1 then 'user' else 'assistant' end
  || ':' || text, chr(10) order by k) as lines from led group by conv_id),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (blank) blank,
  count(*) filter (duplicate) duplicate, count(*) filter (truncated) truncated, count(*) filter (illegal) illegal from turns group by conv_id)
select conv_id, cast(coalesce(gaps, 0) as bigint) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
  coalesce(illegal, 0) illegal, coalesce(cost, 0) as cost, coalesce(audit, '') audit, sha256(coalesce(lines, '')) repaired_sha256
from (select distinct conv_id from conversations) left join counts using (conv_id) left join best using (conv_id) left join mended using (conv_id)""")
def op11_conversations(spark, d):
    rows = table(spark, d, "conversations")
    repaired, found = conversations.repair(damaged(rows))
    hashes = conversations.digests(repaired).select(F.col("conv").alias("c"), "sha256")
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def misspelled_runs(documents: DataFrame) -> DataFrame:
    """(word): the runs of letters of all documents, one in 97 by a hash of document and run without one of its letters."""
    run = spelling.RUN.replace("+", "{5,}")  # shorter runs make no word
    rows = documents.select("doc_id", F.explode(F.regexp_extract_all(lowered(F.col("text")), F.lit(run), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    rows = rows.select("run", h.alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


@query(rf"""
with recursive {SQL_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) run from documents),
counted as (select doc_id, run, count(*) n from runs where length(run) >= 5 group by doc_id, run),
hashed as (select run, n, {sql_crc("(coalesce(cast(doc_id as varchar), '') || ':' || run)")} h from counted, crc_table),
words as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, cast(sum(n) as bigint) n
  from hashed group by 1 having length(word) >= 5 and sum(n) >= 3),
gaps as (select distinct word, n, substr(word, 1, i - 1) || '.' || substr(word, i + 1) hole, substr(word, 1, i - 1) || substr(word, i + 1) rest
  from words, unnest(range(1, length(word) + 1)) t(i)),
near as (select a.word, a.n, b.word near, b.n near_n from gaps a join gaps b on a.hole = b.hole and a.word <> b.word
  union select a.word, a.n, b.word, b.n from gaps a join words b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from gaps a join words b on a.rest = b.word),
best as (select word, count(*) n_near, first(near order by near_n desc, near) near, max(near_n) near_n from near group by word),
forms as (select word, n, coalesce(n_near, 0) n_near, case when near_n >= 2 * n then near end form, case when near_n >= 2 * n then near_n end form_n
  from words left join best using (word)),
walk as (select word, word as at from forms union select walk.word, forms.form from walk join forms on walk.at = forms.word where forms.form is not null),
ends as (select walk.word, walk.at root from walk join forms on walk.at = forms.word where forms.form is null)
select word, form, root, n, n_near, form_n from forms join ends using (word)""")
def op12_spelling(spark, d):
    return spelling.variants(spelling.count_words(misspelled_runs(table(spark, d, "documents"))))


@query("""
with fit as (select vec_id, cast(embedding as double[]) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
pairs as (select a.vec_id query_id, b.vec_id vec_id, list_inner_product(a.v, b.v) score from fit a join fit b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) r from pairs)
select query_id, cast(r as int) as rank, vec_id, score from ranked where r <= 20""")
def op13_neighbours(spark, d):
    return hamming_search.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)
