"""Benchmark decontamination: test n-grams as a hash set, met by the word windows of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from readflow.llm.texts import broadcast_if_small, spare_name, word_array
from readflow.session import materialize

WINDOW = 10
#: Up to this many windows (8 bytes of hash and some 100 of words each) the set is broadcast; beyond, it is shuffled.
BROADCAST_WINDOWS = 1_000_000
BLOCK = 1024  # words whose windows are hashed at once


def _windows(words: Column, size: Column) -> Column:
    """Start positions (from 0) of the windows of ``size`` words."""
    n = F.size(words) - size + 1
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _item_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, size, gram): the word windows of every item; fewer words than ``window``, but not none, are one window."""
    rows = items.select(F.col(item).cast("string").alias("item"), word_array(F.col(text)).alias("w"))
    rows = rows.withColumn("size", F.least(F.size("w"), F.lit(window))).filter(F.col("size") > 0)
    grams = rows.withColumn("at", F.explode(_windows(F.col("w"), F.col("size"))))
    return grams.select("item", "size", F.slice("w", F.col("at") + 1, F.col("size")).alias("gram"))


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(no, h, size, gram) of the distinct word windows of all items, and (no, item) of the items that hold them.

    Windows of items with null ids are windows like others; their ``item`` is null. A window that all
    items share is one window, whose number travels in place of its items. Both tables are stored, so
    that numbers stay.
    """
    grams = _item_windows(items, item, text, window)
    distinct = grams.select("gram", "size").distinct()
    windows = materialize(distinct.select(F.monotonically_increasing_id().alias("no"), F.xxhash64("gram").alias("h"), "size", "gram"), "benchmark-windows")
    owners = materialize(grams.join(windows.select("no", "size", "gram"), ["gram", "size"]).select("no", "item").distinct(), "window-owners")
    return windows, owners


def _hashed_windows(docs: DataFrame, key: str, text: str, sizes: list[int]) -> DataFrame:
    """(doc, text_hash, at, size, h) of all word windows of the given sizes, from one scan.

    A text is cut into blocks of words that overlap by one window, so that no row but the first holds
    a whole text and what leaves a block are hashes and places.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc"), text_hash(body).alias("text_hash"), word_array(body).alias("w"))
    starts = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    block = F.transform(starts, lambda s: F.struct(s.alias("base"), F.slice("w", s + 1, BLOCK + max(sizes) - 1).alias("w")))
    blocks = rows.select("doc", "text_hash", F.inline(block))

    def windows(size: int) -> Column:
        places = F.filter(_windows(F.col("w"), F.lit(size)), lambda at: at < BLOCK)
        return F.transform(places, lambda at: F.struct(
            (F.col("base") + at).alias("at"), F.lit(size).alias("size"), F.xxhash64(F.slice("w", at + 1, size)).alias("h")))

    return blocks.select("doc", "text_hash", F.inline(F.flatten(F.array(*map(windows, sizes)))))


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per distinct (key, text) with an occurring window: doc, text_hash, n_hit, items (sorted), unnamed, spans.

    Each window of a document is hashed and looked up in the set of benchmark windows; a hit counts
    once its words are compared as well, in a second pass over the documents found. ``spans`` are the
    hit windows as (at, size) in words; ``n_hit`` counts the words inside any of them. The starts of
    one document are gathered per row, as many as the document has words.
    """
    known, owners = benchmark_windows(items, item, item_text, window)
    per_size = {r["size"]: r["n"] for r in known.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``window`` rows
    small = sum(per_size.values()) <= BROADCAST_WINDOWS
    scan = _hashed_windows(docs, key, text, sorted(per_size) or [window])
    found = scan.join(F.broadcast(known) if small else known, ["h", "size"])
    places = F.collect_set(F.struct("at", "size", "no", "gram"))
    found = materialize(found.groupBy("doc", "text_hash").agg(places.alias("places")), "window-hits")

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), text_hash(body).alias("hash"), body.alias("body"))
    same = F.col("key").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash"))
    rows = rows.join(broadcast_if_small(found.select("doc", "text_hash"), "texts-hit"), same, "left_semi").dropDuplicates(["key", "hash"])
    true = F.filter("places", lambda p: F.slice("w", p["at"] + 1, p["size"]) == p["gram"])
    spans = F.array_sort(F.array_distinct(F.transform(true, lambda p: F.struct(p["at"].alias("at"), p["size"].alias("size")))))
    checked = rows.withColumn("w", word_array(F.col("body"))).join(found, same).select("doc", "text_hash", spans.alias("spans"), F.array_distinct(F.transform(true, lambda p: p["no"])).alias("numbers"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans", start,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["at"] + s["size"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(acc["end"], s["at"]))).alias("n")),
        lambda acc: acc["n"])
    checked = materialize(checked.filter(F.size("spans") > 0).withColumn("n_hit", covered.cast("bigint")), "texts-with-hits")

    named = checked.select("doc", "text_hash", F.explode("numbers").alias("no")).join(owners, "no").groupBy("doc", "text_hash").agg(
        F.array_sort(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull()).alias("unnamed"))
    named = named.select(F.col("doc").alias("key"), F.col("text_hash").alias("hash"), "items", "unnamed")
    return checked.join(named, same).select("doc", "text_hash", "n_hit", "items", "unnamed", "spans")


def text_hash(text: Column) -> Column:
    """128 bits that tell texts apart, so that documents may share a key."""
    return F.md5(text.cast("binary"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One row per document: key, n_words, n_hit, items (sorted strings), unnamed (whether an item
    without an id is hit), spans, contaminated.

    Null and empty texts have no words and no hits; repeated rows each get their row; null keys are
    kept. An empty benchmark marks nothing. Other columns of either table are not read.
    """
    found = hits(docs, items, key, text, **names)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), text_hash(body).alias("_hash"), F.size(word_array(body)).cast("bigint").alias("n_words"))
    joined = rows.join(found, F.col(key).eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("text_hash")), "left")
    return joined.select(
        F.col(key), "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("unnamed", F.lit(False)).alias("unnamed"),
        F.coalesce("spans", F.array().cast("array<struct<at:int,size:int>>")).alias("spans"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def remove_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents without any benchmark window, with all their columns and repeats."""
    doc, same_text = spare_name(docs, "_doc_"), spare_name(docs, "_text_hash_")
    found = hits(docs, items, key, text, **names).select(F.col("doc").alias(doc), F.col("text_hash").alias(same_text))
    same = F.col(key).eqNullSafe(F.col(doc)) & (text_hash(F.coalesce(F.col(text), F.lit(""))) == F.col(same_text))
    return docs.join(broadcast_if_small(found, "contaminated"), same, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents with ``text`` cut down: words of hit windows and what separates them are taken out.

    The text around a removed span is kept as it is, joined by one blank.
    """
    doc, same_text, spans = (spare_name(docs, n) for n in ("_doc_", "_text_hash_", "_spans_"))
    found = hits(docs, items, key, text, **names).select(F.col("doc").alias(doc), F.col("text_hash").alias(same_text), F.col("spans").alias(spans))
    body = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(found, F.col(key).eqNullSafe(F.col(doc)) & (text_hash(body) == F.col(same_text)), "left")
    # word + what follows it, so that concatenating the kept pieces gives the text back
    pieces = F.regexp_extract_all(body, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), 1)
    hit = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))))
    lead = F.regexp_extract(body, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    bits = F.map_from_entries(F.transform(hit, lambda p: F.struct(p, F.lit(True))))
    kept = F.filter(pieces, lambda _, i: ~F.map_contains_key(bits, i))
    cut = F.concat(lead, F.array_join(kept, ""))
    return joined.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut)).drop(doc, same_text, spans)
