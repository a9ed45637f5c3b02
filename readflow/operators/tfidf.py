"""Term counts and TF-IDF, in long form and as hashed vectors."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from readflow.functions.columns import md5_number
from readflow.functions.text import PORTUGUESE_STOP_WORDS, clean_text
from readflow.session import materialize

N_FEATURES = 300
#: Terms whose document frequencies are sent to all tasks, at most.
COMMON_TERMS = 100_000


def with_clean_text(items: DataFrame, text: str = "title", out: str = "cleaned_text") -> DataFrame:
    return items.withColumn(out, clean_text(F.col(text)))


def term_rows(items: DataFrame, text: str = "cleaned_text", stop_words: list[str] | None = None) -> DataFrame:
    """One row per (page, token occurrence)."""
    rows = items.select("page", F.explode(F.split(F.lower(text), r"\s")).alias("term")).filter("term != ''")
    return rows.filter(~F.col("term").isin([w.lower() for w in stop_words])) if stop_words else rows


def term_counts(items: DataFrame, text: str = "cleaned_text", stop_words: list[str] | None = None) -> DataFrame:
    """(page, term, tf); a page's tokens are counted where they are read, before the shuffle."""
    return term_rows(items, text, stop_words).groupBy("page", "term").agg(F.count(F.lit(1)).alias("tf"))


def idf(documents: Column, document_frequency: Column) -> Column:
    return F.log((documents + F.lit(1.0)) / (document_frequency + F.lit(1.0)))


def join_frequencies(counts: DataFrame, frequencies: DataFrame, common_terms: int = COMMON_TERMS) -> DataFrame:
    """Rows of ``counts`` with the row of their term in ``frequencies`` (one row per term, both stored).

    Terms of the largest document frequencies, ``common_terms`` at most, hold most rows; these meet their frequencies without
    a shuffle. Rows of the other terms, few each, are shuffled. Terms are told apart by the binary digits of their frequency.
    """
    digits = F.length(F.bin("df"))
    sizes = frequencies.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("digits")).collect()  # 64 rows at most
    held, since = 0, 65
    for row in sizes:
        held += row["n"]
        if held > common_terms:
            break
        since = row["digits"]
    common = F.broadcast(frequencies.filter(digits >= since))
    out = counts.join(common, "term")
    if held <= common_terms:
        return out
    rare = counts.join(F.broadcast(frequencies.filter(digits >= since).select("term")), "term", "left_anti")
    return out.unionByName(rare.join(frequencies.filter(digits < since), "term"))


def tfidf_terms(items: DataFrame, text: str = "cleaned_text", stop_words: list[str] | None = None) -> DataFrame:
    """(page, term, tf, df, idf, tfidf).

    The counts are written once, so that texts are cleaned and split once though the counts are read
    several times; so are the document frequencies.
    """
    counts = materialize(term_counts(items, text, stop_words), "term-counts")
    documents = items.agg(F.count(F.lit(1))).scalar()
    frequencies = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    frequencies = materialize(frequencies.withColumn("idf", idf(documents, F.col("df"))), "document-frequencies")
    return join_frequencies(counts, frequencies).withColumn("tfidf", F.col("tf") * F.col("idf"))


def hashing_stages(
    text: str = "cleaned_text", stop_words: list[str] = PORTUGUESE_STOP_WORDS, n_features: int = N_FEATURES,
) -> list:
    """The row-by-row stages: tokens, stop words, hashed term frequency."""
    return [
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\s", minTokenLength=1),
        StopWordsRemover(inputCol="words", outputCol="filtered", stopWords=stop_words, locale="en_US"),
        HashingTF(inputCol="filtered", outputCol="raw_features", numFeatures=n_features),
    ]


def hashed_frequencies(
    items: DataFrame, text: str = "cleaned_text", stop_words: list[str] = PORTUGUESE_STOP_WORDS,
    n_features: int = N_FEATURES, hashing: str = "murmur3",
) -> DataFrame:
    """Add ``words``, ``filtered`` and ``raw_features`` without any shuffle.

    ``hashing`` is ``murmur3`` (Spark ML's) or ``md5``, whose buckets other engines can compute too.
    """
    tokenizer, remover, frequency = hashing_stages(text, stop_words, n_features)
    if hashing == "murmur3":
        return PipelineModel([tokenizer, remover, frequency]).transform(items)
    if hashing != "md5":
        raise ValueError(f"unknown hashing: {hashing}")
    bucket = F.transform("filtered", lambda w: (md5_number(w) % n_features).cast("string"))
    bucketed = PipelineModel([tokenizer, remover]).transform(items).withColumn("buckets", bucket)
    vocabulary = [str(i) for i in range(n_features)]
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="buckets", outputCol="raw_features")
    return counter.transform(bucketed).drop("buckets")


def hashed_tfidf(
    items: DataFrame, text: str = "cleaned_text", stop_words: list[str] = PORTUGUESE_STOP_WORDS,
    n_features: int = N_FEATURES, hashing: str = "murmur3", keep: list[str] | None = None,
) -> DataFrame:
    """Add ``features``, a sparse TF-IDF vector, to the columns of ``hashed_frequencies`` (or to ``keep`` of them).

    The frequencies are written once: the IDF fit (one pass, ``n_features`` sums) and the weighting
    both read them, so texts are split and hashed once.
    """
    frequencies = hashed_frequencies(items, text, stop_words, n_features, hashing)
    if keep is not None:
        frequencies = frequencies.select(*keep, "raw_features")
    stored = materialize(frequencies, "frequencies")
    return IDF(inputCol="raw_features", outputCol="features").fit(stored).transform(stored)


def hashed_model(
    items: DataFrame, text: str = "cleaned_text", stop_words: list[str] = PORTUGUESE_STOP_WORDS, n_features: int = N_FEATURES,
) -> PipelineModel:
    """The fitted stages as one model that can be saved and applied to later articles."""
    stored = materialize(hashed_frequencies(items, text, stop_words, n_features).select("raw_features"), "frequencies")
    weights = IDF(inputCol="raw_features", outputCol="features").fit(stored)
    return PipelineModel([*hashing_stages(text, stop_words, n_features), weights])


def item_features(tfidf: DataFrame) -> DataFrame:
    """(page, features), one row per page: the last modified, then the last issued; rows alike in that by their vectors' hash."""
    dates = [c for c in ("modified", "issued") if c in tfidf.columns]
    order = F.struct(*dates, F.xxhash64(vector_to_array("features")).alias("_hash"))
    return tfidf.groupBy("page").agg(F.max_by("features", order).alias("features"))


def features_long(df: DataFrame, key: str, vector: str = "features") -> DataFrame:
    """Non-zero entries of a vector column as (key, feature_idx, value)."""
    rows = df.select(key, F.posexplode(vector_to_array(vector)).alias("feature_idx", "value"))
    return rows.filter("value != 0")


def unit_arrays(df: DataFrame, key: str, vector: str = "features") -> DataFrame:
    """(key, factors): vectors scaled to length 1, as arrays. A zero vector stays zero."""
    unit = Normalizer(p=2.0, inputCol=vector, outputCol="_unit").transform(df)
    return unit.select(key, vector_to_array("_unit").alias("factors"))
