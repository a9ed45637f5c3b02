"""Text cleaning gives what its fixed patterns give; parts of texts follow their bytes."""

from pyspark.sql import functions as F

from readflow.functions import text
from readflow.operators import tfidf
from readflow.session import configure, spread


def test_clean_text_equals_the_fixed_patterns(spark):
    points = [i for i in [*range(0x3000), *range(0x3000, 0x110000, 211), 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x10FFFF] if not 0xD800 <= i < 0xE000]
    rows = [f"a{chr(i)}B {chr(i)}{chr(i)}c" for i in points]
    rows += [None, "", "x<b>y \U0001F600 http://a.b/\U0001F600c d\x00e", "see www.a.b <i一> http", "a < b", "É é <ÿ> https://x"]
    plain = F.col("x")
    for pattern, by in ((text.URL_PATTERN, ""), (text.TAG_PATTERN, ""), (text.DISALLOWED_PATTERN, ""), (text.BLANKS_PATTERN, " ")):
        plain = F.regexp_replace(plain, pattern, by)
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    both = df.select("x", text.clean_text(F.col("x")).alias("got"), F.coalesce(F.trim(F.lower(plain)), F.lit("")).alias("want"))
    assert both.filter("not got <=> want").collect() == []


def test_plain_characters_need_no_negated_class():
    assert not text.DISALLOWED_PLAIN.startswith("[^") and "\\uD8" not in text.DISALLOWED_PLAIN


def test_parts_follow_the_bytes_of_texts(spark):
    configure(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        def parts(n):
            return spread(spark.range(n).select(F.col("id").cast("string").alias("page"), F.repeat(F.lit("ab "), 350_000).alias("text")), "page").rdd.getNumPartitions()

        assert [parts(n) for n in (1, 8, 48, 96)] == [2, 2, 4, 7]
        assert spread(spark.createDataFrame([], "page string, text string"), "page").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_common_terms_meet_their_frequencies_without_a_shuffle(spark, tmp_path):
    configure(spark)
    rows = [(f"p{p}", f"t{t}", p + t) for p in range(40) for t in range(12) if p % (t + 1) == 0]
    counts = spark.createDataFrame([*rows, (None, "t0", 7)], "page string, term string, tf bigint")
    counts.write.parquet(f"{tmp_path}/counts")
    counts = spark.read.parquet(f"{tmp_path}/counts")
    counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{tmp_path}/frequencies")
    frequencies = spark.read.parquet(f"{tmp_path}/frequencies")
    want = sorted(map(repr, counts.join(frequencies, "term").collect()))
    for n in (0, 1, 3, 12, 100):
        joined = tfidf.join_frequencies(counts, frequencies, n)
        assert sorted(map(repr, joined.collect())) == want, n
    assert "BroadcastHashJoin" in tfidf.join_frequencies(counts, frequencies)._jdf.queryExecution().sparkPlan().toString()
