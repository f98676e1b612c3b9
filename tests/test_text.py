"""Text semantics: FIXTURES edge rows, MLlib equivalence, mutation sanity."""

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from colloquy.functions.text import ENGLISH_STOP_WORDS, clean_text, remove_stop_words, tokenize
from colloquy.operators import cleaning, features

from conftest import SF01

EDGE = [
    ("Hi  there, don't!  ", "hi  there dont  ", True, ["hi", "", "there", "dont"]),
    ("one.\nTwo", "onetwo", True, ["onetwo"]),
    ("   ", "   ", True, []),
    ("", "", False, [""]),
    ("123!", "", False, [""]),
    (" lead Café İK", " lead caf ik", True, ["", "lead", "caf", "ik"]),
]


def test_edge_rows(spark):
    df = spark.createDataFrame([(i, d) for i, (d, *_rest) in enumerate(EDGE)], "id int, dialogue string")
    out = cleaning.with_clean_text(df)
    out = out.withColumn("words", tokenize("clean_text", clean_input=True)).withColumn("w2", tokenize("clean_text"))
    rows = {r["id"]: r for r in out.collect()}
    kept = {r["id"] for r in cleaning.drop_empty(out).collect()}
    for i, (_d, clean, keep, words) in enumerate(EDGE):
        assert rows[i]["clean_text"] == clean, i
        assert (i in kept) == keep, i
        assert list(rows[i]["words"]) == words, i
        assert list(rows[i]["w2"]) == words, i


def test_cleaning_deletes_runs_and_equals_the_pattern_of_single_characters(spark):
    every = [chr(c) for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    texts = [f"Ab{c}{c}Z {c}" for c in every] + ["", " \n\t ", "ÀB--c!!\r\nD  e", "🙂x🙂🙂Y", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    single = F.regexp_replace(F.lower("t"), "[^a-zA-Z ]", "")
    assert df.filter(~clean_text("t").eqNullSafe(single)).count() == 0
    plan = df.select(clean_text("t").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "[^a-z ]+" in plan


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "dialogue string")
    r = cleaning.with_clean_text(df).withColumn("w", tokenize("clean_text")).collect()[0]
    assert r["clean_text"] is None and r["w"] is None
    assert cleaning.drop_empty(cleaning.with_clean_text(df)).count() == 0


def test_stop_word_list_is_sparks():
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(ENGLISH_STOP_WORDS) == 181 and "" not in ENGLISH_STOP_WORDS


def test_tokenize_equals_mllib_on_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", clean_text("text").alias("clean_text"))
    ml = Tokenizer(inputCol="clean_text", outputCol="ml").transform(docs)
    ml = StopWordsRemover(inputCol="ml", outputCol="ml_f").transform(ml)
    ours = (ml.withColumn("a", tokenize("clean_text", clean_input=True))
              .withColumn("b", tokenize("clean_text"))
              .withColumn("f", remove_stop_words("a")))
    assert ours.filter((F.col("a") != F.col("ml")) | (F.col("b") != F.col("ml"))).count() == 0
    assert ours.filter(F.col("f") != F.col("ml_f")).count() == 0


def test_tokenize_raw_text_equals_mllib(spark):
    """Uncleaned text with tabs/newlines/upper case: general path still matches."""
    docs = spark.read.parquet(f"{SF01}/conversations.parquet").select("text")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(docs)
    assert ml.filter(tokenize("text") != F.col("ml")).count() == 0


def test_mutation_split_differs(spark):
    """A plain split keeps trailing empties: the oracle must notice."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select(clean_text("text").alias("c"))
    assert docs.filter(F.split("c", " ") != tokenize("c", clean_input=True)).count() > 0


def test_long_form_equals_array_form(spark):
    docs = features.text_features(spark.read.parquet(f"{SF01}/documents.parquet")
                                  .select("doc_id", F.col("text").alias("dialogue")))
    a = features.term_frequency(docs, "doc_id")
    b = (docs.select("doc_id", F.explode("filtered_words").alias("term"))
             .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_has_clean_text_equals_clean_filter(spark):
    from colloquy.functions.text import has_clean_text
    rows = [(t,) for t in ["", "123!", "İ", "K", "é", "  ", "a", None, "½ü"]]
    df = spark.createDataFrame(rows, "t string").withColumn("c", clean_text("t"))
    got = df.select((F.col("c") != "").alias("a"), has_clean_text("t").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert docs.filter((clean_text("text") != "") != has_clean_text("text")).count() == 0


def test_top_k_by_count_equals_plain_sort(spark):
    from colloquy.operators.features import top_k_by_count
    docs = features.text_features(spark.read.parquet(f"{SF01}/documents.parquet")
                                  .select("doc_id", F.col("text").alias("dialogue")))
    counts = features.doc_terms(docs, None).groupBy("term").agg(F.count(F.lit(1)).alias("c"))
    for k in (1, 7, 100, 20000, 10 ** 6):
        a = [tuple(r) for r in top_k_by_count(counts, "c", "term", k).collect()]
        b = [tuple(r) for r in counts.orderBy(F.desc("c"), F.asc("term")).limit(k).collect()]
        assert a == b, k
