"""Text features (F01-F08): tokens, stop words, vocabulary, TF, IDF, TF-IDF.

Two forms of the same features:

* MLlib stages (``fit_feature_stages``) for model pipelines that are saved and
  re-loaded for scoring;
* long-form DataFrames ``(doc, term, value)`` for the checked operators and
  for joins (word statistics, similarity search).  These are pure Spark SQL:
  explode + aggregate with map-side partial aggregation, so a hot term (the
  empty token, "the") is combined inside each task before any shuffle.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, HashingTF, IDF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import ENGLISH_STOP_WORDS, clean_text, is_stop_word, remove_stop_words, tokenize

# --- fixed values -----------------------------------------------------------
DEFAULT_VOCAB_SIZE = 20000
DEFAULT_NUM_FEATURES = 10000
# -----------------------------------------------------------------------------


def with_tokens(df: DataFrame, in_col: str = "clean_text", out: str = "words",
                clean_input: bool = True) -> DataFrame:
    """Tokenizer semantics as a built-in expression (``clean_input``:
    the column is ``clean_text`` output)."""
    return df.withColumn(out, tokenize(in_col, clean_input=clean_input))


def with_filtered_words(df: DataFrame, in_col: str = "words", out: str = "filtered_words",
                        stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """default English stop words removed, case-insensitive."""
    return df.withColumn(out, remove_stop_words(in_col, stop_words))


def doc_terms(df: DataFrame, key: str | None = None, words_col: str = "words",
              stop_words=ENGLISH_STOP_WORDS, distinct: bool = False) -> DataFrame:
    """Long form ``(key, term)``: one row per token (per distinct token with
    ``distinct``) minus stop words.  Equivalent to exploding the
    ``filtered_words`` array, but the stop-word test runs as a codegen'd row
    filter, and ``explode_outer`` + a null filter keeps Catalyst from
    inferring a ``size(array) > 0`` predicate that would evaluate the whole
    tokenising expression a second time in the scan stage."""
    arr = F.array_distinct(words_col) if distinct else F.col(words_col)
    cols = [key] if key else []
    out = df.select(*cols, F.explode_outer(arr).alias("term")).filter(F.col("term").isNotNull())
    if stop_words:
        out = out.filter(~is_stop_word("term", stop_words))
    return out


def term_frequency(df: DataFrame, key: str, words_col: str = "words",
                   stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(key, term, tf)`` -- occurrences of each term in each row.
    The partial aggregate runs in the task that exploded the row, so what is
    shuffled is already one row per (key, term)."""
    return (doc_terms(df, key, words_col, stop_words)
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))


def document_frequency(df: DataFrame, words_col: str = "words", stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(term, doc_freq)`` -- rows containing the term (one row = one document)."""
    return (doc_terms(df, None, words_col, stop_words, distinct=True)
            .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")))


def vocabulary(df: DataFrame, words_col: str = "words", size: int = DEFAULT_VOCAB_SIZE,
               min_df: int = 1, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """the ``size`` most frequent terms by corpus count,
    ``(term, term_count, term_index)``; ties broken by term so the cut is
    deterministic.  The cut uses ``top_k_by_count`` (count threshold from a
    histogram, then an ordered limit over the few rows above it); the index
    window then runs over at most ``size`` rows."""
    counts = (doc_terms(df, None, words_col, stop_words)
              .groupBy("term").agg(F.count(F.lit(1)).alias("term_count")))
    if min_df > 1:
        dfreq = document_frequency(df, words_col, stop_words).filter(F.col("doc_freq") >= min_df)
        counts = counts.join(dfreq.select("term"), "term", "left_semi")
    top = top_k_by_count(counts, "term_count", "term", size)
    w = Window.orderBy(F.desc("term_count"), F.asc("term"))
    return top.withColumn("term_index", (F.row_number().over(w) - 1).cast("int"))


def idf_table(df: DataFrame, words_col: str = "words", stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``(term, doc_freq, idf)`` with ``idf = ln((m + 1) / (df + 1))``,
    ``m`` = number of rows (documents).  ``m`` is a scalar subquery evaluated
    once and shipped as a value -- no cross join, no window over all rows."""
    m = df.select(F.count(F.lit(1)).cast("double")).scalar()
    return (document_frequency(df, words_col, stop_words)
            .withColumn("idf", F.log((m + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))))


def top_k_by_count(counts: DataFrame, count_col: str, key_col: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest integer ``count_col`` (ties by
    ``key_col`` ascending), exactly, without merging ``k`` candidates from
    every partition in one task.

    A histogram ``count -> number of keys`` (one row per distinct count
    value) gives the smallest count ``c`` whose keys still start inside the
    top k; only rows with ``count >= c`` -- about k of them unless there is
    a large tie at ``c`` -- go into the final ordered limit.  The histogram
    window is a single partition, but it is small by construction: k
    distinct count values need at least 1 + 2 + ... + k tokens, so there are
    at most sqrt(2 x total count) of them (4.5 M for 10^13 tokens)."""
    hist = counts.groupBy(count_col).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.desc(count_col)).rowsBetween(Window.unboundedPreceding, -1)
    cut = (hist.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
               .filter(F.col("_above") < k).agg(F.min(count_col)).scalar())
    return (counts.filter(F.col(count_col) >= cut)
                  .orderBy(F.desc(count_col), F.asc(key_col)).limit(k))


def idf_from_tf(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """F05 from a term-frequency frame: every ``(key, term)`` row is one
    document containing the term, so ``doc_freq`` is a count per term of
    ``tf``.  Reusing ``tf`` means the text is tokenised once for both TF
    and IDF (Spark reuses the shared exchange); ``docs`` only supplies the
    document count (a column-pruned count)."""
    m = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    # count rows with tf > 0 (all of them) rather than rows: the expression
    # keeps the tf column alive, so the tf aggregate is identical on both
    # branches and its shuffle is reused instead of tokenising twice
    return (tf.groupBy("term").agg(F.count(F.when(F.col("tf") > 0, 1)).alias("doc_freq"))
              .withColumn("idf", F.log((m + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))))


def tfidf_table(docs: DataFrame, key: str, words_col: str = "words") -> DataFrame:
    """F04-F06 in one plan: ``(key, term, tfidf)`` with one tokenising pass."""
    tf = term_frequency(docs, key, words_col)
    return tfidf(tf, idf_from_tf(tf, docs), key)


def tfidf(tf: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """``(key, term, tfidf)`` = tf x idf, no length normalisation; AQE
    picks the join from the idf side's run-time size."""
    return (tf.join(idf.select("term", "idf"), "term")
              .select(key, "term", (F.col("tf") * F.col("idf")).alias("tfidf")))


def text_features(df: DataFrame, text_col: str = "dialogue") -> DataFrame:
    """clean_text, words and filtered_words in one projection."""
    return (df.withColumn("clean_text", clean_text(text_col))
              .withColumn("words", tokenize("clean_text", clean_input=True))
              .withColumn("filtered_words", remove_stop_words("words")))


def hashing_stages(num_features: int = DEFAULT_NUM_FEATURES, input_col: str = "clean_text"):
    """Tokenizer -> StopWordsRemover -> HashingTF (F07: non-binary); nothing to fit."""
    return [Tokenizer(inputCol=input_col, outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="filtered_words"),
            HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features)]


def fit_feature_stages(train: DataFrame, kind: str = "count", vocab_size: int = DEFAULT_VOCAB_SIZE,
                       num_features: int = DEFAULT_NUM_FEATURES, input_col: str = "clean_text",
                       features_col: str = "features") -> PipelineModel:
    """MLlib stages Tokenizer -> StopWordsRemover -> (counts over the
    vocabulary | HashingTF) -> IDF, fitted.

    ``kind="count"`` takes the vocabulary of ``vocabulary`` (F03), which breaks
    ties at the cut by term: MLlib's own fit keeps whichever of the tied terms
    arrive first, so the kept set would depend on the cluster.  Only integers
    are counted, so the fitted stages are the same on any layout.
    ``kind="hash"`` is the hashed design (F07)."""
    stages = hashing_stages(num_features, input_col)
    if kind == "count":
        terms = vocabulary(with_tokens(train.select(input_col), input_col), size=vocab_size)
        names = [r.term for r in terms.orderBy("term_index").collect()]     # at most vocab_size rows
        stages[2] = CountVectorizerModel.from_vocabulary(names, "filtered_words", "raw_features")
    elif kind != "hash":
        raise ValueError(f"unknown feature kind {kind!r}; use 'count' or 'hash'")
    counted = PipelineModel(stages=stages)
    idf = IDF(inputCol="raw_features", outputCol=features_col).fit(counted.transform(train.select(input_col)))
    return PipelineModel(stages=[*stages, idf])


def vector_summary(df: DataFrame, vec_col: str = "raw_features") -> DataFrame:
    """Non-zero entry count and total of a (sparse) vector column, as plain numbers."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col(vec_col))
    return (df.withColumn("n_nonzero", F.size(F.filter(arr, lambda x: x != 0)).cast("bigint"))
              .withColumn("total", F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)))
