"""Word / class association (A01-A06) and per-dialogue red-flag terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.functions.formats import round_half_up, round_ratio
from colloquy.functions.text import ENGLISH_STOP_WORDS
from colloquy.operators.features import doc_terms

def word_class_counts(docs: DataFrame, terms: DataFrame, words_col: str = "words",
                      label_col: str = "labels", term_col: str = "word",
                      stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """A02 + A03: for each term in ``terms``: how many dialogues of class 1
    (``scam_count``) and class 0 (``non_scam_count``) contain it, and
    ``scam_ratio = round(scam / (scam + non), 3)`` (0.0 when neither).

    One pass over the dialogues for all terms: explode the distinct words of
    each dialogue, inner-join the term list (broadcast by Spark when its
    measured size allows, shuffled otherwise), and sum per term with map-side partial aggregation.  Terms that occur nowhere
    keep zero counts."""
    term_list = terms.select(F.col(term_col).alias("word")).distinct()
    lab = docs.select(F.col(label_col).alias("_label"), words_col)
    hits = (doc_terms(lab, "_label", words_col, stop_words, distinct=True).withColumnRenamed("term", "word")
                .join(term_list, "word")
                .groupBy("word")
                .agg(F.sum(F.when(F.col("_label") == 1.0, 1).otherwise(0)).cast("bigint").alias("scam_count"),
                     F.sum(F.when(F.col("_label") == 0.0, 1).otherwise(0)).cast("bigint").alias("non_scam_count")))
    out = (term_list.join(hits, "word", "left")
           .select("word",
                   F.coalesce("scam_count", F.lit(0)).cast("bigint").alias("scam_count"),
                   F.coalesce("non_scam_count", F.lit(0)).cast("bigint").alias("non_scam_count")))
    return out.withColumn("scam_ratio", round_ratio("scam_count", F.col("scam_count") + F.col("non_scam_count"), 3))


def word_stats(counts: DataFrame, importances: DataFrame, digits: int = 3) -> DataFrame:
    """Counts joined with importances ``(word, importance)``; importance
    rounded half up to ``digits``; ordered by rounded importance desc, word."""
    imp = importances.select("word", (round_half_up("importance", digits) / F.lit(10.0 ** digits)).alias("importance"))
    return (counts.join(imp, "word")
                  .select("word", "scam_count", "non_scam_count", "scam_ratio", "importance")
                  .orderBy(F.desc("importance"), F.asc("word")))


def melt_counts(stats: DataFrame) -> DataFrame:
    """Long form ``word, variable, value`` of the two counts."""
    return stats.select("word", "scam_count", "non_scam_count").unpivot(
        "word", ["scam_count", "non_scam_count"], "variable", "value")


def rank_by_ratio(stats: DataFrame) -> DataFrame:
    """scam_ratio descending (word breaks ties) with its 1-based rank.
    The window has no partition key, so it is only for bounded (top-n) inputs."""
    w = Window.orderBy(F.desc("scam_ratio"), F.asc("word"))
    return stats.withColumn("ratio_rank", F.row_number().over(w).cast("bigint")).orderBy("ratio_rank")


class NoImportancesError(TypeError):
    pass


def importance_vector(model):
    """Per-feature weights of a fitted classifier: feature importances for
    tree models, |coefficient| for logistic regression."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(stage, "featureImportances"):
        return stage.featureImportances.toArray()
    if hasattr(stage, "coefficients"):
        import numpy as np
        return np.abs(stage.coefficients.toArray())
    raise NoImportancesError(f"{type(stage).__name__} has no feature importances or coefficients")


def idf_vector(model):
    """Index -> idf weight of the model's own IDF stage."""
    for st in model.stages:
        if hasattr(st, "idf"):
            return st.idf.toArray()
    raise NoImportancesError("model has no IDF stage")


def feature_terms(model):
    """Index -> term for the model's vocabulary stage (CountVectorizer)."""
    for st in model.stages:
        if hasattr(st, "vocabulary"):
            return list(st.vocabulary)
    raise NoImportancesError("model has no vocabulary stage (hashed features cannot be named)")


def top_features(spark: SparkSession, model, n: int = 10) -> DataFrame:
    """The ``n`` terms with the largest importance ``(word, importance)``,
    ordered importance desc, word asc.  The importance vector is model state
    of vocabulary size (bounded), already on the driver."""
    imp = importance_vector(model)
    vocab = feature_terms(model)
    rows = [(vocab[i], float(imp[i])) for i in range(min(len(vocab), len(imp)))]
    df = spark.createDataFrame(rows, "word string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("word")).limit(n)


def red_flag_terms(tfidf_long: DataFrame, weights: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Per dialogue, the ``k`` terms with the largest tfidf x weight
    (weights = term importances or |coefficients|), ``(key, rank, word, score)``.
    The window is partitioned by dialogue, so one task holds one dialogue's
    distinct terms at a time."""
    w = weights.select(F.col("word").alias("term"), F.col("importance").alias("_w")).filter(F.col("_w") > 0)
    scored = (tfidf_long.join(w, "term")
              .select(key, F.col("term").alias("word"), (F.col("tfidf") * F.col("_w")).alias("score")))
    win = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("word"))
    return (scored.withColumn("rank", F.row_number().over(win))
                  .filter(F.col("rank") <= k))
