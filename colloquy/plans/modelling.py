"""Model queries: training, evaluation, importances, batch scoring and
red-flag terms on the labelled documents.  What a model predicts is not SQL;
the registered queries return every row's keys and what must hold for it."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import cleaning, features, metrics, models, scoring, split, words
from colloquy.plans.oracle import CLEAN, D01, FILT, LAB, R6, SPLIT, TOK
from colloquy.plans.queries import dialogues, labelled_clean, r6
from colloquy.sources.tables import labelled_documents

_MEMO: dict = {}


def labelled_split(spark, sf):
    """Cleaned, non-empty labelled dialogues with their hash split."""
    df = labelled_clean(spark, sf).select("doc_id", "dialogue", "labels", "clean_text")
    return split.hash_split(df, "doc_id", out="dataset")


_LABELLED: dict = {}


def cached_split(spark, sf):
    """``labelled_split`` cached once per session: every model query trains
    on its Train part and scores its held-out parts without re-scanning,
    re-joining and re-cleaning the documents."""
    from colloquy.session import persist
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LABELLED:
        _LABELLED[key] = persist(labelled_split(spark, sf))
    return _LABELLED[key]


_PREPARED: dict = {}


def prepared(spark, sf, kind: str = "count"):
    """The training set of the model queries of one session: cleaned input,
    fitted vocabulary / IDF, cached vectors."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _PREPARED:
        train = cached_split(spark, sf).filter(F.col("dataset") == split.TRAIN)
        _PREPARED[key] = models.prepare_training(train, kind=kind, key="doc_id")
        _PREPARED[key].vectors.count()
    return _PREPARED[key]


def trained(spark, sf, name: str, kind: str = "count", **params):
    """Fit (once per session, table folder and settings) and return the model."""
    app = spark.sparkContext.applicationId
    key = (app, sf, name, kind, tuple(sorted(params.items())))
    if key not in _MEMO:
        _MEMO[key] = prepared(spark, sf, kind).fit(name, **params)
    return _MEMO[key]


def predictions(spark, sf, name: str, kind: str = "count", **params):
    """doc_id, dataset, labels, prediction, confidence on Validation + Test."""
    model = trained(spark, sf, name, kind, **params)
    held = cached_split(spark, sf).filter(F.col("dataset") != split.TRAIN).select(
        "doc_id", "dialogue", "labels", "dataset")
    return scoring.score(model, held).select("doc_id", "dataset", "labels", "prediction", "confidence")


def _checked(df, *keys):
    """Keys of scored rows and what must hold for any fitted model, so that a
    query of trained output is checked row by row: the prediction is a class,
    the confidence a probability, and the prediction the likelier class."""
    c = F.col("confidence")
    return df.select(
        *keys, F.coalesce(F.col("prediction").isin(0.0, 1.0), F.lit(False)).alias("prediction_is_class"),
        F.coalesce(c.between(0.0, 1.0), F.lit(False)).alias("confidence_is_probability"),
        F.coalesce((F.abs(c - 0.5) < 1e-9) | ((c > 0.5) == (F.col("prediction") == 1.0)), F.lit(False)).alias("prediction_is_likelier"))


def _pred_query(name, kind="count"):
    def q(spark, sf):
        return _checked(predictions(spark, sf, name, kind), "doc_id", "dataset", "labels")
    q.__name__ = f"pred_{name}"
    q.__doc__ = f"{name}: fitted on Train, every held-out document scored and checked."
    return q


def _walk_query(name):
    def q(spark, sf):
        from pyspark.ml import PipelineModel
        from colloquy.operators import treewalk
        model = trained(spark, sf, name)
        held = cached_split(spark, sf).filter(F.col("dataset") != split.TRAIN)
        vectors = PipelineModel(stages=model.stages[:-1]).transform(held).select("doc_id", "features")
        walked = treewalk.confidence(vectors, "doc_id", model.stages[-1]).withColumnRenamed("confidence", "walked")
        both = predictions(spark, sf, name).join(walked, "doc_id", "left")
        w = F.col("walked")
        return both.select(
            "doc_id", F.coalesce(F.abs(w - F.col("confidence")) < 1e-9, F.lit(False)).alias("confidence_equals_walk"),
            F.coalesce((F.abs(w - 0.5) < 1e-9) | ((w > 0.5) == (F.col("prediction") == 1.0)), F.lit(False)).alias("prediction_equals_walk"))
    q.__name__ = f"walk_{name}"
    q.__doc__ = f"{name}: every held-out document's prediction against a walk of the fitted trees in Spark SQL."
    return q


ALL_MODELS = (models.DECISION_TREE, models.RANDOM_FOREST, models.BOOSTED_TREES, models.LOGISTIC_REGRESSION)


def model_table(spark, sf):
    """E07 over the four trained models: Model, Dataset, Metric, Score.  The
    held-out features are computed once for all models."""
    fitted = {name: trained(spark, sf, name) for name in ALL_MODELS}
    held = cached_split(spark, sf).filter(F.col("dataset") != split.TRAIN)
    union = scoring.score_all(fitted, held, ["doc_id", "dataset", "labels"])
    return metrics.metrics_table(union, dataset_col="dataset", score_col="confidence")


def model_metrics_e07(spark, sf):
    """Which metrics of which model exist on which dataset, and that each
    is a share (AUC may be null where a class is missing)."""
    return model_table(spark, sf).select("Model", "Dataset", "Metric", (
        F.col("Score").between(0.0, 1.0) | (F.col("Score").isNull() & (F.col("Metric") == "AUC"))).alias("score_is_share"))


def hashed_tf_f07(spark, sf):
    """hashed term counts (10,000 buckets) per labelled document: the
    total count, and that there are no more used buckets than that."""
    from pyspark.ml import PipelineModel
    df = cleaning.with_clean_text(labelled_documents(spark, sf))
    # tokenizer, stop words and hashing are transformers: no fitting pass (the IDF stage is not needed)
    out = features.vector_summary(PipelineModel(stages=features.hashing_stages()).transform(df), "raw_features")
    return out.select("doc_id", F.col("total").cast("bigint").alias("total"),
                      ((F.col("n_nonzero") <= F.col("total")) & ((F.col("n_nonzero") > 0) == (F.col("total") > 0))).alias("buckets_fit"))


def top_terms(spark, sf, name):
    """The 10 most important terms of a tree model."""
    return words.top_features(spark, trained(spark, sf, name), 10)


def importance_a01(spark, sf):
    """The ranks of the forest's 10 most important terms, that they are
    terms of the training vocabulary and that the weights are shares."""
    from pyspark.sql import Window
    top = top_terms(spark, sf, models.RANDOM_FOREST)
    train = cached_split(spark, sf).filter(F.col("dataset") == split.TRAIN)
    known = features.doc_terms(features.with_tokens(train), None, distinct=True).select(F.col("term").alias("word")).distinct()
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), F.asc("word")))       # 10 rows
    return (top.withColumn("rank", rank.cast("bigint")).join(known.withColumn("_k", F.lit(True)), "word", "left")
            .select("rank", F.coalesce("_k", F.lit(False)).alias("word_is_known"),
                    F.col("importance").between(0.0, 1.0).alias("importance_is_share")))


def _term_report(name):
    def q(spark, sf):
        imp = top_terms(spark, sf, name)
        docs = labelled_clean(spark, sf)
        stats = words.word_stats(words.word_class_counts(docs, imp), imp)
        # the counts again from whole term counts, by another route
        total = features.document_frequency(docs).select(F.col("term").alias("word"), "doc_freq")
        same = stats.join(total, "word", "left").withColumn("doc_freq", F.coalesce("doc_freq", F.lit(0)))
        ok = (F.col("scam_count") + F.col("non_scam_count") == F.col("doc_freq")) & F.col("scam_ratio").between(0.0, 1.0)
        return same.agg(F.count(F.lit(1)).alias("terms"), F.bool_and(ok).alias("counts_add_up"),
                        F.bool_and(F.col("importance").between(0.0, 1.0)).alias("importance_is_share"))
    q.__name__ = f"word_stats_{name}"
    q.__doc__ = f"A02-A04 on the top terms of {name} over the whole labelled set, checked against document counts."
    return q


def batch_b02(spark, sf):
    """B01 + B02: every assembled conversation scored by the forest; the
    dialogue, and that label and confidence text have their forms."""
    model = trained(spark, sf, models.RANDOM_FOREST)
    scored = scoring.classified_batch(scoring.score(model, dialogues(spark, sf).select("conv_id", "dialogue")))
    return scored.select(
        "conv_id", "dialogue",
        F.col("predicted_label").isin("Non-Scam (Safe)", "Potentially Scam").alias("label_is_known"),
        F.coalesce(F.col("confidence").rlike(r"^[0-9]{1,3}\.[0-9]{2}%$"), F.lit(False)).alias("confidence_is_percent"))


def _red_flags(spark, sf, terms_df):
    """Terms of the conversations with the given weights (word, importance, idf)."""
    docs = features.text_features(dialogues(spark, sf).select("conv_id", "dialogue"))
    tf = features.term_frequency(docs, "conv_id")
    weighted = features.tfidf(tf, terms_df.select(F.col("word").alias("term"), "idf"), "conv_id")
    return words.red_flag_terms(weighted, terms_df, "conv_id", 5)


def _forest_terms(spark, sf):
    """word, importance, idf of the terms that the forest uses."""
    model = trained(spark, sf, models.RANDOM_FOREST)
    imp, vocab, idf = words.importance_vector(model), words.feature_terms(model), words.idf_vector(model)
    rows = [(vocab[i], float(imp[i]), float(idf[i])) for i in range(len(vocab)) if imp[i] > 0]
    return spark.createDataFrame(rows, "word string, importance double, idf double")


def red_flag_table(spark, sf):
    """Per conversation, the 5 terms with the largest tf x idf x importance,
    both weights those of the trained forest and its own IDF stage."""
    return _red_flags(spark, sf, _forest_terms(spark, sf))


def red_flags_r01(spark, sf):
    """R01 with the forest's weights: per conversation that it has as many flags
    as it has terms of the forest (5 at most), with ranks from 1 without gaps
    by falling score; and that the forest has terms at all."""
    from pyspark.sql import Window
    terms_df = _forest_terms(spark, sf)
    flags = _red_flags(spark, sf, terms_df)
    before = F.lag("score").over(Window.partitionBy("conv_id").orderBy("rank"))
    per = (flags.withColumn("_b", before).groupBy("conv_id")
           .agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"), F.bool_and(
               (F.col("score") > 0) & F.coalesce(F.col("_b") >= F.col("score"), F.lit(True))).alias("ordered")))
    # the terms of each conversation by another route: its distinct words
    own = features.text_features(dialogues(spark, sf).select("conv_id", "dialogue")).select(
        "conv_id", F.explode(F.array_distinct("words")).alias("word"))
    due = (own.join(F.broadcast(terms_df.filter("idf > 0").select("word")), "word")
           .groupBy("conv_id").agg(F.least(F.lit(5), F.count(F.lit(1))).alias("due")))
    out = dialogues(spark, sf).select("conv_id").join(per, "conv_id", "left").join(due, "conv_id", "left")
    n, some = F.coalesce("n", F.lit(0)), terms_df.limit(1).count() > 0
    return out.select("conv_id", ((n == F.coalesce("due", F.lit(0))) & (n == F.coalesce("top", F.lit(0)))
                                  & F.coalesce("ordered", F.lit(True)) & F.lit(some)).alias("ranks_hold"))


def rule_red_flags_r01(spark, sf):
    """R01 with the documents' idf as both weights: exactly checkable."""
    df = features.text_features(labelled_documents(spark, sf))
    idf = features.idf_table(df).filter("idf > 0")
    terms_df = idf.select(F.col("term").alias("word"), F.col("idf").alias("importance"), "idf")
    return _red_flags(spark, sf, terms_df).select("conv_id", F.col("rank").cast("bigint").alias("rank"), "word",
                                                  r6("score").alias("score"))


def training_best_e08(spark, sf):
    """The training run over all four classifiers: the best by F1 on Validation
    equals the argmax of the run's own metrics table."""
    from colloquy.plans.training import run_training
    labelled = labelled_clean(spark, sf).select("doc_id", "dialogue", "labels", "clean_text")
    run = run_training(labelled, fitted={name: trained(spark, sf, name) for name in ALL_MODELS})
    f1 = run.metrics.filter("Dataset = 'Validation' AND Metric = 'F1'")
    return f1.agg(F.count(F.lit(1)).alias("models"), F.max("Score").alias("top"),
                  F.min(F.when(F.col("Model") == run.best_name, F.col("Score"))).alias("own")).select(
        F.col("models"), F.lit("Validation").alias("dataset"), F.lit("F1").alias("metric"),
        (F.col("top") == F.col("own")).alias("best_is_top"))


def explained_batch_l01(spark, sf):
    """classify-and-explain over the assembled conversations with the
    documents as history, by the trained regression: what it predicts is
    checked, and that both prompts hold the dialogue."""
    from colloquy.operators.analysis import classify_and_explain
    from colloquy.sources.tables import read_table
    model = trained(spark, sf, models.LOGISTIC_REGRESSION)
    hist = read_table(spark, sf, "documents").select("doc_id", F.col("text").alias("dialogue"))
    cases = dialogues(spark, sf).select("conv_id", "dialogue")
    out = classify_and_explain(model, cases, "conv_id", hist, "doc_id").join(cases, "conv_id")
    return _checked(out.withColumn("prompt_holds_dialogue", F.contains("prompt", "dialogue"))
                    .withColumn("history_holds_dialogue", F.coalesce(F.contains("history_prompt", "dialogue"), F.lit(False))),
                    "conv_id", "prompt_holds_dialogue", "history_holds_dialogue")


def rule_batch_b02(spark, sf):
    """B01 + B02 with the rule stand-in model: every assembled conversation
    scored and formatted for display (exactly checkable)."""
    from colloquy.sources.fixtures import RuleModel
    scored = scoring.score(RuleModel(), dialogues(spark, sf).select("conv_id", "dialogue"))
    return scoring.classified_batch(scored)


EXACT = {
    "rule_batch_b02": rule_batch_b02,
    "tree_m01": _pred_query(models.DECISION_TREE),
    "forest_m02": _pred_query(models.RANDOM_FOREST),
    "gbt_m03": _pred_query(models.BOOSTED_TREES),
    "tree_walk_m01": _walk_query(models.DECISION_TREE),
    "forest_walk_m02": _walk_query(models.RANDOM_FOREST),
    "gbt_walk_m03": _walk_query(models.BOOSTED_TREES),
    "logreg_m04": _pred_query(models.LOGISTIC_REGRESSION),
    "logreg_hashed_m04": _pred_query(models.LOGISTIC_REGRESSION, kind="hash"),
    "model_metrics_e07": model_metrics_e07,
    "hashed_tf_f07": hashed_tf_f07,
    "importance_a01": importance_a01,
    "word_stats_a04": _term_report(models.RANDOM_FOREST),
    "tree_words_a04": _term_report(models.DECISION_TREE),
    "batch_b02": batch_b02,
    "red_flags_r01": red_flags_r01,
    "rule_red_flags_r01": rule_red_flags_r01,
    "training_best_e08": training_best_e08,
    "explained_batch_l01": explained_batch_l01,
}

_HELD = "WITH " + LAB + f"""
SELECT doc_id, {SPLIT.format(k='doc_id')} AS dataset, labels, true AS prediction_is_class,
       true AS confidence_is_probability, true AS prediction_is_likelier
FROM lab_nonempty WHERE {SPLIT.format(k='doc_id')} <> 'Train'"""
_WALK = "WITH " + LAB + f"""
SELECT doc_id, true AS confidence_equals_walk, true AS prediction_equals_walk
FROM lab_nonempty WHERE {SPLIT.format(k='doc_id')} <> 'Train'"""
_TERMS = "WITH " + LAB + """
SELECT least(10, count(DISTINCT term)) AS terms, true AS counts_add_up, true AS importance_is_share
FROM (SELECT unnest(fw) AS term FROM lab_fw)"""

SQL = {
    "rule_batch_b02": "WITH " + D01 + f""",
s AS (SELECT conv_id, dialogue, length({CLEAN.format(t='dialogue')}) AS n FROM d01),
p AS (SELECT conv_id, dialogue, n / (n + CAST(100.0 AS DOUBLE)) AS c FROM s),
u AS (SELECT *, CASE WHEN c >= 0.5 THEN 1 ELSE 0 END AS pred,
             CAST(floor(c * 100.0 * 100.0 + 0.5) AS BIGINT) AS u2 FROM p)
SELECT conv_id, dialogue,
       CASE WHEN pred = 0 THEN 'Non-Scam (Safe)' ELSE 'Potentially Scam' END AS predicted_label,
       CASE WHEN c IS NULL OR c = 0 THEN NULL
            ELSE CAST(u2 // 100 AS VARCHAR) || '.' || lpad(CAST(u2 % 100 AS VARCHAR), 2, '0') || '%' END AS confidence
FROM u""",
    "tree_m01": _HELD,
    "forest_m02": _HELD,
    "gbt_m03": _HELD,
    "tree_walk_m01": _WALK,
    "forest_walk_m02": _WALK,
    "gbt_walk_m03": _WALK,
    "logreg_m04": _HELD,
    "logreg_hashed_m04": _HELD,
    "word_stats_a04": _TERMS,
    "tree_words_a04": _TERMS,
    "model_metrics_e07": "WITH " + LAB + f"""
SELECT m."Model", d."Dataset", k."Metric", true AS score_is_share
FROM (SELECT unnest({list(ALL_MODELS)}) AS "Model") m,
     (SELECT DISTINCT {SPLIT.format(k='doc_id')} AS "Dataset" FROM lab_nonempty
      WHERE {SPLIT.format(k='doc_id')} <> 'Train') d,
     (SELECT unnest({list(metrics.METRIC_NAMES)}) AS "Metric") k""",
    "hashed_tf_f07": "WITH " + LAB + f"""
SELECT doc_id, CAST(len({FILT.format(w=TOK.format(c='c'))}) AS BIGINT) AS total, true AS buckets_fit FROM lab_clean""",
    "importance_a01": "WITH " + LAB + f""",
t AS (SELECT DISTINCT term FROM (SELECT unnest(fw) AS term FROM lab_fw WHERE {SPLIT.format(k='doc_id')} = 'Train') LIMIT 10)
SELECT CAST(row_number() OVER () AS BIGINT) AS rank, true AS word_is_known, true AS importance_is_share FROM t""",
    "batch_b02": "WITH " + D01 + "SELECT conv_id, dialogue, true AS label_is_known, true AS confidence_is_percent FROM d01",
    "red_flags_r01": "WITH " + D01 + "SELECT conv_id, true AS ranks_hold FROM d01",
    "rule_red_flags_r01": "WITH " + LAB + "," + D01 + f""",
lab_all AS (SELECT doc_id, {FILT.format(w=TOK.format(c='c'))} AS fw FROM lab_clean),
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM lab_all),
dfq AS (SELECT term, count(*) AS doc_freq FROM (SELECT doc_id, unnest(list_distinct(fw)) AS term FROM lab_all) GROUP BY term),
idf AS (SELECT term, ln((m.m + 1.0) / (doc_freq + 1.0)) AS idf FROM dfq, m),
qfw AS (SELECT conv_id, {FILT.format(w=TOK.format(c=CLEAN.format(t='dialogue')))} AS fw FROM d01),
tf AS (SELECT conv_id, term, count(*) AS tf FROM (SELECT conv_id, unnest(fw) AS term FROM qfw) GROUP BY ALL),
s AS (SELECT conv_id, term AS word, tf * idf * idf AS score FROM tf JOIN idf USING (term) WHERE idf > 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, word) AS BIGINT) AS rank FROM s)
SELECT conv_id, rank, word, {R6('score')} AS score FROM r WHERE rank <= 5""",
    "training_best_e08": f"""
SELECT CAST({len(ALL_MODELS)} AS BIGINT) AS models, 'Validation' AS dataset, 'F1' AS metric, true AS best_is_top""",
    "explained_batch_l01": "WITH " + D01 + """
SELECT conv_id, true AS prompt_holds_dialogue, true AS history_holds_dialogue, true AS prediction_is_class,
       true AS confidence_is_probability, true AS prediction_is_likelier FROM d01""",
}


def release_memos(spark) -> None:
    """Forget the models, vectors and cached inputs that queries of this
    session share (for measurements, and after the tables changed)."""
    for prep in _PREPARED.values():
        prep.release()
    for frame in _LABELLED.values():
        frame.unpersist()
    _PREPARED.clear()
    _LABELLED.clear()
    _MEMO.clear()
    from colloquy.plans import history, queries, streams
    for memo in (history._K01_RUNS, history._INDEXES, queries._CSV_RUNS, streams._RUNS):
        memo.clear()
    spark.catalog.clearCache()
