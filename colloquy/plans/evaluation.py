"""Evaluation queries (E01-E09) on rule-made predictions, exactly checkable.

Two rule "models" (see ``sources.fixtures.rule_predictions``) are scored on
the Validation and Test parts of the hash split, exactly as trained models
are evaluated in ``plans.modelling``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import metrics, split
from colloquy.plans.oracle import LAB, R6, SPLIT
from colloquy.plans.queries import labelled_clean, r6
from colloquy.sources import fixtures


def rule_eval_frame(spark, sf):
    """model, doc_id, labels, prediction, score, dataset (Validation/Test)."""
    preds = fixtures.rule_predictions(labelled_clean(spark, sf, with_extra=True))
    preds = split.hash_split(preds, "doc_id", out="dataset")
    return preds.filter(F.col("dataset") != split.TRAIN)


def auc_e01(spark, sf):
    """E01 per rule model and dataset: model, dataset, auc."""
    a = metrics.roc_auc(rule_eval_frame(spark, sf), ["model", "dataset"])
    return a.select("model", "dataset", r6("auc").alias("auc"))


def metrics_e02_e05(spark, sf):
    """E02-E05 per rule model and dataset."""
    m = metrics.classification_metrics(rule_eval_frame(spark, sf), ["model", "dataset"])
    return m.select("model", "dataset", *[r6(c).alias(c) for c in
                                          ("accuracy", "weighted_precision", "weighted_recall", "f1")])


def confusion_e06(spark, sf):
    """E06 per rule model and dataset, with a third predicted class mixed in."""
    frame = rule_eval_frame(spark, sf)
    third = F.when(F.pmod("doc_id", F.lit(9)) == 0, F.lit(2.0)).when(F.pmod("doc_id", F.lit(9)) == 1, F.lit(0.5))
    return metrics.confusion_matrix(frame.withColumn("prediction", third.otherwise(F.col("prediction"))), ["model", "dataset"])


def metrics_long_e07(spark, sf):
    """Model, Dataset, Metric, Score."""
    return metrics.metrics_table(rule_eval_frame(spark, sf))


def best_model_e08(spark, sf):
    """The best model per dataset and metric."""
    return metrics.best_model(metrics_long_e07(spark, sf))


def report_e09(spark, sf):
    """One report line per metric."""
    return metrics.report_lines(metrics_long_e07(spark, sf))


EXACT = {
    "auc_e01": auc_e01,
    "metrics_e02_e05": metrics_e02_e05,
    "confusion_e06": confusion_e06,
    "metrics_long_e07": metrics_long_e07,
    "best_model_e08": best_model_e08,
    "report_e09": report_e09,
}

_DS = "WITH " + LAB + f""",
preds AS (SELECT 'QualityRule' AS model, doc_id, labels, CAST(quality AS DOUBLE) AS prediction,
                 CAST(quality + n_chars / 1e6 AS DOUBLE) AS score FROM lab_nonempty
          UNION ALL
          SELECT 'LengthRule' AS model, doc_id, labels,
                 CASE WHEN n_chars < 1000 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
                 CAST(-n_chars AS DOUBLE) AS score FROM lab_nonempty),
ds AS (SELECT * FROM (SELECT *, {SPLIT.format(k='doc_id')} AS dataset FROM preds) WHERE dataset <> 'Train'),
counts AS (SELECT model, dataset, labels AS label, prediction, count(*) AS n FROM ds GROUP BY ALL),
cls AS (SELECT model, dataset, cls, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp
        FROM (SELECT model, dataset, label AS cls, n AS support, 0 AS predicted,
                     CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM counts
              UNION ALL
              SELECT model, dataset, prediction AS cls, 0 AS support, n AS predicted, 0 AS tp FROM counts)
        GROUP BY ALL HAVING sum(support) > 0),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE CAST(0.0 AS DOUBLE) END AS p,
              tp / support AS r FROM cls),
f AS (SELECT *, CASE WHEN p + r = 0 THEN CAST(0.0 AS DOUBLE) ELSE 2.0 * p * r / (p + r) END AS f1 FROM pr),
m AS (SELECT model, dataset, sum(tp) / sum(support) AS accuracy,
             sum(support * p) / sum(support) AS weighted_precision,
             sum(support * r) / sum(support) AS weighted_recall,
             sum(support * f1) / sum(support) AS f1 FROM f GROUP BY ALL),
ps AS (SELECT model, dataset, score AS s, sum(CASE WHEN labels > 0.5 THEN 1 ELSE 0 END) AS p,
              sum(CASE WHEN labels > 0.5 THEN 0 ELSE 1 END) AS n FROM ds GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY model, dataset ORDER BY s
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM ps),
auc AS (SELECT model, dataset,
               CASE WHEN sum(p) = 0 OR sum(n) = 0 THEN NULL
                    ELSE sum(p * (cn + n / 2.0)) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) END AS auc
        FROM cum GROUP BY ALL),
wide AS (SELECT m.model, m.dataset, accuracy, weighted_precision, weighted_recall, m.f1, auc
         FROM m LEFT JOIN auc ON m.model = auc.model AND m.dataset = auc.dataset),
long AS (SELECT model AS "Model", dataset AS "Dataset", 'Accuracy' AS "Metric", {R6('accuracy')} AS "Score" FROM wide
         UNION ALL SELECT model, dataset, 'Precision', {R6('weighted_precision')} FROM wide
         UNION ALL SELECT model, dataset, 'Recall', {R6('weighted_recall')} FROM wide
         UNION ALL SELECT model, dataset, 'F1', {R6('f1')} FROM wide
         UNION ALL SELECT model, dataset, 'AUC', {R6('auc')} FROM wide)
"""

SQL = {
    "auc_e01": _DS + f" SELECT model, dataset, {R6('auc')} AS auc FROM auc",
    "metrics_e02_e05": _DS + f""" SELECT model, dataset, {R6('accuracy')} AS accuracy,
        {R6('weighted_precision')} AS weighted_precision, {R6('weighted_recall')} AS weighted_recall,
        {R6('f1')} AS f1 FROM m""",
    "confusion_e06": _DS + """ SELECT model, dataset, CAST(labels AS VARCHAR) AS labels_prediction,
        CAST(sum(CASE WHEN doc_id % 9 > 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS predicted_0,
        CAST(sum(CASE WHEN doc_id % 9 > 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS predicted_1,
        CAST(sum(CASE WHEN doc_id % 9 <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS predicted_other
        FROM ds GROUP BY ALL""",
    "metrics_long_e07": _DS + ' SELECT "Model", "Dataset", "Metric", "Score" FROM long',
    "best_model_e08": _DS + """ SELECT "Dataset", "Metric", "Model" AS best_model, "Score" AS best_score FROM (
        SELECT *, row_number() OVER (PARTITION BY "Dataset", "Metric" ORDER BY "Score" DESC NULLS LAST, "Model" ASC) AS rn
        FROM long) WHERE rn = 1""",
    "report_e09": _DS + """ SELECT "Model", "Dataset", "Metric",
        "Metric" || ': ' || CASE WHEN "Score" IS NULL THEN 'nan' ELSE
          CAST(CAST(floor("Score" * 10000.0 + 0.5) AS BIGINT) // 10000 AS VARCHAR) || '.' ||
          lpad(CAST(CAST(floor("Score" * 10000.0 + 0.5) AS BIGINT) % 10000 AS VARCHAR), 4, '0') END AS line
        FROM long""",
}
