"""Evaluation operators against MLlib's evaluators and invariants."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from colloquy.operators import metrics
from colloquy.plans.evaluation import rule_eval_frame

from conftest import SF01


@pytest.fixture(scope="module")
def preds(spark):
    return rule_eval_frame(spark, SF01).cache()


def _mllib_auc(df):
    ev = BinaryClassificationEvaluator(labelCol="labels", rawPredictionCol="score", numBins=0)
    return ev.evaluate(df)


def test_auc_equals_mllib(spark, preds):
    ours = {(r["model"], r["dataset"]): r["auc"]
            for r in metrics.roc_auc(preds, ["model", "dataset"]).collect()}
    for (m, d), auc in ours.items():
        sub = preds.filter((F.col("model") == m) & (F.col("dataset") == d))
        assert auc == pytest.approx(_mllib_auc(sub), abs=1e-12), (m, d)


def test_auc_ungrouped_and_bucket_invariant(spark, preds):
    sub = preds.filter(F.col("model") == "LengthRule")
    a1 = metrics.roc_auc(sub, buckets=1).collect()[0]["auc"]
    a2 = metrics.roc_auc(sub, buckets=7).collect()[0]["auc"]
    a3 = metrics.roc_auc(sub, buckets=512).collect()[0]["auc"]
    assert a1 == a2 == a3
    assert a1 == pytest.approx(_mllib_auc(sub), abs=1e-12)


def test_auc_degenerate(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.5)], "labels double, score double")
    assert metrics.roc_auc(df).collect()[0]["auc"] is None


def test_classification_metrics_equal_mllib(spark, preds):
    rows = metrics.classification_metrics(preds, ["model", "dataset"]).collect()
    for r in rows:
        sub = preds.filter((F.col("model") == r["model"]) & (F.col("dataset") == r["dataset"]))
        ev = MulticlassClassificationEvaluator(labelCol="labels", predictionCol="prediction")
        assert r["accuracy"] == pytest.approx(ev.setMetricName("accuracy").evaluate(sub), abs=1e-12)
        assert r["weighted_precision"] == pytest.approx(ev.setMetricName("weightedPrecision").evaluate(sub), abs=1e-12)
        assert r["weighted_recall"] == pytest.approx(ev.setMetricName("weightedRecall").evaluate(sub), abs=1e-12)
        assert r["f1"] == pytest.approx(ev.setMetricName("f1").evaluate(sub), abs=1e-12)
        assert r["weighted_recall"] == pytest.approx(r["accuracy"], abs=1e-12)


def test_confusion_matrix_matches_crosstab(spark, preds):
    sub = preds.filter((F.col("model") == "QualityRule") & (F.col("dataset") == "Test"))
    ours = {r["labels_prediction"]: (r["predicted_0"], r["predicted_1"])
            for r in metrics.confusion_matrix(sub).collect()}
    ct = sub.crosstab("labels", "prediction").collect()
    for r in ct:
        d = r.asDict()
        assert ours[d["labels_prediction"]] == (d.get("0.0", 0), d.get("1.0", 0))


def test_confusion_absent_class_gets_zero_column(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "labels double, prediction double")
    rows = {r["labels_prediction"]: r for r in metrics.confusion_matrix(df).collect()}
    assert rows["1.0"]["predicted_1"] == 0 and rows["1.0"]["predicted_0"] == 1


def test_metrics_table_best_and_report(spark, preds):
    table = metrics.metrics_table(preds)
    assert table.count() == 2 * 2 * 5
    best = metrics.pick_best(table).collect()
    assert len(best) == 1 and best[0]["Dataset"] == "Validation" and best[0]["Metric"] == "F1"
    lines = metrics.report_lines(table).collect()
    assert all(ln["line"].startswith(ln["Metric"] + ": ") for ln in lines)
    assert all(len(ln["line"].split(": ")[1].split(".")[1]) == 4 for ln in lines)


def test_weighted_forms_equal_row_forms(spark, preds):
    g = ["model", "dataset"]
    counts = metrics.prediction_counts(preds, g)
    a = metrics.classification_metrics(preds, g)
    b = metrics.classification_metrics(counts, g, weight_col="_count")
    assert a.exceptAll(b).count() == 0
    assert metrics.roc_auc(preds, g).exceptAll(metrics.roc_auc(counts, g, weight_col="_count")).count() == 0
    c1 = metrics.confusion_matrix(preds, g)
    c2 = metrics.confusion_matrix(counts, g, weight_col="_count")
    assert c1.exceptAll(c2).count() == 0 and c2.exceptAll(c1).count() == 0
