"""ML invariants (seeded): predictions, probabilities, reload, quality, importances."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from colloquy.operators import metrics, models, scoring, split, words
from colloquy.plans.modelling import labelled_split
from colloquy.sources.files import single_text

from conftest import SF01


@pytest.fixture(scope="module")
def data(spark):
    df = labelled_split(spark, SF01).cache()
    return df.filter(F.col("dataset") == split.TRAIN), df.filter(F.col("dataset") != split.TRAIN)


@pytest.fixture(scope="module")
def fitted(data):
    train, _ = data
    return models.fit_models(train, [models.DECISION_TREE, models.RANDOM_FOREST, models.LOGISTIC_REGRESSION,
                                     models.BOOSTED_TREES],
                             params={models.BOOSTED_TREES: {"maxIter": 5}})


def test_predictions_and_probabilities(fitted, data):
    _, held = data
    for name, model in fitted.items():
        out = model.transform(held.select("doc_id", "clean_text"))
        bad = out.filter(~F.col("prediction").isin(0.0, 1.0)).count()
        assert bad == 0, name
        s = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
        assert out.filter(F.abs(s - 1.0) > 1e-9).count() == 0, name


def test_forest_quality(fitted, data):
    _, held = data
    p = scoring.score(fitted[models.RANDOM_FOREST], held.select("doc_id", "dialogue", "labels"))
    auc = metrics.roc_auc(p, score_col="confidence").collect()[0]["auc"]
    assert auc > 0.75


def test_save_load_identical(fitted, data, tmp_path):
    _, held = data
    m = fitted[models.DECISION_TREE]
    path = str(tmp_path / "model")
    models.save_model(m, path)
    models.save_model(m, path)  # replaces
    back = models.load_model(path)
    a = scoring.score(m, held.select("doc_id", "dialogue"))
    b = scoring.score(back, held.select("doc_id", "dialogue"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_score_keeps_every_row(spark, fitted):
    m = fitted[models.LOGISTIC_REGRESSION]
    for text in (None, "123!", "", "Please confirm your social security number now"):
        r = scoring.score(m, single_text(spark, text)).collect()
        assert len(r) == 1 and r[0]["prediction"] in (0.0, 1.0) and 0.0 <= r[0]["confidence"] <= 1.0
    b = scoring.classified_batch(scoring.score(m, single_text(spark, "hello there"))).collect()[0]
    assert set(b.asDict()) == {"dialogue", "predicted_label", "confidence"}


def test_importances(spark, fitted):
    top = words.top_features(spark, fitted[models.RANDOM_FOREST], 10).collect()
    assert len(top) == 10
    imps = [r["importance"] for r in top]
    assert imps == sorted(imps, reverse=True)
    lr = words.top_features(spark, fitted[models.LOGISTIC_REGRESSION], 5).collect()
    assert len(lr) == 5 and all(r["importance"] >= 0 for r in lr)


def test_hashed_model_has_no_vocabulary(data):
    train, _ = data
    m = models.fit_models(train, [models.LOGISTIC_REGRESSION], kind="hash")[models.LOGISTIC_REGRESSION]
    assert m.stages[2].getNumFeatures() == 10000
    with pytest.raises(words.NoImportancesError):
        words.feature_terms(m)


def test_unknown_classifier():
    with pytest.raises(ValueError):
        models.classifier("XGBoostJar")


def test_raw_score_auc_variant(fitted, data):
    """SURVEY T6: for a single tree, rawPrediction holds leaf counts, so an
    AUC on it is not the AUC of the probability score."""
    _, held = data
    p = scoring.score(fitted[models.DECISION_TREE], held.select("doc_id", "dialogue", "labels"), keep_raw=True)
    a_prob = metrics.roc_auc(p, score_col="confidence").collect()[0]["auc"]
    a_raw = metrics.roc_auc(p, score_col="raw_score").collect()[0]["auc"]
    assert a_prob is not None and a_raw is not None and a_prob != a_raw
    lr = scoring.score(fitted[models.LOGISTIC_REGRESSION], held.select("doc_id", "dialogue", "labels"), keep_raw=True)
    # for logistic regression the raw margin is monotone in the probability: same AUC
    assert metrics.roc_auc(lr, score_col="confidence").collect()[0]["auc"] == \
        metrics.roc_auc(lr, score_col="raw_score").collect()[0]["auc"]


def test_score_replaces_stale_pipeline_columns(spark, fitted, data):
    from colloquy.operators import features
    _, held = data
    pre = features.text_features(held.select("doc_id", "dialogue")).withColumn("prediction", F.lit(7.0))
    out = scoring.score(fitted[models.DECISION_TREE], pre)
    assert out.filter(~F.col("prediction").isin(0.0, 1.0)).count() == 0
    assert "raw_features" not in out.columns and "words" not in out.columns
    plain = scoring.score(fitted[models.DECISION_TREE], held.select("doc_id", "dialogue"))
    assert out.select("doc_id", "prediction").exceptAll(plain.select("doc_id", "prediction")).count() == 0


def test_tree_models_of_one_training_set_share_the_value_ranges(spark, monkeypatch):
    from colloquy.operators import boosting, forest
    rows = spark.createDataFrame([(i, float(i % 2), f"gift card {'now' * (i % 3)} w{i % 5} w{i % 5}") for i in range(40)],
                                 "id long, labels double, clean_text string")
    calls, plain = [], boosting.bin_edges
    for module in (boosting, forest, models):
        monkeypatch.setattr(module, "bin_edges", lambda *a: (calls.append(1), plain(*a))[1])
    names, few = (models.DECISION_TREE, models.RANDOM_FOREST, models.BOOSTED_TREES), {models.RANDOM_FOREST: {"numTrees": 3}, models.BOOSTED_TREES: {"maxIter": 2}}
    shared = models.fit_models(rows, names, params=few, key="id", partitions=2)
    assert len(calls) == 1
    prep = models.prepare_training(rows, key="id", partitions=2)
    for name in names:                                       # and each finds the same by itself
        alone = models.classifier(name, **few.get(name, {})).fit(prep.vectors)
        assert alone.getOrDefault("trees") == shared[name].stages[-1].getOrDefault("trees")
    assert len(calls) == 4
    prep.release()
