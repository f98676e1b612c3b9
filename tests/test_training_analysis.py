"""Training run (split -> fit -> evaluate -> pick -> save) and classify-and-explain."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import analysis, models
from colloquy.plans.queries import dialogues, labelled_clean
from colloquy.plans.training import run_training, word_report
from colloquy.sources import kafka
from colloquy.sources.tables import read_table

from conftest import SF001, SF01


def test_run_training_saves_best(spark, tmp_path):
    labelled = labelled_clean(spark, SF01).select("doc_id", "dialogue", "labels", "clean_text")
    path = str(tmp_path / "best")
    run = run_training(labelled, names=(models.DECISION_TREE, models.LOGISTIC_REGRESSION), model_path=path)
    assert run.metrics.count() == 2 * 2 * 5
    best = run.best.collect()
    assert len(best) == 1 and best[0]["best_model"] == run.best_name
    f1 = {r["Model"]: r["Score"] for r in run.metrics.filter("Dataset = 'Validation' AND Metric = 'F1'").collect()}
    assert f1[run.best_name] == max(f1.values())
    assert {r["dataset"] for r in run.split_counts.collect()} == {"Train", "Validation", "Test"}
    loaded = models.load_model(path)
    assert type(loaded.stages[-1]) is type(run.models[run.best_name].stages[-1])
    report = word_report(spark, run, labelled_clean(spark, SF01))
    assert set(report) == {models.DECISION_TREE, models.LOGISTIC_REGRESSION}
    assert report[models.DECISION_TREE].count() == 10


def test_classify_and_explain(spark):
    labelled = labelled_clean(spark, SF001).select("doc_id", "dialogue", "labels", "clean_text")
    model = models.fit_models(labelled, [models.LOGISTIC_REGRESSION])[models.LOGISTIC_REGRESSION]
    one = analysis.predict_text(spark, model, "Confirm your social security number now").collect()
    assert len(one) == 1 and one[0]["prediction"] in (0.0, 1.0)
    hist = read_table(spark, SF001, "documents").select("doc_id", F.col("text").alias("dialogue"))
    out = analysis.classify_and_explain(model, dialogues(spark, SF001), "conv_id", hist, "doc_id").collect()
    assert len(out) == dialogues(spark, SF001).count()
    for r in out:
        assert "**Dialogue**" in r["prompt"]
        assert r["history_prompt"] is None or "Historical Similar Cases:" in r["history_prompt"]
    assert any(r["history_prompt"] for r in out)
    plain = analysis.classify_and_explain(model, dialogues(spark, SF001), "conv_id").collect()
    assert all(r["history_prompt"] is None for r in plain)


def test_kafka_stream_needs_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_kafka_stream(spark, {})
