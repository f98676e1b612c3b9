"""Stream = batch, restart adds nothing, rejects are kept apart."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import models, scoring
from colloquy.plans.modelling import labelled_split
from colloquy.plans.streams import messages
from colloquy.streaming import ScoringStream, decode_messages, encode_results, rejects
from colloquy.streaming.runner import score_messages

from conftest import SF01


@pytest.fixture(scope="module")
def model(spark):
    train = labelled_split(spark, SF01).filter(F.col("dataset") == "Train")
    return models.fit_models(train, [models.LOGISTIC_REGRESSION])[models.LOGISTIC_REGRESSION]


def test_decode_edge_messages(spark):
    df = spark.createDataFrame([("k", v) for v in ['{"text": "hi"}', "{oops", "{}", None, '{"text": null}', "[1]"]],
                               "key string, value string")
    got = [(r["text"], r["reject_reason"]) for r in decode_messages(df).collect()]
    assert got == [("hi", None), (None, "bad_json"), (None, "no_text"), (None, "bad_json"),
                   (None, "no_text"), (None, "bad_json")]


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([("k", 1.0, 0.9, "t")], "key string, prediction double, confidence double, text string")
    v = encode_results(df).collect()[0]["value"]
    assert '"analysis":null' in v and '"historical_insight":null' in v and '"original_text":"t"' in v


def test_stream_equals_batch_and_restart(spark, model, tmp_path):
    msgs = messages(spark, SF01)
    src_dir = str(tmp_path / "in")
    msgs.repartition(3, "partition").write.parquet(src_dir)
    schema = msgs.schema
    base = str(tmp_path)

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
        s = ScoringStream(model, src, base + "/out", base + "/rej", base + "/ckpt", encoded_path=base + "/enc")
        s.start(available_now=True)
        s.await_done()
        assert not s.running
        return s

    s = run()
    assert s.processed() + s.rejected() == msgs.count() and s.rejected() > 0
    out = spark.read.parquet(base + "/out").drop("batch_id")
    batch = score_messages(model, msgs)
    cols = ["key", "offset", "prediction", "confidence"]
    assert out.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(out.select(cols)).count() == 0
    rej = spark.read.parquet(base + "/rej")
    assert rej.count() == rejects(decode_messages(msgs)).count() > 0
    assert spark.read.parquet(base + "/enc").count() == out.count()
    n_batches = spark.read.parquet(base + "/out").select("batch_id").distinct().count()
    run()  # restart from the checkpoint: nothing new
    assert spark.read.parquet(base + "/out").count() == out.count()
    assert spark.read.parquet(base + "/out").select("batch_id").distinct().count() == n_batches


def test_score_is_source_agnostic(spark, model):
    msgs = messages(spark, SF01)
    a = score_messages(model, msgs).select("key", "offset", "prediction")
    ok = decode_messages(msgs).filter(F.col("reject_reason").isNull())
    b = scoring.score(model, ok, text_col="text").select("key", "offset", "prediction")
    assert a.exceptAll(b).count() == 0


def test_running_status_counts(spark, tmp_path):
    from colloquy.streaming import start_status_counts, status_counts
    msgs = messages(spark, SF01)
    src_dir = str(tmp_path / "in")
    msgs.repartition(4, "partition").write.parquet(src_dir)
    src = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
    q = start_status_counts(src, str(tmp_path / "counts"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = {r["status"]: r["messages"] for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    want = {r["status"]: r["messages"] for r in status_counts(msgs).collect()}
    assert got == want and set(got) == {"processed", "bad_json", "no_text"}
    assert sum(got.values()) == msgs.count()


def test_stream_explanation_requests(spark, model, tmp_path):
    from colloquy.sources.tables import read_table
    msgs = messages(spark, SF01)
    src_dir = str(tmp_path / "in")
    msgs.repartition(2, "partition").write.parquet(src_dir)
    src = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
    hist = read_table(spark, SF01, "documents").select("doc_id", F.col("text").alias("dialogue"))
    base = str(tmp_path)
    s = ScoringStream(model, src, base + "/out", base + "/rej", base + "/ckpt", requests_path=base + "/req",
                      history=hist, hist_key="doc_id")
    s.start(available_now=True)
    s.await_done()
    req = spark.read.parquet(base + "/req")
    assert req.count() == s.processed()
    assert req.filter(~F.col("prompt").contains("**Dialogue**")).count() == 0
    assert req.filter(F.col("history_prompt").contains("Historical Similar Cases:")).count() > 0


def test_continuous_start_and_stop(spark, model, tmp_path):
    """A processing-time stream keeps running until stopped."""
    import time
    msgs = messages(spark, SF01)
    src_dir = str(tmp_path / "in")
    msgs.repartition(2, "partition").write.parquet(src_dir)
    src = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
    base = str(tmp_path)
    s = ScoringStream(model, src, base + "/out", base + "/rej", base + "/ckpt")
    s.start(processing_time="1 second")
    try:
        s.query.processAllAvailable()
        assert s.running
        assert s.processed() + s.rejected() == msgs.count()
    finally:
        s.stop()
    deadline = time.time() + 30
    while s.running and time.time() < deadline:
        time.sleep(0.2)
    assert not s.running
