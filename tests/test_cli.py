"""The command line: train -> score -> stream -> explain on files derived from the tables."""

from pyspark.sql import functions as F

from colloquy.__main__ import main
from colloquy.plans.queries import dialogues
from colloquy.plans.streams import messages
from colloquy.sources import fixtures
from colloquy.sources.tables import read_table

from conftest import SF001


def test_cli_end_to_end(spark, tmp_path, capsys):
    docs = read_table(spark, SF001, "documents")
    labs = fixtures.dirty_labels(read_table(spark, SF001, "labels"))
    labelled = docs.join(labs, "doc_id").select(F.col("text").alias("dialogue"), F.col("lang").alias("personality"),
                                                F.col("source").alias("type"), "labels")
    csv = str(tmp_path / "labelled")
    labelled.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(csv)
    model = str(tmp_path / "model")
    tables = str(tmp_path / "tables")
    assert main(["train", "--labelled", csv, "--model", model, "--models", "DT,LR", "--tables", tables]) == 0
    out = capsys.readouterr().out
    metrics_csv = spark.read.option("header", True).csv(tables + "/metrics")
    assert metrics_csv.count() == 2 * 2 * 5 and set(metrics_csv.columns) == {"Model", "Dataset", "Metric", "Score"}
    assert spark.read.option("header", True).csv(tables + "/word_stats_DecisionTree").count() == 10
    assert "best model:" in out and "Validation F1:" in out and "Train:" in out

    uploads = str(tmp_path / "uploads")
    dialogues(spark, SF001).select("conv_id", "dialogue").write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(uploads)
    preds = str(tmp_path / "preds")
    assert main(["score", "--model", model, "--csv", uploads, "--out", preds]) == 0
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(preds)
    assert back.columns == ["dialogue", "predicted_label", "confidence"]
    assert back.count() == dialogues(spark, SF001).count()

    src = str(tmp_path / "msgs")
    messages(spark, SF001).write.parquet(src)
    sout = str(tmp_path / "stream")
    assert main(["stream", "--model", model, "--source-dir", src, "--out", sout, "--requests"]) == 0
    assert spark.read.parquet(sout + "/requests").count() == spark.read.parquet(sout + "/results").count()
    assert spark.read.parquet(sout + "/results").count() + spark.read.parquet(sout + "/rejects").count() \
        == messages(spark, SF001).count()

    hist = str(tmp_path / "history")
    docs.select(F.col("text").alias("dialogue")).write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(hist)
    capsys.readouterr()
    assert main(["explain", "--model", model, "--text", "Please confirm your account number and pay now",
                 "--history", hist]) == 0
    out = capsys.readouterr().out
    assert "prediction:" in out and "**Dialogue**" in out


def test_cli_history_index(spark, tmp_path, capsys):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    from colloquy.operators import models
    from colloquy.operators.features import hashing_stages
    docs = read_table(spark, SF001, "documents")
    hist, index, model = (str(tmp_path / n) for n in ("history", "index", "model"))
    (docs.filter("doc_id < 40").select(F.col("text").alias("dialogue")).write.option("header", True)
     .option("quoteAll", True).option("escape", '"').csv(hist))
    train = spark.createDataFrame([("pay now", 1.0), ("see you", 0.0)], "clean_text string, labels double")
    stages = [*hashing_stages(), LogisticRegression(featuresCol="raw_features", labelCol="labels")]
    models.save_model(Pipeline(stages=stages).fit(train), model)
    for _ in range(2):
        assert main(["index", "--history", hist, "--index", index]) == 0
    assert "80 cases in 2 batches" in capsys.readouterr().out
    text = docs.filter("doc_id = 3").first()["text"]
    assert main(["explain", "--model", model, "--text", text, "--index", index, "--k", "2"]) == 0
    # the text is in the index twice, under ids of their own
    assert capsys.readouterr().out.count("(similarity 1.000000)") == 2
