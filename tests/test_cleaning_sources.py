"""Labels, CSV sources/sinks, upload contract, single text, Kafka options."""

import os

import pytest
from pyspark.sql import functions as F

from colloquy.operators import cleaning, split
from colloquy.sources import files, kafka, tables

from conftest import SF01


def test_label_filter(spark):
    df = spark.createDataFrame([(v,) for v in ["0", "1", " 1 ", "1.0", "x", "", None]], "labels string")
    out = [r["labels"] for r in cleaning.filter_labels(df).collect()]
    assert sorted(out) == [0.0, 1.0, 1.0]


def test_labelled_csv_multiline(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text('dialogue,personality,type,labels\n'
                 '"Innocent: hi ""there""\nSuspect: pay now",a,b,1\n'
                 'plain,,,0\n'
                 ',,,\n')
    df = files.read_labelled(spark, str(p))
    rows = df.collect()
    assert len(rows) == 3
    assert rows[0]["dialogue"] == 'Innocent: hi "there"\nSuspect: pay now'
    assert rows[2]["dialogue"] is None and rows[2]["labels"] is None
    cleaned = cleaning.load_and_clean(df).collect()
    assert [r["labels"] for r in cleaned] == [1.0, 0.0]


def test_history_csv_and_contract(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("id,dialogue\n1,hello\n2,bye\n")
    df = files.read_history(spark, str(p))
    assert dict(df.dtypes)["id"] == "int"
    files.require_columns(df)
    n, head = files.upload_summary(df)
    assert n == 2 and head.count() == 2
    with pytest.raises(files.MissingColumnError, match="dialogue"):
        files.require_columns(df.drop("dialogue"))


def test_single_text_none(spark):
    assert files.single_text(spark, None).collect()[0]["dialogue"] is None
    assert files.single_text(spark, "hi").schema.simpleString() == "struct<dialogue:string>"


def test_predictions_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([('a, "b"\nc', "Potentially Scam", "12.34%"), ("x", "Non-Scam (Safe)", None)],
                               "dialogue string, predicted_label string, confidence string")
    out = str(tmp_path / "pred")
    files.write_predictions_csv(df, out)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_kafka_options():
    o = kafka.kafka_reader_options({})
    assert o["subscribe"] == "customer-dialogues-raw" and o["startingOffsets"] == "earliest"
    assert "kafka.security.protocol" not in o
    env = {"KAFKA_SECURITY_PROTOCOL": "SASL_SSL", "KAFKA_USERNAME": "u", "KAFKA_PASSWORD": "p",
           "KAFKA_OUTPUT_TOPIC": "out", "KAFKA_BOOTSTRAP_SERVERS": "b:1"}
    o = kafka.kafka_reader_options(env, max_offsets_per_trigger=100)
    assert o["kafka.sasl.mechanism"] == "PLAIN" and 'username="u"' in o["kafka.sasl.jaas.config"]
    assert o["maxOffsetsPerTrigger"] == "100"
    w = kafka.kafka_writer_options(env)
    assert w["topic"] == "out" and w["kafka.bootstrap.servers"] == "b:1"
    with pytest.raises(ValueError):
        kafka.kafka_writer_options({})


def test_hash_split_stable_across_partitioning(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    a = split.hash_split(df.repartition(1), "doc_id")
    b = split.hash_split(df.repartition(7), "doc_id")
    assert a.exceptAll(b).count() == 0
    counts = {r["split"]: r["n"] for r in split.split_counts(a).collect()}
    assert set(counts) == {"Train", "Validation", "Test"}
    assert 0.6 < counts["Train"] / 1000 < 0.8


def test_assemble_dialogues_chunks(spark):
    turns = spark.read.parquet(f"{SF01}/conversations.parquet")
    a = tables.assemble_dialogues(turns, chunk_turns=512)
    b = tables.assemble_dialogues(turns, chunk_turns=2)
    assert a.exceptAll(b).count() == 0
    r = a.orderBy("conv_id").first()
    assert r["dialogue"].startswith("User: ") and r["n_turns"] >= 2


def test_rebalance_is_an_explicit_setting(spark):
    assert tables.read_table(spark, SF01, "documents").rdd.getNumPartitions() == 1      # one file, one task
    spark.conf.set(tables.REBALANCE_CONF, "6")
    try:
        df = tables.read_table(spark, SF01, "documents")
        assert df.rdd.getNumPartitions() == 6 and df.count() == 1000
        assert tables.read_table(spark, SF01, "labels").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset(tables.REBALANCE_CONF)
