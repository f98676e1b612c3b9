"""Files, saved models, restarts and the random split, through real folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import models, scoring, split
from colloquy.operators.analysis import predict_text
from colloquy.plans.modelling import trained
from colloquy.plans.oracle import CLEAN, D01, LAB, R6
from colloquy.plans.queries import dialogues, labelled_clean, r6
from colloquy.plans.streams import _MSGS, messages, read_input, write_input
from colloquy.session import scratch_path
from colloquy.sources import files, fixtures
from colloquy.sources.tables import read_table
from colloquy.streaming import ScoringStream

_CSV = {"header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"}


def reload_k04(spark, sf):
    """K03 + K04: the regression saved, loaded and applied to every
    conversation; both models must say the same."""
    model = trained(spark, sf, models.LOGISTIC_REGRESSION)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    rows = dialogues(spark, sf).select("conv_id", "dialogue")
    first = scoring.score(model, rows).select("conv_id", "prediction", "confidence")
    again = scoring.score(models.load_model(path), rows).select(
        "conv_id", F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    return first.join(again, "conv_id").select(
        "conv_id", (F.col("prediction") == F.col("p")).alias("same_prediction"),
        (F.abs(F.col("confidence") - F.col("c")) < 1e-12).alias("same_confidence"))


def restart_t04(spark, sf):
    """Half of the messages streamed, the query restarted on the same
    checkpoint with the other half, and once more without news: every accepted
    message is in the results once."""
    base = scratch_path(spark, "restart")
    msgs = messages(spark, sf)

    def run():
        source = read_input(spark, msgs.schema, base + "/in")
        ScoringStream(fixtures.RuleModel(), source, base + "/results", base + "/rejects",
                      base + "/checkpoint").start(available_now=True).await_done()

    half = F.pmod(F.xxhash64("key", "offset"), F.lit(2))
    for part in (0, 1):
        write_input(msgs.filter(half == part), base + "/in", append=True)
        run()
    run()
    return spark.read.parquet(base + "/results").groupBy("key", "offset").agg(F.count(F.lit(1)).alias("copies"))


def history_csv_s02(spark, sf):
    """The documents written as a history CSV and read back with inferred types."""
    path = scratch_path(spark, "history-csv")
    read_table(spark, sf, "documents").select("doc_id", F.col("text").alias("dialogue")).write.options(**_CSV).csv(path)
    return files.read_history(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "dialogue")


def upload_s03(spark, sf):
    """The conversations as an uploaded CSV: accepted by its columns,
    records counted, the first rows among the records."""
    path = scratch_path(spark, "upload-csv")
    dialogues(spark, sf).select("dialogue", "conv_id").write.options(**_CSV).csv(path)
    upload = files.require_columns(files.read_history(spark, path, infer=False))
    n, head = files.upload_summary(upload)
    return head.agg(F.lit(n).cast("bigint").alias("records"), F.count("dialogue").alias("shown"))


def single_text_s06(spark, sf):
    """S06 + B01: the first conversation as one text, scored by the rule stand-in model."""
    text = dialogues(spark, sf).orderBy("conv_id").select("dialogue").first()
    out = predict_text(spark, fixtures.RuleModel(), text[0] if text else None)
    return out.select("dialogue", "prediction", r6("confidence").alias("confidence"))


def random_split_x01(spark, sf):
    """X01, the reference's two-stage random split: every labelled document is
    in one part."""
    rows = labelled_clean(spark, sf).select("doc_id").repartition(4, "doc_id").sortWithinPartitions("doc_id")
    train, val, test = split.random_split(rows)
    return train.unionByName(val).unionByName(test).groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"))


EXACT = {
    "reload_k04": reload_k04,
    "restart_t04": restart_t04,
    "history_csv_s02": history_csv_s02,
    "upload_s03": upload_s03,
    "single_text_s06": single_text_s06,
    "random_split_x01": random_split_x01,
}

SQL = {
    "reload_k04": "WITH " + D01 + "SELECT conv_id, true AS same_prediction, true AS same_confidence FROM d01",
    "restart_t04": _MSGS + ' SELECT key, "offset", CAST(1 AS BIGINT) AS copies FROM ok',
    "history_csv_s02": "SELECT doc_id, text AS dialogue FROM documents",
    "upload_s03": "WITH " + D01 + "SELECT CAST(count(*) AS BIGINT) AS records, CAST(least(5, count(*)) AS BIGINT) AS shown FROM d01",
    "single_text_s06": "WITH " + D01 + f""",
f AS (SELECT dialogue FROM d01 ORDER BY conv_id LIMIT 1),
p AS (SELECT dialogue, length({CLEAN.format(t='dialogue')}) AS n FROM f)
SELECT dialogue, CASE WHEN n / (n + CAST(100.0 AS DOUBLE)) >= 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
       {R6('n / (n + CAST(100.0 AS DOUBLE))')} AS confidence FROM p""",
    "random_split_x01": "WITH " + LAB + "SELECT doc_id, CAST(1 AS BIGINT) AS parts FROM lab_nonempty",
}
