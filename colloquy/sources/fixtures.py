"""Adapters that derive reference-shaped inputs from the driver tables.

Everything here is a projection of the given tables, so its size grows with
them: dirty label strings, rule-made predictions/scores, stream messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dirty_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, labels string)`` with padded, decimal, junk, empty and null
    label strings mixed in by ``doc_id % 7``."""
    t = F.col("toxic").cast("string")
    k = F.pmod(F.col("doc_id"), F.lit(7))
    lab = (F.when(k == 0, F.concat(F.lit(" "), t, F.lit(" ")))
            .when(k == 1, F.concat(t, F.lit(".0")))
            .when(k == 2, F.lit("x"))
            .when(k == 3, F.lit(""))
            .when(k == 4, F.lit(None).cast("string"))
            .otherwise(t))
    return labels.select("doc_id", lab.alias("labels"))


def rule_predictions(labelled: DataFrame) -> DataFrame:
    """Two rule-made "models" over labelled documents, for exact metric checks:
    ``QualityRule`` predicts ``quality`` and scores ``quality + n_chars/1e6``;
    ``LengthRule`` predicts 1 for texts under 1,000 characters and scores
    ``-n_chars``.  Columns: model, doc_id, labels, prediction, score."""
    q = labelled.select(F.lit("QualityRule").alias("model"), "doc_id", "labels",
                        F.col("quality").cast("double").alias("prediction"),
                        (F.col("quality") + F.col("n_chars") / F.lit(1e6)).cast("double").alias("score"))
    n = labelled.select(F.lit("LengthRule").alias("model"), "doc_id", "labels",
                        F.when(F.col("n_chars") < 1000, 1.0).otherwise(0.0).alias("prediction"),
                        (-F.col("n_chars")).cast("double").alias("score"))
    return q.unionByName(n)


def rule_confidence(df: DataFrame) -> DataFrame:
    """A [0, 1] confidence per document with nulls and zeros mixed in."""
    k = F.pmod(F.col("doc_id"), F.lit(11))
    c = (F.when(k == 0, F.lit(None).cast("double"))
          .when(k == 1, F.lit(0.0))
          .otherwise(F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))))
    return df.withColumn("confidence", c)


def stream_messages(turns: DataFrame) -> DataFrame:
    """Kafka-shaped messages built from conversation turns:
    ``key`` (conv_id text), ``value`` (JSON ``{"text": ...}``), ``partition``,
    ``offset``.  Every 25th turn is broken JSON and every 31st has no
    ``text`` field; fewer have trailing garbage, a second object (some with
    text that looks like a parser's own end mark), a text that is not a string,
    or an empty value, so the reject path is exercised; some good ones have
    further fields with braces in them."""
    c = F.pmod(F.col("conv_id") * F.lit(5) + F.col("turn"), F.lit(41))
    k = F.pmod(F.col("conv_id") * F.lit(7) + F.col("turn"), F.lit(25))
    j = F.pmod(F.col("conv_id") * F.lit(3) + F.col("turn"), F.lit(31))
    value = (F.when(k == 0, F.concat(F.lit('{"text": '), F.to_json(F.struct("text"))))
              .when(j == 0, F.lit("{}"))
              .when(c == 0, F.concat(F.to_json(F.struct("text")), F.lit(" garbage")))
              .when(c == 1, F.concat(F.to_json(F.struct("text")), F.lit('{"text":"b"}')))
              .when(c == 2, F.lit('{"text":5}'))
              .when(c == 3, F.lit('{"text":{"a":1}}'))
              .when(c == 4, F.lit(""))
              .when(c == 5, F.concat(F.to_json(F.struct("text")), F.lit(',"x":{"y":1}')))
              .when(c == 6, F.concat(F.to_json(F.struct("text")), F.lit(',"end":true} garbage')))
              .when(c == 7, F.concat(F.to_json(F.struct("text")), F.lit(',"end":true}{"text":"b"}')))
              .when(c == 8, F.concat(F.to_json(F.struct("text")), F.lit("}")))
              .when(c == 9, F.concat(F.lit('{"a":"}{","b":[{"text":"c"}],'), F.substr(F.to_json(F.struct("text")), F.lit(2))))
              .otherwise(F.to_json(F.struct("text"))))
    return turns.select(
        F.col("conv_id").cast("string").alias("key"),
        value.alias("value"),
        F.pmod(F.col("conv_id"), F.lit(3)).cast("int").alias("partition"),
        (F.col("conv_id") * F.lit(1000) + F.col("turn")).cast("bigint").alias("offset"),
    )


class RuleModel:
    """A stand-in classifier with the fitted-pipeline contract
    (``transform`` adds ``probability`` and ``prediction``), for exact checks
    of the scoring paths: P(class 1) = n / (n + 100) with n the cleaned text
    length; class 1 when that is at least 0.5."""

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        n = F.length("clean_text")
        p = n / (n + F.lit(100.0))
        return (df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
                  .withColumn("prediction", F.when(p >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))))
