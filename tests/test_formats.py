from pyspark.sql import functions as F

from colloquy.functions.formats import SCAM_LABELS, label_text, percent_text, preview, round_ratio


def test_percent_and_labels(spark):
    df = spark.createDataFrame([(0.123456, 1.0), (None, 0.0), (0.0, 2.0), (0.125, 1.0)],
                               "c double, p double")
    rows = df.select(
        percent_text("c", 2, zero_is_missing=True).alias("batch"),
        percent_text("c", 1, missing="N/A", zero_is_missing=True).alias("feed"),
        percent_text("c", 0).alias("single"),
        label_text("p", SCAM_LABELS).alias("lab"),
        label_text("p", SCAM_LABELS, default="Unknown").alias("feed_lab"),
    ).collect()
    assert [r["batch"] for r in rows] == ["12.35%", None, None, "12.50%"]
    assert [r["feed"] for r in rows] == ["12.3%", "N/A", "N/A", "12.5%"]
    assert [r["single"] for r in rows] == ["12%", None, "0%", "13%"]
    assert [r["lab"] for r in rows] == ["Potentially Scam", "Non-Scam (Safe)", "2.0", "Potentially Scam"]
    assert rows[2]["feed_lab"] == "Unknown"


def test_round_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (2, 3), (1, 2000)], "a long, b long")
    got = [r[0] for r in df.select(round_ratio("a", "b", 3)).collect()]
    assert got == [0.125, 0.0, 0.667, 0.001]


def test_preview(spark):
    df = spark.createDataFrame([("x" * 150,), ("short",)], "t string")
    got = [r[0] for r in df.select(preview("t")).collect()]
    assert got == ["x" * 100 + "...", "short..."]
