"""T06 inside the stream: the n latest results and the running total of each feed.

The state is a small table per batch, made from the one before it and the
batch's own results.  A replayed batch finds the same predecessor and replaces
its own table, so the feed is exactly-once like the result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FEED_COLUMNS = ("key", "text", "prediction", "confidence")


def advance_feed(previous: DataFrame | None, scored: DataFrame, n: int = 5, feed=None, order_cols=("offset", "partition")) -> DataFrame:
    """``(feed, order_cols, key, text, prediction, confidence, processed)``: the
    n latest rows of every feed and the messages it has seen so far.

    ``feed``: a column (null: a feed of its own), by default one feed of all
    messages.  Each task passes on n rows and one count a feed, so a feed that
    holds most rows is no hot group.  Equal places are put in order by key and
    text; ``previous`` is what the last call returned (None: the beginning)."""
    named = scored.withColumn("feed", F.lit("all") if feed is None else feed.cast("string"))
    rows = named.select("feed", *order_cols, *FEED_COLUMNS)
    totals = named.groupBy("feed").agg(F.count(F.lit(1)).alias("processed"))
    if previous is not None:
        rows = rows.unionByName(previous.select(*rows.columns))
        totals = (totals.unionByName(previous.groupBy("feed").agg(F.max("processed").alias("processed")))
                  .groupBy("feed").agg(F.sum("processed").alias("processed")))
    order = [F.desc(c) for c in order_cols] + [F.asc("key"), F.asc("text")]
    latest = (rows.withColumn("_place", F.row_number().over(Window.partitionBy("feed").orderBy(*order)))
              .filter(F.col("_place") <= n).drop("_place"))
    totals = totals.withColumnRenamed("feed", "_feed")
    return latest.join(totals, F.col("feed").eqNullSafe(F.col("_feed"))).drop("_feed")


def write_feed(scored: DataFrame, batch_id: int, path: str, n: int = 5, feed=None) -> None:
    """One batch's step: reads the table of the batch before it, writes its own."""
    spark = scored.sparkSession
    previous = spark.read.parquet(f"{path}/batch_id={batch_id - 1}") if batch_id else None
    advance_feed(previous, scored, n, feed).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The feed after the latest batch, as display rows (``latest_feed``'s) with
    feed and running total."""
    from colloquy.functions.formats import SCAM_LABELS, UNKNOWN_LABEL, label_text, percent_text, preview
    steps = spark.read.parquet(path)
    newest = steps.agg(F.max("batch_id")).scalar()
    return steps.filter(F.col("batch_id") == newest).select(
        "feed", "offset", "key", label_text("prediction", SCAM_LABELS, default=UNKNOWN_LABEL).alias("label"),
        percent_text("confidence", 1, missing="N/A", zero_is_missing=True).alias("confidence_text"),
        preview("text").alias("preview"), "processed")
