"""Parquet inputs and the turns -> dialogue adapter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables whose rows carry long texts: per-row work (regex, tokenising) dominates.
TEXT_TABLES = ("documents", "conversations", "pages")
REBALANCE_CONF = "colloquy.read.rebalance"
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``, as scanned.

    A text table in a few unsplittable files gives few scan tasks; set
    ``colloquy.read.rebalance`` to a partition count to deal its rows
    round-robin over so many partitions right after the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = int(spark.conf.get(REBALANCE_CONF, "0"))
    return df.repartition(parts) if parts > 0 and name in TEXT_TABLES else df


def labelled_documents(spark: SparkSession, sf_dir: str, with_extra: bool = False) -> DataFrame:
    """``documents`` joined to ``labels``: one labelled dialogue per document.

    Columns: doc_id, dialogue, labels (double; 1.0 = toxic) and, with
    ``with_extra``, quality / n_chars (used as rule-made predictions/scores).
    Only the needed columns are read (pruned at the scan); the join is an
    equi-join on doc_id that AQE turns into a broadcast only when the label
    side is small at run time."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("dialogue"), "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    out = docs.join(labels, "doc_id").withColumn("labels", F.col("toxic").cast("double"))
    cols = ["doc_id", "dialogue", "labels"]
    if with_extra:
        cols += ["quality", "n_chars"]
    return out.select(*cols)


def assemble_dialogues(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                       role: str = "role", text: str = "text", sep: str = " ",
                       chunk_turns: int = 512) -> DataFrame:
    """Turns -> one dialogue string per conversation: ``"Role: text"`` pieces
    joined by ``sep`` in turn order (role capitalised: first letter upper,
    rest lower).

    Two-level: turns are first concatenated inside chunks of ``chunk_turns``
    consecutive turns, then the chunks per conversation.  A conversation that
    holds a large share of all turns is therefore spread over many tasks in
    the first stage; only its (short) chunk list meets in one task."""
    piece = F.concat(
        F.upper(F.substring(F.col(role), 1, 1)), F.lower(F.expr(f"substring({role}, 2)")),
        F.lit(": "), F.col(text),
    )
    chunk = F.floor(F.col(order) / F.lit(chunk_turns)).cast("bigint")
    first = (
        turns.select(key, F.col(order).alias("_o"), piece.alias("_p"), chunk.alias("_c"))
        .groupBy(key, "_c")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_o", "_p"))), lambda s: s["_p"]), sep
            ).alias("_p"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    return (
        first.groupBy(key)
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_c", "_p"))), lambda s: s["_p"]), sep
            ).alias("dialogue"),
            F.sum("_n").cast("bigint").alias("n_turns"),
        )
    )
