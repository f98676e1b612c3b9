"""Fitted trees as a table, and an independent walk of it in Spark SQL.

The walk knows nothing of the classifiers' own code: it reads nodes (from the
saved model, or the model's table) and the non-zero features of each row, and
steps from node to node by joins.  It checks predictions (M01-M03, P05) and
explains single ones (which splits a dialogue took)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.boosting import BoostedTreesModel
from colloquy.session import scratch_path


def node_table(spark: SparkSession, stage) -> DataFrame:
    """``(tree, node, feature, threshold, left, right, vote)`` of a fitted tree
    model: leaves have no feature.  ``vote``: what a leaf adds to class 1 -- the
    share of its training rows for trees and forests, the margin for boosted
    trees.  The table grows with the model, not with data."""
    if hasattr(stage, "node_table"):
        return stage.node_table(spark).withColumnRenamed("value", "vote")
    path = scratch_path(spark, "tree-model")
    stage.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    nodes = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.withColumn("tree", F.lit(0))
    leaf = F.col("leftChild") < 0
    stats = F.col("impurityStats")
    return nodes.select(
        "tree", F.col("id").alias("node"), F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(leaf, F.when(F.size(stats) > 1, stats[1]).otherwise(0.0) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("vote"))


def steps(vectors: DataFrame, key: str, nodes: DataFrame, depth: int, features_col: str = "features") -> DataFrame:
    """``(key, tree, node)``: the leaf that every row reaches in every tree.
    Only features that some split asks for are joined; the node table is
    settled by its size (it is model state)."""
    v = F.unwrap_udt(features_col)
    places = F.when(v["type"] == 1, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(v["indices"])
    asked = nodes.filter("feature IS NOT NULL").select("feature").distinct()
    held = (vectors.select(key, F.explode(F.arrays_zip(places.alias("i"), v["values"].alias("x"))).alias("e"))
            .select(key, F.col("e.i").alias("feature"), F.col("e.x").alias("x")).filter("x <> 0")
            .join(F.broadcast(asked), "feature", "left_semi"))
    roots = nodes.filter("node = 0").select("tree", "node", "feature", "threshold", "left", "right").collect()    # one a tree
    here = vectors.select(key, F.explode(F.array(*[F.struct(*[F.lit(v).cast(nodes.schema[c].dataType).alias(c) for c, v in r.asDict().items()])
                                                  for r in roots])).alias("r")).select(key, "r.*")
    table = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right"))
    for level in range(depth):
        here = at.join(table, ["tree", "node"]) if level else here
        on = here.join(held, [key, "feature"], "left")
        at = on.select(key, "tree", F.when(F.col("feature").isNull(), F.col("node")).when(
            F.coalesce("x", F.lit(0.0)) <= F.col("threshold"), F.col("left")).otherwise(F.col("right")).alias("node"))
    return at


def confidence(vectors: DataFrame, key: str, stage, depth: int = 5) -> DataFrame:
    """``(key, confidence)``: P(class 1) of every row by the walk."""
    nodes = node_table(vectors.sparkSession, stage)
    votes = steps(vectors, key, nodes, depth).join(F.broadcast(nodes.select("tree", "node", "vote")), ["tree", "node"])
    boosted = isinstance(stage, BoostedTreesModel)
    out = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.sum("vote"))) if boosted else F.avg("vote")
    return votes.groupBy(key).agg(out.alias("confidence"))
