"""Single trees and forests on sparse features.

The blocks of the boosted trees (``boosting``) are used again: packed (row, bin)
entries of the non-zero values.  All trees grow at once, one job a level: for
every open node the rows and the class-1 rows per bin of the features that the
node may look at, added up per node and range of features, best split found
where they meet.  What is shuffled depends on nodes, features looked at and
partitions, not on rows.

A row's weight in a tree is a Poisson number drawn from a hash of (row key,
tree), a node's features from (seed, tree, node): nothing depends on partitions
or the order of rows, so any layout and cluster grows the same trees.  Sums are
whole numbers.

For two classes the Gini gain times the rows equals the loss of squared error,
which is what ``boosting.best_splits`` measures with class-1 rows as gradients,
rows as weights and no regularisation."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.boosting import (LEAST_GAIN, MAX_BINS, PACKED, SCALE, Bins, Block, added, best_splits, bin_edges,
                                         leaf_sums, pack, sparse_parts, vector_length, walk)

ROW_KEY = "row_key"            # 64-bit column that names a row of the training set
RANGE_FEATURES = 2_048         # features whose splits one reducer looks at
# Poisson(1): P(at most k rows of a kind), the last one rounded up
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def bag_weights(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in the tree's sample: Poisson(1) of a hash (the
    finaliser of splitmix64) of row, seed and tree."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(1 + tree + ((seed & 0xFFFFFFFF) << 20))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(float) / float(1 << 53), "right")


def subset_size(strategy: str, trees: int, n_features: int) -> int:
    """Features a node may look at: all for one tree, else the square root."""
    if strategy not in ("auto", "all", "sqrt"):
        raise ValueError(f"featureSubsetStrategy {strategy!r}: auto, all or sqrt")
    whole = strategy == "all" or (strategy == "auto" and trees == 1)
    return n_features if whole else min(n_features, math.ceil(math.sqrt(n_features)))


class _Open:
    """An open node: its tree's number, its own, and the places in ``Bins`` of
    the features it may look at, in ranges."""

    def __init__(self, bins: Bins, tree: int, node: int, take: int, n_features: int, seed: int):
        self.tree, self.node = tree, node
        if take >= n_features:
            places = np.arange(len(bins.features))
        else:
            asked = np.random.default_rng([seed, tree, node]).choice(n_features, take, replace=False)
            places = np.flatnonzero(np.isin(bins.features, asked))
        self.ranges = [places[a:a + RANGE_FEATURES] for a in range(0, len(places), RANGE_FEATURES)] or [places]

    @staticmethod
    def cells(bins: Bins, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bins of the features, and where each feature's cells begin when
        the bins of only these features are counted (last: their number)."""
        first = bins.first[places]
        return first, np.concatenate([[0], np.cumsum(bins.first[places + 1] - first)]).astype(np.int64)


def _add_node_sums(sums: np.ndarray, block: Block, weight: np.ndarray, positive: np.ndarray, node: np.ndarray, own: int,
                   first: np.ndarray, local: np.ndarray) -> None:
    """Adds the class-1 rows and the rows of node ``own`` per cell to ``sums``
    (2, cells); only entries of the node's features are read."""
    lo = block.places(first)
    n = block.places(first + np.diff(local)) - lo
    # the entries of all features of the node, one run after another
    at = np.arange(n.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else np.empty(0, np.int64)
    row = block.rows[at]
    held = node[row] == own
    row = row[held]
    cell = block.bins[at[held]] + np.repeat(local[:-1] - first, n)[held]
    for out, x in zip(sums, (positive, weight)):
        out += np.bincount(cell, x[row], len(out))


class GrownForest(Estimator, HasFeaturesCol, HasLabelCol):
    """M01 (one tree, all rows and features) and M02 (``numTrees`` trees on
    Poisson samples of the rows, the square root of the features at each node).
    Labels 0 and 1, features of zero and more; no rows: an error.  Rows are
    named by the column ``row_key`` where the input has one, else by their
    label and vector: rows of one name are drawn together."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", numTrees=1, maxDepth=5, seed=42,
                 featureSubsetStrategy="auto", minInstancesPerNode=1, maxBins=MAX_BINS):
        super().__init__()
        given = self._input_kwargs
        self._set(featuresCol=given.get("featuresCol", "features"), labelCol=given.get("labelCol", "label"))
        self.num_trees, self.max_depth, self.seed = numTrees, maxDepth, seed & 0xFFFFFFFF
        self.strategy, self.least, self.max_bins = featureSubsetStrategy, minInstancesPerNode, maxBins
        self.edges = None                                    # ``bin_edges`` of the rows at MAX_BINS, where they are known

    def _fit(self, dataset: DataFrame) -> GrownForestModel:
        label = F.col(self.getLabelCol()).cast("double")
        i, x = sparse_parts(self.getFeaturesCol())
        key = F.col(ROW_KEY) if ROW_KEY in dataset.columns else F.xxhash64(label, i, x)
        rows = dataset.select(label.alias("y"), i.alias("i"), x.alias("x"), key.cast("long").alias("k"))
        n, odd = rows.select(F.count(F.lit(1)), F.count_if(~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False)))).first()
        if not n or odd:
            raise ValueError(f"trees need rows with labels 0 and 1: {n} rows, {odd} others")
        known = self.edges if self.max_bins == MAX_BINS else None
        bins = Bins(bin_edges(rows, self.max_bins) if known is None else known)
        n_features = vector_length(dataset, self.getFeaturesCol())
        blocks = rows.mapInArrow(pack(bins), PACKED).rdd.map(
            lambda r: (Block(np.frombuffer(r[0], "<i4"), np.frombuffer(r[1], "<i4"), np.frombuffer(r[2]), None),
                       np.frombuffer(r[3], "<i8"))).persist(StorageLevel.MEMORY_AND_DISK)
        take = subset_size(self.strategy, self.num_trees, n_features)
        shared = dataset.sparkSession.sparkContext.broadcast(bins)       # model state: cuts of the vocabulary
        trees: list = [[{}] for _ in range(self.num_trees)]
        active = [(t, 0) for t in range(self.num_trees)]
        try:
            for _ in range(self.max_depth):
                if not active or not len(bins.features):
                    break
                active = self._grow(trees, self._level(blocks, shared, trees, active, take, n_features), bins)
            self._roots(blocks, trees)
        finally:
            blocks.unpersist()
            shared.unpersist()
        for tree in trees:
            for node in tree:
                if "left" not in node:
                    node["value"] = node["g"] / node["h"] if node["h"] else 0.5
        return GrownForestModel(trees=json.dumps(trees), numFeatures=n_features)._set(featuresCol=self.getFeaturesCol())

    def _weights(self, ids: np.ndarray, tree: int) -> np.ndarray:
        return bag_weights(ids, self.seed, tree) if self.num_trees > 1 else np.ones(len(ids), np.int64)

    def _level(self, blocks, shared, trees: list, active: list, take: int, n_features: int) -> list:
        """One job: (tree, node, gain, bin, class-1 rows and rows of the right
        side, of the node) for the best split of each open node and range."""
        depth, seed, least, weights = self.max_depth, self.seed, float(self.least), self._weights

        def sums(part):
            bins, plan, total, held = shared.value, None, {}, {}
            for block, ids in part:
                if plan is None:
                    plan = [_Open(bins, t, i, take, n_features, seed) for t, i in active]
                tree = None
                for slot, own in enumerate(plan):
                    if own.tree != tree:                     # once a tree; its nodes read their own entries only
                        tree = own.tree
                        node = walk(trees[tree], len(ids), block.above, depth)
                        weight = weights(ids, tree) * SCALE
                        positive = weight * block.label
                        found = [np.bincount(node, x, len(trees[tree])) for x in (positive, weight)]
                    if not found[1][own.node]:
                        continue
                    total[slot] = total.get(slot, 0.0) + np.array([[x[own.node]] for x in found])
                    for k, places in enumerate(own.ranges):
                        first, local = _Open.cells(bins, places)
                        if (slot, k) not in held:
                            held[slot, k] = np.zeros((2, int(local[-1])))    # by the bins, not by the rows
                        _add_node_sums(held[slot, k], block, weight, positive, node, own.node, first, local)
            while held:
                (slot, k), own = held.popitem()
                where = np.flatnonzero(own[1])
                yield (slot, k), (total[slot], where, own[:, where])

        def split(kv):
            (slot, k), got = kv
            bins, (t, i) = shared.value, active[slot]
            places = _Open(bins, t, i, take, n_features, seed).ranges[k]
            g, h = (got[0][:, 0] / SCALE).tolist()
            if not len(places):
                return t, i, -1.0, -1, 0.0, 0.0, g, h
            first, local = _Open.cells(bins, places)
            with np.errstate(divide="ignore", invalid="ignore"):
                [(_, gain, cell, rg, rh)] = best_splits([got], 0, local, 0.0, least)
            at = int(np.searchsorted(local, cell, "right")) - 1
            return t, i, gain, int(first[at] + cell - local[at]), rg, rh, g, h

        reducers = max(1, min(len(active), blocks.context.defaultParallelism))
        return blocks.mapPartitions(sums).reduceByKey(added, reducers).map(split).collect()      # one row a node and range

    @staticmethod
    def _grow(trees: list, found: list, bins: Bins) -> list:
        """Splits the nodes that gain; returns the new open nodes."""
        best: dict = {}
        for t, i, gain, b, rg, rh, g, h in found:
            trees[t][i].update(g=g, h=h)
            if gain > LEAST_GAIN:
                best[t, i] = max(best.get((t, i), (-1.0, 0)), (gain, -b, rg, rh))
        new = []
        for (t, i), (gain, b, rg, rh) in sorted(best.items()):
            tree, b = trees[t], -b
            feature, threshold, end = bins.split(b)
            g, h = tree[i]["g"], tree[i]["h"]
            tree[i].update(feature=feature, threshold=threshold, bin=b, end=end, gain=gain, left=len(tree), right=len(tree) + 1)
            tree += [{"g": g - rg, "h": h - rh}, {"g": rg, "h": rh}]
            new += [(t, c) for c in (len(tree) - 2, len(tree) - 1) if 0 < tree[c]["g"] < tree[c]["h"]]
        return new

    def _roots(self, blocks, trees: list) -> None:
        """Sums of the roots that no level has seen (no features, no depth, an
        empty sample)."""
        missing = [t for t, tree in enumerate(trees) if "h" not in tree[0]]
        if not missing:
            return
        weights = self._weights

        def sums(part):
            total = np.zeros((2, len(missing)))
            for block, ids in part:
                for k, t in enumerate(missing):
                    w = weights(ids, t)
                    total[:, k] += (w * block.label).sum(), w.sum()
            yield total

        for t, (g, h) in zip(missing, blocks.mapPartitions(sums).treeReduce(np.add).T.tolist()):
            trees[t][0].update(g=g, h=h)


class GrownForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                       DefaultParamsReadable, DefaultParamsWritable):
    """Adds raw prediction (one tree: the leaf's rows of either class; a forest:
    the sum of the trees' shares), probability and prediction (ties: class 0)."""

    trees = Param(Params._dummy(), "trees", "the trees as JSON", typeConverter=TypeConverters.toString)
    numFeatures = Param(Params._dummy(), "numFeatures", "length of the vectors", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, trees="[]", numFeatures=0):
        super().__init__()
        self._set(**self._input_kwargs)

    def tree_list(self) -> list:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def featureImportances(self):
        """Gain times rows of each feature's splits as shares of its tree, then
        of all trees."""
        total: dict[int, float] = {}
        for tree in self.tree_list():
            splits = [t for t in tree if "feature" in t]
            whole = sum(t["gain"] for t in splits)
            for t in splits:
                total[t["feature"]] = total.get(t["feature"], 0.0) + t["gain"] / whole
        whole = sum(total.values()) or 1.0
        return Vectors.sparse(self.getOrDefault(self.numFeatures), {f: g / whole for f, g in total.items()})

    def node_table(self, spark) -> DataFrame:
        """(tree, node, feature, threshold, left, right, value): leaves have no
        feature, splits no value."""
        rows = [(k, i, t.get("feature"), t.get("threshold"), t.get("left"), t.get("right"), t.get("value"))
                for k, tree in enumerate(self.tree_list()) for i, t in enumerate(tree)]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.tree_list()
        n = len(trees)

        @F.pandas_udf("share double, rows double")
        def leaf(i: pd.Series, x: pd.Series) -> pd.DataFrame:
            i, x = i.tolist(), x.tolist()
            rows = leaf_sums(trees, i, x, "h") if n == 1 else float(n)
            return pd.DataFrame({"share": leaf_sums(trees, i, x) / n, "rows": rows}, index=range(len(i)))

        p, rows = F.col("_leaf.share"), F.col("_leaf.rows")
        return (dataset.withColumn("_leaf", leaf(*sparse_parts(self.getFeaturesCol())))
                .withColumn(self.getRawPredictionCol(), array_to_vector(F.array(rows * (F.lit(1.0) - p), rows * p)))
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn(self.getPredictionCol(), F.when(p > 0.5, 1.0).otherwise(0.0)).drop("_leaf"))
