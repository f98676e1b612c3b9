"""Boosted trees on sparse features.

Second-order boosting of the logistic loss on histograms.  Rows are packed once
into blocks of (row, bin) entries of their non-zero values only; a bin belongs
to one value range of one feature, so a vocabulary of 20,000 terms costs
nothing where a row does not hold them.  A tree level is one job over the cached
blocks: gradient sums per (node, bin) in the tasks, one array for all blocks of a
partition, added up per range of features, the best split of each range found
where it was added up.  Zeros are what is left of the node's sum.  Only one
candidate per node and range reaches the driver (and the sums themselves where
they are tiny).

Gradients are whole multiples of 2^-20, so sums are exact and the trees do not
depend on partitions or the order of rows.

The blocks are an RDD: 500 such jobs run on state that stays in its partitions,
and planning a query for each would cost more than the work."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.session import ensure_checkpoint_dir

SCALE = float(1 << 20)     # gradients are whole multiples of 1 / SCALE
MAX_BINS = 16              # value ranges of a feature beside zero
RANGE_BINS = 8_192         # bins whose splits one reducer looks at
REFRESH = 10               # trees after which the rows' margins are stored again
LEAST_GAIN = 1e-9
DIRECT_BYTES = 256 << 10   # a level's sums that may go straight to the driver (a fit has 500 levels); more are added up by range
BLOCK_ROWS = 4_096         # rows of a block


def sparse_parts(features: str):
    """(indices, values) of a vector column, dense vectors too."""
    v = F.unwrap_udt(features)
    dense = v["type"] == 1
    places = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    return F.when(dense, places).otherwise(v["indices"]), v["values"]


def bin_edges(rows: DataFrame, max_bins: int = MAX_BINS) -> dict[int, np.ndarray]:
    """feature -> ascending cuts of its non-zero values (at most ``max_bins`` - 1;
    few values are told apart exactly).  One row a feature reaches the driver."""
    long = rows.select(F.explode(F.arrays_zip("i", "x")).alias("e")).select(F.col("e.i").alias("f"), F.col("e.x").alias("x"))
    at = [k / max_bins for k in range(1, max_bins)]
    got = long.filter("x <> 0").groupBy("f").agg(F.percentile_approx("x", at, 10_000).alias("cuts"), F.min("x").alias("low"))
    edges = {}
    for f, cuts, low in got.toLocalIterator():
        if low < 0:
            raise ValueError("boosted trees take features of zero and more")
        edges[f] = np.unique(cuts)
    return edges


class Bins:
    """Numbers of all bins: feature by feature, ascending values."""

    def __init__(self, edges: dict[int, np.ndarray]):
        self.features = np.array(sorted(edges), np.int64)
        self.cuts = [edges[f] for f in self.features.tolist()]
        sizes = np.array([len(c) + 1 for c in self.cuts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        # cuts of all features in one ascending list: feature number first
        self.key = np.concatenate([c for c in self.cuts]) if self.cuts else np.empty(0)
        self.owner = np.repeat(np.arange(len(self.cuts)), sizes - 1)

    def of(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Bin of each entry."""
        place = np.searchsorted(self.features, feature)
        out = np.empty(len(feature), np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            own, p = order[a:b], place[order[a]]
            out[own] = self.first[p] + np.searchsorted(self.cuts[p], value[own], "left")
        return out

    def ranges(self) -> np.ndarray:
        """Cuts of the bins into ranges of whole features, about RANGE_BINS each."""
        total, out = int(self.first[-1]), [0]
        while out[-1] < total:
            nxt = self.first[np.searchsorted(self.first, out[-1] + RANGE_BINS, "right") - 1]
            out.append(int(nxt if nxt > out[-1] else self.first[np.searchsorted(self.first, out[-1], "right")]))
        return np.array(out)

    def split(self, b: int) -> tuple[int, float, int]:
        """Split in front of bin ``b``: feature, threshold (above goes right),
        end of the feature's bins."""
        p = int(np.searchsorted(self.first, b, "right")) - 1
        k = b - int(self.first[p])
        return int(self.features[p]), float(self.cuts[p][k - 1]) if k else 0.0, int(self.first[p + 1])


def walk(tree: list[dict], n: int, right_rows, depth: int) -> np.ndarray:
    """Node of each of ``n`` rows.  A tree is a list of nodes; a split node has
    ``left`` and ``right``; ``right_rows(node)`` are the rows whose value is
    above the split."""
    node = np.zeros(n, np.int64)
    left = np.array([t.get("left", i) for i, t in enumerate(tree)])
    level = [0]
    for _ in range(depth):
        split = [i for i in level if "left" in tree[i]]
        if not split:
            break
        new = left[node]
        for i in split:
            rows = right_rows(tree[i])
            new[rows[node[rows] == i]] = tree[i]["right"]
        node = new
        level = [c for i in split for c in (tree[i]["left"], tree[i]["right"])]
    return node


class Block:
    """Some rows: entries (row, bin) in order of the bins, labels, margins."""

    def __init__(self, rows, bins, label, margin):
        self.rows, self.bins, self.label, self.margin = rows, bins, label, margin

    def places(self, bins) -> np.ndarray:
        """Where the entries of these bins begin.  (Numbers of another type would
        have numpy convert all entries first.)"""
        return np.searchsorted(self.bins, np.asarray(bins, self.bins.dtype))

    def above(self, node: dict) -> np.ndarray:
        a, b = self.places((node["bin"], node["end"]))
        return self.rows[a:b]

    def margins(self, trees: list, depth: int) -> np.ndarray:
        out = self.margin.copy()
        for tree in trees:
            out += np.array([t.get("value", 0.0) for t in tree])[walk(tree, len(out), self.above, depth)]
        return out

    def add_sums(self, total: np.ndarray, sums: np.ndarray, trees: list, tree: list, active: list[int], depth: int) -> None:
        """Adds the gradients and weights of the open nodes to ``total`` (2, node)
        and those of every (bin, node) to ``sums`` (2, bins x nodes)."""
        size = len(active)
        p = 1 / (1 + np.exp(-self.margins(trees, depth)))
        g, h = np.rint((p - self.label) * SCALE), np.rint(np.maximum(p * (1 - p), 1e-6) * SCALE)
        slot = np.full(len(tree), -1)
        slot[active] = np.arange(size)
        own = slot[walk(tree, len(self.label), self.above, depth)]
        live = own >= 0
        total += np.stack([np.bincount(own[live], x[live], size) for x in (g, h)])
        row, bins = self.rows, self.bins
        if not live.all():
            held = live[row]
            row, bins = row[held], bins[held]
        if size == 1 and len(bins):                          # the entries lie in order of their cells already
            first = np.append(0, np.flatnonzero(bins[1:] != bins[:-1]) + 1)
            for out, x in zip(sums, (g, h)):
                out[bins[first]] += np.add.reduceat(x[row], first)
            return
        key = bins * np.int64(size)
        key += own[row]
        for out, x in zip(sums, (g, h)):
            out += np.bincount(key, x[row], len(out))


def added(a, b):
    """Sums of one range of two partitions."""
    where, at = np.unique(np.concatenate([a[1], b[1]]), return_inverse=True)
    both = np.concatenate([a[2], b[2]], axis=1)
    return a[0] + b[0], where, np.stack([np.bincount(at, x, len(where)) for x in both])


def _gain(g, h, reg):
    return g * g / (h + reg)


def best_splits(parts: list, low: int, firsts: np.ndarray, reg: float, least_weight: float) -> list[tuple]:
    """Per node the best split in front of a bin of one range, whose sums come
    in ``parts``: (slot, gain, bin, right's gradient and weight).  ``firsts``: the first bin of each
    feature of the range and the range's end; ties go to the first bin."""
    total = sum(p[0] for p in parts)
    size, n = total.shape[1], int(firsts[-1]) - low
    dense = np.zeros((2, n * size))
    for _, where, sums in parts:
        dense[:, where] += sums
    dense = dense.reshape(2, n, size)
    # sums from each bin to the end of its feature
    back = np.concatenate([np.cumsum(dense[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1, size))], axis=1)
    ends = np.repeat(firsts[1:] - low, np.diff(firsts))
    right = (back[:, :n] - back[:, ends]) / SCALE
    whole = total[:, None, :] / SCALE
    left = whole - right
    ok = (right[1] >= least_weight) & (left[1] >= least_weight)
    gain = np.where(ok, _gain(left[0], left[1], reg) + _gain(right[0], right[1], reg) - _gain(whole[0], whole[1], reg), -1.0)
    top = gain.argmax(0)
    return [(s, float(gain[b, s]), low + int(b), float(right[0, b, s]), float(right[1, b, s])) for s, b in enumerate(top.tolist())]


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol):
    """``maxIter`` trees of at most ``maxDepth`` splits above a leaf on the
    logistic loss; labels 0 and 1, features of zero and more.  Same input, same
    trees, on any partitions."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=100, maxDepth=5, stepSize=0.3,
                 regularisation=1.0, leastWeight=1.0):
        super().__init__()
        given = dict(self._input_kwargs)
        self._set(featuresCol=given.pop("featuresCol", "features"), labelCol=given.pop("labelCol", "label"))
        self.max_iter, self.max_depth, self.step = maxIter, maxDepth, stepSize
        self.reg, self.least_weight = regularisation, leastWeight
        self.edges = None                                    # ``bin_edges`` of the rows, where they are known

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        spark = dataset.sparkSession
        ensure_checkpoint_dir(spark)
        i, x = sparse_parts(self.getFeaturesCol())
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), i.alias("i"), x.alias("x"))
        bins = Bins(bin_edges(rows) if self.edges is None else self.edges)
        n_features = vector_length(dataset, self.getFeaturesCol())
        depth = self.max_depth

        packed = rows.mapInArrow(pack(bins), PACKED).rdd.map(
            lambda r: Block(np.frombuffer(r[0], "<i4"), np.frombuffer(r[1], "<i4"), np.frombuffer(r[2]),
                            np.zeros(len(r[2]) // 8)))
        blocks = packed.persist(StorageLevel.MEMORY_AND_DISK)
        cuts = bins.ranges()
        firsts = [np.append(bins.first[(bins.first >= a) & (bins.first < b)], b) for a, b in zip(cuts, cuts[1:])]
        trees: list = []
        fresh: list = []                                     # trees since the margins were stored
        for _ in range(self.max_iter):
            tree, active = [{}], [0]
            for _ in range(depth):
                if not active or not len(firsts):
                    break
                found = self._level(blocks, fresh, tree, active, cuts, firsts, depth)
                active = self._grow(tree, active, found, bins)
            for t in tree:
                if "left" not in t:
                    t["value"] = -self.step * t.get("g", 0.0) / (t.get("h", 0.0) + self.reg)
            trees.append(tree)
            fresh.append(tree)
            if len(tree) == 1:
                break                                        # nothing left to split
            if len(fresh) == REFRESH:
                done, fresh = fresh, []
                newer = blocks.map(lambda b, done=done: Block(b.rows, b.bins, b.label, b.margins(done, depth)))
                newer = newer.persist(StorageLevel.MEMORY_AND_DISK)
                newer.checkpoint()
                newer.count()
                blocks.unpersist()
                blocks = newer
        blocks.unpersist()
        model = BoostedTreesModel(trees=json.dumps(trees), numFeatures=n_features)
        return model._set(featuresCol=self.getFeaturesCol())

    def _level(self, blocks, trees, tree, active, cuts, firsts, depth) -> list[tuple]:
        """One job: the best split of each active node in each range."""
        reg, least, size = self.reg, self.least_weight, len(active)

        def sums(part):
            total, cells = np.zeros((2, size)), None
            for block in part:
                if cells is None:
                    cells = np.zeros((2, int(cuts[-1]) * size))      # by the bins, not by the rows
                block.add_sums(total, cells, trees, tree, active, depth)
            for k, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()) if cells is not None else ()):
                own = cells[:, a * size:b * size]
                where = np.flatnonzero(own[1]).astype("<i4")
                yield k, (total, where, own[:, where])

        def splits(kv):
            k, own = kv
            total = sum(p[0] for p in own)
            return (best_splits(own, int(cuts[k]), firsts[k], reg, least)
                    + [(s, None, 0, float(g) / SCALE, float(h) / SCALE) for s, (g, h) in enumerate(total.T)][:size if k == 0 else 0])

        parts = blocks.mapPartitions(sums)
        if blocks.getNumPartitions() * size * int(cuts[-1]) * 20 <= DIRECT_BYTES:
            by_range: dict[int, list] = {}
            for k, part in parts.collect():                  # at most DIRECT_BYTES
                by_range.setdefault(k, []).append(part)
            return [c for kv in sorted(by_range.items()) for c in splits(kv)]
        return parts.reduceByKey(added, len(firsts)).mapValues(lambda p: [p]).flatMap(splits).collect()

    def _grow(self, tree: list, active: list[int], found: list[tuple], bins: Bins) -> list[int]:
        """Splits the nodes that gain; returns the new nodes."""
        totals = {s: (g, h) for s, gain, _, g, h in found if gain is None}
        new = []
        for s, i in enumerate(active):
            g, h = totals[s]
            tree[i].update(g=g, h=h)
            gain, b, rg, rh = max(((gain, b, rg, rh) for t, gain, b, rg, rh in found if t == s and gain is not None),
                                  key=lambda c: (c[0], -c[1]))
            if gain <= LEAST_GAIN:
                continue
            feature, threshold, end = bins.split(b)
            tree[i].update(feature=feature, threshold=threshold, bin=b, end=end, gain=gain, left=len(tree), right=len(tree) + 1)
            new += [len(tree), len(tree) + 1]
            tree += [{"g": g - rg, "h": h - rh}, {"g": rg, "h": rh}]
        return new


PACKED = "rows binary, bins binary, label binary, ids binary"


def pack(bins: Bins):
    """Arrow map of (label, indices, values and, if there, a 64-bit id) to packed
    entries (row, bin) of up to BLOCK_ROWS rows in order of the bins."""
    def run(batches):
        for batch in (whole.slice(a, BLOCK_ROWS) for whole in batches for a in range(0, len(whole), BLOCK_ROWS)):
            lists, values = batch.column(1), batch.column(2)
            at = lists.offsets.to_numpy()
            row = np.repeat(np.arange(len(batch)), np.diff(at))
            feature = lists.values.to_numpy()[at[0]:at[-1]]
            own = values.offsets.to_numpy()
            value = values.values.to_numpy()[own[0]:own[-1]]
            held = np.flatnonzero(value != 0)
            number = bins.of(feature[held], value[held])
            order = np.argsort(number, kind="stable")
            ids = batch.column(3).to_numpy() if batch.num_columns > 3 else np.empty(0, np.int64)
            cells = (row[held][order].astype("<i4"), number[order].astype("<i4"), batch.column(0).to_numpy(), ids)
            yield pa.RecordBatch.from_pydict({n: [c.tobytes()] for n, c in zip(("rows", "bins", "label", "ids"), cells)},
                                             schema=pa.schema([(n, pa.binary()) for n in ("rows", "bins", "label", "ids")]))
    return run


def vector_length(rows: DataFrame, features: str) -> int:
    """Length of the vectors of a column (0: no rows)."""
    v = F.unwrap_udt(features)
    return int(rows.select(F.max(F.coalesce(v["size"], F.size(v["values"])))).first()[0] or 0)


def leaf_sums(trees: list, indices: list, values: list, field: str = "value") -> np.ndarray:
    """Sum over the trees of a ``field`` of the leaf that each row of sparse
    vectors reaches."""
    n = len(indices)
    out = np.zeros(n)
    row = np.repeat(np.arange(n), [len(i) for i in indices])
    feature = np.concatenate([np.asarray(i, np.int64) for i in indices]) if n else np.empty(0, np.int64)
    value = np.concatenate([np.asarray(x, float) for x in values]) if n else np.empty(0)
    order = np.lexsort((value, feature))
    row, feature, value = row[order], feature[order], value[order]

    def above(node: dict) -> np.ndarray:
        a, b = np.searchsorted(feature, (node["feature"], node["feature"] + 1))
        return row[a + np.searchsorted(value[a:b], node["threshold"], "right"):b]

    for tree in trees:
        out += np.array([t.get(field, 0.0) for t in tree])[walk(tree, n, above, len(tree))]
    return out


class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                        DefaultParamsReadable, DefaultParamsWritable):
    """Adds the raw prediction, probability and prediction columns, like MLlib's
    classifiers; saved and loaded as a pipeline stage."""

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
        """Gain of each feature's splits, as shares of all gain."""
        gain: dict[int, float] = {}
        for tree in self.tree_list():
            for t in tree:
                if "feature" in t:
                    gain[t["feature"]] = gain.get(t["feature"], 0.0) + t["gain"]
        total = sum(gain.values()) or 1.0
        return Vectors.sparse(self.getOrDefault(self.numFeatures), {f: g / total for f, g in gain.items()})

    def node_table(self, spark) -> DataFrame:
        """(tree, node, feature, threshold, left, right, value): leaves have no
        feature, splits no value."""
        rows = [(k, i, t.get("feature"), t.get("threshold"), t.get("left"), t.get("right"), t.get("value"))
                for k, tree in enumerate(self.tree_list()) for i, t in enumerate(tree)]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.tree_list()

        @F.pandas_udf("double")
        def margin(i: pd.Series, x: pd.Series) -> pd.Series:
            return pd.Series(leaf_sums(trees, i.tolist(), x.tolist()))

        m, p = F.col("_margin"), F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return (dataset.withColumn("_margin", margin(*sparse_parts(self.getFeaturesCol())))
                .withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-m, m)))
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn(self.getPredictionCol(), F.when(p > 0.5, 1.0).otherwise(0.0)).drop("_margin"))
