"""Boosted trees on sparse histograms: layout, exactness, model contract."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from colloquy.operators import boosting, models, treewalk


def _data(n=240, dim=30, seed=3):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, dim)) < 0.2, rng.integers(1, 5, (n, dim)) * 0.5, 0.0)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0) | (x[:, 7] > 1)).astype(float)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = _data()
    out = []
    for i in range(len(x)):
        at = np.flatnonzero(x[i])
        vector = Vectors.dense(x[i]) if i % 5 == 0 else Vectors.sparse(x.shape[1], at.tolist(), x[i][at].tolist())
        out.append((i, float(y[i]), vector))
    return spark.createDataFrame(out, ["id", "labels", "features"]).cache()


def _fit(df, **kw):
    return boosting.BoostedTrees(featuresCol="features", labelCol="labels", **{"maxIter": 4, "maxDepth": 3, **kw}).fit(df)


def _plain(x, y, rounds, depth, step=0.3, reg=1.0, least=1.0):
    """The same boosting on the dense table: every split of every feature."""
    margin, trees = np.zeros(len(y)), []

    def grow(rows, g, h, left):
        G, H = g[rows].sum(), h[rows].sum()
        best = (0.0, None, None)
        if left:
            for f in range(x.shape[1]):
                values = np.unique(x[rows, f])
                for low in values[:-1]:
                    r = rows[x[rows, f] > low]
                    gr, hr = g[r].sum(), h[r].sum()
                    if hr < least or H - hr < least:
                        continue
                    gain = (G - gr) ** 2 / (H - hr + reg) + gr ** 2 / (hr + reg) - G ** 2 / (H + reg)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, low)
        if best[1] is None:
            margin_of = -step * G / (H + reg)
            return lambda v: margin_of
        _, f, low = best
        a, b = grow(rows[x[rows, f] <= low], g, h, left - 1), grow(rows[x[rows, f] > low], g, h, left - 1)
        return lambda v: (b if v[f] > low else a)(v)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        scale = boosting.SCALE
        tree = grow(np.arange(len(y)), np.rint((p - y) * scale) / scale, np.rint(np.maximum(p * (1 - p), 1e-6) * scale) / scale, depth)
        margin = margin + np.array([tree(v) for v in x])
    return margin


def test_margins_equal_a_search_of_all_splits(spark, rows):
    x, y = _data()
    model = _fit(rows)
    got = {r.id: r.m for r in model.transform(rows).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    assert np.allclose([got[i] for i in range(len(x))], _plain(x, y, 4, 3), atol=1e-6)


def test_same_trees_on_any_layout_and_by_either_way_of_adding(rows, monkeypatch):
    seen = {_fit(rows.repartition(n)).getOrDefault("trees") for n in (1, 3, 7)}
    monkeypatch.setattr(boosting, "DIRECT_BYTES", 0)          # sums meet by range in a shuffle
    monkeypatch.setattr(boosting, "RANGE_BINS", 10)
    monkeypatch.setattr(boosting, "REFRESH", 2)               # margins stored again on the way
    seen.add(_fit(rows.repartition(5)).getOrDefault("trees"))
    assert len(seen) == 1


def test_model_contract_and_walk(spark, rows, tmp_path):
    model = PipelineModel(stages=[_fit(rows)])
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    a, b = (m.transform(rows).select("id", "prediction", vector_to_array("probability")[1].alias("confidence")) for m in (model, again))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    imp = model.stages[0].featureImportances
    assert imp.size == 30 and abs(imp.toArray().sum() - 1) < 1e-9 and set(np.argsort(-imp.toArray())[:3]) <= {0, 3, 7}
    walked = {r.id: r.confidence for r in treewalk.confidence(rows, "id", model.stages[0], 3).collect()}
    assert all(abs(walked[r.id] - r.confidence) < 1e-9 for r in a.collect()) and len(walked) == 240
    assert a.join(rows, "id").filter("prediction = labels").count() > 220


def test_awkward_inputs(spark, rows):
    one_class = rows.withColumn("labels", F.lit(1.0))
    out = _fit(one_class).transform(one_class).select(vector_to_array("probability")[1].alias("p")).distinct().collect()
    assert len(out) == 1 and 0.5 < out[0].p < 1
    empty = spark.createDataFrame([(0, 1.0, Vectors.sparse(3, [], [])), (1, 0.0, Vectors.sparse(3, [], []))], ["id", "labels", "features"])
    assert {r.prediction for r in _fit(empty).transform(empty).collect()} == {0.0}
    with pytest.raises(ValueError):
        _fit(spark.createDataFrame([(1.0, Vectors.dense([-1.0]))], ["labels", "features"]))


def test_sums_stay_off_the_driver_and_blocks_are_bounded(spark, monkeypatch):
    import pickle
    import pyarrow as pa
    from pyspark.rdd import RDD
    rows = [(float(i % 2), Vectors.sparse(3_000, {(i * 37 + k) % 3_000: 1.0 + k % 2 for k in range(120)})) for i in range(200)]
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(8)
    sent = []
    monkeypatch.setattr(RDD, "collect", lambda self, f=RDD.collect: (sent.append(f(self)), sent[-1])[1])
    boosting.BoostedTrees(maxIter=2, maxDepth=3).fit(df)
    assert sent and max(len(pickle.dumps(x)) for x in sent) < 8_000        # candidates, not sums of 3,000 features
    lists = pa.array([[0, 1]] * 10_000, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([1.0] * 10_000), lists, lists.cast(pa.list_(pa.float64()))], names=["y", "i", "x"])
    blocks = list(boosting.pack(boosting.Bins({0: np.empty(0), 1: np.empty(0)}))([batch]))
    sizes = [len(b.column(2)[0].as_py()) // 8 for b in blocks]
    assert sum(sizes) == 10_000 and max(sizes) <= boosting.BLOCK_ROWS


def test_a_block_is_searched_without_converting_its_entries(monkeypatch):
    """Looking up a split's rows costs a binary search, not a pass over the block's
    entries: what is looked for has their type, in boosting and in the forest."""
    from colloquy.operators import forest
    x, y = _data()
    row, feature = np.nonzero(x)
    order = np.argsort(feature, kind="stable")
    block = boosting.Block(row[order].astype("<i4"), feature[order].astype("<i4"), y, np.zeros(len(y)))
    types = []
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *k, f=np.searchsorted: (types.append((a.dtype, np.asarray(v).dtype)), f(a, v, *k))[1])
    assert block.above({"bin": 3, "end": 5}).tolist() == [*np.flatnonzero(x[:, 3]), *np.flatnonzero(x[:, 4])]
    sums = np.zeros((2, 2))
    forest._add_node_sums(sums, block, np.ones(len(y)), y, np.zeros(len(y), np.int64), 0, np.array([3, 9]), np.array([0, 1, 2]))
    assert sums.tolist() == [[y[x[:, f] > 0].sum() for f in (3, 9)], [float((x[:, f] > 0).sum()) for f in (3, 9)]]
    assert types and all(a == v for a, v in types)


def test_sums_of_one_node_and_of_two_agree():
    rng = np.random.default_rng(5)
    x, y = _data()
    row, feature = np.nonzero(x)
    order = np.argsort(feature, kind="stable")
    block = boosting.Block(row[order].astype("<i4"), feature[order].astype("<i4"), y, rng.normal(size=len(y)))
    split = [{"left": 1, "right": 2, "bin": 3, "end": 4}, {}, {}]
    def sums(tree, active):
        total, cells = np.zeros((2, len(active))), np.zeros((2, 30 * len(active)))
        for _ in range(2):                                   # added to what is there
            block.add_sums(total, cells, [], tree, active, 3)
        return total.sum(1), cells.reshape(2, 30, -1).sum(2)
    both = sums(split, [1, 2])
    for got in (sums([{}], [0]), tuple(a + b for a, b in zip(sums(split, [1]), sums(split, [2])))):
        assert all((a == b).all() for a, b in zip(got, both))
