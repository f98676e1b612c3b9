"""Trees and forests on sparse histograms: exactness, layout, sampling, model contract."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from colloquy.operators import forest, models, treewalk
from test_boosting import _data


@pytest.fixture(scope="module")
def rows(spark):
    x, y = _data()
    out = []
    for i in range(len(x)):
        at = np.flatnonzero(x[i])
        vector = Vectors.dense(x[i]) if i % 5 == 0 else Vectors.sparse(x.shape[1], at.tolist(), x[i][at].tolist())
        out.append((i, int((i * 0x9E3779B97F4A7C15) % (1 << 63)), float(y[i]), vector))
    return spark.createDataFrame(out, ["id", "row_key", "labels", "features"]).cache()


def _fit(df, **kw):
    return forest.GrownForest(featuresCol="features", labelCol="labels", **{"maxDepth": 3, **kw}).fit(df)


def _shares(x, y, weight, depth):
    """Share of class 1 by a tree that tries every split of every feature by
    the Gini impurity of weighted rows."""
    def gini(w):
        n = w.sum()
        p = (w * y).sum() / n if n else 0
        return n * 2 * p * (1 - p)

    def grow(w, left):
        best = (1e-9, None, None)
        for f in range(x.shape[1]) if left else ():
            for low in np.unique(np.append(x[:, f], 0.0))[:-1]:
                r = np.where(x[:, f] > low, w, 0)
                if r.sum() < 1 or (w - r).sum() < 1:
                    continue
                gain = gini(w) - gini(r) - gini(w - r)
                if gain > best[0] + 1e-9:
                    best = (gain, f, low)
        if best[1] is None:
            share = (w * y).sum() / w.sum()
            return lambda v: share
        _, f, low = best
        a, b = grow(np.where(x[:, f] <= low, w, 0), left - 1), grow(np.where(x[:, f] > low, w, 0), left - 1)
        return lambda v: (b if v[f] > low else a)(v)

    tree = grow(weight, depth)
    return np.array([tree(v) for v in x])


def _confidence(model, rows):
    return {r.id: r.p for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}


def test_tree_equals_a_search_of_all_splits(rows):
    x, y = _data()
    got = _confidence(_fit(rows), rows)
    assert np.allclose([got[i] for i in range(len(x))], _shares(x, y, np.ones(len(y)), 3))


def test_sampled_trees_equal_a_search_on_the_sampled_rows(rows):
    x, y = _data()
    ids = np.array([r.row_key for r in rows.sort("id").collect()], np.int64)
    got = _confidence(_fit(rows, numTrees=4, featureSubsetStrategy="all", seed=11), rows)
    weights = [forest.bag_weights(ids, 11, t) for t in range(4)]
    assert len({w.tobytes() for w in weights}) == 4
    assert np.allclose([got[i] for i in range(len(x))], np.mean([_shares(x, y, w, 3) for w in weights], axis=0))


def test_bag_weights_are_poisson():
    w = forest.bag_weights(np.arange(200_000, dtype=np.int64), 42, 7)
    share = np.bincount(w, minlength=4)[:4] / len(w)
    assert np.allclose(share, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.005)


def test_same_trees_on_any_layout(rows, monkeypatch):
    fit = dict(numTrees=12, seed=5)
    seen = {_fit(rows.repartition(n), **fit).getOrDefault("trees") for n in (1, 4, 40)}
    monkeypatch.setattr(forest, "RANGE_FEATURES", 3)          # a node's features in several ranges
    seen.add(_fit(rows.orderBy(F.desc("id")).coalesce(3), **fit).getOrDefault("trees"))
    assert len(seen) == 1
    assert _fit(rows, numTrees=12, seed=6).getOrDefault("trees") not in seen


def test_partitions_of_a_training_run_change_nothing(spark):
    text = [f"alpha beta w{k % 11} gift" if k % 3 == 0 else f"hello w{k % 7} tuesday" for k in range(120)]
    df = spark.createDataFrame([(k, t, float(k % 3 == 0)) for k, t in enumerate(text)], "doc_id long, clean_text string, labels double")
    seen = set()
    for n in (4, 40):
        prep = models.prepare_training(df, vocab_size=20, key="doc_id", partitions=n)
        seen.add(tuple(prep.fit(name).stages[-1].getOrDefault("trees") for name in (models.DECISION_TREE, models.RANDOM_FOREST)))
        prep.release()
    assert len(seen) == 1


def test_as_good_as_the_dense_tree(rows):
    dense = DecisionTreeClassifier(featuresCol="features", labelCol="labels", maxDepth=5).fit(rows)
    right = [m.transform(rows).filter("prediction = labels").count() for m in (dense, _fit(rows, maxDepth=5))]
    assert right[1] >= right[0] - 2


def test_model_contract_and_walk(spark, rows, tmp_path):
    for trees in (1, 8):
        model = PipelineModel(stages=[_fit(rows, numTrees=trees)])
        models.save_model(model, str(tmp_path / "m"))
        again = models.load_model(str(tmp_path / "m"))
        cols = ["id", "prediction", vector_to_array("probability")[1].alias("confidence"), vector_to_array("rawPrediction").alias("raw")]
        a, b = (m.transform(rows).select(*cols).collect() for m in (model, again))
        assert sorted(map(str, a)) == sorted(map(str, b))
        for r in a:
            assert abs(r.raw[1] - r.confidence * sum(r.raw)) < 1e-9 and (sum(r.raw) >= 1 if trees == 1 else abs(sum(r.raw) - 8) < 1e-9)
            assert (r.confidence > 0.5) == (r.prediction == 1.0)
        imp = model.stages[0].featureImportances
        assert imp.size == 30 and abs(imp.toArray().sum() - 1) < 1e-9
        walked = {r.id: r.confidence for r in treewalk.confidence(rows, "id", model.stages[0], 3).collect()}
        assert len(walked) == 240 and all(abs(walked[r.id] - r.confidence) < 1e-9 for r in a)


def test_awkward_inputs(spark, rows):
    one_class = rows.withColumn("labels", F.lit(1.0))
    assert set(_confidence(_fit(one_class, numTrees=3), one_class).values()) == {1.0}
    blank = spark.createDataFrame([(0, 1.0, Vectors.sparse(3, [], [])), (1, 0.0, Vectors.sparse(3, [], []))], ["id", "labels", "features"])
    assert _confidence(_fit(blank), blank) == {0: 0.5, 1: 0.5}
    copies = rows.drop("row_key").filter("id < 10").select("id", "labels", "features")
    twice = copies.unionByName(copies)                        # no row key: rows of one name are drawn together
    assert _fit(twice, numTrees=4).getOrDefault("trees") == _fit(twice.repartition(5), numTrees=4).getOrDefault("trees")
    for bad in (rows.limit(0), rows.withColumn("labels", F.lit(2.0)), rows.withColumn("labels", F.lit(None).cast("double"))):
        with pytest.raises(ValueError):
            _fit(bad)
    with pytest.raises(ValueError):
        _fit(rows, featureSubsetStrategy="third")
