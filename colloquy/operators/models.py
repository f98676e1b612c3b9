"""Model training, saving and loading.

Features are fitted once and the transformed training set is cached; every
classifier then trains on the same cached vectors and is glued behind the
fitted feature stages into one ``PipelineModel`` (the reference refits the
features for each model).  Tree models are this library's own (``forest``,
``boosting``: sparse histograms, the same trees on any layout), logistic
regression is MLlib's.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.boosting import BoostedTrees, bin_edges, sparse_parts
from colloquy.operators.features import DEFAULT_NUM_FEATURES, DEFAULT_VOCAB_SIZE, fit_feature_stages
from colloquy.operators.forest import ROW_KEY, GrownForest
from colloquy.session import ensure_checkpoint_dir, persist

# --- fixed values -----------------------------------------------------------
# Classifier settings of the reference run: depth 5 trees; 100 trees (seed
# 42, feature subset "auto") for the forest; 100 boosting rounds; logistic
# regression with MLlib defaults.
DECISION_TREE = "DecisionTree"
RANDOM_FOREST = "RandomForest"
BOOSTED_TREES = "GradientBoostedTrees"
LOGISTIC_REGRESSION = "LogisticRegression"
DEFAULT_PARAMS = {
    DECISION_TREE: {"maxDepth": 5},
    RANDOM_FOREST: {"numTrees": 100, "maxDepth": 5, "seed": 42, "featureSubsetStrategy": "auto"},
    BOOSTED_TREES: {"maxDepth": 5, "maxIter": 100},
    LOGISTIC_REGRESSION: {},
}
REFERENCE_MODELS = (DECISION_TREE, RANDOM_FOREST, BOOSTED_TREES)
# Partitions of the training vectors where a run names none; the models do not
# depend on them.
TRAIN_PARTITIONS = 8
# -----------------------------------------------------------------------------

_CLASSES = {
    DECISION_TREE: GrownForest,
    RANDOM_FOREST: GrownForest,
    BOOSTED_TREES: BoostedTrees,
    LOGISTIC_REGRESSION: LogisticRegression,
}


def classifier(name: str, label_col: str = "labels", features_col: str = "features", **overrides):
    """M01-M04 estimator with the reference settings (``overrides`` win).
    M01-M03 grow on sparse histograms (``forest``, ``boosting``): same depth,
    trees, rounds and defaults, not numerically the same models."""
    if name not in _CLASSES:
        raise ValueError(f"unknown classifier {name!r}; choose from {sorted(_CLASSES)}")
    params = dict(DEFAULT_PARAMS[name])
    params.update(overrides)
    return _CLASSES[name](featuresCol=features_col, labelCol=label_col, **params)


def fit_features(train: DataFrame, kind: str = "count", vocab_size: int = DEFAULT_VOCAB_SIZE,
                 num_features: int = DEFAULT_NUM_FEATURES, text_col: str = "clean_text") -> PipelineModel:
    """F08 fitted: tokenizer, stop words, vocabulary or hashing, IDF."""
    return fit_feature_stages(train, kind, vocab_size, num_features, input_col=text_col)


class PreparedTraining:
    """Fitted feature stages plus the cached training vectors, shared by
    every classifier trained on them.  ``release()`` drops the caches."""

    def __init__(self, base, feat, vectors, label_col: str):
        self.base, self.feat, self.vectors, self.label_col = base, feat, vectors, label_col
        self._edges: dict | None = None

    def fit(self, name: str, **params) -> PipelineModel:
        """One classifier glued behind the shared feature stages."""
        est = classifier(name, label_col=self.label_col, **params)
        if hasattr(est, "edges"):                            # the tree models cut the same vectors alike
            est.edges = self.edges(est.getFeaturesCol())
        return PipelineModel(stages=list(self.feat.stages) + [est.fit(self.vectors)])

    def edges(self, features: str) -> dict:
        """The value ranges of the vectors, found once for all tree models (at
        most 15 numbers a feature)."""
        if self._edges is None:
            i, x = sparse_parts(features)
            self._edges = bin_edges(self.vectors.select(i.alias("i"), x.alias("x")))
        return self._edges

    def release(self) -> None:
        self.vectors.unpersist()
        self.base.unpersist()


def prepare_training(train: DataFrame, kind: str = "count", vocab_size: int = DEFAULT_VOCAB_SIZE,
                     num_features: int = DEFAULT_NUM_FEATURES, label_col: str = "labels",
                     text_col: str = "clean_text", key: str | None = None,
                     partitions: int = TRAIN_PARTITIONS) -> PreparedTraining:
    """Scan / join / clean the training input once (cached), fit the feature
    stages, and cache the vectors.

    Rows are dealt by a hash of ``key`` (the text where no key is named) over
    ``partitions`` partitions and sorted in them; the forest draws its samples
    by the same hash, so that the same input gives the same trees on any
    cluster and with any ``partitions``.  Set them to the cores of a large run;
    copies of one text need a key to spread and to be drawn one by one."""
    ensure_checkpoint_dir(train.sparkSession)  # boosting checkpoints its margins there
    order = [key] if key else []
    named = F.xxhash64(F.col(key)) if key else F.xxhash64(F.col(text_col), F.col(label_col))
    dealt = (train.select(*order, label_col, text_col).repartition(partitions, *(order or [text_col]))
             .sortWithinPartitions(*order, text_col, label_col))
    base = persist(dealt.select(named.alias(ROW_KEY), label_col, text_col))
    feat = fit_features(base, kind, vocab_size, num_features, text_col)
    vectors = persist(feat.transform(base).select(ROW_KEY, label_col, "features"))
    return PreparedTraining(base, feat, vectors, label_col)


def fit_models(train: DataFrame, names=REFERENCE_MODELS, kind: str = "count",
               vocab_size: int = DEFAULT_VOCAB_SIZE, num_features: int = DEFAULT_NUM_FEATURES,
               params: dict | None = None, label_col: str = "labels", text_col: str = "clean_text",
               key: str | None = None, partitions: int = TRAIN_PARTITIONS) -> dict:
    """``{name: PipelineModel}``; features fitted once, vectors cached
    (memory and disk, recomputed from lineage if an executor is lost) and
    released afterwards."""
    params = params or {}
    prep = prepare_training(train, kind, vocab_size, num_features, label_col, text_col, key, partitions)
    try:
        return {name: prep.fit(name, **params.get(name, {})) for name in names}
    finally:
        prep.release()


def save_model(model: PipelineModel, path: str) -> None:
    """Save, replacing whatever is at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """K04."""
    return PipelineModel.load(path)
