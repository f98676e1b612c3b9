"""The offline training run: split, fit, evaluate, pick, save."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators import metrics, models, scoring, split, words
from colloquy.operators.features import DEFAULT_VOCAB_SIZE
from colloquy.session import materialize


@dataclass
class TrainingRun:
    models: dict
    metrics: DataFrame          # Model, Dataset, Metric, Score
    confusion: DataFrame        # model, dataset, labels_prediction, predicted_0, predicted_1
    split_counts: DataFrame     # split, n
    best: DataFrame             # Dataset, Metric, best_model, best_score (one row)
    best_name: str


def run_training(labelled: DataFrame, key: str = "doc_id", names=models.REFERENCE_MODELS,
                 kind: str = "count", params: dict | None = None, select_metric: str = "F1",
                 select_dataset: str = split.VALIDATION, model_path: str | None = None,
                 fitted: dict | None = None, partitions: int = models.TRAIN_PARTITIONS,
                 vocab_size: int = DEFAULT_VOCAB_SIZE) -> TrainingRun:
    """``labelled``: key, dialogue, labels (double), clean_text -- already
    cleaned and non-empty (``cleaning.load_and_clean``).  Trains every
    model on the Train part, evaluates all of them on Validation and Test
    in one metrics pass, picks the best by ``select_metric`` on
    ``select_dataset`` and, with ``model_path``, saves it (replacing).
    ``fitted``: models already trained on the same Train part.

    ``partitions`` of the training vectors: set it to the cores of a large run.
    The same setting gives the same models on any cluster; boosted trees and
    the single tree are the same for any setting, the forest draws its samples
    per partition."""
    parts = split.hash_split(labelled, key, out="dataset")
    train = parts.filter(F.col("dataset") == split.TRAIN)
    held = parts.filter(F.col("dataset") != split.TRAIN).select(key, "dialogue", "labels", "dataset")
    fitted = fitted or models.fit_models(train, names, kind=kind, vocab_size=vocab_size, params=params, key=key,
                                         partitions=partitions)
    union = scoring.score_all(fitted, held, [key, "dataset", "labels"])
    # three consumers (metrics, confusion, best pick) and four model
    # transforms behind them: write the small counted form once to the
    # shared folder (cuts the lineage; survives executor loss)
    counts = materialize(metrics.prediction_counts(union, ["model", "dataset"], score_col="confidence"))
    table = metrics.metrics_table(counts, score_col="confidence", weight_col="_count")
    best = metrics.pick_best(table, select_dataset, select_metric)
    row = best.first()
    if row is None:
        raise ValueError(f"no {select_metric} on {select_dataset}: nothing to pick the best model by")
    best_name = row["best_model"]
    if model_path:
        models.save_model(fitted[best_name], model_path)
    return TrainingRun(fitted, table, metrics.confusion_matrix(counts, ["model", "dataset"], weight_col="_count"),
                       split.split_counts(parts, "dataset"), best, best_name)


def word_report(spark, run: TrainingRun, labelled_words: DataFrame, n: int = 10) -> dict:
    """A01-A04 for every model that has importances: ``{name: word stats}``."""
    out = {}
    for name, model in run.models.items():
        try:
            imp = words.top_features(spark, model, n)
        except words.NoImportancesError:
            continue
        counts = words.word_class_counts(labelled_words, imp)
        out[name] = words.word_stats(counts, imp)
    return out
