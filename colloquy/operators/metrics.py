"""Evaluation (E01-E09) as aggregations over prediction frames.

One ``groupBy(group, label, prediction)`` count feeds accuracy, weighted
precision / recall / F1 and the confusion matrix for every (model, dataset)
group at once (the evaluator API would scan the data once per metric and
per group).  ROC AUC is exact: rank-sum over distinct scores with ties
counted half, which equals the trapezoid area of MLlib's ROC curve when it
does not down-sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.formats import round_half_up
from colloquy.session import materialize

METRIC_NAMES = ("Accuracy", "Precision", "Recall", "F1", "AUC")


def _is_pos(label: Column) -> Column:
    return label > F.lit(0.5)


def _weight(weight_col):
    return F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)


def confusion_counts(pred: DataFrame, group_cols=(), label_col: str = "labels",
                     prediction_col: str = "prediction", weight_col: str | None = None) -> DataFrame:
    """``(group..., label, prediction, n)``; partial aggregation makes the
    shuffle a handful of rows per task whatever the input size.  With
    ``weight_col`` each input row stands for that many predictions."""
    return (pred.groupBy(*group_cols, F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction"))
                .agg(_weight(weight_col).cast("bigint").alias("n")))


def classification_metrics(pred: DataFrame, group_cols=(), label_col: str = "labels",
                           prediction_col: str = "prediction", weight_col: str | None = None) -> DataFrame:
    """Accuracy, weightedPrecision, weightedRecall, weighted F1 per
    group, with MLlib's definitions: classes are the true labels present;
    precision of a never-predicted class is 0; F1 of a class is 0 when
    precision + recall is 0."""
    g = list(group_cols)
    counts = confusion_counts(pred, g, label_col, prediction_col, weight_col)
    by_true = counts.select(*g, F.col("label").alias("cls"), F.col("n").alias("support"),
                            F.lit(0).cast("bigint").alias("predicted"),
                            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"))
    by_pred = counts.select(*g, F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                            F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp"))
    per_cls = (by_true.unionByName(by_pred).groupBy(*g, "cls")
               .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                    F.sum("tp").alias("tp"))
               .filter(F.col("support") > 0))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.col("tp") / F.col("support")
    per_cls = per_cls.withColumn("p", p).withColumn("r", r)
    f1 = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    per_cls = per_cls.withColumn("f1", f1)
    agg = per_cls.groupBy(*g).agg(
        F.sum("support").alias("_n"), F.sum("tp").alias("_tp"),
        F.sum(F.col("support") * F.col("p")).alias("_wp"),
        F.sum(F.col("support") * F.col("r")).alias("_wr"),
        F.sum(F.col("support") * F.col("f1")).alias("_wf"))
    n = F.col("_n")
    return agg.select(*g, (F.col("_tp") / n).alias("accuracy"), (F.col("_wp") / n).alias("weighted_precision"),
                      (F.col("_wr") / n).alias("weighted_recall"), (F.col("_wf") / n).alias("f1"))


def roc_auc(pred: DataFrame, group_cols=(), label_col: str = "labels", score_col: str = "score",
            buckets: int | None = None, weight_col: str | None = None) -> DataFrame:
    """Exact ROC AUC per group, ``(group..., auc)``; null when a group
    has no positives or no negatives.

    AUC = sum over distinct scores s of p_s * (negatives below s + n_s / 2),
    divided by P * N.  The running count of negatives needs no single-task
    window: the distinct scores, counted once, are range-partitioned by (group,
    score) and written to the shared folder with the number of their range
    (``buckets`` ranges; by default the session's shuffle partitions, joined
    to what the data need).  A prefix sum over the ranges' totals, one row a
    range and group, gives each range its offset; the running sum inside a
    range is a window over its own rows.  Only integers are summed, so the
    result does not depend on the ranges, and the input is evaluated once."""
    g = list(group_cols)
    if not g:  # a constant group key keeps every step an equi-join / partitioned window
        pred = pred.withColumn("_g0", F.lit(0))
        g = ["_g0"]
    s = F.col(score_col).cast("double")
    wt = F.lit(1).cast("long") if weight_col is None else F.col(weight_col).cast("long")
    per_score = (pred.select(*g, s.alias("_s"), _is_pos(F.col(label_col)).alias("_pos"), wt.alias("_wt"))
                 .groupBy(*g, "_s")
                 .agg(F.sum(F.when(F.col("_pos"), F.col("_wt")).otherwise(0)).alias("_p"),
                      F.sum(F.when(F.col("_pos"), 0).otherwise(F.col("_wt"))).alias("_n")))
    ranged = per_score.repartitionByRange(*([buckets] if buckets else []), *g, "_s")
    keyed = materialize(ranged.withColumn("_bk", F.spark_partition_id()))
    tot = keyed.groupBy(*g, "_bk").agg(F.sum("_n").alias("_bn"))
    wb = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.withColumn("_off", F.coalesce(F.sum("_bn").over(wb), F.lit(0))).drop("_bn")
    keyed = keyed.join(offs, g + ["_bk"])
    wi = Window.partitionBy(*g, "_bk").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_off") + F.coalesce(F.sum("_n").over(wi), F.lit(0))
    keyed = keyed.withColumn("_below", below)
    agg = keyed.groupBy(*g).agg(
        F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / F.lit(2.0))).alias("_area"),
        F.sum("_p").alias("_P"), F.sum("_n").alias("_N"))
    auc = F.when((F.col("_P") == 0) | (F.col("_N") == 0), F.lit(None).cast("double")).otherwise(
        F.col("_area") / (F.col("_P").cast("double") * F.col("_N").cast("double")))
    if g == ["_g0"]:
        return agg.select(auc.alias("auc"))
    return agg.select(*g, auc.alias("auc"))


def confusion_matrix(pred: DataFrame, group_cols=(), label_col: str = "labels",
                     prediction_col: str = "prediction", classes=(0.0, 1.0),
                     weight_col: str | None = None) -> DataFrame:
    """One row per true label (``labels_prediction`` as text, like
    ``crosstab``), one bigint column per class in ``classes`` (even when never
    predicted) and ``predicted_other`` for every other prediction, null
    included, so that the counts of a row always add up to its rows."""
    g = list(group_cols)
    pr = F.col(prediction_col).cast("double")
    weight = F.lit(1) if weight_col is None else F.col(weight_col)
    cell = lambda hit: F.sum(F.when(hit, weight).otherwise(0)).cast("bigint")
    own = [cell(pr == c).alias(f"predicted_{int(c)}") for c in classes]
    other = cell(~F.coalesce(pr.isin(*classes), F.lit(False))).alias("predicted_other")
    label = F.col(label_col).cast("double").cast("string").alias("labels_prediction")
    return pred.groupBy(*g, label).agg(*own, other)


def prediction_counts(pred: DataFrame, group_cols, label_col: str = "labels",
                      prediction_col: str = "prediction", score_col: str = "score") -> DataFrame:
    """Predictions collapsed to ``(group..., label, prediction, score,
    _count)``.  Every metric can read this instead of the predictions, so a
    costly prediction frame (model transforms) is computed once: the
    consumers share this aggregate's shuffle."""
    return (pred.groupBy(*group_cols, label_col, prediction_col, score_col)
                .agg(F.count(F.lit(1)).alias("_count")))


def metrics_table(pred: DataFrame, model_col: str = "model", dataset_col: str = "dataset",
                  label_col: str = "labels", prediction_col: str = "prediction",
                  score_col: str = "score", digits: int = 6, weight_col: str | None = None) -> DataFrame:
    """Long table ``Model, Dataset, Metric, Score`` for all models and
    datasets of a unioned prediction frame.  The predictions are evaluated once
    and settled as counts (``prediction_counts``); weighted metrics and AUC both derive from it."""
    g = [model_col, dataset_col]
    if weight_col is None:
        counts, weight_col = materialize(prediction_counts(pred, g, label_col, prediction_col, score_col)), "_count"
    else:  # already counted (e.g. a materialised ``prediction_counts``)
        counts = pred
    m = classification_metrics(counts, g, label_col, prediction_col, weight_col=weight_col)
    a = roc_auc(counts, g, label_col, score_col, weight_col=weight_col)
    wide = m.join(a, g, "left").select(
        F.col(model_col).alias("Model"), F.col(dataset_col).alias("Dataset"),
        F.col("accuracy").alias("Accuracy"), F.col("weighted_precision").alias("Precision"),
        F.col("weighted_recall").alias("Recall"), F.col("f1").alias("F1"), F.col("auc").alias("AUC"))
    long = wide.unpivot(["Model", "Dataset"], list(METRIC_NAMES), "Metric", "Score")
    if digits is not None:
        long = long.withColumn("Score", round_half_up("Score", digits) / F.lit(10.0 ** digits))
    return long


def best_model(metrics: DataFrame) -> DataFrame:
    """Per (Dataset, Metric) the model with the highest score (model
    name breaks ties): ``Dataset, Metric, best_model, best_score``."""
    w = Window.partitionBy("Dataset", "Metric").orderBy(F.desc_nulls_last("Score"), F.asc("Model"))
    return (metrics.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
                   .select("Dataset", "Metric", F.col("Model").alias("best_model"), F.col("Score").alias("best_score")))


def pick_best(metrics: DataFrame, dataset: str = "Validation", metric: str = "F1") -> DataFrame:
    """E08 default: the best model by F1 on the validation set (one row)."""
    return best_model(metrics).filter((F.col("Dataset") == dataset) & (F.col("Metric") == metric))


def report_lines(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """``"<Metric>: <score to 4 decimals>"`` per row (half-up rounding)."""
    units = round_half_up("Score", digits)
    scale = 10 ** digits
    whole = ((units - F.pmod(units, F.lit(scale))) / F.lit(scale)).cast("bigint")
    text = F.concat(whole.cast("string"), F.lit("."), F.lpad(F.pmod(units, F.lit(scale)).cast("string"), digits, "0"))
    line = F.concat(F.col("Metric"), F.lit(": "), F.when(F.col("Score").isNull(), F.lit("nan")).otherwise(text))
    return metrics.select("Model", "Dataset", "Metric", line.alias("line"))
