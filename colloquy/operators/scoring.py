"""Scoring (B01, B02, P05): one code path for a single text, a batch frame
and a streaming frame."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.formats import SCAM_LABELS, label_text, percent_text
from colloquy.functions.text import clean_text

_INTERNAL = ("clean_text", "words", "filtered_words", "raw_features", "features",
             "rawPrediction", "probability")


def score(model, df: DataFrame, text_col: str = "dialogue", keep_raw: bool = False) -> DataFrame:
    """Every input row with ``prediction`` (double) and ``confidence``
    = P(class 1) (P05; also when class 0 is predicted).  Null text is scored
    as empty text rather than failing the job; empty cleaned text is kept.
    Works unchanged on streaming frames (transform only, no fitting).
    Input columns named like the pipeline's intermediate columns (``words``,
    ``features``, ...) are recomputed and not returned; an input
    ``prediction`` / ``confidence`` is replaced by the new one.
    ``keep_raw`` adds ``raw_score`` = ``rawPrediction[1]``, the column the
    reference's AUC was computed on (leaf counts for a single tree: use it
    only to reproduce that number)."""
    # columns the pipeline itself produces are replaced, not an error
    stale = [c for c in _INTERNAL + ("prediction", "confidence") if c in df.columns and c != text_col]
    prepared = df.drop(*stale).withColumn("clean_text", clean_text(F.coalesce(F.col(text_col), F.lit(""))))
    out = model.transform(prepared)
    out = out.withColumn("confidence", vector_to_array(F.col("probability"))[1])
    if keep_raw:
        out = out.withColumn("raw_score", vector_to_array(F.col("rawPrediction"))[1])
    return out.drop(*[c for c in _INTERNAL if c not in df.columns or c in stale])


def score_all(models: dict, df: DataFrame, keep: list[str], text_col: str = "dialogue") -> DataFrame:
    """``model, <keep>, prediction, confidence`` of every row under every model.

    Models that share their feature stages are applied one after another to
    the same vectors, so tokenising, counting and weighting run once."""
    groups: dict[tuple, list[str]] = {}
    for name, model in models.items():
        groups.setdefault(tuple(st.uid for st in model.stages[:-1]), []).append(name)
    union = None
    for names in groups.values():
        stages = models[names[0]].stages[:-1]
        text = df.select(*keep, clean_text(F.coalesce(F.col(text_col), F.lit(""))).alias("clean_text"))
        out = PipelineModel(stages=list(stages)).transform(text).select(*keep, "features")
        cells = []
        for k, name in enumerate(names):
            last = models[name].stages[-1]
            last = last.copy({last.predictionCol: f"_p{k}", last.probabilityCol: f"_c{k}", last.rawPredictionCol: f"_r{k}"})
            out = last.transform(out).drop(f"_r{k}")
            cells.append(F.struct(F.lit(name).alias("model"), F.col(f"_p{k}").alias("prediction"),
                                  vector_to_array(F.col(f"_c{k}"))[1].alias("confidence")))
        part = out.select(*keep, F.inline(F.array(*cells))).select("model", *keep, "prediction", "confidence")
        union = part if union is None else union.unionByName(part)
    return union


def classified_batch(scored: DataFrame, text_col: str = "dialogue") -> DataFrame:
    """``dialogue, predicted_label, confidence`` as display text
    (label text, or the value itself when unmapped; ``"12.34%"`` or null when
    the confidence is missing or zero)."""
    keep = [c for c in scored.columns if c not in (text_col, "prediction", "confidence")]
    return scored.select(
        *keep,
        F.col(text_col).alias("dialogue"),
        label_text("prediction", SCAM_LABELS).alias("predicted_label"),
        percent_text("confidence", 2, zero_is_missing=True).alias("confidence"),
    )
