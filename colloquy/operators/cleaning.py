"""Label filter / cast and text cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import clean_text, has_clean_text

VALID_LABELS = ("0", "1")


def filter_labels(df: DataFrame, col: str = "labels", valid=VALID_LABELS) -> DataFrame:
    """P01 + P02: keep rows whose trimmed label is one of ``valid`` and cast
    the label to double (a padded ``" 1 "`` is kept, ``"1.0"`` is not).
    Null labels drop out of the filter."""
    return (df.filter(F.trim(F.col(col)).isin(list(valid)))
              .withColumn(col, F.trim(F.col(col)).try_cast("double")))


def with_clean_text(df: DataFrame, text_col: str = "dialogue", out: str = "clean_text") -> DataFrame:
    """``clean_text`` column (see ``functions.text.clean_text``)."""
    return df.withColumn(out, clean_text(text_col))


def drop_empty(df: DataFrame, col: str = "clean_text", source: str | None = None) -> DataFrame:
    """P04 (training only): drop rows whose cleaned text is empty or null.
    Whitespace-only text is kept.  With ``source`` (the text ``col`` was
    cleaned from) the test runs on the source text without re-cleaning it."""
    if source is not None:
        return df.filter(has_clean_text(source))
    return df.filter(F.col(col) != "")


def load_and_clean(df: DataFrame, text_col: str = "dialogue", label_col: str = "labels") -> DataFrame:
    """P01-P04 in the order training uses them."""
    return drop_empty(with_clean_text(filter_labels(df, label_col), text_col), source=text_col)
