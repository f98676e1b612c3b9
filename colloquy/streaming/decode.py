"""Message decode / encode (T01, T03) and the reject split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAD_JSON, NO_TEXT = "bad_json", "no_text"


def decode_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """UTF-8 JSON ``{"text": "..."}`` -> ``text``, plus ``reject_reason``:
    ``bad_json`` for a value that is not exactly one JSON object (null, empty,
    cut off, trailing garbage, a second object), ``no_text`` when the field is
    missing, null or not a string, null for good messages.  No message can
    fail the query (the reference loop dies on the first bad one).

    The value is parsed inside an outer object, before a key that is made of
    the value's own SHA-256.  A bare parse would stop at the value's end and
    pass whatever follows; here it would have to hold a key that no value can
    know, so the outer object has its two keys only if the value is one."""
    raw = F.col(value_col).cast("string")
    end = F.sha2(raw, 256)
    wrapped = F.concat(F.lit('{"value":'), raw, F.lit(',"'), end, F.lit('":true}'))
    whole = F.try_parse_json(wrapped)
    one = ((F.json_object_keys(wrapped) == F.array(F.lit("value"), end))
           & F.schema_of_variant(F.try_variant_get(whole, "$.value", "variant")).startswith("OBJECT"))
    text = F.try_variant_get(whole, "$.value.text", "variant")
    good = F.schema_of_variant(text) == "STRING"
    reason = (F.when(~F.coalesce(one, F.lit(False)), F.lit(BAD_JSON))
               .when(~F.coalesce(good, F.lit(False)), F.lit(NO_TEXT)))
    return (messages.withColumn("reject_reason", reason)
            .withColumn("text", F.when(F.col("reject_reason").isNull(), F.try_variant_get(whole, "$.value.text", "string")))
            .select(*[c for c in messages.columns if c != "text"], "text", "reject_reason"))


def accepted(decoded: DataFrame) -> DataFrame:
    """Rows that decoded to a text (reason dropped)."""
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(decoded: DataFrame) -> DataFrame:
    """Rows that cannot be scored, with the raw value and the reason."""
    return decoded.filter(F.col("reject_reason").isNotNull())


def encode_results(scored: DataFrame, key_col: str = "key", text_col: str = "text", keep=()) -> DataFrame:
    """``key`` passed through; ``value`` = JSON of prediction,
    confidence, analysis, historical_insight (null here: no LLM call) and
    original_text.  Null fields are written as JSON null, not dropped.
    ``keep``: further columns."""
    body = F.struct(
        F.col("prediction").alias("prediction"),
        F.col("confidence").alias("confidence"),
        F.lit(None).cast("string").alias("analysis"),
        F.lit(None).cast("string").alias("historical_insight"),
        F.col(text_col).alias("original_text"),
    )
    return scored.select(F.col(key_col).alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"), *keep)
