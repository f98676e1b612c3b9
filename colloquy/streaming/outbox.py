"""K02 without doubles: sent messages name their source, readers drop repeats.

A topic write cannot be undone: a batch that fails after it has sent is sent
again.  Every message therefore carries ``partition:offset`` of the message it
answers in a header, and a reader keeps the first of each within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.streaming.decode import encode_results

SOURCE_HEADER = "source"


def outgoing(scored: DataFrame, batch_id: int | None = None) -> DataFrame:
    """``key, value, headers`` of the results (T03's key and value); headers:
    the source message and the batch that sent it, as Kafka writes them."""
    source = F.concat_ws(":", "partition", "offset")
    pairs = [(SOURCE_HEADER, source)] + ([("batch", F.lit(str(batch_id)))] if batch_id is not None else [])
    named = scored.withColumn("headers", F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "UTF-8").alias("value"))
                                                   for k, v in pairs]))
    return encode_results(named, keep=("headers",))


def file_topic(path: str) -> Callable[[DataFrame], None]:
    """A topic as a folder that is only appended to (tests, and hand-over by
    files): the columns a Kafka topic read with headers has."""
    def send(messages: DataFrame) -> None:
        messages.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(path)
    return send


def kafka_topic(options: dict) -> Callable[[DataFrame], None]:
    def send(messages: DataFrame) -> None:
        messages.write.format("kafka").options(**options).save()
    return send


def once(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each sent message once: the first of every source message, on a stream
    within ``delay`` of its time stamp (longer than a failed batch takes to be
    repeated), on a table over all rows.  Messages without the header cannot be
    told apart and all stay.  ``source`` is added."""
    named = messages.withColumn("source", F.decode(F.try_element_at(F.transform(
        F.filter("headers", lambda h: h["key"] == SOURCE_HEADER), lambda h: h["value"]), F.lit(1)), "UTF-8"))
    named = named.withColumn("_source", F.coalesce("source", F.concat(F.lit("?"), F.uuid())))
    if messages.isStreaming:
        return named.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["_source"]).drop("_source")
    return named.dropDuplicates(["_source"]).drop("_source")
