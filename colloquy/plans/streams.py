"""Streaming queries.

Some run the stream operators on the static message table derived from
``conversations`` (the operators are source-agnostic); the ``stream_*`` ones
drive a real Structured Streaming query (file source, AvailableNow) through
the scoring model and read back its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import models
from colloquy.plans.modelling import _checked, trained
from colloquy.plans.queries import r6
from colloquy.session import scratch_path
from colloquy.sources import fixtures
from colloquy.sources.tables import read_table
from colloquy.streaming import (Control, ScoringStream, accepted, decode_messages, file_topic, latest_feed, once,
                                processed_count, read_feed, rejects)

_RUNS: dict = {}
# A stream run takes its input in so many micro-batches at any size (each costs
# planning, a listing of the input and a commit), from so many files at least.
BATCHES, LEAST_FILES = 4, 8


def messages(spark, sf):
    """Kafka-shaped messages derived from the conversation turns."""
    return fixtures.stream_messages(read_table(spark, sf, "conversations").select("conv_id", "turn", "text"))


def decode_t01(spark, sf):
    """The accepted messages (key, offset, text)."""
    return accepted(decode_messages(messages(spark, sf))).select("key", "offset", "text")


def rejects_k05(spark, sf):
    """The rejected messages with their reason."""
    return rejects(decode_messages(messages(spark, sf))).select("key", "offset", "value", "reject_reason")


def processed_t05(spark, sf):
    """Number of processed (accepted) messages."""
    return processed_count(accepted(decode_messages(messages(spark, sf)))).select(
        F.col("processed").cast("bigint").alias("processed"))


def status_counts_t05(spark, sf):
    """T05 as status counts (processed / bad_json / no_text)."""
    from colloquy.streaming import status_counts
    return status_counts(messages(spark, sf)).select("status", F.col("messages").cast("bigint").alias("messages"))


def feed_t06(spark, sf):
    """The 5 latest rule-scored messages as display rows."""
    ok = accepted(decode_messages(messages(spark, sf)))
    n = F.length("text")
    scored = ok.select("key", "offset", "text", F.pmod(n, F.lit(3)).cast("double").alias("prediction"),
                       (n / (n + F.lit(100.0))).alias("confidence"))
    return latest_feed(scored, 5)


def write_input(msgs, path: str, append: bool = False) -> None:
    """The messages as files for a stream: as many as the cluster shuffles into,
    so that files grow with the messages and their number does not."""
    files = max(LEAST_FILES, int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    msgs.repartition(files).write.mode("append" if append else "errorifexists").parquet(path)


def read_input(spark, schema, path: str):
    """A stream over such files that takes a run's share of them a batch."""
    files = max(LEAST_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", -(-files // BATCHES)).parquet(path)


def run_stream(spark, sf, rule: bool = False):
    """Write the messages as files, stream them through the forest model (or
    the rule stand-in) a share of the files per micro-batch, return the output folder."""
    key = (spark.sparkContext.applicationId, sf, rule)
    if key in _RUNS:
        return _RUNS[key]    # one run a session feeds several queries; release_memos() drops it
    base = scratch_path(spark, "stream")
    msgs = messages(spark, sf)
    write_input(msgs, base + "/in")
    src = read_input(spark, msgs.schema, base + "/in")
    model = fixtures.RuleModel() if rule else trained(spark, sf, models.RANDOM_FOREST)
    stream = ScoringStream(model, src, base + "/results", base + "/rejects", base + "/checkpoint",
                           encoded_path=base + "/encoded").start(available_now=True)
    stream.await_done()
    _RUNS[key] = base
    return base


def stream_score_t02(spark, sf):
    """T02 from a real stream run with the forest: every accepted message once,
    and what must hold for its prediction."""
    out = spark.read.parquet(run_stream(spark, sf) + "/results")
    return _checked(out, "key", "offset")


def stream_rule_score_t02(spark, sf):
    """The whole stream path (file source, micro-batches, decode, score,
    foreachBatch sink) with the rule stand-in model: exactly checkable."""
    out = spark.read.parquet(run_stream(spark, sf, rule=True) + "/results")
    return out.select("key", "offset", "prediction", r6("confidence").alias("confidence"))


def stream_rule_encode_t03(spark, sf):
    """The encoded (key, JSON value) output of that stream run."""
    return spark.read.parquet(run_stream(spark, sf, rule=True) + "/encoded").select("key", "value")


def stream_rule_rejects_k05(spark, sf):
    """The reject sink of that stream run."""
    out = spark.read.parquet(run_stream(spark, sf, rule=True) + "/rejects")
    return out.select("key", "offset", "value", "reject_reason")


def stream_encode_t03(spark, sf):
    """T03 from that stream run: every message's JSON carries its text and a
    prediction and confidence of the right form."""
    out = spark.read.parquet(run_stream(spark, sf) + "/encoded")
    v = F.from_json("value", "prediction double, confidence double, analysis string, historical_insight string, original_text string")
    return _checked(out.select("key", v.alias("v")).select("key", "v.*"), "key", F.col("original_text").alias("text"))


class _FailsOnce:
    """A topic whose sender is lost once, after a batch has been sent."""

    def __init__(self, send, batch: int):
        self.send, self.left = send, batch

    def __call__(self, rows):
        self.send(rows)
        self.left -= 1
        if self.left == 0:
            raise ConnectionError("the sender was lost after sending")


def run_interrupted(spark, sf):
    """The messages through the rule stand-in with a feed, a topic and a control
    table: the first run's sender fails after its second batch was sent, the
    second run is asked to stop before batch 3, the third goes on to the end.
    Returns the output folder and the log of the runs."""
    from pyspark.errors import StreamingQueryException
    key = (spark.sparkContext.applicationId, sf, "interrupted")
    if key in _RUNS:
        return _RUNS[key]
    base = scratch_path(spark, "interrupted")
    msgs = messages(spark, sf)
    write_input(msgs, base + "/in")                       # batches to stop between at any size
    control = Control(spark, base + "/control")
    topic = _FailsOnce(file_topic(base + "/topic"), 2)

    def run():
        source = read_input(spark, msgs.schema, base + "/in")
        ScoringStream(fixtures.RuleModel(), source, base + "/results", base + "/rejects", base + "/checkpoint", topic=topic,
                      feed_path=base + "/feed", control=control).start(available_now=True).await_done()

    try:
        run()
    except StreamingQueryException as e:
        if "the sender was lost" not in str(e):
            raise
    control.request_stop(after_batch=2)
    run()
    run()
    _RUNS[key] = base, control
    return _RUNS[key]


def running_feed_t06(spark, sf):
    """T06 as running state: the feed and the total that the stream kept over a
    failure and a stop."""
    base, _ = run_interrupted(spark, sf)
    return read_feed(spark, base + "/feed").drop("feed")


def topic_once_k02(spark, sf):
    """The topic holds a batch twice; read as a stream, each message once."""
    base, _ = run_interrupted(spark, sf)
    sent = spark.read.parquet(base + "/topic")
    out = scratch_path(spark, "topic-once")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 8).parquet(base + "/topic")
    (once(stream).select("key", "value", "source").writeStream.format("parquet").option("checkpointLocation", out + "/checkpoint")
     .trigger(availableNow=True).start(out + "/read").awaitTermination())
    return spark.read.parquet(out + "/read")


def controlled_stop_t07(spark, sf):
    """Every message with the number of its results after a failed, a
    stopped and a finished run, and what the log says of the stop."""
    base, control = run_interrupted(spark, sf)
    stops = control.log().filter("event = 'stopped'").agg(F.max("batch_id").alias("b"), F.count(F.lit(1)).alias("n"))
    at, n = stops.select("b").scalar(), stops.select("n").scalar()
    return (spark.read.parquet(base + "/results").groupBy("key", "offset").agg(F.count(F.lit(1)).alias("copies"))
            .select("key", "offset", F.col("copies").cast("bigint").alias("copies"), at.alias("stopped_before_batch"),
                    n.cast("bigint").alias("stops")))


EXACT = {
    "running_feed_t06": running_feed_t06,
    "topic_once_k02": topic_once_k02,
    "controlled_stop_t07": controlled_stop_t07,
    "decode_t01": decode_t01,
    "rejects_k05": rejects_k05,
    "processed_t05": processed_t05,
    "status_counts_t05": status_counts_t05,
    "feed_t06": feed_t06,
    "stream_rule_score_t02": stream_rule_score_t02,
    "stream_rule_rejects_k05": stream_rule_rejects_k05,
    "stream_rule_encode_t03": stream_rule_encode_t03,
    "stream_score_t02": stream_score_t02,
    "stream_encode_t03": stream_encode_t03,
}

_MSGS = """
WITH msgs AS (
  SELECT CAST(conv_id AS VARCHAR) AS key,
         CASE WHEN (conv_id * 7 + turn) % 25 = 0 THEN '{"text": ' || CAST(to_json({'text': text}) AS VARCHAR)
              WHEN (conv_id * 3 + turn) % 31 = 0 THEN '{}'
              WHEN (conv_id * 5 + turn) % 41 = 0 THEN CAST(to_json({'text': text}) AS VARCHAR) || ' garbage'
              WHEN (conv_id * 5 + turn) % 41 = 1 THEN CAST(to_json({'text': text}) AS VARCHAR) || '{"text":"b"}'
              WHEN (conv_id * 5 + turn) % 41 = 2 THEN '{"text":5}'
              WHEN (conv_id * 5 + turn) % 41 = 3 THEN '{"text":{"a":1}}'
              WHEN (conv_id * 5 + turn) % 41 = 4 THEN ''
              WHEN (conv_id * 5 + turn) % 41 = 5 THEN CAST(to_json({'text': text}) AS VARCHAR) || ',"x":{"y":1}'
              WHEN (conv_id * 5 + turn) % 41 = 6 THEN CAST(to_json({'text': text}) AS VARCHAR) || ',"end":true} garbage'
              WHEN (conv_id * 5 + turn) % 41 = 7 THEN CAST(to_json({'text': text}) AS VARCHAR) || ',"end":true}{"text":"b"}'
              WHEN (conv_id * 5 + turn) % 41 = 8 THEN CAST(to_json({'text': text}) AS VARCHAR) || '}'
              WHEN (conv_id * 5 + turn) % 41 = 9 THEN '{"a":"}{","b":[{"text":"c"}],' || substring(CAST(to_json({'text': text}) AS VARCHAR), 2)
              ELSE CAST(to_json({'text': text}) AS VARCHAR) END AS value,
         CAST(conv_id % 3 AS INTEGER) AS partition,
         CAST(conv_id * 1000 + turn AS BIGINT) AS "offset"
  FROM conversations),
dec AS (
  SELECT *,
         CASE WHEN json_valid(value) THEN CASE WHEN json_type(value) = 'OBJECT' AND json_type(value, '$.text') = 'VARCHAR'
              THEN json_extract_string(value, '$.text') END END AS text,
         CASE WHEN value IS NULL OR NOT json_valid(value) THEN 'bad_json'
              WHEN json_type(value) <> 'OBJECT' THEN 'bad_json'
              WHEN coalesce(json_type(value, '$.text'), '') <> 'VARCHAR' THEN 'no_text' END AS reject_reason
  FROM msgs),
ok AS (SELECT * FROM dec WHERE reject_reason IS NULL)
"""

_RULE = _MSGS + """,
s AS (SELECT key, "offset", partition, text, length(regexp_replace(lower(text), '[^a-zA-Z ]', '', 'g')) AS n FROM ok),
p AS (SELECT key, "offset", partition, text, n / (n + CAST(100.0 AS DOUBLE)) AS c FROM s)
"""

SQL = {
    "running_feed_t06": _RULE + """,
u AS (SELECT *, CAST(floor(c * 100.0 * 10.0 + 0.5) AS BIGINT) AS u1 FROM p ORDER BY "offset" DESC, partition DESC LIMIT 5)
SELECT "offset", key, CASE WHEN c >= 0.5 THEN 'Potentially Scam' ELSE 'Non-Scam (Safe)' END AS label,
       CASE WHEN c = 0 THEN 'N/A' ELSE CAST(u1 // 10 AS VARCHAR) || '.' || CAST(u1 % 10 AS VARCHAR) || '%' END AS confidence_text,
       substring(text, 1, 100) || '...' AS preview, (SELECT CAST(count(*) AS BIGINT) FROM ok) AS processed
FROM u""",
    "topic_once_k02": _RULE + """
SELECT key, CAST(to_json({'prediction': CASE WHEN c >= 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END,
                         'confidence': c, 'analysis': CAST(NULL AS VARCHAR),
                         'historical_insight': CAST(NULL AS VARCHAR), 'original_text': text}) AS VARCHAR) AS value,
       partition || ':' || "offset" AS source
FROM p""",
    "controlled_stop_t07": _MSGS + """ SELECT key, "offset", CAST(1 AS BIGINT) AS copies,
        CAST(3 AS BIGINT) AS stopped_before_batch, CAST(1 AS BIGINT) AS stops FROM ok""",
    "stream_rule_score_t02": _MSGS + """,
s AS (SELECT key, "offset", length(regexp_replace(lower(text), '[^a-zA-Z ]', '', 'g')) AS n FROM ok),
p AS (SELECT key, "offset", n / (n + CAST(100.0 AS DOUBLE)) AS c FROM s)
SELECT key, "offset", CASE WHEN c >= 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
       floor(c * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS confidence FROM p""",
    "stream_rule_encode_t03": _MSGS + """,
s AS (SELECT key, text, length(regexp_replace(lower(text), '[^a-zA-Z ]', '', 'g')) AS n FROM ok),
p AS (SELECT key, text, n / (n + CAST(100.0 AS DOUBLE)) AS c FROM s)
SELECT key, CAST(to_json({'prediction': CASE WHEN c >= 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END,
                         'confidence': c, 'analysis': CAST(NULL AS VARCHAR),
                         'historical_insight': CAST(NULL AS VARCHAR), 'original_text': text}) AS VARCHAR) AS value
FROM p""",
    "stream_rule_rejects_k05": _MSGS + ' SELECT key, "offset", value, reject_reason FROM dec WHERE reject_reason IS NOT NULL',
    "decode_t01": _MSGS + ' SELECT key, "offset", text FROM ok',
    "rejects_k05": _MSGS + ' SELECT key, "offset", value, reject_reason FROM dec WHERE reject_reason IS NOT NULL',
    "processed_t05": _MSGS + " SELECT CAST(count(*) AS BIGINT) AS processed FROM ok",
    "status_counts_t05": _MSGS + """ SELECT coalesce(reject_reason, 'processed') AS status,
        CAST(count(*) AS BIGINT) AS messages FROM dec GROUP BY ALL""",
    "feed_t06": _MSGS + """,
s AS (SELECT key, "offset", text, CAST(length(text) % 3 AS DOUBLE) AS prediction,
             length(text) / (length(text) + CAST(100.0 AS DOUBLE)) AS confidence FROM ok),
u AS (SELECT *, CAST(floor(confidence * 100.0 * 10.0 + 0.5) AS BIGINT) AS u1 FROM s ORDER BY "offset" DESC LIMIT 5)
SELECT "offset", key,
       CASE WHEN prediction = 0 THEN 'Non-Scam (Safe)' WHEN prediction = 1 THEN 'Potentially Scam' ELSE 'Unknown' END AS label,
       CASE WHEN confidence IS NULL OR confidence = 0 THEN 'N/A'
            ELSE CAST(u1 // 10 AS VARCHAR) || '.' || CAST(u1 % 10 AS VARCHAR) || '%' END AS confidence_text,
       substring(text, 1, 100) || '...' AS preview
FROM u""",
    "stream_score_t02": _MSGS + """ SELECT key, "offset", true AS prediction_is_class,
        true AS confidence_is_probability, true AS prediction_is_likelier FROM ok""",
    "stream_encode_t03": _MSGS + """ SELECT key, text, true AS prediction_is_class,
        true AS confidence_is_probability, true AS prediction_is_likelier FROM ok""",
}
