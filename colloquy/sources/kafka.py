"""Kafka source / sink options.

The Kafka connector jar is not bundled; these builders return plain option
dicts for ``readStream.format("kafka")`` / ``writeStream.format("kafka")`` and
the stream logic itself is source-agnostic (see ``colloquy.streaming``).
"""

from __future__ import annotations

import os

# --- fixed values -----------------------------------------------------------
DEFAULT_BOOTSTRAP = "localhost:9092"
DEFAULT_INPUT_TOPIC = "customer-dialogues-raw"
DEFAULT_GROUP = "dialogue-classifier-group"
# -----------------------------------------------------------------------------


def _security(env) -> dict:
    if env.get("KAFKA_SECURITY_PROTOCOL") != "SASL_SSL":
        return {}
    # backslashes and quotes would end the quoted value
    user, password = ((env.get(k) or "").replace("\\", "\\\\").replace('"', '\\"')
                      for k in ("KAFKA_USERNAME", "KAFKA_PASSWORD"))
    jaas = ('org.apache.kafka.common.security.plain.PlainLoginModule required '
            f'username="{user}" password="{password}";')
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
    }


def kafka_reader_options(env=None, max_offsets_per_trigger: int | None = None) -> dict:
    """Subscribe to the input topic from the earliest offset.  Offsets
    are tracked by the streaming checkpoint, not by consumer-group commits."""
    env = os.environ if env is None else env
    opts = {
        "kafka.bootstrap.servers": env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP),
        "subscribe": env.get("KAFKA_INPUT_TOPIC", DEFAULT_INPUT_TOPIC),
        "startingOffsets": "earliest",
        "kafka.group.id": env.get("KAFKA_CONSUMER_GROUP", DEFAULT_GROUP),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(_security(env))
    return opts


def kafka_writer_options(env=None) -> dict:
    """Output topic from the environment; there is no default topic."""
    env = os.environ if env is None else env
    topic = env.get("KAFKA_OUTPUT_TOPIC")
    if not topic:
        raise ValueError("KAFKA_OUTPUT_TOPIC is not set")
    opts = {
        "kafka.bootstrap.servers": env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP),
        "topic": topic,
    }
    opts.update(_security(env))
    return opts


def read_kafka_stream(spark, env=None, max_offsets_per_trigger: int | None = None):
    """The input topic as a streaming frame ``key, value, partition,
    offset, timestamp`` (value as text).  Needs the Kafka connector on the
    classpath; feed the result to ``streaming.ScoringStream``."""
    opts = kafka_reader_options(env, max_offsets_per_trigger)
    raw = spark.readStream.format("kafka").options(**opts).load()
    return raw.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                          "partition", "offset", "timestamp")
