"""Structured Streaming scoring.

The same ``decode`` / ``score`` / ``encode`` functions run on static frames
and on streaming frames; the source (Kafka, files) only decides how
``key, value`` rows arrive.
"""

from colloquy.streaming.control import Control, RunLog  # noqa: F401
from colloquy.streaming.decode import accepted, decode_messages, encode_results, rejects  # noqa: F401
from colloquy.streaming.feed import advance_feed, read_feed  # noqa: F401
from colloquy.streaming.outbox import file_topic, kafka_topic, once, outgoing  # noqa: F401
from colloquy.streaming.runner import (  # noqa: F401
    ScoringStream,
    latest_feed,
    processed_count,
    start_status_counts,
    status_counts,
)
