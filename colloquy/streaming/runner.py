"""Running the scoring stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.formats import SCAM_LABELS, UNKNOWN_LABEL, label_text, percent_text, preview
from colloquy.operators.scoring import score
from colloquy.session import scratch_path
from colloquy.streaming.control import Control, RunLog, StopRequested
from colloquy.streaming.decode import accepted, decode_messages, encode_results, rejects
from colloquy.streaming.feed import write_feed
from colloquy.streaming.outbox import outgoing


def score_messages(model, messages: DataFrame) -> DataFrame:
    """T01 + T02 on any frame of ``key, value`` messages (static or streaming)."""
    return score(model, accepted(decode_messages(messages)), text_col="text")


class ScoringStream:
    """One streaming query that decodes, scores and writes results
    and rejects per micro-batch.

    Offsets live in ``checkpoint`` (a shared folder), so a restart resumes
    after the last committed batch instead of replaying from the start.
    Each batch is written to ``<out>/batch_id=<n>`` with overwrite, so a
    batch replayed after a failure replaces its own output (exactly-once
    files).  ``kafka_options`` (see ``sources.kafka``) sends the encoded
    results to a topic as well (at-least-once).  ``requests_path`` adds the
    explanation-request table per batch (L01; with ``history`` /
    ``hist_key`` -- a frame with a ``dialogue`` column -- or a
    ``history_index`` also the history requests, L02).

    ``topic`` sends the results with their source in a header, so that readers
    drop what a repeated batch sends twice (``outbox.once``).  ``feed_path``
    keeps the latest results and the running total (``feed``).  ``control`` is
    looked at before every batch; a requested stop ends the run between two
    batches and is logged (``control``)."""

    def __init__(self, model, source: DataFrame, results_path: str, rejects_path: str, checkpoint: str,
                 kafka_options: dict | None = None, encoded_path: str | None = None,
                 requests_path: str | None = None, history: DataFrame | None = None,
                 hist_key: str | None = None, k: int = 3, history_index=None, topic=None,
                 feed_path: str | None = None, control: Control | None = None):
        self.model, self.source = model, source
        self.results_path, self.rejects_path = results_path, rejects_path
        self.encoded_path, self.checkpoint = encoded_path, checkpoint
        self.kafka_options = kafka_options
        self.requests_path, self.history, self.hist_key, self.k = requests_path, history, hist_key, k
        self.history_index = history_index
        self.topic, self.feed_path, self.control = topic, feed_path, control
        self.query, self.run_log = None, None
        self.stopped_by: list[tuple[str, int]] = []      # (request, batch that met it) of the last run

    def _history_index(self):
        """The history's index: as given, else made by the first batch that
        needs it and kept for the run."""
        if self.history_index is None:
            from colloquy.operators.history import HistoryIndex
            self.history_index = HistoryIndex.build(self.history, self.hist_key,
                                                    scratch_path(self.history.sparkSession, "history-index"))
        return self.history_index

    def _write_requests(self, scored: DataFrame, batch_id: int) -> None:
        """Per message (``msg_id`` = partition:offset): the analysis request
        and, with a history corpus, the history request over its k most
        similar past cases -- what the reference asks its LLM per message."""
        from colloquy.operators import explain, features

        msgs = scored.select(F.concat_ws(":", "partition", "offset").alias("msg_id"), "key",
                             F.col("text").alias("dialogue"), "prediction", "confidence")
        out = explain.explanation_requests(msgs, "msg_id", keep=("key",))
        if self.history is not None or self.history_index is not None:
            index = self._history_index()
            sim = index.similar(features.text_features(msgs.select("msg_id", "dialogue")), "msg_id", self.k)
            hp = explain.history_prompts(msgs, "msg_id", sim, index.cases().select("id", F.col("dialogue").alias("text")), "id")
            out = out.join(hp.withColumnRenamed("prompt", "history_prompt"), "msg_id", "left")
        out.write.mode("overwrite").parquet(f"{self.requests_path}/batch_id={batch_id}")

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self.control is not None:
            self.stopped_by = [(r, batch_id) for r in self.control.due(batch_id)]
            if self.stopped_by:
                raise StopRequested(f"stop requested before batch {batch_id}")
        decoded = decode_messages(batch).persist()
        try:
            scored = score(self.model, accepted(decoded), text_col="text").persist()
            try:
                scored.write.mode("overwrite").parquet(f"{self.results_path}/batch_id={batch_id}")
                enc = encode_results(scored)
                if self.encoded_path:
                    enc.write.mode("overwrite").parquet(f"{self.encoded_path}/batch_id={batch_id}")
                if self.kafka_options:
                    enc.write.format("kafka").options(**self.kafka_options).save()
                if self.requests_path:
                    self._write_requests(scored, batch_id)
                if self.feed_path:
                    write_feed(scored, batch_id, self.feed_path)
                if self.topic:
                    self.topic(outgoing(scored, batch_id))
            finally:
                scored.unpersist()
            rejects(decoded).write.mode("overwrite").parquet(f"{self.rejects_path}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    def start(self, available_now: bool = True, processing_time: str | None = None):
        w = self.source.writeStream.foreachBatch(self._write_batch).option("checkpointLocation", self.checkpoint)
        if processing_time:
            w = w.trigger(processingTime=processing_time)
        elif available_now:
            w = w.trigger(availableNow=True)
        self.stopped_by = []
        if self.control is not None:
            self.run_log = RunLog()
            self.source.sparkSession.streams.addListener(self.run_log)
        self.query = w.start()
        if self.run_log is not None:
            self.run_log.follow(str(self.query.runId))
        return self

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def await_done(self, timeout: float | None = None) -> bool:
        """Waits for the end of the run (False: still running after ``timeout``);
        a stop that was asked for is a normal end, any other failure is raised."""
        if self.query is None:
            return True
        failed = True
        try:
            done = self.query.awaitTermination(timeout) if timeout else (self.query.awaitTermination() or True)
            failed = False
        except StreamingQueryException:
            if not self.stopped_by:
                raise
            done, failed = True, False
        finally:
            if failed or done:
                self._close_log(failed)
        return done

    def _close_log(self, failed: bool) -> None:
        """Writes what the run did once its last event has come."""
        log, self.run_log = self.run_log, None
        if log is None:
            return
        log.ended.wait(30)
        self.source.sparkSession.streams.removeListener(log)
        rows = [(log.run, "batch", b, n, None) for b, n in log.batches]
        rows += [(log.run, "stopped", b, None, r) for r, b in self.stopped_by]
        self.control.write_log(rows + [(log.run, "failed" if failed else "ended", None, None, None)] * (not self.stopped_by))

    def stop(self) -> None:
        if self.query is not None and self.query.isActive:
            self.query.stop()

    def _sink_rows(self, path: str) -> int:
        from pyspark.errors import AnalysisException
        try:
            return self.source.sparkSession.read.parquet(path).count()
        except AnalysisException:  # nothing written yet
            return 0

    def processed(self) -> int:
        """Messages scored so far, read from the exactly-once result
        folders (progress reports are only kept for the last batches)."""
        return self._sink_rows(self.results_path)

    def rejected(self) -> int:
        """Messages sent to the reject table so far."""
        return self._sink_rows(self.rejects_path)


def status_counts(messages: DataFrame) -> DataFrame:
    """T05 as an aggregation: messages per status (``processed`` or the
    reject reason).  On a streaming frame this is a stateful running count
    (state store, complete mode); partial aggregation keeps the per-batch
    shuffle to one row per status per task."""
    decoded = decode_messages(messages)
    status = F.coalesce(F.col("reject_reason"), F.lit("processed"))
    return decoded.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("messages"))


def start_status_counts(source: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Run ``status_counts`` on a stream; each trigger rewrites the complete
    (small: one row per status) table at ``path``."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    w = (status_counts(source).writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def processed_count(results: DataFrame) -> DataFrame:
    """T05 on the result table: total processed messages (one row)."""
    return results.agg(F.count(F.lit(1)).alias("processed"))


def latest_feed(results: DataFrame, n: int = 5, order_cols=("offset",), text_col: str = "text") -> DataFrame:
    """The ``n`` latest results (by ``order_cols`` desc) as display rows:
    label text ("Unknown" when unmapped), confidence to one decimal or
    "N/A", and a 100-character preview.  A top-n over the result table."""
    ordered = results.orderBy(*[F.desc(c) for c in order_cols]).limit(n)
    return ordered.select(
        *order_cols, "key",
        label_text("prediction", SCAM_LABELS, default=UNKNOWN_LABEL).alias("label"),
        percent_text("confidence", 1, missing="N/A", zero_is_missing=True).alias("confidence_text"),
        preview(text_col).alias("preview"),
    )
