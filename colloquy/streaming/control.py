"""A controlled stop, asked for in a table and logged by a listener.

The stream looks at the control folder before it writes a batch.  A batch that
meets a request is given back unwritten; all earlier ones are written and
committed, and the next start begins with it.  No batch is cut in two."""

from __future__ import annotations

import threading
import uuid
from collections import deque

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LOG_ENTRIES = 1_000       # latest batches of a run that its log names one by one
_REQUEST = "request string, after_batch long, requested_at timestamp"
_LOG = "run string, event string, batch_id long, messages long, request string"


class StopRequested(Exception):
    """Ends the query before a batch is written; not an error of the stream."""


class Control:
    """Requests, served requests and run logs under one shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def request_stop(self, after_batch: int | None = None) -> str:
        """Asks the stream to stop before its next batch (or the first one after
        ``after_batch``); returns the request's id."""
        name = uuid.uuid4().hex
        self.spark.createDataFrame([(name, after_batch)], "request string, after_batch long").withColumn(
            "requested_at", F.current_timestamp()).write.mode("append").parquet(f"{self.path}/requests")
        return name

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:       # nothing written yet
            return self.spark.createDataFrame([], schema)

    def due(self, batch_id: int) -> list[str]:
        """Open requests that the batch has to obey."""
        open_ = self._table("requests", _REQUEST).filter(F.coalesce("after_batch", F.lit(-1)) < batch_id)
        served = self._table("log", _LOG).filter("request IS NOT NULL").select("request")
        return sorted(r.request for r in open_.join(served, "request", "left_anti").select("request").collect())   # a person's requests

    def log(self) -> DataFrame:
        """``run, event (batch / stopped / ended / failed), batch_id, messages, request``."""
        return self._table("log", _LOG)

    def write_log(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")


class RunLog(StreamingQueryListener):
    """What one run of a query did, from its progress events."""

    def __init__(self):
        self.run: str | None = None
        self.batches: deque = deque(maxlen=LOG_ENTRIES)
        self.ended = threading.Event()
        self._held: list = []

    def follow(self, run: str) -> None:
        """The run to follow; events that came before are looked at now."""
        self.run = run
        held, self._held = self._held, []
        for handle, event in held:
            handle(event)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        if self.run is None:
            self._held.append((self.onQueryProgress, event))
        elif str(event.progress.runId) == self.run and event.progress.numInputRows:
            self.batches.append((event.progress.batchId, event.progress.numInputRows))

    def onQueryTerminated(self, event):  # noqa: N802
        if self.run is None:
            self._held.append((self.onQueryTerminated, event))
        elif str(event.runId) == self.run:
            self.ended.set()
