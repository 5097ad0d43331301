"""What each micro-batch did, as rows of the metric table."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from supplyloom.operators.metrics import METRICS_SCHEMA, append_metrics


class BatchMetrics(StreamingQueryListener):
    """Takes the observed metrics of the queries it watches; they come with the batch that they count.

    The rows are keyed by run, split, step (the batch) and name, so a batch that is replayed after a failure replaces
    its own counts, and a call that finds nothing new adds none.
    """

    def __init__(self, run_id: str):
        self.run_id = run_id
        self._rows: dict[tuple[str, int, str], float] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for split, row in progress.observedMetrics.items():
                for name, value in row.asDict().items():
                    if progress.numInputRows:
                        self._rows[(split, progress.batchId, name)] = float(value)

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def wait(self, query, timeout: float = 60.0) -> None:
        """Until the last event of a stopped query has come: they arrive in order, a little after the query."""
        if not self._event(str(query.runId)).wait(timeout):
            raise TimeoutError("the query's last event did not arrive")

    def flush(self, spark: SparkSession, path: str) -> None:
        """Appends what came since the last call to the metric table at ``path``."""
        with self._lock:
            rows = [(self.run_id, split, step, name, value) for (split, step, name), value in sorted(self._rows.items())]
            self._rows.clear()
        if rows:
            append_metrics(spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1), path)
