"""Progress of running streams as rows (ST5, A10).

A listener of the session writes a small record for every finished
micro-batch: rows in, duration, the observed row counts. The records are
JSON files of one row each, named by query, run and batch, so they are
read back as a table, by any session, while the stream runs or after it
has stopped. A batch that is replayed after a restart has a record for each
run that finished it.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from airshed.sources.versions import put

PROGRESS_SCHEMA = ("query_id string, run_id string, query_name string, batch_id bigint, started_at string, "
                   "input_rows bigint, duration_ms bigint, observed map<string, bigint>")


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's streams below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {f"{name}.{key}": value for name, row in p.observedMetrics.items()
                    for key, value in row.asDict().items() if isinstance(value, int)}
        row = {"query_id": str(p.id), "run_id": str(p.runId), "query_name": p.name, "batch_id": p.batchId,
               "started_at": p.timestamp, "input_rows": p.numInputRows, "duration_ms": p.batchDuration, "observed": observed}
        # a trigger without data repeats the number of the batch before it
        put(self.spark, f"{self.path}/{p.runId}-{p.batchId:012d}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Until all records of a stopped query are written (events arrive in
        order, but after the query has ended)."""
        return self._end_of(str(query.runId)).wait(timeout)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(path)
