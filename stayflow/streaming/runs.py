"""Starting, draining and watching streaming queries."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..sources.versions import write_text

PROGRESS_SCHEMA = "name string, batch_id bigint, input_rows bigint"
LOG_SCHEMA = (
    "query_id string, run_id string, name string, batch_id bigint, started string, input_rows bigint, "
    "duration_ms bigint, state_rows bigint"
)


def triggered(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """Run for good at an interval such as ``2 seconds``; without one, take what is there and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query that takes what is there has ended; its failure is raised here."""
    query.awaitTermination()
    return query


def stop_when_idle(query: StreamingQuery) -> bool:
    """Stop a query that runs for good once its newest batch was empty after one with rows."""
    seen = [(p["batchId"], p["numInputRows"]) for p in query.recentProgress[-2:]]
    if query.isActive and len(seen) == 2 and seen[0][0] != seen[1][0] and seen[0][1] > 0 and seen[1][1] == 0:
        query.stop()
        return True
    return False


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Batch ids and input rows of the query's newest batches, as many as the session keeps; ``ProgressLog`` has all."""
    rows = [(query.name, p["batchId"], p["numInputRows"]) for p in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every batch of the session's queries to a table, one small file per batch.

    A file is named by query and batch, so a batch that a restarted query runs again replaces its row. Reports on an idle query name
    no new batch and are left out. Use it as a context; ``wait`` returns when all batches of an ended query are written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        self.errors: list[Exception] = []
        self.newest: dict[str, int] = {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        if p.batchId <= self.newest.get(run, -1) and not p.numInputRows:
            return
        self.newest[run] = max(p.batchId, self.newest.get(run, -1))
        row = {
            "query_id": str(p.id),
            "run_id": run,
            "name": p.name,
            "batch_id": p.batchId,
            "started": p.timestamp,
            "input_rows": p.numInputRows,
            "duration_ms": p.batchDuration,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
        }
        try:
            write_text(self.spark, f"{self.path}/query={p.id}/{p.batchId:012d}.json", json.dumps(row))
        except Exception as e:  # noqa: BLE001 - a listener's error would only be logged; wait() raises it
            self.errors.append(e)

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the query has not been reported")
        if self.errors:
            raise self.errors[0]

    def table(self) -> DataFrame:
        """One row per query and batch."""
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/query=*")
