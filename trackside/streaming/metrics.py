"""Progress of every batch of a stream, kept in a table."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query string, run string, batch_id bigint, started string, input_rows bigint, "
    "rows_per_second double, late_rows bigint, state_rows bigint, milliseconds bigint, "
    "observed map<string,string>"
)


class ProgressTable(StreamingQueryListener):
    """Appends the progress of all batches of a session's queries to a table.

    Spark itself keeps that of the last 100. Rows are written `every` so many
    batches and when a query ends; what was not written is lost with the
    process. `observed` has the values that `live.observed` asked for, as text.

    with ProgressTable(spark, folder) as table: run the queries, ``table.wait(query)``.
    """

    def __init__(self, spark: SparkSession, folder: str, every: int = 20):
        self.spark, self.folder, self.every = spark, folder, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        seen = {
            f"{name}.{field}": str(value)
            for name, row in (p.observedMetrics or {}).items()
            for field, value in row.asDict().items()
        }
        row = (
            str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond,
            sum(s.numRowsDroppedByWatermark for s in states), sum(s.numRowsTotal for s in states),
            p.durationMs.get("triggerExecution"), seen,
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._event(str(event.runId)).set()

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def wait(self, query, seconds: float = 60) -> None:
        """Until the progress of a query that has ended is written: events come late."""
        if not self._event(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the query has not been told")

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            table = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            table.write.mode("append").parquet(self.folder)


def progress_of(spark: SparkSession, folder: str) -> DataFrame:
    """What `ProgressTable` has written; of a batch that ran again, each run."""
    try:
        return spark.read.schema(PROGRESS).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS)
