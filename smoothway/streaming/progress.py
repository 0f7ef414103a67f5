"""Progress of streams as rows of a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from smoothway.streaming.raw import progress_figures

FIGURES = "query string, batch long, rows long, rows_per_second double, batch_ms long, event_lag_s double, offset_lag long, end_offset long, state string"


class ProgressTable(StreamingQueryListener):
    """Appends a row for each batch of the session's queries, and for each query's start and end, to a table.

    Add it by spark.streams.addListener. A batch without rows has no event lag. clock gives seconds, so
    that lags can be tested; name is the observed metric that holds the latest event's time.
    """

    def __init__(self, spark: SparkSession, path: str, clock, name: str = "events") -> None:
        self.spark, self.path, self.clock, self.name = spark, path, clock, name
        self.rows: list[tuple] = []
        self.lock = threading.Lock()

    def _add(self, row: tuple) -> None:
        with self.lock:
            self.rows.append(row)

    def onQueryStarted(self, event) -> None:
        self._add((str(event.id), None, None, None, None, None, None, None, "started"))

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        figures = progress_figures(told, self.clock(), self.name)
        self._add((str(event.progress.id), told["batchId"], *[figures[k] for k in ("rows", "rows_per_second", "batch_ms", "event_lag_s", "offset_lag", "end_offset")], "running"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add((str(event.id), None, None, None, None, None, None, None, "failed" if event.exception else "ended"))

    def flush(self) -> DataFrame:
        """Write the rows since the last time, and read the table."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            kinds = FIGURES.split(", ")
            whole = [tuple(None if v is None else float(v) if k.endswith("double") else int(v) if k.endswith("long") else v for v, k in zip(r, kinds, strict=True)) for r in rows]
            self.spark.createDataFrame(whole, FIGURES).coalesce(1).write.mode("append").parquet(self.path)
        return self.spark.read.schema(FIGURES).parquet(self.path)
