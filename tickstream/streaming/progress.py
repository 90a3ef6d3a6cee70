"""What streaming queries did, batch by batch, as a table."""

from __future__ import annotations

import json
import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("query string, run_id string, batch bigint, started timestamp, input_rows bigint, "
            "rows_per_second double, batch_millis bigint, state_rows bigint, late_rows bigint")


class ProgressLog(StreamingQueryListener):
    """Keeps one row for every micro-batch of the session's queries, until they are written.

    Use it as ``with ProgressLog(spark) as log``; ``table`` shows what is held and ``flush`` appends
    it to a table, which the owner calls as often as the rows shall be kept safe. A batch that is
    repeated after a failure has a row for each run.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = json.loads(event.progress.json)
        state = seen.get("stateOperators", [])
        row = (
            seen.get("name"), seen["runId"], seen["batchId"],
            datetime.fromisoformat(seen["timestamp"].replace("Z", "+00:00")), seen["numInputRows"],
            seen.get("processedRowsPerSecond"), seen.get("batchDuration"),
            sum(s.get("numRowsTotal", 0) for s in state), sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        )
        with self._lock:
            self._rows.append(row)

    def table(self) -> DataFrame:
        with self._lock:
            return self._spark.createDataFrame(list(self._rows), PROGRESS)

    def flush(self, path: str, fmt: str = "parquet") -> int:
        """Append the rows held to a table and forget them; returns their number."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.format(fmt).mode("append").save(path)
        return len(rows)
