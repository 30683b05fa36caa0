"""Running metrics of a stream (K2, T1): observed while the stream writes, read by a listener.

The batch is not held up: Spark counts as the rows pass (``observe``) and reports after
each trigger; the listener notes the report. ``rows`` gives what was noted as a table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wardline.operators.cleanse import drop_update_columns, stamp_insert
from wardline.sinks.metered import record_metrics

#: T1.
EVERY_SECOND = {"processingTime": "1 second"}
_COLUMNS = "table_name string, batch_id bigint, batch_rows bigint, latest_msg_tm timestamp, seconds double"


class LiveMetrics(StreamingQueryListener):
    """Notes the observed metrics of every stream that :func:`live_append` starts, by table and batch."""

    def __init__(self, spark: SparkSession):
        self.spark, self._held, self._lock = spark, {}, threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, m in p.observedMetrics.items():
            if m["rows"]:
                with self._lock:  # a batch that is run again replaces its note
                    self._held[name, p.batchId] = (name, p.batchId, m["rows"], m["latest_msg_tm"], (p.durationMs or {}).get("triggerExecution", 0) / 1000)

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> DataFrame:
        with self._lock:
            return self.spark.createDataFrame(list(self._held.values()), _COLUMNS)

    def record(self, metrics_path: str) -> None:
        """What was noted so far, into a metrics table: a handful of rows a batch."""
        with self._lock:
            held = list(self._held.values())
        names = ("table_name", "batch_id", "batch_rows", "latest_msg_tm", "seconds")
        if held:
            record_metrics(self.spark, [dict(zip(names, r, strict=True)) for r in held], metrics_path)

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def live_append(df: DataFrame, path: str, table_name: str, checkpoint: str, trigger: dict | None = None):
    """K2 without a blocking read: an append stream on a running trigger, its metrics observed under the table's name."""
    out = stamp_insert(drop_update_columns(df)).observe(table_name, F.count(F.lit(1)).alias("rows"), F.max("msg_tm").alias("latest_msg_tm"))
    return out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or EVERY_SECOND)).start(path)
