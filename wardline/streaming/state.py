"""Latest state kept by the stream itself.

``winners`` is a streaming aggregate in update mode: the state store holds one row a key, its
latest, and a batch emits only the keys whose latest row came with it, so that a merge or a
warehouse load sees what changed and no more. The whole is built-in aggregates; a row's
arrival is its batch's time, which Spark fixes once a batch. The state grows with the
number of keys and lies in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.schemas import KEY
from wardline.sinks.upsert import upsert
from wardline.sinks.warehouse import write_batch


def winners(stream: DataFrame, key: str = KEY, order: tuple[str, ...] = ("msg_tm", "msg_nm")) -> DataFrame:
    """Of each key whose latest row (by ``order``; of equal ones the first to arrive) came with this batch, that row.
    Rows without a key have no state: they are left to the caller."""
    rows = stream.where(F.col(key).isNotNull()).withColumn("_arrival", F.current_timestamp())
    late = F.struct(*order, (-F.unix_micros("_arrival")).alias("_first"))
    held = rows.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != key]), late).alias("row"), F.max("_arrival").alias("_now"))
    return held.where(F.col("row._arrival") == F.col("_now")).select(*[F.col(key) if c == key else F.col(f"row.`{c}`").alias(c) for c in stream.columns])


def winners_stream(stream: DataFrame, checkpoint: str, put: Callable[[DataFrame, int], None], key: str = KEY,
                   order: tuple[str, ...] = ("msg_tm", "msg_nm"), trigger: dict | None = None):
    """Hands each batch's changed keys to ``put``."""
    return winners(stream, key, order).writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(put).trigger(**(trigger or {"availableNow": True})).start()


def upsert_winners(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """K6: only changed keys reach the merge."""
    return winners_stream(stream, checkpoint, lambda b, i: upsert(b.sparkSession, b, path), trigger=trigger)


def load_winners(stream: DataFrame, table: str, checkpoint: str, fmt: str = "jdbc", options: dict | None = None, trigger: dict | None = None):
    """Only changed keys reach the warehouse."""
    marks = f"{checkpoint.rstrip('/')}/_copied"
    return winners_stream(stream, checkpoint, lambda b, i: write_batch(b, i, table, marks, fmt, options), trigger=trigger)
