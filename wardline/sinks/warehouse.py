"""Warehouse copy (K9-K11). The destination is any DataFrame writer format: JDBC on a
cluster, files in tests.

A stream may replay its last batch. File destinations hold each batch in a folder
of its own, which a replay replaces. For others a batch is loaded in steps that may each be cut off:
its rows are written to files of a staging folder and a manifest names these; then the
files are appended to the destination, each row with its batch and file, all rows of a
file by one task (so, over JDBC, in one transaction); then the batch is marked as loaded and
its files go. A replay appends only the files that the destination does not hold yet.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.latest import latest_with_ties
from wardline.schemas import KEY
from wardline.sinks.tables import BATCH, data_files, exists, read_property, remove, write_property

#: Columns of a loaded row: its batch, and the staged file that it came from.
LOAD, LOAD_FILE = "_load_id", "_load_file"
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def write_warehouse(df: DataFrame, table: str, fmt: str = "jdbc", options: dict | None = None) -> None:
    """K9: batch append. For JDBC, ``options`` carries url/user/password and ``table`` is dbtable."""
    w = df.write.format(fmt).mode("append").options(**(options or {}))
    if fmt == "jdbc":
        w.option("dbtable", table).save()
    else:
        w.save(table)


def write_batch(df: DataFrame, batch_id: int, table: str, marks: str, fmt: str = "jdbc", options: dict | None = None) -> None:
    """Append a batch once, however often it is replayed."""
    if fmt in FILE_FORMATS:
        df.withColumn(BATCH, F.lit(int(batch_id))).write.format(fmt).mode("overwrite").options(**(options or {})) \
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).save(table)
        return
    stage_batch(df, batch_id, marks)
    load_batch(df.sparkSession, batch_id, table, marks, fmt, options)


def _loaded(spark: SparkSession, batch_id: int, marks: str) -> bool:
    return exists(spark, f"{marks}/_wardline_{batch_id}")


def stage_batch(df: DataFrame, batch_id: int, marks: str) -> None:
    """Step 1: the batch's rows in files of the staging folder, and a manifest of them. A staged batch is not staged again."""
    spark, folder = df.sparkSession, f"{marks}/staged/{int(batch_id)}"
    if _loaded(spark, batch_id, marks) or read_property(spark, folder, "manifest") is not None:
        return
    df.write.mode("overwrite").parquet(folder)
    write_property(spark, folder, "fresh", "nothing appended yet")
    write_property(spark, folder, "manifest", json.dumps(sorted(f.rsplit("/", 1)[-1] for f in data_files(spark, folder))))


def load_batch(spark: SparkSession, batch_id: int, table: str, marks: str, fmt: str = "jdbc", options: dict | None = None,
               only: int | None = None) -> None:
    """Steps 2 and 3: append the manifest's files that the destination lacks, then mark the batch.

    ``only`` loads so many files and stops before the mark, as a job that is cut off does.
    """
    folder = f"{marks}/staged/{int(batch_id)}"
    if _loaded(spark, batch_id, marks):
        return
    files = json.loads(read_property(spark, folder, "manifest"))
    fresh = read_property(spark, folder, "fresh") is not None  # no append was begun: the destination need not be asked
    todo = sorted(set(files) - (set() if fresh else files_held(spark, batch_id, table, fmt, options)))[:only]
    remove(spark, f"{folder}/_wardline_fresh")
    if todo:
        rows = spark.read.option("ignoreMissingFiles", "false").parquet(*[f"{folder}/{f}" for f in todo])
        rows = rows.select("*", F.lit(int(batch_id)).cast("long").alias(LOAD), F.col("_metadata.file_name").alias(LOAD_FILE))
        write_warehouse(rows.repartition(len(todo), LOAD_FILE), table, fmt, options)
    if only is None:
        write_property(spark, marks, str(batch_id), "loaded")
        remove(spark, folder)


def files_held(spark: SparkSession, batch_id: int, table: str, fmt: str, options: dict | None = None) -> set[str]:
    """The staged files of a batch that the destination has rows of: names, at most the batch's files."""
    r = spark.read.format(fmt).options(**(options or {}))
    try:
        rows = r.option("dbtable", table).load() if fmt == "jdbc" else r.load(table)
        if LOAD not in rows.columns:
            return set()
    except AnalysisException:  # the destination does not exist yet
        return set()
    return {r[0] for r in rows.where(F.col(LOAD) == batch_id).select(LOAD_FILE).distinct().collect()}


def latest_to_warehouse(df: DataFrame, table: str, fmt: str = "jdbc", options: dict | None = None, key: str = KEY) -> None:
    """Reduce a batch to its latest rows per key (ties kept), then append."""
    write_warehouse(latest_with_ties(df, [key]), table, fmt, options)


def _stream(source: DataFrame, table: str, checkpoint: str, fmt: str, options: dict | None, trigger: dict | None,
            reduce: Callable[[DataFrame], DataFrame]):
    marks = f"{checkpoint.rstrip('/')}/_copied"
    return source.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda b, i: write_batch(reduce(b), i, table, marks, fmt, options)) \
        .trigger(**(trigger or {"availableNow": True})).start()


def copy_stream(source: DataFrame, table: str, checkpoint: str, fmt: str = "jdbc", options: dict | None = None,
                trigger: dict | None = None):
    """Tail a table and append each new batch to the warehouse."""
    return _stream(source, table, checkpoint, fmt, options, trigger, lambda b: b)


def latest_stream(source: DataFrame, table: str, checkpoint: str, fmt: str = "jdbc", options: dict | None = None,
                  trigger: dict | None = None, key: str = KEY):
    """K10 as a stream: each batch's latest rows per key."""
    return _stream(source, table, checkpoint, fmt, options, trigger, lambda b: latest_with_ties(b, [key]))
