"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardline.sinks.tables import NOT_REWRITTEN
from wardline.sources.files import ANY_AGE


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of a path-based table."""
    return spark.read.parquet(path)


def tail_table(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Incremental read of a table that is appended to.

    Files that a rewrite (compaction, retention) wrote hold no new rows and are passed
    over by their name (files of any other name are read); let the tail catch up before rows it has not read are rewritten.
    """
    r = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).option("pathGlobFilter", NOT_REWRITTEN)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)
