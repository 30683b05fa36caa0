"""File-drop sources (S1-S3, K19): new files arrive as one binary row each.

The file source records the files it has seen in the query checkpoint, so a
restarted stream resumes without re-reading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file counts however old it is: Spark's default would pass over files that are a
#: week older than the newest one seen, without a word.
ANY_AGE = "36500d"

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_files(spark: SparkSession, directory: str, max_files: int | None = None, archive_dir: str | None = None,
               glob: str | None = None, recursive: bool = True, max_age: str = ANY_AGE) -> DataFrame:
    """Streaming binary files, sub-folders included, late files of any age (``max_age``) too.
    ``archive_dir`` moves processed files away (K19)."""
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("maxFileAge", max_age)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(directory)


def decode_text(files: DataFrame) -> DataFrame:
    """UTF-8 text of each file, in the JVM; NULL if its bytes are no UTF-8 (rejected later, D4)."""
    return files.select(F.try_validate_utf8(F.col("content").cast("string")).alias("text"))


def decode_named(files: DataFrame) -> DataFrame:
    """Text plus the file name as ``msg_nm`` (the real name at any depth, D1)."""
    return files.select(F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
                        F.element_at(F.split(F.col("path"), "/"), -1).alias("msg_nm"))


def read_text(spark: SparkSession, directory: str, **kw) -> DataFrame:
    return decode_text(read_files(spark, directory, **kw))


def read_text_named(spark: SparkSession, directory: str, **kw) -> DataFrame:
    return decode_named(read_files(spark, directory, **kw))


def read_files_batch(spark: SparkSession, directory: str) -> DataFrame:
    """Batch variant of S1 for back-fills."""
    return spark.read.format("binaryFile").load(directory)
