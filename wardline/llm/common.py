"""Helpers shared by the operators: tables, scratch tables, checked broadcasts."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side is broadcast only when its counted rows times its row bytes stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the session's Python workers, once, wherever the driver runs."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/wardline_package.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(held.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)


#: Rows of an Arrow batch, unless the session says otherwise: whole texts are long, and a
#: worker holds a batch several times over.
BATCH_ROWS = "2000"
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

Frames = Iterator[pd.DataFrame]
Batches = Iterator[pa.RecordBatch]


def _release() -> None:
    """Give freed memory back to the system, so that reused workers don't add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    def run(frames: Iterator) -> Iterator:
        try:
            yield from work(frames)
        finally:
            _release()

    return run


def map_frames(df: DataFrame, work: Callable[[Frames], Frames], schema: str) -> DataFrame:
    """mapInPandas of a function of this package, in batches of bounded size."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    return df.mapInPandas(_released(work), schema)


def map_batches(df: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """mapInArrow of a function of this package, in batches of bounded size: longs with nulls stay exact."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    return df.mapInArrow(_released(work), schema)


def in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The rows sorted by ``keys`` over all partitions, each partition a range of them.

    Rows with equal keys may be any share of all, so a number of the row closes the keys:
    they spread over partitions, too. It orders nothing that the keys tell apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({f"_key{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)})
    keyed = keyed.withColumn("_keyed", F.monotonically_increasing_id())
    by = [*(f"_key{i}" for i in range(len(keys))), "_keyed"]
    return keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(*[F.col(f"`{c}`") for c in df.columns])


def ranked(df: DataFrame, *keys: Column, name: str) -> DataFrame:
    """The rows with ``rank``, their place from 1 in the order of ``keys``, counted without a task that sees them all.

    The sorted rows are written with their place in their partition; what lies before each
    partition is a sum over partitions, of which the driver holds one number each.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_keyed", F.monotonically_increasing_id())
    place = F.monotonically_increasing_id()  # partition and, in the low 33 bits, the row in it
    rows = materialise(keyed.repartitionByRange(parts, *keys, "_keyed").sortWithinPartitions(*keys, "_keyed")
                       .withColumn("_place", place).drop("_keyed"), name)
    part = F.shiftright("_place", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, []
    for r in sorted(counts):
        starts.append((r["_part"], before))
        before += r["n"]
    base = spark.createDataFrame(starts, "_part long, _before long")
    found = rows.withColumn("_part", part).join(F.broadcast(base), "_part")
    return found.withColumn("rank", F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1) \
        .select(*[F.col(f"`{c}`") for c in df.columns], "rank")


def whole_groups(frames: Frames, by: list[str]) -> Frames:
    """Frames sorted by the key, cut so that no key goes over a frame's end."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        same = np.logical_and.reduce([(frame[c] == frame[c].iloc[-1]).to_numpy() for c in by])
        cut = len(frame) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield frame.iloc[:cut]
        rest = frame.iloc[cut:]
    if rest is not None and len(rest):
        yield rest


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only under the byte bound; beyond it Spark shuffles the join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def bounded_sample(rows: DataFrame, label: str, most: int, *ids: str) -> DataFrame:
    """At most ``most`` rows of each label, those with the least hashes of ``ids``.

    Labels are counted first (sums of the tasks), which says how small a hash a row must
    have; so about twice ``most`` rows of a label, not a share of every task's, meet in
    the window that makes the number exact. A label with few rows keeps them all.
    """
    counts = materialise(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), "label-counts")
    place = F.xxhash64(*ids, F.lit(label))
    share = (place / F.lit(float(1 << 64))) + 0.5  # 0 to 1
    near = (rows.join(broadcast_if_small(counts, counts.count(), 64), label)
            .where(share * F.col("_n") <= 2 * most + 64).drop("_n"))
    by = Window.partitionBy(label).orderBy(place, *ids)
    return near.withColumn("_nth", F.row_number().over(by)).where(F.col("_nth") <= most).drop("_nth")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
