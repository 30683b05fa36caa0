"""Current-state upserts (K5-K8) on bucketed parquet directories.

A current table is partitioned by ``_bucket = pmod(xxhash64(key), n)``; ``n`` is
stored with the table when it is made and holds for every writer. An upsert
reduces the batch to the latest state per key, reads only the buckets that the
batch touches, decides per key by the two sides' latest times (aggregated in the
tasks first), and writes the merged buckets once, into a hidden folder of the
table. They are then renamed into place. A folder that was written completely
but not yet moved is moved by the next upsert, so a failure in between is rolled
forward. Large buckets are split over several tasks and files.

Merge rule (D7): per key, the side with the later ``msg_tm`` wins and the
batch wins ties, so replaying or reordering batches cannot roll a row back.
``mode="one"`` keeps one row per key (ADT), ``mode="set"`` replaces the
key's whole set of rows (children hold several rows per encounter). Rows
without a key match nothing: all are kept.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.operators.cleanse import drop_update_columns, stamp_insert, stamp_update
from wardline.operators.latest import latest_one, latest_with_ties
from wardline.schemas import KEY
from wardline.sinks.tables import _fs, append_batch_rows, data_files, exists, read_property, write_property

BUCKET = "_bucket"
BUCKETS = 64
_STAGED = "_staged-"


def reduce_batch(batch: DataFrame, key: str = KEY, mode: str = "one",
                 order: tuple[str, ...] = ("msg_tm", "msg_nm")) -> DataFrame:
    """Latest state per key inside one batch: one winner, or every row at the max time; rows without a key all stay."""
    keyed, rest = batch.where(F.col(key).isNotNull()), batch.where(F.col(key).isNull())
    if mode == "one":
        return latest_one(keyed, [key], [c for c in order if c in batch.columns]).unionByName(rest)
    return latest_with_ties(keyed, [key], order[0]).unionByName(rest)


def bucket_of(key: str, columns: list[str], buckets: int) -> Column:
    """The key's bucket; rows without a key are spread by all of their columns."""
    spread = F.xxhash64(*[F.col(c) for c in columns])
    return F.pmod(F.when(F.col(key).isNull(), spread).otherwise(F.xxhash64(key)), F.lit(buckets)).cast("int")


def merge_states(target: DataFrame, updates: DataFrame, key: str = KEY, time_col: str = "msg_tm") -> DataFrame:
    """Per key keep the updates when their time is >= the target's, else the target rows.

    An updated key keeps its first insert stamp. Both sides' rows without a key are kept.
    """
    stamp = "row_insert_tsp"
    held = [F.max(time_col).alias("_t_max")] + ([F.min(stamp).alias("_first")] if stamp in target.columns else [])
    ours = target.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("_had"), *held)
    theirs = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(time_col).alias("_s_max"))
    wins = F.col("_t_max").isNull() | (F.col("_s_max") >= F.col("_t_max"))
    # keys of the batch that the table holds too, and which side wins each
    both = theirs.join(ours, key).select(key, F.coalesce(wins, F.lit(False)).alias("_new"), *(["_first"] if len(held) > 1 else []))
    stay = target.join(both.where("_new").select(key), key, "left_anti")
    come = updates.join(both, key, "left").where(F.col("_new").isNull() | F.col("_new"))
    if len(held) > 1:
        come = come.withColumn(stamp, F.coalesce("_first", stamp))
    return stay.select(*target.columns).unionByName(come.select(*target.columns))


def create_current(spark: SparkSession, path: str, schema: StructType, buckets: int = BUCKETS) -> bool:
    """An empty current-state table with its bucket count; False if there is one already."""
    if exists(spark, path):
        return False
    write_property(spark, path, "schema", schema.json())
    write_property(spark, path, "buckets", str(buckets))
    return True


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a current-state table, an empty one included."""
    return _read(spark, path).drop(BUCKET)


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType.fromJson(json.loads(read_property(spark, path, "schema"))).add(BUCKET, "integer")
    if not data_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.option("ignoreMissingFiles", "false").schema(schema).parquet(path)


def _move_in(spark: SparkSession, path: str) -> None:
    """Rename completely written buckets into the table; drop what was not written completely."""
    fs, root, jvm = _fs(spark, path)
    join = jvm.org.apache.hadoop.fs.Path
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith(_STAGED):
            continue
        if fs.exists(join(st.getPath(), "_SUCCESS")):
            aside = join(root, "_old-" + name.removeprefix(_STAGED))
            fs.mkdirs(aside)
            for b in fs.listStatus(st.getPath()):
                bucket = b.getPath().getName()
                if not b.isDirectory() or "=" not in bucket:
                    continue
                live = join(root, bucket)
                if fs.exists(live) and not fs.rename(live, join(aside, bucket)):
                    raise OSError(f"cannot move {live} aside")
                if not fs.rename(b.getPath(), live):
                    raise OSError(f"cannot move {b.getPath()} into the table")
            fs.delete(aside, True)
        fs.delete(st.getPath(), True)
    for st in fs.listStatus(root):
        if st.getPath().getName().startswith("_old-"):
            fs.delete(st.getPath(), True)


def upsert(spark: SparkSession, batch: DataFrame, path: str, key: str = KEY, mode: str = "one",
           buckets: int = BUCKETS) -> None:
    """K5: upsert ``batch`` into the current-state table at ``path``; ``buckets`` counts only when it makes the table."""
    reduced = stamp_update(stamp_insert(reduce_batch(batch.drop(BUCKET), key, mode)))
    create_current(spark, path, reduced.schema, buckets)
    _move_in(spark, path)
    n = int(read_property(spark, path, "buckets"))
    columns = StructType.fromJson(json.loads(read_property(spark, path, "schema"))).fieldNames()
    reduced = reduced.withColumn(BUCKET, bucket_of(key, [c for c in columns if c in batch.columns], n)).persist()
    try:
        touched = [r[0] for r in reduced.select(BUCKET).distinct().collect()]  # at most ``n`` values
        if not touched:
            return
        target = _read(spark, path).where(F.col(BUCKET).isin(touched))
        merged = merge_states(target, reduced.select(*target.columns), key)
        staged = f"{path.rstrip('/')}/{_STAGED}{uuid.uuid4().hex[:8]}"
        merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(staged)
        _move_in(spark, path)
    finally:
        reduced.unpersist()


def append_and_upsert(spark: SparkSession, batch: DataFrame, batch_id: int, history: str, current: str,
                      key: str = KEY, mode: str = "one", buckets: int = BUCKETS) -> None:
    """K7: every row appended to the history (idempotent per batch), latest state upserted."""
    cached = batch.persist()
    try:
        append_batch(cached, batch_id, history)
        upsert(spark, cached, current, key, mode, buckets)
    finally:
        cached.unpersist()


def append_batch(batch: DataFrame, batch_id: int, history: str) -> None:
    """History append that a retried batch overwrites instead of duplicating."""
    append_batch_rows(stamp_insert(drop_update_columns(batch)), batch_id, history)


def upsert_stream(df: DataFrame, path: str, checkpoint: str, key: str = KEY, mode: str = "one", trigger: dict | None = None,
                  buckets: int = BUCKETS):
    """K6: stream of batches upserted into ``path``."""
    spark = df.sparkSession
    w = df.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda b, i: upsert(spark, b, path, key, mode, buckets))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def append_and_upsert_stream(df: DataFrame, history: str, current: str, checkpoint: str, key: str = KEY,
                             mode: str = "one", trigger: dict | None = None, buckets: int = BUCKETS):
    """K8: stream wrapper of K7."""
    spark = df.sparkSession
    w = df.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda b, i: append_and_upsert(spark, b, i, history, current, key, mode, buckets))
    return w.trigger(**(trigger or {"availableNow": True})).start()
