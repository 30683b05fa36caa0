"""What must not be lost at the edges: late files, odd shapes, retries, rewrites under way."""

import os
import time

import pytest
from pyspark.sql import functions as F

from wardline.schemas import ADT_CURRENT
from wardline.session import scratch_path
from wardline.sinks import metered as MT
from wardline.sinks import tables as TB
from wardline.sinks import upsert as UP
from wardline.sinks import warehouse as WH
from wardline.sources import files as FS
from wardline.sources import tables as ST

STATE = "pat_enc_csn_id long, msg_tm timestamp, msg_nm string"


def states(spark, rows):
    return spark.createDataFrame(rows, "k long, t string, n string").select(
        F.col("k").alias("pat_enc_csn_id"), F.to_timestamp("t").alias("msg_tm"), F.col("n").alias("msg_nm"))


def keyed(df):
    return sorted(((r.pat_enc_csn_id, r.msg_nm) for r in df.collect()), key=str)


def test_files_of_any_age_are_read(spark):
    root = scratch_path(spark, "late")
    os.makedirs(f"{root}/in")

    def run():
        FS.read_text_named(spark, f"{root}/in").writeStream.format("parquet").option("checkpointLocation", f"{root}/ck") \
            .trigger(availableNow=True).start(f"{root}/out").awaitTermination()
        return {r.msg_nm for r in spark.read.parquet(f"{root}/out").collect()}

    open(f"{root}/in/new.xml", "w").write("n")
    assert run() == {"new.xml"}
    open(f"{root}/in/old.xml", "w").write("o")
    old = time.time() - 30 * 86400
    os.utime(f"{root}/in/old.xml", (old, old))
    assert run() == {"new.xml", "old.xml"}


def test_insert_select_wants_as_many_columns(spark):
    path, schema = scratch_path(spark, "arity"), states(spark, []).schema
    TB.ensure_table(spark, path, schema)
    for df in (spark.range(1), spark.range(1).selectExpr("id", "id a", "id b", "id c")):
        with pytest.raises(ValueError):
            TB.insert_select(df, path, schema)


def test_upsert_keeps_all_rows_without_a_key_and_its_bucket_count(spark):
    path = scratch_path(spark, "up")
    rows = [(i, "2024-01-01", f"a{i}") for i in range(20)] + [(None, "2024-01-01", f"n{i}") for i in range(3)]
    UP.upsert(spark, states(spark, rows), path, buckets=64)
    UP.upsert(spark, states(spark, [(i, "2024-01-02", f"b{i}") for i in range(10)] + [(None, "2024-01-02", "n9")]), path, buckets=16)
    want = [(i, f"b{i}" if i < 10 else f"a{i}") for i in range(20)] + [(None, f"n{i}") for i in (0, 1, 2, 9)]
    assert keyed(UP.read_current(spark, path)) == sorted(want, key=str)
    assert TB.read_property(spark, path, "buckets") == "64"


def test_upsert_into_created_tables_and_after_a_failure(spark):
    root = scratch_path(spark, "k15")
    path = TB.create_tables(spark, root, buckets=4)["adt_dtl"]
    assert UP.read_current(spark, path).count() == 0
    data = [f for f in ADT_CURRENT.fieldNames() if f not in ("row_insert_tsp", "insert_user_id", "row_updt_tsp", "update_user_id")]

    def batch(rows):
        return states(spark, rows).select(*[F.col(c) if c in ("pat_enc_csn_id", "msg_tm", "msg_nm")
                                            else F.lit(None).cast(ADT_CURRENT[c].dataType).alias(c) for c in data])

    UP.upsert(spark, batch([(1, "2024-01-01", "a"), (2, "2024-01-01", "a")]), path)
    # a writer that died after writing, before the renames: rolled forward by the next one
    left = f"{path}/_staged-dead"
    bucket = next(d for d in os.listdir(path) if d.startswith("_bucket="))
    rows = spark.read.parquet(f"{path}/{bucket}").withColumn("msg_nm", F.lit("rolled"))
    rows.write.parquet(f"{left}/{bucket}")
    open(f"{left}/_SUCCESS", "w").close()
    os.makedirs(f"{path}/_staged-unfinished/_bucket=0")
    before = keyed(UP.read_current(spark, path))
    UP.upsert(spark, batch([(77, "2024-01-01", "new")]), path)
    after = dict(keyed(UP.read_current(spark, path)))
    assert len(before) == 2 and set(after) == {1, 2, 77} and "rolled" in after.values()
    assert not [d for d in os.listdir(path) if d.startswith(("_staged", "_old"))]


def test_metrics_and_history_of_a_replayed_batch(spark):
    root = scratch_path(spark, "metrics")
    for _ in range(2):
        MT.append_with_metrics(spark, states(spark, [(1, "2024-01-01", "a")]), 5, f"{root}/t", "t", f"{root}/m")
    m = MT.read_metrics(spark, f"{root}/m").collect()
    assert [(r.table_name, r.batch_id, r.batch_rows) for r in m] == [("t", 5, 1)]
    assert spark.read.parquet(f"{root}/t").count() == 1


def test_compaction_folds_batches_splits_a_hot_stamp_and_keeps_replays_out(spark):
    path = scratch_path(spark, "fold")
    stamp = F.lit("2024-01-01").cast("timestamp")
    for i in range(4):
        TB.append_batch_rows(spark.range(i * 1000, i * 1000 + 1000).withColumn("row_insert_tsp", stamp), i, path)
    TB.compact(spark, path, files=8)
    parts = {d for d in os.listdir(path) if d.startswith("_batch_id")}
    assert parts == {"_batch_id=-1", "_batch_id=3"}
    assert len([f for f in os.listdir(f"{path}/_batch_id=-1") if f.endswith(".parquet")]) > 1
    assert not TB.append_batch_rows(spark.range(9).withColumn("row_insert_tsp", stamp), 1, path)  # folded already
    assert TB.append_batch_rows(spark.range(3000, 4000).withColumn("row_insert_tsp", stamp), 3, path)  # the newest replaces itself
    assert spark.read.parquet(path).select("id").distinct().count() == spark.read.parquet(path).count() == 4000


def test_a_tail_does_not_emit_rewritten_rows(spark):
    root = scratch_path(spark, "tail")
    schema = states(spark, []).schema

    def copy():
        WH.copy_stream(ST.tail_table(spark, f"{root}/t", schema), f"{root}/w", f"{root}/ck", fmt="parquet").awaitTermination()
        return spark.read.parquet(f"{root}/w").count()

    TB.append_batch_rows(states(spark, [(i, "2024-01-01", "a") for i in range(10)]), 0, f"{root}/t")
    assert copy() == 10
    TB.compact(spark, f"{root}/t", "msg_tm", keep_batches=0)
    assert copy() == 10
    TB.append_batch_rows(states(spark, [(99, "2024-01-01", "b")]), 1, f"{root}/t")
    assert copy() == 11


def test_marks_keep_a_replayed_batch_from_other_destinations(spark, monkeypatch):
    root, sent = scratch_path(spark, "marks"), []
    monkeypatch.setattr(WH, "write_warehouse", lambda df, *a: sent.append(df.count()))
    for batch in (0, 0, 1):
        WH.write_batch(spark.range(3), batch, "t", root)
    assert sent == [3, 3]


def test_a_rewrite_fails_rather_than_losing_rows_that_came_meanwhile(spark):
    path = scratch_path(spark, "swap")
    states(spark, [(1, "2024-01-01", "a")]).write.parquet(path)
    seen = TB.data_files(spark, path)
    staged = TB.stage(spark.read.parquet(path), path)
    states(spark, [(2, "2024-01-01", "b")]).write.mode("append").parquet(path)
    with pytest.raises(TB.ConcurrentWrite):
        TB.swap_in(spark, staged, path, seen)
    assert spark.read.parquet(path).count() == 2


def test_retention_swaps_no_table_if_one_was_written_to(spark, monkeypatch):
    from wardline.operators import retention as RT

    root = scratch_path(spark, "ret")
    master = spark.createDataFrame([(1, "2020-01-01"), (2, None)], "pat_enc_csn_id long, t string").select("pat_enc_csn_id", F.to_timestamp("t").alias("hosp_disch_time"))
    master.write.parquet(f"{root}/m")
    for c in ("a", "b"):
        spark.createDataFrame([(1,), (2,)], "pat_enc_csn_id long").write.parquet(f"{root}/{c}")
    stage, calls = TB.stage, []

    def stage_and_write(df, path, *a, **k):
        calls.append(path)
        out = stage(df, path, *a, **k)
        if path.endswith("/b"):  # an ingest appends while the job runs
            spark.createDataFrame([(2,)], "pat_enc_csn_id long").write.mode("append").parquet(path)
        return out

    monkeypatch.setattr(TB, "stage", stage_and_write)
    with pytest.raises(TB.ConcurrentWrite):
        RT.retention_job(spark, f"{root}/m", [f"{root}/a", f"{root}/b"], as_of="2024-01-01")
    assert [spark.read.parquet(f"{root}/{t}").count() for t in ("m", "a", "b")] == [2, 2, 3]
    monkeypatch.setattr(TB, "stage", stage)
    RT.retention_job(spark, f"{root}/m", [f"{root}/a", f"{root}/b"], as_of="2024-01-01")
    assert [spark.read.parquet(f"{root}/{t}").count() for t in ("m", "a", "b")] == [1, 1, 2]


def test_key_max_of_null_keys(spark):
    from wardline.operators.latest import key_max

    df = states(spark, [(1, "2024-01-01", "a"), (1, "2024-01-03", "b"), (None, "2024-01-02", "c")])
    got = {(r.msg_nm, r.max_time.day) for r in key_max(df, ["pat_enc_csn_id"]).collect()}
    assert got == {("a", 3), ("b", 3), ("c", 2)}
