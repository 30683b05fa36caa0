import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardline.operators import retention as RT
from wardline.session import scratch_path
from wardline.sinks import tables as TB
from wardline.sinks import upsert as UP

SCHEMA = "pat_enc_csn_id bigint, msg_tm timestamp, msg_nm string, v string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def state(spark, path):
    return sorted(((r["pat_enc_csn_id"], r["v"]) for r in UP.read_current(spark, path).collect()), key=str)


T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def test_upsert_guard_and_order_independence(spark):
    a = rows(spark, [(1, T1, "a", "old1"), (2, T3, "b", "new2"), (1, T2, "c", "mid1")])
    b = rows(spark, [(1, T3, "d", "new1"), (2, T1, "e", "old2"), (3, T2, "f", "only3"), (None, T1, "g", "nokey")])
    p1, p2 = scratch_path(spark, "u1"), scratch_path(spark, "u2")
    UP.upsert(spark, a, p1)
    UP.upsert(spark, b, p1)
    UP.upsert(spark, b, p2)
    UP.upsert(spark, a, p2)
    want = [(None, "nokey"), (1, "new1"), (2, "new2"), (3, "only3")]
    assert sorted(state(spark, p1), key=str) == sorted(want, key=str)
    assert sorted(state(spark, p2), key=str) == sorted(want, key=str)
    UP.upsert(spark, a, p1)  # replaying an old batch changes nothing but NULL keys
    assert {k for k, _ in state(spark, p1) if k is not None} == {1, 2, 3}
    assert sorted(v for k, v in state(spark, p1) if k is not None) == ["new1", "new2", "only3"]


def test_upsert_set_mode_replaces_whole_set(spark):
    p = scratch_path(spark, "uset")
    UP.upsert(spark, rows(spark, [(1, T1, "a", "x"), (1, T1, "a", "y")]), p, mode="set")
    UP.upsert(spark, rows(spark, [(1, T2, "b", "z")]), p, mode="set")
    assert state(spark, p) == [(1, "z")]
    UP.upsert(spark, rows(spark, [(1, T3, "c", "p"), (1, T3, "c", "q"), (1, T2, "c", "old")]), p, mode="set")
    assert state(spark, p) == [(1, "p"), (1, "q")]


def test_history_append_is_idempotent_per_batch(spark):
    h = scratch_path(spark, "hist")
    df = rows(spark, [(1, T1, "a", "x"), (2, T2, "b", "y")])
    UP.append_batch(df, 7, h)
    UP.append_batch(df, 7, h)
    UP.append_batch(df, 8, h)
    assert spark.read.parquet(h).count() == 4


def test_retention_idempotent_and_nulls(spark):
    m = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, None), (2, None), (None, dt.datetime(2020, 1, 1)),
                               (3, dt.datetime(2024, 1, 9))], "pat_enc_csn_id bigint, hosp_disch_time timestamp")
    once = RT.prune_master(m, 2, "2024-01-10")
    twice = RT.prune_master(once, 2, "2024-01-10")
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)
    assert sorted(str(r[0]) for r in once.collect()) == ["2", "3", "None"]
    child = spark.createDataFrame([(1,), (2,), (None,), (4,)], "pat_enc_csn_id bigint")
    assert [r[0] for r in RT.prune_child(child, once).collect()] == [2]


def test_staged_overwrite_and_compact(spark):
    p = scratch_path(spark, "tbl")
    df = spark.range(100).select(F.col("id"), (F.col("id") * 7 % 13).alias("row_insert_tsp"))
    assert TB.ensure_table(spark, p, df.schema) and not TB.ensure_table(spark, p, df.schema)
    df.write.mode("append").parquet(p)
    TB.overwrite_table(spark, spark.read.parquet(p).where("id < 50"), p)
    assert spark.read.parquet(p).count() == 50
    TB.compact(spark, p, "row_insert_tsp", files=3)
    parts = spark.read.parquet(p).withColumn("f", F.input_file_name()).groupBy("f") \
        .agg(F.min("row_insert_tsp").alias("lo"), F.max("row_insert_tsp").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(parts, parts[1:]))  # ranges do not overlap
    assert spark.read.parquet(p).count() == 50


def test_retention_job_prunes_children_and_master(spark):
    root = scratch_path(spark, "rjob")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)), (2, None, dt.datetime(2024, 1, 2))],
                          "pat_enc_csn_id bigint, hosp_disch_time timestamp, row_insert_tsp timestamp") \
        .write.parquet(f"{root}/m")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "orphan")], "pat_enc_csn_id bigint, x string").write.parquet(f"{root}/c")
    RT.retention_job(spark, f"{root}/m", [f"{root}/c"], 2, "2024-01-10")
    assert [r[0] for r in spark.read.parquet(f"{root}/m").collect()] == [2]
    assert [r[0] for r in spark.read.parquet(f"{root}/c").collect()] == [2]


def test_rewrites_keep_batch_partitioning(spark):
    root = scratch_path(spark, "histpart")
    h = f"{root}/h"
    df = rows(spark, [(1, T1, "a", "x"), (2, T2, "b", "y")])
    UP.append_batch(df, 0, h)
    m = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None)], "pat_enc_csn_id bigint, hosp_disch_time timestamp")
    m.write.parquet(f"{root}/m")
    RT.retention_job(spark, f"{root}/m", [h], 2, "2024-01-10", cluster_by="row_insert_tsp")
    assert TB.partition_columns(spark, h) == ["_batch_id"]
    UP.append_batch(df, 1, h)  # appending after the rewrite still works
    assert sorted(r[0] for r in spark.read.parquet(h).select("pat_enc_csn_id").collect()) == [1, 2, 2]


def files_and_times(path):
    import pathlib

    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}


def local(path):
    return path.removeprefix("file://").replace("file:", "")


def clinic(spark, root):
    """A master and a child of ten files each, one encounter a file."""
    keys = [(k, dt.datetime(2024, 1, 1) if k in (3, 7) else None, dt.datetime(2024, 1, k + 1)) for k in range(10)]
    master = spark.createDataFrame(keys, "pat_enc_csn_id bigint, hosp_disch_time timestamp, row_insert_tsp timestamp")
    master.withColumn("f", F.col("pat_enc_csn_id")).repartition("f").write.partitionBy("f").parquet(f"{root}/m")
    child = spark.createDataFrame([(k, f"c{k}") for k in range(11)], "pat_enc_csn_id bigint, x string")
    child.withColumn("f", F.col("pat_enc_csn_id")).repartition("f").write.partitionBy("f").parquet(f"{root}/c")


def keys_of(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("pat_enc_csn_id").collect())


def test_retention_rewrites_touched_files_only(spark):
    root = scratch_path(spark, "touched")
    clinic(spark, root)
    before = {t: files_and_times(local(f"{root}/{t}")) for t in "mc"}
    done = RT.retention_job(spark, f"{root}/m", [f"{root}/c"], 2, "2024-01-10")
    assert done == {f"{root}/m": 2, f"{root}/c": 3}  # the child's orphan, too
    assert keys_of(spark, f"{root}/m") == keys_of(spark, f"{root}/c") == [0, 1, 2, 4, 5, 6, 8, 9]
    for t in "mc":
        after = files_and_times(local(f"{root}/{t}"))
        assert {f: time for f, time in before[t].items() if f.split("/")[0] not in ("f=3", "f=7", "f=10")}.items() <= after.items()
    assert RT.retention_job(spark, f"{root}/m", [f"{root}/c"], 2, "2024-01-10") == {f"{root}/m": 0, f"{root}/c": 0}


def test_a_rewrite_that_was_cut_off_is_finished_or_undone(spark, monkeypatch):
    for at in ("aside", "half", "swapped"):
        root = scratch_path(spark, f"cut-{at}")
        clinic(spark, root)
        fs, old, jvm = TB._fs(spark, f"{root}/m")

        def crash(spark, path, at=at, fs=fs, jvm=jvm):
            import json

            plan = json.loads(TB._read_text(spark, f"{path}.journal"))
            path_of = jvm.org.apache.hadoop.fs.Path
            if at == "aside":  # before the table was moved
                fs.rename(path_of(plan["old"]), path_of(path))
            elif at == "half":
                name = plan["kept"][0]
                fs.mkdirs(path_of(plan["staged"], name).getParent())
                fs.rename(path_of(plan["old"], name), path_of(plan["staged"], name))
            else:
                for name in plan["kept"]:
                    fs.mkdirs(path_of(plan["staged"], name).getParent())
                    fs.rename(path_of(plan["old"], name), path_of(plan["staged"], name))
                fs.rename(path_of(plan["staged"]), path_of(path))
            raise RuntimeError("killed")

        real = TB.recover
        monkeypatch.setattr(TB, "recover", lambda spark, path: crash(spark, path) if TB.exists(spark, f"{path}.journal") else None)
        try:
            RT.retention_job(spark, f"{root}/m", [], 2, "2024-01-10")
            raise AssertionError("it was not cut off")
        except RuntimeError:
            pass
        monkeypatch.setattr(TB, "recover", real)
        TB.recover(spark, f"{root}/m")
        want = list(range(10)) if at == "aside" else [0, 1, 2, 4, 5, 6, 8, 9]
        assert keys_of(spark, f"{root}/m") == want
        assert not any(TB.exists(spark, f"{root}/m{s}") for s in (".journal",))
        RT.retention_job(spark, f"{root}/m", [], 2, "2024-01-10")
        assert keys_of(spark, f"{root}/m") == [0, 1, 2, 4, 5, 6, 8, 9]


def test_tail_reads_files_of_any_writer(spark):
    from wardline.sources.tables import tail_table
    root = scratch_path(spark, "tail")
    one = spark.createDataFrame([(1,)], "a bigint")
    for name in ("part-1", "f", "fold", "folded", "foldedx", "data", "0", "folded-1"):
        one.coalesce(1).write.parquet(f"{root}/w/{name}")
        fs, _, jvm = TB._fs(spark, root)
        p = jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(p(f"{root}/t"))
        src = next(f for f in TB.data_files(spark, f"{root}/w/{name}"))
        fs.rename(p(src), p(f"{root}/t/{name}"))
    q = tail_table(spark, f"{root}/t", one.schema).writeStream.format("parquet").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start(f"{root}/out")
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 7


def test_files_are_told_by_a_number_each(spark):
    path = scratch_path(spark, "with % and space")
    rows = spark.createDataFrame([(i, f"a b%2{i % 3}=ü") for i in range(9)], "k long, part string")
    rows.repartition(3).write.partitionBy("part").parquet(path)
    files = TB.data_files(spark, path)
    assert len(files) > 2
    told = TB.with_file(TB.read_files(spark, path, files), "k", "part")
    assert dict(told.dtypes)[TB.FILE] == "bigint"  # goes through a shuffle with every row
    assert TB.files_of(told, files) == files
    one = TB.files_of(told.where("k = 4"), files)
    assert len(one) == 1 and [r.k for r in TB.read_files(spark, path, one).where("k = 4").collect()] == [4]
    assert TB.files_of(told.where("k < 0"), files) == set()
    with pytest.raises(ValueError):
        TB.files_of(told, one)


def test_key_fates_are_the_expired_and_the_kept_keys(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (1, None), (2, dt.datetime(2024, 1, 9)), (3, None), (None, dt.datetime(2024, 1, 1)), (4, dt.datetime(2024, 1, 8)), (5, dt.datetime(2024, 1, 7, 23))]
    m = spark.createDataFrame(rows, "pat_enc_csn_id long, hosp_disch_time timestamp_ntz")
    fates = {r[0]: r[1] for r in RT.key_fates(m, 2, "2024-01-10").collect()}
    expired = {r[0] for r in RT.expired_keys(m, 2, "2024-01-10").collect()}
    kept = {r[0] for r in RT.prune_master(m, 2, "2024-01-10").collect()}
    assert fates == {k: k in expired for k in (1, 2, 3, 4, 5)} and {k for k, gone in fates.items() if not gone} == kept - {None}
