"""Stream wrappers of the sinks (K1, K2/K4, K6, K8, K10, K11, K15) and W1."""

import datetime as dt

from pyspark.sql import functions as F

from wardline.operators.latest import key_max
from wardline.schemas import CURRENT, HISTORY
from wardline.session import scratch_path
from wardline.sinks import metered as M
from wardline.sinks import tables as TB
from wardline.sinks import upsert as UP
from wardline.sinks import warehouse as WH

SF = "/root/testdata/sf0.001"
SCHEMA = "pat_enc_csn_id bigint, msg_tm timestamp_ntz, msg_nm string, trigger_evnt string"


def _drop(spark):
    root = scratch_path(spark, "ssinks")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.select(F.col("user_id").alias("pat_enc_csn_id"), F.col("ts").alias("msg_tm"),
              F.concat(F.lit("evt-"), F.col("event_id")).alias("msg_nm"), F.col("event_type").alias("trigger_evnt")) \
        .repartition(3).write.parquet(f"{root}/drop")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/drop")
    return root, ev, stream


def test_stream_sinks(spark):
    root, ev, stream = _drop(spark)
    n, users = ev.count(), ev.select("user_id").distinct().count()
    M.append_stream(stream, f"{root}/k1", f"{root}/c1").awaitTermination()
    assert spark.read.parquet(f"{root}/k1").count() == n
    M.metered_stream(stream, f"{root}/k2", "t", f"{root}/c2", f"{root}/m2", wait=True)
    assert spark.read.parquet(f"{root}/m2").agg(F.sum("batch_rows")).first()[0] == n
    UP.upsert_stream(stream, f"{root}/k6", f"{root}/c6").awaitTermination()
    cur = UP.read_current(spark, f"{root}/k6")
    assert cur.count() == users
    latest = ev.groupBy("user_id").agg(F.max("ts").alias("t"))
    assert cur.join(latest, (cur.pat_enc_csn_id == latest.user_id) & (cur.msg_tm == latest.t)).count() == users
    UP.append_and_upsert_stream(stream, f"{root}/k8h", f"{root}/k8c", f"{root}/c8").awaitTermination()
    assert spark.read.parquet(f"{root}/k8h").count() == n and UP.read_current(spark, f"{root}/k8c").count() == users
    WH.copy_stream(stream, f"{root}/k11", f"{root}/c11", fmt="parquet").awaitTermination()
    assert spark.read.parquet(f"{root}/k11").count() == n


def test_latest_to_warehouse_keeps_ties_and_key_max(spark):
    root = scratch_path(spark, "k10")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, t1, "a"), (1, t2, "b"), (1, t2, "c"), (2, t1, "d"), (3, None, "e")],
                               "pat_enc_csn_id bigint, msg_tm timestamp_ntz, msg_nm string")
    WH.latest_to_warehouse(df, f"{root}/wh", fmt="parquet")
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/wh").select("msg_nm").collect()) == ["b", "c", "d"]
    mx = {r["msg_nm"]: r["max_time"] for r in key_max(df, ["pat_enc_csn_id"]).collect()}
    assert mx["a"] == t2 and mx["d"] == t1 and mx["e"] is None


def test_create_tables(spark):
    root = scratch_path(spark, "k15")
    paths = TB.create_tables(spark, root)
    assert set(paths) == set(HISTORY) | set(CURRENT)
    for name, path in paths.items():
        read = TB.read_history if name in HISTORY else UP.read_current
        names = [c for c in read(spark, path).schema.fieldNames() if c != TB.BATCH]
        assert names == {**HISTORY, **CURRENT}[name].fieldNames()


def test_latest_to_warehouse_reduces_each_of_two_batches(spark, monkeypatch):
    from wardline.operators.latest import latest_with_ties
    from wardline.plans import queries as Q

    roots = []
    monkeypatch.setattr(Q, "scratch_path", lambda s, name: roots.append(scratch_path(s, name)) or roots[-1])
    Q.latest_to_warehouse(spark, SF).count()
    root = next(r for r in roots if "latest" in r.rsplit("/", 1)[-1])
    got = spark.read.parquet(f"{root}/warehouse")
    assert sorted(r[0] for r in got.select(TB.BATCH).distinct().collect()) == [0, 1]
    for batch, half in enumerate(Q._halves(spark, SF)):
        want = latest_with_ties(half.withColumn("msg_tm", F.date_trunc("hour", "msg_tm")), ["pat_enc_csn_id"])
        mine = got.where(F.col(TB.BATCH) == batch).select(*want.columns)
        assert mine.count() > 0 and mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0
