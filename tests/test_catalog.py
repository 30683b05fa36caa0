"""Catalog tables by name, bucketed joins, staged loads, committed batches, state in the stream, live metrics."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from wardline import jobs as JB
from wardline.operators import retention as RT
from wardline.plans import carriers as C
from wardline.schemas import CURRENT, HISTORY
from wardline.session import scratch_path
from wardline.sinks import catalog as CT
from wardline.sinks import tables as TB
from wardline.sinks import upsert as UP
from wardline.sinks import warehouse as WH
from wardline.sources import tables as ST
from wardline.streaming import ingest as IN
from wardline.streaming import live as LV
from wardline.streaming import state as WN


@pytest.fixture
def database(spark):
    name = f"wardline_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_tables_by_name(spark, database):
    place = scratch_path(spark, "db")
    names = CT.create_catalog(spark, database, location=place)
    assert {n.split(".")[1] for n in names} == {*HISTORY, *CURRENT}
    for n in names:
        assert [(f.name, f.dataType) for f in spark.table(n).schema] == [(f.name, f.dataType) for f in {**HISTORY, **CURRENT}[n.split(".")[1]]]
    er = f"{database}.encntr_er_complnt_hist"
    CT.insert_named(spark.createDataFrame([(1, "cut")], "pat_enc_csn_id bigint, er_complaint string"), er)
    row = spark.table(er).first()
    assert row.row_insert_tsp is not None and row.insert_user_id and row.msg_src is None
    CT.create_catalog(spark, database)  # again: what holds rows stays
    assert spark.table(er).count() == 1
    CT.insert_select(spark.createDataFrame([("S", dt.datetime(2024, 1, 1), "7", "ache", None, "u")], "a string, b timestamp, c string, d string, e timestamp, f string"), er)
    assert {(r.pat_enc_csn_id, r.er_complaint) for r in spark.table(er).collect()} == {(1, "cut"), (7, "ache")}
    with pytest.raises(ValueError):
        CT.insert_select(spark.createDataFrame([(1,)], "a bigint"), er)
    CT.truncate(spark, [er])
    assert spark.table(er).count() == 0 and spark.table(er).columns == HISTORY["encntr_er_complnt_hist"].fieldNames()


def exchanges(df):
    """Names of the plan's shuffles below its joins."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"\bExchange \w+", plan)


def test_bucketed_joins_shuffle_nothing(spark, database):
    CT.create_catalog(spark, database, buckets=4, location=scratch_path(spark, "db"))
    rows = spark.range(200).select(F.col("id").alias("pat_enc_csn_id"), F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).cast("timestamp").alias("hosp_disch_time"))
    CT.insert_named(rows, f"{database}.adt_hist")
    CT.insert_named(rows.select("pat_enc_csn_id", F.lit("x").alias("dx_name")), f"{database}.encntr_dx_hist")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables of real size
    try:
        master, child = spark.table(f"{database}.adt_hist"), spark.table(f"{database}.encntr_dx_hist")
        kept = RT.prune_master(master, 2, "2024-02-01")
        left = RT.prune_child(child, kept)
        assert not exchanges(left) and "SortMergeJoin" in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == kept.count() == 133
        merged = child.select("pat_enc_csn_id", "dx_name").join(master.select("pat_enc_csn_id", "hosp_disch_time"), "pat_enc_csn_id", "left")  # J6's read
        assert not exchanges(merged)
        assert exchanges(RT.prune_child(child.repartition(3), kept))  # the probe sees a shuffle where there is one
        CT.retention(spark, database, 2, "2024-02-01", buckets=4)
        assert not exchanges(RT.prune_child(spark.table(f"{database}.encntr_dx_hist"), spark.table(f"{database}.adt_hist")))  # buckets stay
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.table(f"{database}.adt_hist").count() == spark.table(f"{database}.encntr_dx_hist").count() == 133


def test_a_load_cut_off_between_its_steps(spark, monkeypatch):
    root = scratch_path(spark, "load")
    rows = spark.range(100).select(F.col("id").alias("pat_enc_csn_id")).repartition(4)
    table, marks = f"{root}/t", f"{root}/m"

    def held():
        return sorted(r[0] for r in spark.read.parquet(table).select("pat_enc_csn_id").collect())

    WH.stage_batch(rows, 0, marks)
    WH.load_batch(spark, 0, table, marks, "parquet", only=1)  # one file of four, no mark
    assert 0 < len(held()) < 100
    WH.load_batch(spark, 0, table, marks, "parquet", only=4)  # all files, no mark
    assert held() == list(range(100))
    monkeypatch.setattr(WH, "FILE_FORMATS", ())  # a destination without folders
    WH.write_batch(rows, 0, table, marks, "parquet")  # the stream's replay
    assert held() == list(range(100)) and TB.read_property(spark, marks, "0") == "loaded" and not TB.exists(spark, f"{marks}/staged/0")
    WH.write_batch(rows, 0, table, marks, "parquet")
    WH.write_batch(rows, 1, table, marks, "parquet")
    assert held() == sorted([*range(100)] * 2)


def test_a_batch_cut_off_between_tables_shows_no_row(spark, monkeypatch):
    root = scratch_path(spark, "commit")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(40)
    msgs = C.hl7_from_events(events)
    paths, real, done = JB.paths(root), IN.append_with_metrics, []

    def dies_after_two(spark, df, batch_id, path, name, *rest):
        if len(done) >= 2:
            raise RuntimeError("killed")
        done.append(name)
        return real(spark, df, batch_id, path, name, *rest)

    def run(batch_id):
        return IN.process_batch(spark, msgs, batch_id, "hl7", paths, commits=f"{root}/commits")

    run(0)
    monkeypatch.setattr(IN, "append_with_metrics", dies_after_two)
    with pytest.raises(RuntimeError):
        run(1)
    monkeypatch.setattr(IN, "append_with_metrics", real)
    assert spark.read.parquet(paths["adt_hist"]).count() == 80  # the half batch is there
    assert JB.read_committed(spark, root, "adt_hist").count() == 40
    run(1)  # the replay
    assert JB.read_committed(spark, root, "adt_hist").count() == 80
    TB.compact(spark, paths["adt_hist"], "msg_tm")
    assert JB.read_committed(spark, root, "adt_hist").count() == 80


def test_state_emits_only_changed_keys(spark):
    root = scratch_path(spark, "winners")
    schema = "pat_enc_csn_id bigint, msg_tm timestamp, msg_nm string, v string"
    day = [dt.datetime(2024, 1, d + 1) for d in range(6)]
    batches = [[(1, day[1], "a", "one"), (1, day[0], "b", "zero"), (2, day[4], "c", "two"), (None, day[0], "n", "none")],
               [(1, day[0], "z", "late"), (2, day[5], "d", "newer"), (2, day[5], "c", "less")], [(1, day[1], "a", "again"), (3, None, "e", "no time")]]
    got = []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in")
        seen = []

        def put(b, _, seen=seen):
            seen += [(r.pat_enc_csn_id, r.v) for r in b.collect()]
            UP.upsert(b.sparkSession, b, f"{root}/current")

        WN.winners_stream(ST.tail_table(spark, f"{root}/in", spark.createDataFrame([], schema).schema), f"{root}/ck", put).awaitTermination()
        got.append(sorted(seen))
    assert got == [[(1, "one"), (2, "two")], [(2, "newer")], [(3, "no time")]]
    assert {(r.pat_enc_csn_id, r.v) for r in UP.read_current(spark, f"{root}/current").collect()} >= {(1, "one"), (2, "newer")}


def test_live_metrics_on_a_running_trigger(spark):
    root = scratch_path(spark, "live")
    rows = spark.range(30).select(F.col("id").alias("pat_enc_csn_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("msg_tm"))
    rows.repartition(3).write.parquet(f"{root}/in")
    heard = LV.LiveMetrics(spark)
    try:
        q = LV.live_append(ST.tail_table(spark, f"{root}/in", rows.schema, 1), f"{root}/out", "adt_hist", f"{root}/ck", {"processingTime": "1 second"})
        q.processAllAvailable()
        assert q.isActive  # it goes on until it is stopped
        rows.write.mode("append").parquet(f"{root}/in")
        q.processAllAvailable()
        q.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        noted = heard.rows().collect()
    finally:
        heard.close()
    assert not q.isActive and q.exception() is None
    assert sum(r.batch_rows for r in noted) == spark.read.parquet(f"{root}/out").count() == 60
    assert len(noted) > 3 and max(r.latest_msg_tm for r in noted) == rows.agg(F.max("msg_tm")).first()[0]
