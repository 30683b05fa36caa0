"""The XML drop: how much of it lies on disk at a time, and what it is read by."""

from pyspark.sql import functions as F

from wardline import jobs as JB
from wardline.operators import extract as E
from wardline.plans import carriers as C
from wardline.plans import queries as Q


def test_the_drop_comes_in_rounds_and_goes(spark, monkeypatch, tmp_path):
    kind = F.element_at(F.array(*[F.lit(k) for k in C.EVENT_TRIGGERS]), (F.col("id") % 5 + 1).cast("int"))
    events = spark.range(1500).select(F.when(F.col("id") != 3, F.col("id")).alias("event_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts"),
                                      (F.col("id") % 11).alias("user_id"), kind.alias("event_type"), (F.col("id") % 97).cast("double").alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    seen, ingest = [], JB.ingest_xml

    def counted(spark, drop, root, **kw):
        seen.append((drop, spark.read.text(drop, lineSep="\n").where(F.col("value").contains("<ns0:HL7MessageEnvelope")).count()))
        return ingest(spark, drop, root, **kw)

    monkeypatch.setattr(JB, "ingest_xml", counted)
    monkeypatch.setattr(Q, "EVENTS_PER_ROUND", 600, raising=False)
    rows = Q.stream_xml_files(spark, str(tmp_path))
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    assert len(seen) > 1 and sum(n for _, n in seen) == events.count() and max(n for _, n in seen) < 0.8 * events.count()
    assert not Q.TB.exists(spark, seen[0][0])
    want = Q.portable(E.adt_detail(Q._accepted(Q.land(spark, C.xml_from_events(events), "whole"), E.XML), E.XML).drop("msg_nm"))
    assert sorted(map(str, rows.drop("named_by_file").collect())) == sorted(map(str, want.collect()))
    assert rows.where(~F.col("named_by_file")).count() == 0


def test_many_files_are_parsed_where_they_are_read(spark):
    files = spark.createDataFrame([("a" + E.xmlmsg.BATCH_DELIMITER + "\nb", "f")], "text string, msg_nm string")
    plans = [E.explode_batches(files, **kw) for kw in ({}, {"spread": False})]
    assert ["Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in plans] == [True, False]
    assert [sorted(map(str, p.collect())) for p in plans][0] == sorted(map(str, plans[1].collect()))
