from pyspark.sql import functions as F

from wardline.operators import extract as E
from wardline.plans import carriers as C
from wardline.session import scratch_path
from wardline.sources import broker as BR
from wardline.streaming import ingest as IN

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    msgs = C.hl7_from_events(ev)
    root = scratch_path(spark, "stream")
    recs = msgs.select(F.col("text").cast("binary").alias("body"), F.lit("0").alias("partition"),
                       F.monotonically_increasing_id().alias("sequenceNumber"), F.col("msg_nm").alias("offset"))
    recs.repartition(4).write.parquet(f"{root}/drop")
    schema = "body binary, partition string, sequenceNumber bigint, offset string"
    paths = {t: f"{root}/{t}" for t in IN.TABLES}

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/drop")
        IN.ingest(BR.broker_messages(s), E.HL7, paths, f"{root}/ckpt", metrics=f"{root}/metrics").awaitTermination()

    run()
    got = spark.read.parquet(paths["adt_hist"])
    batch = E.adt_detail(E.parse_hl7(msgs))
    assert got.count() == batch.count() == ev.count()
    cols = ["bod_id", "msg_tm", "pat_enc_csn_id", "acuity_level_abbr", "hosp_disch_time"]
    assert sorted(got.select(*cols).collect(), key=str) == sorted(batch.select(*cols).collect(), key=str)
    assert got.select("_batch_id").distinct().count() == 4
    run()  # same checkpoint: nothing new
    assert spark.read.parquet(paths["adt_hist"]).count() == ev.count()
    m = spark.read.parquet(f"{root}/metrics").where("table_name = 'adt_hist'")
    assert m.agg(F.sum("batch_rows")).first()[0] == ev.count()


def test_replayed_batch_overwrites_itself(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    msgs = C.hl7_from_events(ev)
    root = scratch_path(spark, "replay")
    paths = {t: f"{root}/{t}" for t in IN.TABLES}
    IN.process_batch(spark, msgs, 3, E.HL7, paths)
    IN.process_batch(spark, msgs, 3, E.HL7, paths)
    assert spark.read.parquet(paths["adt_hist"]).count() == ev.count()
