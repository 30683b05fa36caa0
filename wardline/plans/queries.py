"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Instants leave as TIMESTAMP_NTZ holding their UTC wall clock, so results
compare with SQL engines that have no session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from wardline.functions import hl7
from wardline.functions import xmlmsg as XM
from wardline.functions.timeparse import utc_ntz
from wardline.operators import cleanse as CL
from wardline.operators import extract as E
from wardline.operators import latest as LT
from wardline.operators import flatten as FL
from wardline.operators import retention as RT
from wardline.operators import segments as SG
from wardline import jobs as JB
from wardline.plans import carriers as C
from wardline.plans import seed_roles as SR
from wardline.schemas import ADT_HIST
from wardline.session import scratch_path
from wardline.sinks import catalog as CT
from wardline.sinks import metered as MT
from wardline.sinks import tables as TB
from wardline.sinks import upsert as UP
from wardline.sinks import warehouse as WH
from wardline.sources import files as FS
from wardline.sources import tables as ST
from wardline.streaming import live as LV
from wardline.streaming import state as WN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a scan that one task renders at most, about.
ROWS_PER_TASK = 100_000


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin a table scan that has fewer partitions than the cluster has cores, or
    than its rows ask for: tables are cut by their bytes, and a few bytes of a row become a
    message. Only for scans: their rows are counted from the files' footers, and the
    partition count of a plan with a shuffle is only known by running it."""
    par = scan.sparkSession.sparkContext.defaultParallelism
    par = max(par, -(-scan.count() // ROWS_PER_TASK))
    return scan.repartition(par) if scan.rdd.getNumPartitions() < par else scan


#: Messages in a landed file: small enough that a few partitions still make many readable files.
MESSAGES_PER_FILE = 5_000


def land(spark: SparkSession, msgs: DataFrame, name: str) -> DataFrame:
    """Writes rendered messages to the shared folder and reads them back, as a message
    drop would deliver them. Parsing then starts from stored text, and the optimizer
    cannot fold the rendering into every consumer. Files are cut by rows, so the
    reading side is as parallel as the data allow."""
    path = scratch_path(spark, name)
    msgs.write.option("maxRecordsPerFile", MESSAGES_PER_FILE).parquet(path)
    return spark.read.parquet(path)


def portable(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock NTZ, other columns untouched."""
    return df.select(*[utc_ntz(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _accepted(msgs: DataFrame, fmt: str, segments: dict | None = None) -> DataFrame:
    parsed = E.parse(msgs, fmt, segments=segments)
    good, _ = E.split_valid(parsed, fmt)
    return good


# ------------------------------------------------------------------ HL7


def _hl7_events(spark, d):
    return land(spark, C.hl7_from_events(spread(table(spark, d, "events"))), "hl7-events")


def hl7_adt_detail(spark, d):
    return portable(E.adt_detail(_accepted(_hl7_events(spark, d), E.HL7)))


def hl7_event_times(spark, d):
    adt = E.adt_detail(_accepted(_hl7_events(spark, d), E.HL7))
    return portable(adt.select("msg_nm", "trigger_evnt", "adt_arrival_time", "hosp_admsn_time", "hosp_disch_time"))


def _hl7_orders(spark, d):
    msgs = land(spark, C.hl7_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem")), "hl7-orders")
    return _accepted(msgs, E.HL7)


def hl7_dx(spark, d):
    return portable(E.encounter_dx(_hl7_orders(spark, d), E.HL7))


def hl7_visit_reason(spark, d):
    return portable(E.visit_reason(_hl7_orders(spark, d), E.HL7))


def hl7_er_complaint(spark, d):
    return portable(E.er_complaint(_hl7_orders(spark, d), E.HL7))


def hl7_acuity(spark, d):
    return E.adt_detail(_hl7_orders(spark, d), E.HL7).select("msg_nm", "acuity_level_abbr")


def hl7_mrn_first_repetition(spark, d):
    msgs = land(spark, C.hl7_from_customers(spread(table(spark, d, "customer"))), "hl7-customers")
    return E.adt_detail(_accepted(msgs, E.HL7), E.HL7) \
        .select("msg_nm", "pat_mrn_id")


def hl7_reject_split(spark, d):
    msgs = land(spark, C.damage_events(C.hl7_from_events(spread(table(spark, d, "events")), keep=("event_type", "value"))), "hl7-damaged")
    return E.with_validity(msgs, E.HL7).select("msg_nm", "reject_reason")


def hl7_foreign_separators(spark, d):
    """Feeds with separators of their own, escaped text in every one of them."""
    msgs = land(spark, C.foreign_events(spread(table(spark, d, "events"))), "hl7-foreign")
    return portable(E.adt_detail(_accepted(msgs, E.HL7)))


def hl7_by_address(spark, d):
    """The long segment table of the event messages, met by a table of field addresses."""
    return portable(SG.adt_by_address(_hl7_events(spark, d).where(hl7.is_valid(F.col("text"))), SG.adt_addresses(spark)))


def hl7_segment_table(spark, d):
    """Every repetition and component of the feeds' messages as a row, decoded; counted by address."""
    msgs = land(spark, C.foreign_events(spread(table(spark, d, "events"))), "hl7-segments")
    rows = SG.segment_table(msgs).where("component > 0")
    at = ["segment", "field", "repetition", "component"]
    # by value first, which is counted in a hash table: a least text beside it would have every row sorted
    values = rows.groupBy(*at, "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy(*at).agg(F.sum("n").alias("n"), F.count("value").alias("n_values"), F.min("value").alias("least"))


# ------------------------------------------------------------------ XML


def xml_adt_detail(spark, d):
    msgs = land(spark, C.xml_from_events(spread(table(spark, d, "events"))), "xml-events")
    return portable(E.adt_detail(_accepted(msgs, E.XML), E.XML))


def _xml_orders(spark, d, segments):
    msgs = land(spark, C.xml_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem")), "xml-orders")
    return _accepted(msgs, E.XML, segments)


def xml_dx(spark, d):
    return portable(E.encounter_dx(_xml_orders(spark, d, XM.DX_ONLY), E.XML))


def xml_visit_reason(spark, d):
    return portable(E.visit_reason(_xml_orders(spark, d, XM.VISIT_REASON_ONLY), E.XML))


def xml_er_complaint(spark, d):
    return portable(E.er_complaint(_xml_orders(spark, d, XM.ER_COMPLAINT_ONLY), E.XML))


def xml_acuity(spark, d):
    columns = ("msg_nm", "acuity_level_abbr")
    return E.adt_detail(_xml_orders(spark, d, XM.ACUITY_ONLY), E.XML, columns=columns).select(*columns)


def split_batched_files(spark, d):
    files = land(spark, C.batch_documents(table(spark, d, "documents")), "batched-files")
    return E.explode_batches(files).select("file_id", "part_no", "text")


QUERIES = {
    "hl7_adt_detail": hl7_adt_detail,
    "hl7_event_times": hl7_event_times,
    "hl7_dx": hl7_dx,
    "hl7_visit_reason": hl7_visit_reason,
    "hl7_er_complaint": hl7_er_complaint,
    "hl7_acuity": hl7_acuity,
    "hl7_mrn_first_repetition": hl7_mrn_first_repetition,
    "hl7_reject_split": hl7_reject_split,
    "hl7_foreign_separators": hl7_foreign_separators,
    "hl7_by_address": hl7_by_address,
    "hl7_segment_table": hl7_segment_table,
    "xml_adt_detail": xml_adt_detail,
    "xml_dx": xml_dx,
    "xml_visit_reason": xml_visit_reason,
    "xml_er_complaint": xml_er_complaint,
    "xml_acuity": xml_acuity,
    "split_batched_files": split_batched_files,
}


# ------------------------------------------------------------------ relational


# Fixed query parameters of the registered retention check.
RETENTION_AS_OF = "1996-01-01"
RETENTION_DAYS = 2
RETENTION_BUCKETS = 16


def latest_per_key_ties(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("ts_hour"))
    return LT.latest_with_ties(ev, ["user_id"], "ts_hour")


def latest_row_number(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity")
    return LT.latest_one(li, ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_quantity"])


def _retention_master(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("pat_enc_csn_id"), "o_orderkey",
                    F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("hosp_disch_time"))


def retention_master(spark, d):
    return RT.prune_master(_retention_master(spark, d), RETENTION_DAYS, RETENTION_AS_OF)


def retention_child(spark, d):
    kept = RT.prune_master(_retention_master(spark, d), RETENTION_DAYS, RETENTION_AS_OF)
    child = table(spark, d, "customer").select(F.col("c_custkey").alias("pat_enc_csn_id"), "c_name")
    return RT.prune_child(child, kept)


def _nullable_customers(spark, d):
    c = table(spark, d, "customer")
    gone = F.col("c_mktsegment") == "BUILDING"
    return c.select(F.when(~gone, F.col("c_custkey")).alias("c_custkey"), F.when(~gone, F.col("c_name")).alias("c_name"),
                    F.when(~gone & (F.col("c_acctbal") >= 0), F.col("c_acctbal")).alias("c_acctbal"))


def drop_all_null(spark, d):
    return CL.drop_all_null(_nullable_customers(spark, d))


def drop_null_subset(spark, d):
    """rows whose given columns are all NULL go, whatever the others hold."""
    return CL.drop_all_null(_nullable_customers(spark, d), subset=["c_acctbal"])


def drop_update_columns(spark, d):
    """a current row's update stamps don't reach a history."""
    stamped = CL.stamp_update(table(spark, d, "customer").select("c_custkey", "c_name"))
    return CL.drop_update_columns(stamped)


def key_max(spark, d):
    """Every event with its user's latest time."""
    return LT.key_max(table(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], "ts")


def audit_columns(spark, d):
    stamped = CL.stamp_update(CL.stamp_insert(table(spark, d, "customer").select("c_custkey")))
    return stamped.select("c_custkey", F.col("row_insert_tsp").isNotNull().alias("has_insert_tsp"),
                          F.col("insert_user_id").isNotNull().alias("has_insert_user"),
                          F.col("row_updt_tsp").isNotNull().alias("has_update_tsp"))


def flatten_xml_paths(spark, d):
    from wardline.functions import xmlmsg as X
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType
    o = spread(table(spark, d, "orders"))
    xml = F.concat(F.lit("<Order><Header><Key>"), F.col("o_orderkey"), F.lit("</Key><Status>"), F.col("o_orderstatus"),
                   F.lit("</Status></Header><Notes><Note><Text>first</Text></Note><Note><Text>"),
                   F.col("o_orderpriority"), F.lit("</Text></Note></Notes><Price>"), F.col("o_totalprice"),
                   F.lit("</Price></Order>"))
    schema = StructType([
        StructField("Header", StructType([StructField("Key", StringType()), StructField("Status", StringType())])),
        StructField("Notes", StructType([StructField("Note", ArrayType(StructType([StructField("Text", StringType())])))])),
        StructField("Price", StringType()),
    ])
    parsed = o.select(F.from_xml(xml, schema).alias("m"))
    return parsed.select(*X.flatten_struct(F.col("m"), schema))


def flatten_xml_discovered(spark, d):
    """P10 without a schema: documents of two shapes in one column, their paths found in the documents."""
    orders = C.order_documents(spread(table(spark, d, "orders")), table(spark, d, "lineitem"))
    docs = land(spark, orders.unionByName(C.customer_documents(spread(table(spark, d, "customer")))), "shapes")
    return FL.flatten_documents(docs, "text")


QUERIES.update({
    "flatten_xml_discovered": flatten_xml_discovered,
    "latest_per_key_ties": latest_per_key_ties,
    "latest_row_number": latest_row_number,
    "retention_master": retention_master,
    "retention_child": retention_child,
    "drop_all_null": drop_all_null,
    "audit_columns": audit_columns,
    "drop_null_subset": drop_null_subset,
    "drop_update_columns": drop_update_columns,
    "key_max": key_max,
    "flatten_xml_paths": flatten_xml_paths,
})


# ------------------------------------------------------------------ sinks and streams


# Fixed query parameter: files of the clustered table.
CLUSTERED_FILES = 4
# Fixed query parameter: envelopes in a dropped XML file.
XML_PER_FILE = 500
#: Envelopes that lie in the drop at a time, and that one batch of it takes, about: they bound the disk that it needs.
EVENTS_PER_ROUND = 2_000_000
# Fixed query parameter: events before this instant form the older of two upsert batches.
SPLIT_TS = "2024-01-16 00:00:00"


def _event_states(spark, d):
    ev = table(spark, d, "events")
    return ev.select(F.col("user_id").alias("pat_enc_csn_id"), F.col("ts").alias("msg_tm"),
                     F.concat(F.lit("evt-"), F.col("event_id")).alias("msg_nm"),
                     F.col("event_type").alias("trigger_evnt"))


def _halves(spark, d):
    rows = _event_states(spark, d)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    newer = F.coalesce(F.col("msg_tm") >= split, F.lit(False))  # rows without a time are in the older half
    return rows.where(newer), rows.where(~newer)


def upsert_merge(spark, d):
    """K5: the newer half is applied first, the older second; the guard must keep the newer state."""
    newer, older = _halves(spark, d)
    path = scratch_path(spark, "current")
    UP.upsert(spark, newer, path)
    UP.upsert(spark, older, path)
    return UP.read_current(spark, path).select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt")


def _appended_and_upserted(spark, d):
    """K7: both batches appended to the history (batch 0 twice: a retry) and upserted."""
    newer, older = _halves(spark, d)
    hist, cur = scratch_path(spark, "hist"), scratch_path(spark, "current")
    UP.append_and_upsert(spark, newer, 0, hist, cur)
    UP.append_and_upsert(spark, newer, 0, hist, cur)
    UP.append_and_upsert(spark, older, 1, hist, cur)
    return hist, cur


def append_and_upsert(spark, d):
    """K7, the history side; folded by a compaction first, after which batch 0 is replayed once more."""
    hist, _ = _appended_and_upserted(spark, d)
    TB.compact(spark, hist, "msg_tm")
    UP.append_batch(_halves(spark, d)[0], 0, hist)
    return spark.read.parquet(hist).select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt")


def append_and_upsert_current(spark, d):
    """K7, the current-state side."""
    return UP.read_current(spark, _appended_and_upserted(spark, d)[1]).select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt")


def upsert_null_keys(spark, d):
    """K5: rows without a key match nothing and are all kept."""
    newer, older = (h.withColumn("pat_enc_csn_id", F.when(F.col("trigger_evnt") != "error", F.col("pat_enc_csn_id"))) for h in _halves(spark, d))
    path = scratch_path(spark, "current")
    UP.upsert(spark, newer, path, buckets=16)
    UP.upsert(spark, older, path)  # the table's own bucket count holds
    return UP.read_current(spark, path).select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt")


def upsert_children_set(spark, d):
    """K5-K8 with child rows: an encounter's whole set is replaced by the set of its latest time."""
    newer, older = (h.select("pat_enc_csn_id", F.date_trunc("day", "msg_tm").alias("msg_tm"), "trigger_evnt") for h in _halves(spark, d))
    path = scratch_path(spark, "children")
    UP.upsert(spark, older, path, mode="set")
    UP.upsert(spark, newer, path, mode="set")
    return UP.read_current(spark, path).select("pat_enc_csn_id", "msg_tm", "trigger_evnt")


def _event_records(spark, d):
    """Event messages as broker records: body bytes plus partition, sequence number, offset."""
    msgs = C.hl7_from_events(spread(table(spark, d, "events")), keep=("event_id", "user_id"))
    return msgs.select(F.col("text").cast("binary").alias("body"), (F.col("user_id") % 4).cast("string").alias("partition"),
                       F.col("event_id").alias("sequenceNumber"), (F.col("event_id") * 10).cast("string").alias("offset"))


def _order_records(spark, d):
    """Order messages, which hold diagnoses, complaints and reasons, as broker records."""
    msgs = C.hl7_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem"))
    key = F.regexp_extract("msg_nm", "[0-9]+", 0).cast("long")
    return msgs.select(F.col("text").cast("binary").alias("body"), (key % 4).cast("string").alias("partition"),
                       key.alias("sequenceNumber"), (key * 10).cast("string").alias("offset"))


#: Files of the broker drop that one trigger takes at least, and at most for each core.
FILES_PER_TRIGGER = 4
#: Batches that a drop is taken in while they are within these bounds.
BATCHES = 8


def files_per_trigger(spark: SparkSession, files: int) -> int:
    """A batch has jobs of its own, so a larger drop is taken in larger batches, until a batch fills the cluster."""
    return min(max(FILES_PER_TRIGGER, -(-files // BATCHES)), FILES_PER_TRIGGER * max(1, spark.sparkContext.defaultParallelism))


def _run_ingest(spark, records):
    root = scratch_path(spark, "ingest")
    drop = f"{root}/broker"
    records.write.option("maxRecordsPerFile", 20_000).parquet(drop)
    stream = spark.readStream.schema("body binary, partition string, sequenceNumber bigint, offset string") \
        .option("maxFilesPerTrigger", files_per_trigger(spark, len(TB.data_files(spark, drop)))).option("maxFileAge", FS.ANY_AGE).parquet(drop)
    # rejects are not dropped at the source: the fan-out routes them to the quarantine
    JB.ingest_hl7(stream, root).awaitTermination()
    return root, JB.paths(root)


def stream_ingest_fanout(spark, d):
    """S4 + T7 + K2: broker records streamed, parsed once, fanned out; ADT table read back."""
    _, paths = _run_ingest(spark, _event_records(spark, d))
    cols = [c for c in ADT_HIST.fieldNames() if c not in ("row_insert_tsp", "insert_user_id")]
    return portable(spark.read.parquet(paths["adt_hist"]).select(*cols))


def stream_batch_metrics(spark, d):
    """A2 + A3 via K2's observed metrics, summed over the batches of the ingest; one batch's are written twice."""
    root, _ = _run_ingest(spark, _order_records(spark, d))
    again = MT.read_metrics(spark, f"{root}/metrics").where("batch_id = 0")  # a row for each table
    MT.record_metrics(spark, [r.asDict() for r in again.collect()], f"{root}/metrics")
    m = MT.read_metrics(spark, f"{root}/metrics")
    return portable(m.groupBy("table_name").agg(F.sum("batch_rows").alias("batch_rows"),
                                                F.max("latest_msg_tm").alias("latest_msg_tm")))


def _fanned_out(name):
    def query(spark, d):
        _, paths = _run_ingest(spark, _order_records(spark, d))
        return portable(spark.read.parquet(paths[name]).drop("row_insert_tsp", "insert_user_id", TB.BATCH))

    query.__doc__ = f"T7: {name} of the order messages' fan-out."
    return query


def stream_xml_files(spark, d):
    """S1-S3 + P1 + T7: batched XML files of bounded size dropped in a folder, in rounds, streamed, split, parsed once.

    Each round's files are read by the same stream, resumed, and go before the next round's come. Spark names the dropped files, so the message name is compared by its form: the file's own name.
    """
    root = scratch_path(spark, "xmldrop")
    events = table(spark, d, "events")
    rounds = max(1, -(-events.count() // EVENTS_PER_ROUND))
    turn = F.pmod(F.xxhash64(*events.columns), F.lit(rounds))
    for i in range(rounds):
        msgs = C.xml_from_events(spread(events).where(turn == i) if rounds > 1 else spread(events))
        lines = msgs.select(F.concat(F.col("text"), F.lit("\n"), F.lit(XM.BATCH_DELIMITER)).alias("value"))
        lines.write.mode("append").option("maxRecordsPerFile", XML_PER_FILE).text(f"{root}/drop")
        JB.ingest_xml(spark, f"{root}/drop", root).awaitTermination()
        dropped = spark.read.format("binaryFile").load(f"{root}/drop")
        dropped.select(F.element_at(F.split("path", "/"), -1).alias("msg_nm")).write.mode("append").parquet(f"{root}/names")
        TB.remove(spark, f"{root}/drop")  # read, and kept by no one: text is many times as large as the tables
    cols = [c for c in ADT_HIST.fieldNames() if c not in ("row_insert_tsp", "insert_user_id", "msg_nm")]
    names = spark.read.parquet(f"{root}/names")
    adt = spark.read.parquet(JB.paths(root)["adt_hist"]).join(names.withColumn("is_file", F.lit(True)), "msg_nm", "left")
    return portable(adt.select(*cols, F.coalesce("is_file", F.lit(False)).alias("named_by_file")))


def stream_table_copy(spark, d):
    """S5 + K11: a table appended to in batches is tailed and copied to a warehouse folder; the
    table is compacted and a batch of the copy replayed on the way."""
    root = scratch_path(spark, "copy")
    newer, older = _halves(spark, d)

    def copy():
        src = ST.tail_table(spark, f"{root}/table", newer.schema, max_files=3)
        WH.copy_stream(src, f"{root}/warehouse", f"{root}/_checkpoint", fmt="parquet").awaitTermination()

    TB.append_batch_rows(newer, 0, f"{root}/table")
    copy()
    first = spark.read.parquet(f"{root}/warehouse").where(F.col(TB.BATCH) == 0).drop(TB.BATCH)
    replay = land(spark, first, "replayed")
    TB.append_batch_rows(older, 1, f"{root}/table")
    copy()
    TB.compact(spark, f"{root}/table", "msg_tm", keep_batches=0)
    copy()  # rewritten files hold nothing new
    WH.write_batch(replay, 0, f"{root}/warehouse", f"{root}/_marks", fmt="parquet")
    return spark.read.parquet(f"{root}/warehouse").drop(TB.BATCH)


def append_stream(spark, d):
    """K1: a plain append stream, resumed once; stamps set, update columns dropped."""
    root = scratch_path(spark, "append")
    rows = CL.stamp_update(_event_states(spark, d))
    newer = F.coalesce(F.col("msg_tm") >= F.lit(SPLIT_TS).cast("timestamp_ntz"), F.lit(False))
    for part in (newer, ~newer):
        rows.where(part).write.mode("append").parquet(f"{root}/drop")
        MT.append_stream(ST.tail_table(spark, f"{root}/drop", rows.schema), f"{root}/table", f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/table").where("row_insert_tsp IS NOT NULL AND insert_user_id IS NOT NULL").drop("row_insert_tsp", "insert_user_id")


def latest_to_warehouse(spark, d):
    """K10 as a stream: the latest states of each of two batches, ties kept; the rows as they were loaded, with their batch,
    and whether they are the latest of their key in the warehouse."""
    root = scratch_path(spark, "latest")
    for batch, half in enumerate(_halves(spark, d)):
        rows = half.withColumn("msg_tm", F.date_trunc("hour", "msg_tm"))
        TB.append_batch_rows(rows, batch, f"{root}/table")
        WH.latest_stream(ST.tail_table(spark, f"{root}/table", rows.schema), f"{root}/warehouse", f"{root}/_checkpoint", fmt="parquet").awaitTermination()
    rows = spark.read.parquet(f"{root}/warehouse").withColumnRenamed(TB.BATCH, "batch")
    latest = LT.key_max(rows, ["pat_enc_csn_id"])
    return latest.select(*rows.columns, (F.col("msg_tm") == F.col("max_time")).alias("is_latest"))


def cluster_by_range(spark, d):
    """Rewrite clustered by time into a few files; contents unchanged, and no file's times reach into the next file's."""
    path = scratch_path(spark, "cluster")
    spread(_event_states(spark, d)).write.parquet(path)
    TB.compact(spark, path, "msg_tm", files=CLUSTERED_FILES)
    rows = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    ranges = rows.groupBy("file").agg(F.min("msg_tm").alias("low"), F.max("msg_tm").alias("high"))  # a row a file
    before = ranges.select(F.col("low").alias("l"), F.col("high").alias("h"), F.col("file").alias("f"))
    overlaps = (F.col("f") != F.col("file")) & (F.col("l") < F.col("high")) & (F.col("low") < F.col("h"))
    kept = ranges.join(F.broadcast(before), overlaps, "left_anti").select("file", F.lit(True).alias("apart"))
    many = ranges.count() == CLUSTERED_FILES
    return rows.join(F.broadcast(kept), "file", "left").select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt",
                                                               (F.coalesce("apart", F.lit(False)) & F.lit(many)).alias("in_range"))


def table_actions(spark, d):
    """Ensure (idempotent), self-overwrite through staging, truncate + positional insert."""
    path = scratch_path(spark, "actions")
    rows = _event_states(spark, d)
    TB.ensure_table(spark, path, rows.schema)
    TB.ensure_table(spark, path, rows.schema)
    rows.write.mode("append").parquet(path)
    current = spark.read.parquet(path)
    TB.overwrite_table(spark, current.where(F.col("trigger_evnt") != "error"), path)
    keep = spark.read.parquet(path)
    other = scratch_path(spark, "actions2")
    TB.ensure_table(spark, other, rows.schema)
    TB.truncate_table(spark, other, rows.schema)
    TB.insert_select(keep.select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt"), other, rows.schema)
    return spark.read.parquet(other)


QUERIES.update({
    "upsert_merge": upsert_merge,
    "append_and_upsert": append_and_upsert,
    "append_and_upsert_current": append_and_upsert_current,
    "upsert_null_keys": upsert_null_keys,
    "upsert_children_set": upsert_children_set,
    "stream_ingest_fanout": stream_ingest_fanout,
    "stream_batch_metrics": stream_batch_metrics,
    "stream_fanout_dx": _fanned_out("encntr_dx_hist"),
    "stream_fanout_er": _fanned_out("encntr_er_complnt_hist"),
    "stream_fanout_visit": _fanned_out("encntr_visit_rsn_hist"),
    "stream_xml_files": stream_xml_files,
    "stream_table_copy": stream_table_copy,
    "append_stream": append_stream,
    "latest_to_warehouse": latest_to_warehouse,
    "cluster_by_range": cluster_by_range,
    "table_actions": table_actions,
})


# ------------------------------------------------------------------ seed


def _seeded(spark, d, name):
    """The seed job over the driver tables, ADT and one table of the four; read back without stamps."""
    root = scratch_path(spark, "seed")
    JB.seed_job(spark, SR.roles(spark, d), root, SR.RULES, SR.seed_msg_tm(), only=name)
    rows = spark.read.parquet(f"{root}/{name}").drop("row_insert_tsp", "insert_user_id")
    # the driver tables hold wall clocks: read back as such; the stamp alone is an instant
    return rows.select(*[(utc_ntz(F.col(c)) if c == "msg_tm" else F.col(c).cast("timestamp_ntz") if t == "timestamp" else F.col(c)).alias(c)
                         for c, t in rows.dtypes])


def seed_adt(spark, d):
    return _seeded(spark, d, "adt_hist")


def seed_dx(spark, d):
    return _seeded(spark, d, "encntr_dx_hist")


def seed_er(spark, d):
    return _seeded(spark, d, "encntr_er_complnt_hist")


def seed_visit_reason(spark, d):
    return _seeded(spark, d, "encntr_visit_rsn_hist")


QUERIES.update({"seed_adt": seed_adt, "seed_dx": seed_dx, "seed_er": seed_er, "seed_visit_reason": seed_visit_reason})


def _retained(spark, d):
    """Master (orders by customer) and one child (customers) pruned together, then clustered."""
    root = scratch_path(spark, "retention")
    _retention_master(spark, d).withColumn("row_insert_tsp", F.col("hosp_disch_time")).write.parquet(f"{root}/master")
    table(spark, d, "customer").select(F.col("c_custkey").alias("pat_enc_csn_id"), "c_name").write.parquet(f"{root}/child")
    RT.retention_job(spark, f"{root}/master", [f"{root}/child"], RETENTION_DAYS, RETENTION_AS_OF)
    return root


def retention_job(spark, d):
    return spark.read.parquet(f"{_retained(spark, d)}/master").drop("row_insert_tsp")


def retention_job_child(spark, d):
    return spark.read.parquet(f"{_retained(spark, d)}/child")


# Fixed query parameters: folders of the master by encounter, a day that expires few encounters.
RETENTION_FOLDERS = 64
EARLY_AS_OF = "1995-01-05"


def retention_touched_files(spark, d):
    """Which rows stay, and which of them still lie in the file that they lay in before (same name, same time)."""
    path = scratch_path(spark, "touched")
    folder = (F.col("pat_enc_csn_id") % RETENTION_FOLDERS).cast("int")
    _retention_master(spark, d).withColumn("folder", folder).repartition("folder").write.partitionBy("folder").parquet(path)

    def held():
        where = F.struct("_metadata.file_name", "_metadata.file_modification_time").alias("file")
        return spark.read.parquet(path).select("*", where)

    before = land(spark, held().select(F.col("folder").alias("f"), F.col("file").alias("was")).distinct(), "files-before")
    RT.retention_job(spark, path, [], RETENTION_DAYS, EARLY_AS_OF)
    same = F.col("file").eqNullSafe(F.col("was"))
    return held().join(before, F.col("folder") == F.col("f"), "left").select("pat_enc_csn_id", "o_orderkey", "hosp_disch_time", same.alias("same_file"))


def _clinic(spark, d):
    """Four history tables under one root, filled by the ingest of the order messages."""
    root, _ = _run_ingest(spark, _order_records(spark, d))
    return root


def four_table_retention(spark, d):
    """R3 over the four tables of an ingest: rows left of each, with the encounters they belong to."""
    root = _clinic(spark, d)
    adt = f"{root}/adt_hist"  # the order messages carry no discharge: closed orders get their message's time
    closed = F.when(F.col("trigger_evnt") == "A03", F.col("msg_tm"))
    TB.overwrite_table(spark, spark.read.parquet(adt).withColumn("hosp_disch_time", F.coalesce("hosp_disch_time", closed)), adt, [TB.BATCH], clustered=True)
    JB.retention(spark, root, RETENTION_DAYS, RETENTION_AS_OF)
    left = None
    for name, path in JB.paths(root).items():
        rows = TB.read_history(spark, path).groupBy("pat_enc_csn_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "pat_enc_csn_id", "n")
        left = rows if left is None else left.unionByName(rows)
    return left


def four_table_copy(spark, d):
    """K11 for the four tables of an ingest, the copies started twice; rows and latest time of each in the warehouse."""
    root = _clinic(spark, d)
    for _ in range(2):
        for query in JB.copy_tables(spark, root, f"{root}/warehouse", f"{root}/_copies", fmt="parquet").values():
            query.awaitTermination()
    out = None
    for name in JB.paths(root):
        rows = spark.read.parquet(f"{root}/warehouse/{name}").agg(F.count(F.lit(1)).alias("n"), F.max("msg_tm").alias("latest")).select(F.lit(name).alias("table_name"), "n", "latest")
        out = rows if out is None else out.unionByName(rows)
    return portable(out)


QUERIES.update({"retention_job": retention_job, "retention_job_child": retention_job_child, "retention_touched_files": retention_touched_files,
                "four_table_retention": four_table_retention, "four_table_copy": four_table_copy})


# ------------------------------------------------------------------ catalog tables, staged loads, state


def _catalog(spark, buckets=None):
    """A database of its own below the shared folder, with the eight tables."""
    place = scratch_path(spark, "catalog")
    name = "wardline_" + place.rsplit("-", 1)[-1]
    CT.create_catalog(spark, name, buckets, place)
    return name


def _kept(spark, rows, name):
    """A result read from a database that goes."""
    out = land(spark, rows, "catalog-result")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return out


def catalog_tables(spark, d):
    """K12, K14, K15, K17, K18, S5 by name: the tables made twice, filled by name (the table stamps the rows), tailed into a
    current table by position, a third filled and truncated."""
    db = _catalog(spark)
    CT.create_catalog(spark, db)
    rows = _event_states(spark, d).withColumn("msg_tm", F.col("msg_tm").cast("timestamp"))
    for part in (0, 1):
        CT.insert_named(rows.where(F.substring("msg_nm", -1, 1).cast("int") % 2 == part), f"{db}.adt_hist")
    columns = [*ADT_HIST.fieldNames(), F.lit(None).alias("row_updt_tsp"), F.lit(None).alias("update_user_id")]
    CT.tail(spark, f"{db}.adt_hist").writeStream.option("checkpointLocation", scratch_path(spark, "catalog-tail")).trigger(availableNow=True) \
        .foreachBatch(lambda b, i: CT.insert_select(b.select(*columns), f"{db}.adt_dtl")).start().awaitTermination()
    CT.insert_named(rows.select("pat_enc_csn_id", "msg_tm"), f"{db}.encntr_dx")
    filled = spark.table(f"{db}.encntr_dx").count()
    CT.truncate(spark, [f"{db}.encntr_dx"])
    stamped = F.col("row_insert_tsp").isNotNull() & F.col("insert_user_id").isNotNull() & F.col("row_updt_tsp").isNull()
    out = spark.table(f"{db}.adt_dtl").select("pat_enc_csn_id", F.col("msg_tm").cast("timestamp_ntz").alias("msg_tm"), "msg_nm", "trigger_evnt", stamped.alias("stamped"),
                                             F.lit(filled).cast("long").alias("n_before"), F.lit(spark.table(f"{db}.encntr_dx").count()).cast("long").alias("n_after"))
    return _kept(spark, out, db)


def bucketed_retention(spark, d):
    """J4, J5, R3 over catalog tables bucketed by encounter."""
    db = _catalog(spark, buckets=RETENTION_BUCKETS)
    master = _retention_master(spark, d)
    CT.insert_named(master.select("pat_enc_csn_id", F.col("o_orderkey").cast("string").alias("bod_id"), F.col("hosp_disch_time").cast("timestamp").alias("hosp_disch_time")), f"{db}.adt_hist")
    CT.insert_named(table(spark, d, "customer").select(F.col("c_custkey").alias("pat_enc_csn_id"), F.col("c_name").alias("dx_name")), f"{db}.encntr_dx_hist")
    CT.retention(spark, db, RETENTION_DAYS, RETENTION_AS_OF, buckets=RETENTION_BUCKETS)
    rows = spark.table(f"{db}.adt_hist").select(F.lit("adt_hist").alias("table_name"), "pat_enc_csn_id", F.col("bod_id").alias("item")) \
        .unionByName(spark.table(f"{db}.encntr_dx_hist").select(F.lit("encntr_dx_hist").alias("table_name"), "pat_enc_csn_id", F.col("dx_name").alias("item")))
    return _kept(spark, rows, db)


def staged_load(spark, d):
    """Two batches staged and loaded; each load is cut off after two files, replayed, and replayed once more."""
    root = scratch_path(spark, "staged")
    for batch, half in enumerate(_halves(spark, d)):
        WH.stage_batch(half.repartition(5), batch, f"{root}/marks")
        WH.load_batch(spark, batch, f"{root}/warehouse", f"{root}/marks", "parquet", only=2)
        for _ in range(2):
            WH.stage_batch(half, batch, f"{root}/marks")
            WH.load_batch(spark, batch, f"{root}/warehouse", f"{root}/marks", "parquet")
    return spark.read.parquet(f"{root}/warehouse").drop(WH.LOAD, WH.LOAD_FILE)


def committed_batches(spark, d):
    """T7, all or nothing: an ingest's committed rows beside a batch that was cut off after two of its four tables."""
    root, paths = _run_ingest(spark, _event_records(spark, d))
    cut_off = land(spark, spark.read.parquet(paths["adt_hist"]).drop(TB.BATCH), "cut-off")
    for name, rows in (("adt_hist", cut_off), ("encntr_dx_hist", cut_off.select("msg_src", "msg_tm", "pat_enc_csn_id", F.lit("x").alias("dx_icd_cd")))):
        TB.append_batch_rows(rows, 1_000_000, paths[name])
    cols = [c for c in ADT_HIST.fieldNames() if c not in ("row_insert_tsp", "insert_user_id")]
    n_dx = JB.read_committed(spark, root, "encntr_dx_hist").count()
    return portable(JB.read_committed(spark, root, "adt_hist").select(*cols, F.lit(n_dx).cast("long").alias("n_dx")))


def stateful_winners(spark, d):
    """K6, T8 with state: events in three drops; the rows that each run emits, those whose key's latest row came with it."""
    root = scratch_path(spark, "state")
    rows = _event_states(spark, d)
    drop = F.regexp_extract("msg_nm", "[0-9]+", 0).cast("long") % 3
    for run in range(3):
        rows.where(drop == run).write.mode("append").parquet(f"{root}/drop")

        def put(batch, _, run=run):
            batch.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{root}/out")

        WN.winners_stream(ST.tail_table(spark, f"{root}/drop", rows.schema), f"{root}/_checkpoint", put).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def live_metrics(spark, d):
    """An append stream on a one-second trigger; its rows and latest time as a listener heard of them."""
    root = scratch_path(spark, "live")
    rows = spread(_event_states(spark, d)).withColumn("msg_tm", F.col("msg_tm").cast("timestamp"))
    rows.write.parquet(f"{root}/drop")
    heard = LV.LiveMetrics(spark)
    try:
        q = LV.live_append(ST.tail_table(spark, f"{root}/drop", rows.schema, max_files=3), f"{root}/table", "adt_hist", f"{root}/_checkpoint")
        q.processAllAvailable()
        q.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        heard.record(f"{root}/metrics")
    finally:
        heard.close()
    m = MT.read_metrics(spark, f"{root}/metrics").groupBy("table_name").agg(F.sum("batch_rows").alias("batch_rows"), F.max("latest_msg_tm").alias("latest_msg_tm"))
    return m.select("table_name", "batch_rows", F.col("latest_msg_tm").cast("timestamp_ntz").alias("latest_msg_tm"))


def _two_drops(spark, d):
    """A folder that gets the newer half, then the older one, and the stream that tails it."""
    root = scratch_path(spark, "drops")
    for part in _halves(spark, d):
        part.write.mode("append").parquet(f"{root}/drop")
        yield root, ST.tail_table(spark, f"{root}/drop", part.schema)


def upsert_stream(spark, d):
    """K6: two batches streamed into the current table."""
    for root, drop in _two_drops(spark, d):
        UP.upsert_stream(drop, f"{root}/current", f"{root}/_checkpoint").awaitTermination()
    return UP.read_current(spark, f"{root}/current").select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt")


def append_and_upsert_stream(spark, d):
    """K8: the same stream into a history and a current table; every history row, and whether it is its key's current one."""
    for root, drop in _two_drops(spark, d):
        UP.append_and_upsert_stream(drop, f"{root}/hist", f"{root}/current", f"{root}/_checkpoint").awaitTermination()
    now = UP.read_current(spark, f"{root}/current").select("pat_enc_csn_id", F.col("msg_nm").alias("now"))
    rows = spark.read.parquet(f"{root}/hist").select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt").join(now, "pat_enc_csn_id", "left")
    return rows.select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt", F.col("now").eqNullSafe(F.col("msg_nm")).alias("is_current"))


def blocking_append(spark, d):
    """K4: an append with metrics that returns when the stream has ended."""
    for root, drop in _two_drops(spark, d):
        q = MT.metered_stream(drop, f"{root}/table", "adt_hist", f"{root}/_checkpoint", f"{root}/metrics", wait=True)
    counted = MT.read_metrics(spark, f"{root}/metrics").agg(F.sum("batch_rows")).first()[0]
    return spark.read.parquet(f"{root}/table").select("pat_enc_csn_id", "msg_tm", "msg_nm", "trigger_evnt", F.lit(counted).alias("n_counted"), F.lit(q.isActive).alias("running"))


def archived_files(spark, d):
    """Files dropped in two rounds, archived as they are done; what each folder holds at last, line by line."""
    root = scratch_path(spark, "archive")
    lines = _event_states(spark, d).select(F.col("msg_nm").alias("value"), F.col("msg_tm"))
    for name, part in (("one", F.col("msg_tm") < F.lit(SPLIT_TS)), ("two", F.col("msg_tm") >= F.lit(SPLIT_TS))):
        lines.where(part).select("value").repartition(3).write.text(f"{root}/drop/{name}")
        files = FS.read_files(spark, f"{root}/drop", archive_dir=f"{root}/archive", glob="part-*", max_files=2)
        FS.decode_named(files).writeStream.format("parquet").option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start(f"{root}/read").awaitTermination()
    # a file goes once the batch after its own is planned; those of the last batch stay
    FS.decode_named(FS.read_files(spark, f"{root}/drop", archive_dir=f"{root}/archive", glob="part-*")).writeStream.format("parquet") \
        .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start(f"{root}/read").awaitTermination()
    where = F.when(F.col("_metadata.file_path").contains("/archive/"), "archive").otherwise("drop").alias("folder")
    left = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").text([f"{root}/archive", f"{root}/drop"]).select("value", where)
    n = spark.read.parquet(f"{root}/read").select(F.explode(F.split("text", "\n")).alias("value")).where("value <> ''")
    once = n.groupBy("value").agg(F.count(F.lit(1)).alias("n_read"))
    return left.groupBy("value").agg(F.count(F.lit(1)).alias("n_held"), F.max(F.col("folder")).isNotNull().alias("held")).join(once, "value")


def hl7_normalized(spark, d):
    """The event messages as other tools want them: version patched, carriage returns alone."""
    text = hl7.normalize(F.col("text"))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return _hl7_events(spark, d).select("msg_nm", F.element_at(F.split(F.substring_index(text, "\r", 1), r"\|"), 12).alias("version"), breaks.cast("long").alias("n_newlines"))


QUERIES.update({f.__name__: f for f in (upsert_stream, append_and_upsert_stream, blocking_append, archived_files, hl7_normalized)})
QUERIES.update({f.__name__: f for f in (catalog_tables, bucketed_retention, staged_load, committed_batches, stateful_winners, live_metrics)})
