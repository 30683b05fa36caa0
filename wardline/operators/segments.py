"""HL7 messages as a long table, and rows read from it by addresses that are data.

``segment_table`` gives a row for each component of each repetition of each field, with
the segment's place in its message. ``adt_addresses`` is a table of (column, segment,
field, component); a site that sends a segment of its own adds rows to it, no code.
``by_address`` joins the two and folds each message's hits into one row. Only addressed
cells are shuffled, on the message's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import hl7
from wardline.operators.extract import ordered_columns, typed
from wardline.schemas import ADT_HIST

#: Addresses are sent to the tasks up to so many; beyond it they are joined by a shuffle.
SENT = 10_000

ADDRESS = "column string, segment string, field int, component int, code string, code_text string, many boolean"
# Where the columns of an ADT row stand. Component 0 is the whole field.
ADT_ADDRESSES = [
    ("msg_typ", "MSH", 9, 1), ("trigger_evnt", "MSH", 9, 2), ("msg_tm", "MSH", 7, 0), ("bod_id", "MSH", 10, 0), ("pat_mrn_id", "PID", 3, 1),
    ("birth_date", "PID", 7, 0), ("sex_abbr", "PID", 8, 0), ("death_date", "PID", 29, 0), ("pat_class_abbr", "PV1", 2, 0),
    ("department_abbr", "PV1", 3, 1), ("room_nm", "PV1", 3, 2), ("bed_label", "PV1", 3, 3), ("bed_status", "PV1", 3, 5), ("pat_enc_csn_id", "PV1", 19, 0),
    ("disch_disp_abbr", "PV1", 36, 0), ("admitted", "PV1", 44, 0), ("discharged", "PV1", 45, 0), ("hsp_account_id", "PV1", 50, 0),
    ("accommodation_abbr", "PV2", 2, 0), ("means_of_arrv_abbr", "PV2", 38, 0), ("ed_disposition_abbr", "ZPV", 15, 0), ("user_id", "EVN", 5, 1),
    ("loc_abbr", "EVN", 5, 14)]


def adt_addresses(spark: SparkSession) -> DataFrame:
    rows = [(*a, None, None, False) for a in ADT_ADDRESSES]
    rows.append(("acuity_level_abbr", "OBX", 5, 2, hl7.OBS_ACUITY, hl7.TEXT_ACUITY, True))
    return spark.createDataFrame(rows, ADDRESS)


def segment_table(messages: DataFrame, key: str = "msg_nm", text: str = "text") -> DataFrame:
    """``key``, segment_no (from 1), segment, field, repetition, component (from 1; 0: the whole repetition), value;
    for OBX also code and code_text, the first two components of OBX-3. Empty values give no row."""
    segments = messages.select(key, F.posexplode(hl7.lines(F.col(text))).alias("segment_no", "line")).where("line <> ''")
    fields = segments.select(key, (F.col("segment_no") + 1).alias("segment_no"), F.split("line", hl7.FIELD_SEP).alias("f"))
    observed = F.when(F.col("f")[0] == "OBX", F.split(F.get("f", F.lit(3)), hl7.COMPONENT_SEP))
    cells = fields.select(key, "segment_no", F.col("f")[0].alias("segment"), observed.alias("c"), F.posexplode("f").alias("field", "held")).where("field > 0 AND held <> ''")
    header = F.col("segment") == "MSH"  # whose first field is the separator itself
    cells = cells.select(key, "segment_no", "segment", hl7.part(F.col("c"), 1).alias("code"), hl7.part(F.col("c"), 2).alias("code_text"),
                         (F.col("field") + header.cast("int")).alias("field"),
                         F.posexplode(F.when(header & (F.col("field") == 1), F.array("held")).otherwise(F.split("held", hl7.REPETITION_SEP))).alias("repetition", "held"))
    separators = header & (F.col("field") == 2)
    parts = F.when(separators, F.array("held")).otherwise(F.concat(F.array("held"), F.split("held", hl7.COMPONENT_SEP)))
    rows = cells.select(key, "segment_no", "segment", "code", "code_text", "field", (F.col("repetition") + 1).alias("repetition"), F.posexplode(parts).alias("component", "held"))
    return rows.where("held <> ''").withColumn("value", hl7.literal_held(F.col("held"))).drop("held")


def by_address(messages: DataFrame, addresses: DataFrame, key: str = "msg_nm", text: str = "text") -> DataFrame:
    """A row for each message, a text column for each address: the value in the first segment of that id,
    or, if the address says ``many``, all values in order, joined. Repetitions but the first are not read."""
    names = addresses.select("column", "many").distinct().orderBy("column").collect()  # a configuration: a row an address
    slots = {c: i for i, c in enumerate(dict.fromkeys(r["column"] for r in names))}
    asked = addresses.withColumn("slot", F.array_position(F.lit(list(slots)), F.col("column")).cast("int") - 1)
    asked = F.broadcast(asked) if addresses.limit(SENT + 1).count() <= SENT else asked
    cells = segment_table(messages, key, text).where("repetition = 1")
    fits = (F.col("a.code").isNull() | ((F.col("a.code") == F.col("c.code")) & (F.col("a.code_text") == F.col("c.code_text"))))
    hits = cells.alias("c").join(asked.alias("a"), (F.col("c.segment") == F.col("a.segment")) & (F.col("c.field") == F.col("a.field"))
                                 & (F.col("c.component") == F.col("a.component")) & fits) \
        .select(F.col(f"c.{key}").alias(key), F.struct("a.slot", "c.segment_no", "c.value").alias("hit"))
    # a message without a hit stays a row
    every = hits.unionByName(messages.select(key, F.lit(None).cast(hits.schema["hit"].dataType).alias("hit")))
    # one list a message, by address and place: an aggregate for each address would test every hit for every address
    rows = every.groupBy(key).agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    rows = rows.select(key, "hits", F.transform("hits", lambda h: h["slot"]).alias("slots"), F.transform("hits", lambda h: h["value"]).alias("values"))
    out = []
    for r in names:
        slot = slots[r["column"]]
        if r["many"]:
            held = F.filter("hits", lambda h: h["slot"] == slot)
            out.append(hl7.blank_to_null(F.array_join(F.transform(held, lambda h: h["value"]), hl7.ACUITY_DELIMITER)).alias(r["column"]))
        else:
            first = F.array_position("slots", slot)
            out.append(F.get("values", (first - 1).cast("int")).alias(r["column"]))
    return rows.select(key, *out)


def adt_by_address(messages: DataFrame, addresses: DataFrame, msg_src: str = hl7.HL7_SOURCE) -> DataFrame:
    """E1 from the long table: the ADT rows, and as text whatever other columns the addresses name."""
    rows = by_address(messages, addresses)
    event = F.col("trigger_evnt")
    raw = {c: F.col(c) for c in rows.columns if c not in ("admitted", "discharged")}
    raw |= {"hosp_admsn_time": F.when(event.isin(*hl7.ADMIT_TRIGGERS), F.col("admitted")),
            "hosp_disch_time": F.when(event.isin(*hl7.DISCHARGE_TRIGGERS), F.col("discharged")),
            "adt_arrival_time": F.when(event.isin(*hl7.ARRIVAL_TRIGGERS), F.col("admitted")), "msg_src": F.lit(msg_src)}
    own = [c for c in raw if c not in ADT_HIST.fieldNames() and c != "msg_nm"]
    staged, cols = typed(rows.select(F.struct(*[c.alias(k) for k, c in raw.items()]).alias("_raw")), list(raw), hl7.convert)
    return staged.select(*ordered_columns(cols, ADT_HIST, {}), *[cols[c].alias(c) for c in own])
