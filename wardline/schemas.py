"""The eight table shapes: four append-only histories and four current-state tables.

Column order follows the table DDL, which matters for positional inserts.
"""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

S, T, L = StringType(), TimestampType(), LongType()

ADT_HIST = StructType([
    StructField("msg_typ", S), StructField("msg_src", S), StructField("trigger_evnt", S),
    StructField("msg_tm", T), StructField("msg_nm", S), StructField("bod_id", S),
    StructField("pat_mrn_id", S), StructField("pat_enc_csn_id", L), StructField("birth_date", T),
    StructField("death_date", T), StructField("pat_class_abbr", S), StructField("hosp_admsn_time", T),
    StructField("hosp_disch_time", T), StructField("department_abbr", S), StructField("loc_abbr", S),
    StructField("room_nm", S), StructField("bed_label", S), StructField("bed_status", S),
    StructField("sex_abbr", S), StructField("means_of_arrv_abbr", S), StructField("acuity_level_abbr", S),
    StructField("ed_disposition_abbr", S), StructField("disch_disp_abbr", S), StructField("adt_arrival_time", T),
    StructField("hsp_account_id", L), StructField("accommodation_abbr", S), StructField("user_id", S),
    StructField("row_insert_tsp", T), StructField("insert_user_id", S),
])

DX_HIST = StructType([
    StructField("msg_src", S), StructField("msg_tm", T), StructField("pat_enc_csn_id", L),
    StructField("dx_icd_cd", S), StructField("dx_name", S), StructField("dx_code_type", S),
    StructField("row_insert_tsp", T), StructField("insert_user_id", S),
])

ER_HIST = StructType([
    StructField("msg_src", S), StructField("msg_tm", T), StructField("pat_enc_csn_id", L),
    StructField("er_complaint", S), StructField("row_insert_tsp", T), StructField("insert_user_id", S),
])

VISIT_HIST = StructType([
    StructField("msg_src", S), StructField("msg_tm", T), StructField("pat_enc_csn_id", L),
    StructField("encntr_rsn", S), StructField("row_insert_tsp", T), StructField("insert_user_id", S),
])

UPDATE_COLUMNS = ("row_updt_tsp", "update_user_id")
AUDIT_COLUMNS = ("row_insert_tsp", "insert_user_id") + UPDATE_COLUMNS


def current_of(hist: StructType) -> StructType:
    """Current-state shape: the history columns plus the update audit pair."""
    return StructType(list(hist.fields) + [StructField("row_updt_tsp", T), StructField("update_user_id", S)])


ADT_CURRENT = current_of(ADT_HIST)
DX_CURRENT = current_of(DX_HIST)
ER_CURRENT = current_of(ER_HIST)
VISIT_CURRENT = current_of(VISIT_HIST)

HISTORY = {"adt_hist": ADT_HIST, "encntr_dx_hist": DX_HIST,
           "encntr_er_complnt_hist": ER_HIST, "encntr_visit_rsn_hist": VISIT_HIST}
CURRENT = {"adt_dtl": ADT_CURRENT, "encntr_dx": DX_CURRENT,
           "encntr_er_complnt": ER_CURRENT, "encntr_visit_rsn": VISIT_CURRENT}
CHILD_TABLES = ("encntr_dx_hist", "encntr_er_complnt_hist", "encntr_visit_rsn_hist")

KEY = "pat_enc_csn_id"


def data_columns(schema: StructType) -> list[str]:
    """Columns a parser fills (everything but the audit stamps)."""
    return [f.name for f in schema.fields if f.name not in AUDIT_COLUMNS]


def ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
