"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

Each statement recomputes, from the driver tables alone, what parsing the
carrier messages must return. ``TZ(x)`` below stands for reading wall clock
``x`` in US/Central and returning its UTC wall clock.
"""

from __future__ import annotations


def _tz(x: str) -> str:
    return f"timezone('UTC', timezone('US/Central', {x}))"


_TRIG = ("CASE event_type WHEN 'signup' THEN 'A04' WHEN 'view' THEN 'A01' WHEN 'click' THEN 'A11' "
         "WHEN 'purchase' THEN 'A03' WHEN 'error' THEN 'A13' END")
_TS = "date_trunc('second', ts)"
_LVL = "CAST(floor(value / 20) AS BIGINT)"


def _event_adt(xml: bool) -> str:
    msg_tm = _TS if xml else _tz(_TS)
    src = "'OKC'" if xml else "'STL'"
    arrival = ("CASE WHEN event_type = 'signup' THEN 'AMB' ELSE 'CAR' END" if xml
               else "CASE WHEN event_type = 'signup' THEN 'AMB^Ambulance' ELSE 'CAR' END")
    return f"""
SELECT
  'ADT' AS msg_typ,
  {src} AS msg_src,
  {_TRIG} AS trigger_evnt,
  {msg_tm} AS msg_tm,
  'evt-' || CAST(event_id AS VARCHAR) AS msg_nm,
  CAST(event_id AS VARCHAR) AS bod_id,
  'M' || CAST(user_id AS VARCHAR) AS pat_mrn_id,
  CASE WHEN event_type = 'error' AND value < 3 THEN NULL ELSE user_id END AS pat_enc_csn_id,
  {_tz("CAST(DATE '1950-01-01' + CAST((user_id * 97) % 20000 AS INTEGER) AS TIMESTAMP)")} AS birth_date,
  CASE WHEN value >= 90 THEN {_tz(_TS)} END AS death_date,
  upper(event_type) AS pat_class_abbr,
  CASE WHEN event_type = 'view' THEN {_tz(_TS)}
       WHEN event_type = 'click' THEN {_tz("date_trunc('minute', ts)")} END AS hosp_admsn_time,
  CASE WHEN event_type IN ('purchase', 'error') THEN {_tz(_TS + " + INTERVAL 2 HOUR")} END AS hosp_disch_time,
  'D' || CAST(user_id % 10 AS VARCHAR) AS department_abbr,
  'FAC' || CAST(user_id % 7 AS VARCHAR) AS loc_abbr,
  'R' || CAST(user_id % 50 AS VARCHAR) AS room_nm,
  'B' || CAST(event_id % 4 AS VARCHAR) AS bed_label,
  CASE WHEN value < 10 THEN 'DIRTY' ELSE 'READY' END AS bed_status,
  CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS sex_abbr,
  {arrival} AS means_of_arrv_abbr,
  CASE WHEN value > 80 THEN 'Level ' || CAST({_LVL} AS VARCHAR) || '|||Level ' || CAST({_LVL} + 1 AS VARCHAR)
       WHEN value > 40 THEN 'Level ' || CAST({_LVL} AS VARCHAR) END AS acuity_level_abbr,
  CASE WHEN value > 50 THEN 'ADMIT' ELSE 'DISCHARGE' END AS ed_disposition_abbr,
  CASE WHEN event_type = 'purchase' THEN 'HOME' END AS disch_disp_abbr,
  CASE WHEN event_type = 'signup' THEN {_tz(_TS)} END AS adt_arrival_time,
  CASE WHEN value < 5 THEN NULL ELSE event_id * 10 + 7 END AS hsp_account_id,
  CASE user_id % 3 WHEN 0 THEN 'PRIVATE' WHEN 1 THEN 'SEMI' END AS accommodation_abbr,
  'U' || CAST(user_id AS VARCHAR) AS user_id
FROM events"""


_ORDER_CSN = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END"


def _order_children(xml: bool) -> dict[str, str]:
    msg_tm = "o_orderdate" if xml else _tz("date_trunc('second', o_orderdate)")
    src = "'OKC'" if xml else "'STL'"
    region_ok = "AND o_orderpriority <> '4-NOT SPECIFIED'" if xml else ""
    base = f"""FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE ({_ORDER_CSN}) IS NOT NULL {region_ok}"""
    dx = f"""
SELECT {src} AS msg_src, {msg_tm} AS msg_tm, o_orderkey AS pat_enc_csn_id,
  CASE WHEN l_discount > 0 THEN 'P' || CAST(l_partkey AS VARCHAR) END AS dx_icd_cd,
  CASE WHEN l_discount > 0 THEN 'Part ' || CAST(l_partkey AS VARCHAR) END AS dx_name,
  CASE WHEN l_linestatus = 'O' THEN 'ICD-10-CM' END AS dx_code_type
{base} AND l_returnflag = 'R' AND (l_discount > 0 OR l_linestatus = 'O')"""
    visit = f"""
SELECT {src} AS msg_src, {msg_tm} AS msg_tm, o_orderkey AS pat_enc_csn_id,
  'Reason ' || CAST(l_suppkey AS VARCHAR) AS encntr_rsn
{base} AND l_returnflag = 'A' AND l_tax > 0"""
    er = f"""
SELECT {src} AS msg_src, {msg_tm} AS msg_tm, o_orderkey AS pat_enc_csn_id, o_orderpriority AS er_complaint
FROM orders
WHERE ({_ORDER_CSN}) IS NOT NULL {region_ok}
  AND (o_orderpriority = '1-URGENT' OR (o_orderpriority = '2-HIGH' AND o_totalprice > 200000))"""
    acuity = """
SELECT 'ord-' || CAST(o.o_orderkey AS VARCHAR) AS msg_nm,
  string_agg('Q' || CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR), '|||' ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity)
    FILTER (WHERE l.l_returnflag NOT IN ('R', 'A')) AS acuity_level_abbr
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey"""
    return {"dx": dx, "visit_reason": visit, "er_complaint": er, "acuity": acuity}


_HL7_ORDERS = _order_children(False)
_XML_ORDERS = _order_children(True)

ORACLE = {
    "hl7_adt_detail": _event_adt(False),
    "hl7_event_times": f"SELECT msg_nm, trigger_evnt, adt_arrival_time, hosp_admsn_time, hosp_disch_time FROM ({_event_adt(False)})",
    "hl7_dx": _HL7_ORDERS["dx"],
    "hl7_visit_reason": _HL7_ORDERS["visit_reason"],
    "hl7_er_complaint": _HL7_ORDERS["er_complaint"],
    "hl7_acuity": _HL7_ORDERS["acuity"],
    "hl7_mrn_first_repetition": """
SELECT 'cus-' || CAST(c_custkey AS VARCHAR) AS msg_nm,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS pat_mrn_id
FROM customer""",
    "hl7_reject_split": """
SELECT 'evt-' || CAST(event_id AS VARCHAR) AS msg_nm,
  CASE WHEN event_type = 'error' AND value < 4 THEN 'not_hl7'
       WHEN event_type = 'purchase' AND value < 4 THEN 'encoding'
       WHEN event_type = 'view' AND value < 4 THEN 'no_version' END AS reject_reason
FROM events""",
    "xml_adt_detail": _event_adt(True),
    "xml_dx": _XML_ORDERS["dx"],
    "xml_visit_reason": _XML_ORDERS["visit_reason"],
    "xml_er_complaint": _XML_ORDERS["er_complaint"],
    "xml_acuity": _XML_ORDERS["acuity"],
    "split_batched_files": """
SELECT doc_id // 8 AS file_id,
  CAST(row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) - 1 AS INTEGER) AS part_no,
  text
FROM documents WHERE length(text) > 0""",
}

def _cells() -> str:
    """Every component of the event messages by its address: (segment, field, repetition, component, SQL value, NULL if absent)."""
    ts14, two = "strftime(ts, '%Y%m%d%H%M%S')", "ts + INTERVAL 2 HOUR"
    admit = f"CASE WHEN event_type = 'click' THEN strftime(ts, '%Y%m%d%H%M') WHEN user_id % 4 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE {ts14} END"
    disch = f"CASE WHEN user_id % 4 = 1 THEN strftime({two}, '%Y-%m-%d %H:%M:%S') ELSE strftime({two}, '%Y%m%d%H%M%S') END"
    birth = "strftime(DATE '1950-01-01' + CAST((user_id * 97) % 20000 AS INTEGER), '%Y%m%d')"
    cells = {
        "MSH": [(3, 1, "'WLSRC'"), (4, 1, "'WLFAC'"), (7, 1, ts14), (9, 1, "'ADT'"), (9, 2, _TRIG), (9, 3, "'ADT_A01'"), (10, 1, "event_id"), (11, 1, "'P'"), (12, 1, "'2.3'")],
        "EVN": [(1, 1, _TRIG), (2, 1, ts14), (4, 1, "'REG'"), (5, 1, "'U' || user_id"), (5, 2, "'DOE'"), (5, 3, "'JO'"), (5, 14, "'FAC' || user_id % 7")],
        "PID": [(1, 1, "'1'"), (3, 1, "'M' || user_id"), (3, 4, "'E'"), (7, 1, birth), (8, 1, "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END"), (29, 1, f"CASE WHEN value >= 90 THEN {ts14} END")],
        "PV1": [(1, 1, "'1'"), (2, 1, "upper(event_type)"), (3, 1, "'D' || user_id % 10"), (3, 2, "'R' || user_id % 50"), (3, 3, "'B' || event_id % 4"), (3, 4, "'FACX'"),
                (3, 5, "CASE WHEN value < 10 THEN 'DIRTY' ELSE 'READY' END"), (19, 1, "CASE WHEN event_type = 'error' AND value < 3 THEN 'X' ELSE '' END || user_id"),
                (36, 1, "CASE WHEN event_type = 'purchase' THEN 'HOME' END"), (44, 1, admit), (45, 1, disch), (50, 1, "CASE WHEN value < 5 THEN 'H' || event_id ELSE CAST(event_id * 10 + 7 AS VARCHAR) END")],
        "PV2": [(2, 1, "CASE user_id % 3 WHEN 0 THEN 'PRIVATE' WHEN 1 THEN 'SEMI' END"), (38, 1, "CASE WHEN event_type = 'signup' THEN 'AMB' ELSE 'CAR' END"),
                (38, 2, "CASE WHEN event_type = 'signup' THEN 'Ambulance' END")],
        "ZPV": [(15, 1, f"CASE WHEN value > 50 THEN {_HARD} ELSE 'DISCHARGE' END")]}
    out = [(seg, f, 1, c, v) for seg, held in cells.items() for f, c, v in held] + [("PID", 3, 2, 1, "'A' || event_id"), ("PID", 3, 2, 4, "'E'")]
    for when, n, kind, code, text, value in (("true", 0, "TX", "8661-1", "OTHER", [(5, 1, "'x'")]),
                                             ("value > 40", 1, "CWE", "11283-9", "ACUITY ASSESSMENT AT FIRST ENCOUNTER", [(5, 1, _LVL), (5, 2, f"'Level ' || {_LVL}")]),
                                             ("value > 80", 2, "CWE", "11283-9", "ACUITY ASSESSMENT AT FIRST ENCOUNTER", [(5, 1, f"{_LVL} + 1"), (5, 2, f"'Level ' || ({_LVL} + 1)")])):
        held = [(1, 1, f"'{n}'"), (2, 1, f"'{kind}'"), (3, 1, f"'{code}'"), (3, 2, f"'{text}'"), (3, 3, "'LN'"), (4, 1, f"'{n}'"), (11, 1, "'F'"), *value]
        out += [("OBX", f, 1, c, f"CASE WHEN {when} THEN {v} END") for f, c, v in held]
    return ", ".join(f"{{'s': '{s}', 'f': {f}, 'r': {r}, 'c': {c}, 'v': CAST({v} AS VARCHAR)}}" for s, f, r, c, v in out)


_HARD = "'A|D^M~I' || chr(92) || 'T&#$!@*%?é'"
ORACLE.update({
    "hl7_by_address": _event_adt(False),
    "hl7_segment_table": f"""
SELECT x.s AS segment, x.f AS field, x.r AS repetition, x.c AS component, count(*) AS n, count(DISTINCT x.v) AS n_values, min(x.v) AS least
FROM (SELECT unnest([{_cells()}]) AS x FROM events) WHERE x.v IS NOT NULL GROUP BY ALL""",
    "hl7_foreign_separators": _event_adt(False).replace("THEN 'ADMIT'", f"THEN {_HARD}"),
    "flatten_xml_discovered": """
WITH lines AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i, * FROM lineitem)
SELECT NULL AS "Customer.Address.@kind", NULL AS "Customer.Address.Nation", NULL AS "Customer.Key", NULL AS "Customer.Key.@kind", NULL AS "Customer.Tag",
  o_orderstatus AS "Order.@status", CAST(o_orderkey AS VARCHAR) AS "Order.Key", CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS "Order.Note",
  (SELECT CAST(max_by(l_linenumber, i) AS VARCHAR) FROM lines WHERE l_orderkey = o_orderkey) AS "Order.Lines.Line.@no",
  (SELECT CAST(max_by(l_partkey, i) FILTER (WHERE l_tax > 0) AS VARCHAR) FROM lines WHERE l_orderkey = o_orderkey) AS "Order.Lines.Line.Part.Id",
  (SELECT '00' || CAST(CAST(trunc(max_by(l_quantity, i)) AS BIGINT) AS VARCHAR) FROM lines WHERE l_orderkey = o_orderkey) AS "Order.Lines.Line.Qty"
FROM orders
UNION ALL BY NAME
SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'home' END AS "Customer.Address.@kind", CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS "Customer.Address.Nation",
  CAST(c_custkey AS VARCHAR) AS "Customer.Key", CASE WHEN c_custkey % 2 = 0 THEN 'even' END AS "Customer.Key.@kind", c_mktsegment AS "Customer.Tag"
FROM customer""",
})

_MASTER = """WITH m AS (SELECT o_custkey AS pat_enc_csn_id, o_orderkey,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS hosp_disch_time FROM orders),
kept AS (SELECT * FROM m WHERE NOT EXISTS (
  SELECT 1 FROM m e WHERE e.pat_enc_csn_id = m.pat_enc_csn_id AND e.hosp_disch_time IS NOT NULL
    AND CAST(e.hosp_disch_time AS DATE) < CAST(DATE '1996-01-01' - INTERVAL 2 DAY AS DATE)))"""

ORACLE.update({
    "latest_per_key_ties": """
SELECT event_id, user_id, ts_hour FROM (
  SELECT event_id, user_id, date_trunc('hour', ts) AS ts_hour,
    rank() OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts) DESC) AS rk FROM events) WHERE rk = 1""",
    "latest_row_number": """
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_quantity,
    row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "retention_master": _MASTER + "\nSELECT * FROM kept",
    "retention_child": _MASTER + """
SELECT c_custkey AS pat_enc_csn_id, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM kept k WHERE k.pat_enc_csn_id = c.c_custkey)""",
    "drop_all_null": """
SELECT * FROM (SELECT
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS c_custkey,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS c_name,
  CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)
WHERE c_custkey IS NOT NULL OR c_name IS NOT NULL OR c_acctbal IS NOT NULL""",
    "drop_null_subset": """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal >= 0""",
    "drop_update_columns": "SELECT c_custkey, c_name FROM customer",
    "key_max": "SELECT event_id, user_id, ts, (SELECT max(y.ts) FROM events AS y WHERE y.user_id IS NOT DISTINCT FROM x.user_id) AS max_time FROM events AS x",
    "audit_columns": "SELECT c_custkey, true AS has_insert_tsp, true AS has_insert_user, true AS has_update_tsp FROM customer",
    "flatten_xml_paths": """
SELECT CAST(o_orderkey AS VARCHAR) AS "Header.Key", o_orderstatus AS "Header.Status",
  o_orderpriority AS "Notes.Note.Text", CAST(o_totalprice AS VARCHAR) AS "Price" FROM orders""",
})

_STATES = "SELECT user_id AS pat_enc_csn_id, ts AS msg_tm, 'evt-' || CAST(event_id AS VARCHAR) AS msg_nm, event_type AS trigger_evnt FROM events"
_BROKER_ADT = _event_adt(False).replace(
    "'evt-' || CAST(event_id AS VARCHAR) AS msg_nm",
    "CAST(user_id % 4 AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) || '-' || CAST(event_id * 10 AS VARCHAR) AS msg_nm")
_XML_ADT_NO_NAME = "SELECT * EXCLUDE (msg_nm) FROM (" + _event_adt(True) + ")"

ORACLE.update({
    "upsert_merge": f"""
SELECT pat_enc_csn_id, msg_tm, msg_nm, trigger_evnt FROM (
  SELECT *, row_number() OVER (PARTITION BY pat_enc_csn_id ORDER BY msg_tm DESC, msg_nm DESC) AS rn FROM ({_STATES}))
WHERE rn = 1""",
    "append_and_upsert": _STATES,
    "append_and_upsert_current": f"""
SELECT unnest(arg_max(x, ROW(msg_tm, msg_nm))) FROM ({_STATES}) AS x GROUP BY x.pat_enc_csn_id""",
    "upsert_null_keys": f"""
SELECT unnest(arg_max(x, ROW(msg_tm, msg_nm))) FROM ({_STATES}) AS x WHERE trigger_evnt <> 'error' GROUP BY x.pat_enc_csn_id
UNION ALL SELECT NULL, msg_tm, msg_nm, trigger_evnt FROM ({_STATES}) WHERE trigger_evnt = 'error'""",
    "upsert_children_set": f"""
SELECT pat_enc_csn_id, date_trunc('day', msg_tm) AS msg_tm, trigger_evnt FROM ({_STATES}) AS x
WHERE date_trunc('day', msg_tm) = (SELECT max(date_trunc('day', msg_tm)) FROM ({_STATES}) AS y WHERE y.pat_enc_csn_id = x.pat_enc_csn_id
  AND (y.msg_tm >= TIMESTAMP '2024-01-16 00:00:00' OR NOT EXISTS (SELECT 1 FROM ({_STATES}) AS z
    WHERE z.pat_enc_csn_id = x.pat_enc_csn_id AND z.msg_tm >= TIMESTAMP '2024-01-16 00:00:00')))""",
    "latest_to_warehouse": f"""
SELECT pat_enc_csn_id, h AS msg_tm, msg_nm, trigger_evnt, batch, h = best AS is_latest FROM (
  SELECT *, date_trunc('hour', msg_tm) AS h, max(date_trunc('hour', msg_tm)) OVER (PARTITION BY pat_enc_csn_id, batch) AS m,
    max(date_trunc('hour', msg_tm)) OVER (PARTITION BY pat_enc_csn_id) AS best FROM (
    SELECT *, CASE WHEN msg_tm >= TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS batch FROM ({_STATES}))) WHERE h = m""",
    "stream_ingest_fanout": _BROKER_ADT,
    "stream_batch_metrics": f"""
SELECT 'adt_hist' AS table_name, count(*) AS batch_rows, max({_tz("date_trunc('second', o_orderdate)")}) AS latest_msg_tm FROM orders
UNION ALL SELECT 'encntr_dx_hist', count(*), max(msg_tm) FROM ({_HL7_ORDERS["dx"]})
UNION ALL SELECT 'encntr_er_complnt_hist', count(*), max(msg_tm) FROM ({_HL7_ORDERS["er_complaint"]})
UNION ALL SELECT 'encntr_visit_rsn_hist', count(*), max(msg_tm) FROM ({_HL7_ORDERS["visit_reason"]})""",
    "stream_fanout_dx": _HL7_ORDERS["dx"],
    "stream_fanout_er": _HL7_ORDERS["er_complaint"],
    "stream_fanout_visit": _HL7_ORDERS["visit_reason"],
    "stream_xml_files": f"SELECT *, true AS named_by_file FROM ({_XML_ADT_NO_NAME})",
    "stream_table_copy": _STATES,
    "append_stream": _STATES,
    "cluster_by_range": f"SELECT *, true AS in_range FROM ({_STATES})",
    "table_actions": _STATES + " WHERE event_type <> 'error'",
})

# The seed's results, stated on the driver tables themselves: each order's last
# line that counts (by aggregation), and names by scalar look-ups.
_SEEDED = """WITH last AS (
  SELECT l_orderkey, max(ROW(l_linenumber, l_shipdate, l_suppkey, l_partkey)) AS m
  FROM lineitem
  WHERE l_returnflag <> 'R' AND l_linenumber NOT IN (4, 7)
    AND date_trunc('day', l_shipdate) BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
    AND l_partkey IN (SELECT p_partkey FROM part)
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (
      SELECT n_nationkey FROM nation WHERE n_nationkey IN (3, 7) OR n_regionkey = (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')))
  GROUP BY l_orderkey),
seeded AS (
  SELECT orders.*, customer.*, m[1] AS line, m[3] AS place, m[4] AS spot, CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS prio
  FROM last, orders, customer
  WHERE o_orderkey = l_orderkey AND c_custkey = o_custkey AND o_orderstatus IN ('O', 'F')
    AND o_orderdate >= TIMESTAMP '1996-01-01' AND c_acctbal >= -500 AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')
    AND (o_orderstatus = 'O' OR date_trunc('day', o_orderdate) + INTERVAL 30 DAY >= TIMESTAMP '1998-12-30'))
"""
_PRIO = "(SELECT {} FROM region WHERE r_regionkey = prio)"


def _carried(rest: str) -> str:
    return "'STL' AS msg_src, TIMESTAMP '1999-01-01 00:00:00' AS msg_tm, o_orderkey AS pat_enc_csn_id, " + rest


ORACLE.update({
    "seed_adt": _SEEDED + f"""SELECT 'ETL' AS msg_typ, 'ETL' AS trigger_evnt, 'ETL' AS msg_nm, 'ETL' AS bod_id, {_carried('')}
  'MRN' || c_custkey AS pat_mrn_id, CAST(DATE '1950-01-01' + c_nationkey AS TIMESTAMP) AS birth_date, CAST(NULL AS TIMESTAMP) AS death_date,
  o_orderdate AS hosp_admsn_time, o_orderdate AS adt_arrival_time,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS hosp_disch_time, o_orderkey + 1000000 AS hsp_account_id,
  'U' || place AS user_id, 'DEP' || place AS department_abbr,
  (SELECT n_name FROM nation WHERE n_nationkey = (SELECT s_nationkey FROM supplier WHERE s_suppkey = place)) AS loc_abbr,
  (SELECT p_name FROM part WHERE p_partkey = spot) AS room_nm, (SELECT p_brand FROM part WHERE p_partkey = spot) AS bed_label,
  (SELECT n_name FROM nation WHERE n_nationkey = (SELECT p_size FROM part WHERE p_partkey = spot)) AS bed_status,
  (SELECT 'ACC ' || n_name FROM nation WHERE n_nationkey = 6 * line) AS accommodation_abbr,
  (SELECT left(n_name, 1) FROM nation WHERE n_nationkey = 2 * c_nationkey) AS sex_abbr,
  {_PRIO.format('r_name')} AS pat_class_abbr, {_PRIO.format('r_name')} AS acuity_level_abbr,
  {_PRIO.format("'D-' || r_name")} AS disch_disp_abbr, {_PRIO.format("'ARR ' || r_name")} AS means_of_arrv_abbr,
  {_PRIO.format("'ED ' || r_name")} AS ed_disposition_abbr
FROM seeded""",
    "seed_dx": _SEEDED + f"""SELECT {_carried("'ICD' || p_partkey AS dx_icd_cd, p_name AS dx_name, 'ICD-10-CM' AS dx_code_type")}
FROM lineitem, part, seeded WHERE l_orderkey = o_orderkey AND p_partkey = l_partkey + l_partkey""",
    "seed_er": _SEEDED + f"""SELECT {_carried("unnest(c) AS er_complaint")}
FROM seeded, (SELECT l_orderkey, list(DISTINCT concat('C', l_linestatus, l_returnflag)) AS c FROM lineitem GROUP BY 1) AS x WHERE x.l_orderkey = o_orderkey""",
    "seed_visit_reason": _SEEDED + f"""SELECT {_carried("'RSN ' || n_name AS encntr_rsn")}
FROM seeded, nation WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey % 40 = n_nationkey)""",
})

ORACLE["retention_job"] = ORACLE["retention_master"]
ORACLE["retention_job_child"] = ORACLE["retention_child"]

_EARLY = """(SELECT * FROM (SELECT o_custkey AS k, o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS t FROM orders))"""
_GONE = f"SELECT k FROM {_EARLY} WHERE CAST(t AS DATE) < DATE '1995-01-03'"
_LEFT = f"""WITH gone AS (SELECT {_ORDER_CSN} AS k FROM orders
  WHERE o_orderstatus = 'F' AND CAST({_tz("date_trunc('second', o_orderdate)")} AS DATE) < DATE '1995-12-30')"""
ORACLE.update({
    "retention_touched_files": f"""
SELECT k AS pat_enc_csn_id, o_orderkey, t AS hosp_disch_time, k % 64 NOT IN (SELECT k % 64 FROM ({_GONE})) AS same_file
FROM {_EARLY} WHERE k NOT IN ({_GONE})""",
    "four_table_retention": _LEFT + f"""
SELECT 'adt_hist' AS table_name, {_ORDER_CSN} AS pat_enc_csn_id, count(*) AS n FROM orders WHERE ({_ORDER_CSN}) IS NULL OR ({_ORDER_CSN}) NOT IN (SELECT k FROM gone WHERE k IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'encntr_dx_hist', pat_enc_csn_id, count(*) FROM ({_HL7_ORDERS["dx"]}) WHERE pat_enc_csn_id NOT IN (SELECT k FROM gone WHERE k IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'encntr_er_complnt_hist', pat_enc_csn_id, count(*) FROM ({_HL7_ORDERS["er_complaint"]}) WHERE pat_enc_csn_id NOT IN (SELECT k FROM gone WHERE k IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'encntr_visit_rsn_hist', pat_enc_csn_id, count(*) FROM ({_HL7_ORDERS["visit_reason"]}) WHERE pat_enc_csn_id NOT IN (SELECT k FROM gone WHERE k IS NOT NULL) GROUP BY ALL""",
    "four_table_copy": ORACLE["stream_batch_metrics"].replace("batch_rows", "n").replace("latest_msg_tm", "latest"),
})

ORACLE.update({
    "catalog_tables": f"SELECT *, true AS stamped, (SELECT count(*) FROM events) AS n_before, 0 AS n_after FROM ({_STATES})",
    "bucketed_retention": _MASTER + """
SELECT 'adt_hist' AS table_name, pat_enc_csn_id, CAST(o_orderkey AS VARCHAR) AS item FROM kept
UNION ALL SELECT 'encntr_dx_hist', c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT pat_enc_csn_id FROM kept)""",
    "staged_load": _STATES,
    "committed_batches": f"SELECT *, 0 AS n_dx FROM ({_BROKER_ADT})",
    "stateful_winners": f"""
SELECT pat_enc_csn_id, msg_tm, msg_nm, trigger_evnt, run FROM (
  SELECT *, max(ROW(msg_tm, msg_nm)) OVER (PARTITION BY pat_enc_csn_id ORDER BY run RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
  FROM (SELECT *, CAST(substr(msg_nm, 5) AS BIGINT) % 3 AS run FROM ({_STATES}) WHERE pat_enc_csn_id IS NOT NULL)) WHERE best = ROW(msg_tm, msg_nm)""",
    "live_metrics": f"SELECT 'adt_hist' AS table_name, count(*) AS batch_rows, max(msg_tm) AS latest_msg_tm FROM ({_STATES})",
})

ORACLE.update({
    "upsert_stream": ORACLE["upsert_merge"],
    "append_and_upsert_stream": f"""
SELECT x.*, msg_nm = (SELECT max(ROW(y.msg_tm, y.msg_nm))[2] FROM ({_STATES}) AS y WHERE y.pat_enc_csn_id = x.pat_enc_csn_id) AS is_current FROM ({_STATES}) AS x""",
    "blocking_append": f"SELECT *, (SELECT count(*) FROM events) AS n_counted, false AS running FROM ({_STATES})",
    "archived_files": f"SELECT msg_nm AS value, 1 AS n_held, true AS held, 1 AS n_read FROM ({_STATES})",
    "hl7_normalized": f"SELECT msg_nm, '2.5' AS version, 0 AS n_newlines FROM ({_STATES})",
})
