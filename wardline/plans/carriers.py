"""Message carriers: HL7 v2 and XML text built from the driver tables with Spark expressions.

The driver tables hold no clinical messages, so each query first renders
rows of a table as messages (one per event, one per order with an OBX per
line item, one per customer) and then parses them back. Everything is a
column expression except the per-order OBX list, which is one aggregation on
the order key (an order has a handful of lines, so no group is large).
Every value written is a function of the source row, which is what lets the
oracle SQL compute the expected parse result straight from the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import xmlmsg as X
from wardline.functions.hl7 import (
    OBS_ACUITY, OBS_CHIEF_COMPLAINT, TEXT_ACUITY, TEXT_DX, TEXT_VISIT_REASON, ER_DIAGNOSIS_TYPE,
)

# Event type -> trigger event, order status -> trigger event.
EVENT_TRIGGERS = {"signup": "A04", "view": "A01", "click": "A11", "purchase": "A03", "error": "A13"}
ORDER_TRIGGERS = {"O": "A04", "F": "A03", "P": "A08"}


def _case(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out if default is None else out.otherwise(F.lit(default))


def _s(c) -> Column:
    return F.coalesce((c if isinstance(c, Column) else F.lit(c)).cast("string"), F.lit(""))


def segment(seg_id: str, fields: dict[int, object]) -> Column:
    """One segment line; missing positions are empty. MSH positions start at 2 (MSH-1 is the separator).
    What stands between two columns is one literal."""
    first = 2 if seg_id == "MSH" else 1
    parts, held = [], seg_id
    for i in range(first, max(fields) + 1):
        value = fields.get(i, "")
        held += "|"
        if isinstance(value, str):
            held += value
        else:
            parts += [F.lit(held), _s(value)]
            held = ""
    return F.concat(*parts, F.lit(held))


def hl7_digits(ts: Column, minutes_only: bool = False) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm" if minutes_only else "yyyyMMddHHmmss")


def _event_values(e) -> dict[str, Column]:
    uid, eid, val, et, ts = e["user_id"], e["event_id"], e["value"], e["event_type"], e["ts"]
    return {
        "trig": _case(et, EVENT_TRIGGERS),
        "ts14": hl7_digits(ts),
        # the same times in all layouts: digits to the second or minute, and ISO
        "admit": F.when(et == "click", hl7_digits(ts, True)).when(uid % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
                  .otherwise(hl7_digits(ts)),
        "disch": F.when(uid % 4 == 1, F.date_format(ts + F.expr("INTERVAL '2' HOUR"), "yyyy-MM-dd HH:mm:ss"))
                  .otherwise(hl7_digits(ts + F.expr("INTERVAL '2' HOUR"))),
        "birth": F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), ((uid * 97) % 20000).cast("int")), "yyyyMMdd"),
        "death": F.when(val >= 90, hl7_digits(ts)),
        "sex": F.when(uid % 2 == 0, "F").otherwise("M"),
        "csn": F.when((et == "error") & (val < 3), F.concat(F.lit("X"), uid)).otherwise(uid.cast("string")),
        "hsp": F.when(val < 5, F.concat(F.lit("H"), eid)).otherwise((eid * 10 + 7).cast("string")),
        "dept": F.concat(F.lit("D"), uid % 10), "room": F.concat(F.lit("R"), uid % 50),
        "bed": F.concat(F.lit("B"), eid % 4), "status": F.when(val < 10, "DIRTY").otherwise("READY"),
        "cls": F.upper(et), "disp": F.when(et == "purchase", "HOME"),
        "accom": F.when(uid % 3 == 0, "PRIVATE").when(uid % 3 == 1, "SEMI"),
        "arrival": F.when(et == "signup", "AMB^Ambulance").otherwise("CAR"),
        "ed": F.when(val > 50, "ADMIT").otherwise("DISCHARGE"),
        "user": F.concat(F.lit("U"), uid), "fac": F.concat(F.lit("FAC"), uid % 7),
        "mrn": F.concat(F.lit("M"), uid), "alt": F.concat(F.lit("A"), eid),
        "lvl": F.floor(val / 20).cast("int"),
    }


def _event_break(e) -> Column:
    return F.when(e["event_type"] == "view", "\n").when(e["event_type"] == "click", "\r\n").otherwise("\r")


def hl7_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One HL7 ADT message per event: (msg_nm, text) and the columns to keep. Mapping documented in the oracle SQL."""
    e = {c: F.col(c) for c in events.columns}
    # the values are a projection of their own: with them, the method that renders a message is too long for the JVM to compile
    values = _event_values(e)
    events = events.withColumn("_v", F.struct(*[c.alias(k) for k, c in values.items()]))
    v = {k: F.col("_v")[k] for k in values}
    obx_other = segment("OBX", {1: "0", 2: "TX", 3: "8661-1^OTHER^LN", 4: "0", 5: "x", 11: "F"})
    obx_acuity = F.when(e["value"] > 40, segment("OBX", {
        1: "1", 2: "CWE", 3: f"{OBS_ACUITY}^{TEXT_ACUITY}^LN", 4: "1",
        5: F.concat(v["lvl"], F.lit("^Level "), v["lvl"]), 11: "F"}))
    obx_acuity2 = F.when(e["value"] > 80, segment("OBX", {
        1: "2", 2: "CWE", 3: f"{OBS_ACUITY}^{TEXT_ACUITY}^LN", 4: "2",
        5: F.concat(v["lvl"] + 1, F.lit("^Level "), v["lvl"] + 1), 11: "F"}))
    segs = [
        segment("MSH", {2: "^~\\&", 3: "WLSRC", 4: "WLFAC", 7: v["ts14"],
                        9: F.concat(F.lit("ADT^"), v["trig"], F.lit("^ADT_A01")), 10: e["event_id"], 11: "P", 12: "2.3"}),
        segment("EVN", {1: v["trig"], 2: v["ts14"], 4: "REG",
                        5: F.concat(v["user"], F.lit("^DOE^JO" + "^" * 11), v["fac"])}),
        segment("PID", {1: "1", 3: F.concat(v["mrn"], F.lit("^^^E~"), v["alt"], F.lit("^^^E")),
                        7: v["birth"], 8: v["sex"], 29: v["death"]}),
        segment("PV1", {1: "1", 2: v["cls"],
                        3: F.concat_ws("^", v["dept"], v["room"], v["bed"], F.lit("FACX"), v["status"]),
                        19: v["csn"], 36: v["disp"], 44: v["admit"], 45: v["disch"], 50: v["hsp"]}),
        segment("PV2", {2: v["accom"], 38: v["arrival"]}),
        segment("ZPV", {15: v["ed"]}),
        obx_other, obx_acuity, obx_acuity2,
    ]
    text = F.concat_ws("", *[F.concat(s, _event_break(e)) for s in segs])
    return events.select(F.concat(F.lit("evt-"), e["event_id"]).alias("msg_nm"), text.alias("text"), *keep)


# ---------------------------------------------------------------- XML


def esc(c: Column) -> Column:
    """XML-escape free text. The carrier values are codes and numbers, so nodes take them raw."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


class _Node:
    """Rendered text (not escaped again), one flat list of literals and columns however deep its elements nest, so that
    no sign is copied once for each level. An absent leaf (``whole`` False) is NULL if one of its columns is;
    other text is never NULL and goes without the columns that are."""

    def __init__(self, *parts, whole: bool = False):
        self.parts, self.whole = [], whole
        for p in parts:
            if isinstance(p, str) and self.parts and isinstance(self.parts[-1], str):
                self.parts[-1] += p
            else:
                self.parts.append(p)

    @property
    def col(self) -> Column:
        kids = [p if isinstance(p, Column) else F.lit(p) for p in self.parts]
        return F.concat_ws("", *kids) if self.whole else kids[0] if len(kids) == 1 else F.concat(*kids)


def joined(*children) -> _Node:
    """Elements, columns and literals in a row; those that are NULL leave nothing."""
    out = []
    for c in children:
        if isinstance(c, _Node):
            out += c.parts if c.whole else [c.col]
        else:
            out.append(c)
    return _Node(*out, whole=True)


def node(name: str, *children) -> _Node:
    """``<name>children</name>``: NULL when its only child is NULL (an absent leaf); a parent
    whose children are all absent renders empty, which parses to the same NULL fields."""
    if len(children) == 1 and not isinstance(children[0], str):
        only = children[0] if isinstance(children[0], _Node) else _Node(children[0])
        return _Node(f"<{name}>", *only.parts, f"</{name}>", whole=only.whole)
    return joined(f"<{name}>", *children, f"</{name}>")


def _chain(names: tuple, leaf) -> _Node:
    out = leaf
    for n in reversed(names):
        out = node(n, out)
    return out


def xml_envelope(region, bodid, received, admin_children: list, *groups: list) -> Column:
    head = '<ns0:HL7MessageEnvelope xmlns:ns0="urn:wardline:a" xmlns:ns1="urn:wardline:b">'
    payload = node(X.PAYLOAD, node(X.ADMINISTER, *admin_children, *[node(X.VISIT_GROUP, *g) for g in groups]))
    return joined(head, node(X.REGION, region), node(X.BODID, bodid), node(X.RECEIVED, received), payload, "</ns0:HL7MessageEnvelope>").col


def _ts(name: str, v: Column) -> _Node:
    return node(name, _chain(X.TS[:1], node(X.TS[1], v)))


def _cx(name: str, v: Column) -> _Node:
    return node(name, _chain(X.CX[:1], node(X.CX[1], v)))


def _ce(name: str, v: Column) -> _Node:
    return node(name, _chain(X.CE[:1], node(X.CE[1], v)))


def _hd(name: str, v: Column) -> _Node:
    return node(name, _chain(X.HD[:1], node(X.HD[1], v)))


def obx_xml(code: str, text: Column | str, icd=None, name=None, ctype=None, reason=None) -> _Node:
    oi = node("OBX.3.ObservationIdentifier", node(X.OI, node("OI.1.Identifier", code), node("OI.2.Text", text)))
    xad = node("OBX.5.ObservationValue_XAD", node(X.XAD,
               node("XAD.1.StreetAddress", _chain(X.SAD[:1], node(X.SAD[1], icd))),
               node("XAD.2.OtherDesignation", name), node("XAD.3.City", ctype), node("XAD.9.CountyparishCode", reason)))
    return node(X.OBX, oi, xad)


def xml_from_events(events: DataFrame) -> DataFrame:
    """One XML envelope per event, same field values as :func:`hl7_from_events`."""
    e = {c: F.col(c) for c in events.columns}
    v = _event_values(e)
    arrival_code = F.split(v["arrival"], r"\^")[0]
    msh = node(X.MSH, node("MSH.9.MessageType", node("ns0:MSG.MessageType",
               node("MSG.1.MessageCode", "ADT"), node("MSG.2.TriggerEvent", v["trig"]))))
    evn = node(X.EVN, node("EVN.5.OperatorID", node(X.XCN, node("XCN.1.IDNumber", v["user"]),
               _hd("XCN.14.AssigningFacility", v["fac"]))))
    pid = node(X.PID, _cx("PID.3.PatientIdentifierList", v["mrn"]), _cx("PID.3.PatientIdentifierList", v["alt"]),
               _ts("PID.7.DatetimeOfBirth", v["birth"]), node("PID.8.Sex", v["sex"]),
               _ts("PID.29.PatientDeathDateAndTime", v["death"]))
    pv2 = node(X.PV2, _ce("PV2.2.AccommodationCode", v["accom"]), _ce("PV2.38.ModeOfArrivalCode", arrival_code))
    zpv = node(X.ZPV, node("ZPV.15.EDDisposition", v["ed"]))
    pv1 = node(X.PV1, node("PV1.2.PatientClass", v["cls"]),
               node("PV1.3.AssignedPatientLocation", node(X.PL, node("PL.1.PointOfCare", v["dept"]),
                    node("PL.2.Room", v["room"]), _hd("PL.3.Bed", v["bed"]), node("PL.5.LocationStatus", v["status"]))),
               _cx("PV1.19.VisitNumber", v["csn"]), node("PV1.36.DischargeDisposition", v["disp"]),
               _ts("PV1.44.AdmitDatetime", v["admit"]), _ts("PV1.45.DischargeDatetime", v["disch"]),
               _cx("PV1.50.AlternateVisitID", v["hsp"]))
    lvl = v["lvl"]
    obx = [obx_xml(OBS_CHIEF_COMPLAINT, "OTHER", name=F.lit("x")),
           _Node(F.when(e["value"] > 40, obx_xml(OBS_ACUITY, TEXT_ACUITY, name=F.concat(F.lit("Level "), lvl)).col)),
           _Node(F.when(e["value"] > 80, obx_xml(OBS_ACUITY, TEXT_ACUITY, name=F.concat(F.lit("Level "), lvl + 1)).col))]
    received = (F.when(e["event_id"] % 3 == 0, F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                .when(e["event_id"] % 3 == 1, hl7_digits(e["ts"])).otherwise(F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss")))
    text = xml_envelope(F.lit("OKC"), e["event_id"].cast("string"), received, [msh, evn, pid, pv2, zpv], [pv1, *obx])
    return events.select(F.concat(F.lit("evt-"), e["event_id"]).alias("msg_nm"), text.alias("text"))


# ---------------------------------------------------------------- orders + line items


def _line_values(l) -> dict[str, Column]:
    return {
        "kind": l["l_returnflag"],  # R -> diagnosis OBX, A -> visit reason OBX, N -> acuity OBX
        "icd": F.when(l["l_discount"] > 0, F.concat(F.lit("P"), l["l_partkey"])),
        "dxname": F.when(l["l_discount"] > 0, F.concat(F.lit("Part "), l["l_partkey"])),
        "ctype": F.when(l["l_linestatus"] == "O", "ICD-10-CM"),
        "reason": F.when(l["l_tax"] > 0, F.concat(F.lit("Reason "), l["l_suppkey"])),
        "lvl": F.concat(F.lit("Q"), l["l_quantity"].cast("int")),
    }


def _order_values(o) -> dict[str, Column]:
    prio = o["o_orderpriority"]
    return {
        "trig": _case(o["o_orderstatus"], ORDER_TRIGGERS),
        "ts14": hl7_digits(o["o_orderdate"]),
        "csn": F.when((o["o_orderstatus"] == "P") & (prio == "5-LOW"), F.concat(F.lit("V"), o["o_orderkey"]))
                .otherwise(o["o_orderkey"].cast("string")),
        "dg1_type": F.when(prio.isin("1-URGENT", "2-HIGH"), ER_DIAGNOSIS_TYPE).otherwise("OTHER"),
        "dg1_desc": F.when(prio != "2-HIGH", prio).otherwise(F.when(o["o_totalprice"] > 200000, prio)),
        "second_dg1": prio == "3-MEDIUM",
    }


def _obx_hl7(l, v) -> Column:
    ln = l["l_linenumber"]
    dx = segment("OBX", {1: ln, 2: "CWE", 3: f"{OBS_CHIEF_COMPLAINT}^{TEXT_DX}^LN", 4: ln,
                         5: F.concat_ws("^", _s(v["icd"]), _s(v["dxname"]), _s(v["ctype"])), 11: "F"})
    rsn = segment("OBX", {1: ln, 2: "TX", 3: f"{OBS_CHIEF_COMPLAINT}^{TEXT_VISIT_REASON}^LN", 4: ln,
                          5: F.concat(F.lit("^" * 8), _s(v["reason"])), 11: "F"})
    acu = segment("OBX", {1: ln, 2: "CWE", 3: f"{OBS_ACUITY}^{TEXT_ACUITY}^LN", 4: ln,
                          5: F.concat(F.lit("x^"), v["lvl"]), 11: "F"})
    return F.when(v["kind"] == "R", dx).when(v["kind"] == "A", rsn).otherwise(acu)


def _obx_xml(l, v) -> Column:
    dx = obx_xml(OBS_CHIEF_COMPLAINT, TEXT_DX, icd=v["icd"], name=v["dxname"], ctype=v["ctype"]).col
    rsn = obx_xml(OBS_CHIEF_COMPLAINT, TEXT_VISIT_REASON, reason=v["reason"]).col
    acu = obx_xml(OBS_ACUITY, TEXT_ACUITY, name=v["lvl"]).col
    return F.when(v["kind"] == "R", dx).when(v["kind"] == "A", rsn).otherwise(acu)


#: Columns of a line item that its OBX segment and its place among the others are made of.
LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_discount", "l_linestatus", "l_tax")


def _order_lines(lineitem: DataFrame, render) -> DataFrame:
    """Per order: its OBX segments ordered by (line number, part, supplier, quantity); one bounded aggregation per order.

    The line items are shuffled and rendered behind the shuffle: a segment is many times as long as what it is made of."""
    from wardline.plans.queries import spread

    lineitem = spread(lineitem)  # a no-op for a source with enough splits
    per_order = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*LINE).alias("line")) \
        .groupBy("o_orderkey").agg(F.collect_list("line").alias("lines"))

    def rendered(line: Column) -> Column:
        l = {c: line[c] for c in LINE}
        order = [l["l_linenumber"].alias("n"), l["l_partkey"].alias("p"), l["l_suppkey"].alias("q"), l["l_quantity"].alias("r")]
        return F.struct(*order, render(l, _line_values(l)).alias("s"))

    return per_order.select("o_orderkey", F.sort_array(F.transform("lines", rendered)).alias("obx"))


def hl7_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One HL7 message per order: OBX per line item, DG1 from the priority."""
    lines = _order_lines(lineitem, _obx_hl7)
    j = orders.join(lines, "o_orderkey", "left")
    o = {c: F.col(c) for c in orders.columns}
    v = _order_values(o)
    dg1 = segment("DG1", {1: "1", 2: "ICD-10-CM", 3: "Z00^Exam^ICD-10-CM", 4: v["dg1_desc"], 6: v["dg1_type"]})
    dg1b = F.when(v["second_dg1"], segment("DG1", {1: "2", 4: "second", 6: ER_DIAGNOSIS_TYPE}))
    segs = [
        segment("MSH", {2: "^~\\&", 3: "WLSRC", 4: "WLFAC", 7: v["ts14"],
                        9: F.concat(F.lit("ADT^"), v["trig"], F.lit("^ADT_A01")), 10: o["o_orderkey"], 11: "P", 12: "2.3"}),
        segment("PID", {1: "1", 3: F.concat(F.lit("C"), o["o_custkey"], F.lit("^^^MR"))}),
        segment("PV1", {1: "1", 2: "INPATIENT", 19: v["csn"], 44: v["ts14"]}),
        dg1, dg1b,
        F.array_join(F.transform(F.coalesce(F.col("obx"), F.array()), lambda x: x["s"]), "\r"),
    ]
    text = F.concat_ws("\r", *segs)
    return j.select(F.concat(F.lit("ord-"), o["o_orderkey"]).alias("msg_nm"), text.alias("text"))


def xml_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One XML envelope per order, same values as :func:`hl7_from_orders`."""
    lines = _order_lines(lineitem, _obx_xml)
    j = orders.join(lines, "o_orderkey", "left")
    o = {c: F.col(c) for c in orders.columns}
    v = _order_values(o)
    msh = node(X.MSH, node("MSH.9.MessageType", node("ns0:MSG.MessageType",
               node("MSG.1.MessageCode", "ADT"), node("MSG.2.TriggerEvent", v["trig"]))))
    pid = node(X.PID, _cx("PID.3.PatientIdentifierList", F.concat(F.lit("C"), o["o_custkey"])))
    dg1 = node(X.DG1, node("DG1.4.DiagnosisDescription", v["dg1_desc"]), node("DG1.6.DiagnosisType", v["dg1_type"]))
    dg1b = _Node(F.when(v["second_dg1"], node(X.DG1, node("DG1.4.DiagnosisDescription", "second"),
                                                  node("DG1.6.DiagnosisType", ER_DIAGNOSIS_TYPE)).col))
    pv1 = node(X.PV1, node("PV1.2.PatientClass", "INPATIENT"), _cx("PV1.19.VisitNumber", v["csn"]),
               _ts("PV1.44.AdmitDatetime", v["ts14"]))
    # observations sit in the visit group, beside it, in both, under a parent that no one knows, or in two groups
    place, lines = o["o_orderkey"] % 5, F.coalesce(F.col("obx"), F.array())
    early = F.filter(lines, lambda x: x["n"] <= 2)

    def put(where, of) -> _Node:
        return _Node(F.when(where, F.array_join(F.transform(of, lambda x: x["s"]), "")))

    late = put(place.isin(2, 4), F.filter(lines, lambda x: x["n"] > 2))
    beside = [put(place == 1, lines), put(place == 2, early)]
    other = put(place == 3, lines)
    known, unknown = (_Node(F.when(c, F.concat_ws("", dg1.col, dg1b.col))) for c in (place != 3, place == 3))
    # what no parser may read as segments: comments, CDATA, an empty element with a sign of markup in its attribute
    old_dg1 = node(X.DG1, node("DG1.4.DiagnosisDescription", "STALE"), node("DG1.6.DiagnosisType", ER_DIAGNOSIS_TYPE)).col
    old_obx = obx_xml(OBS_CHIEF_COMPLAINT, TEXT_DX, icd=F.lit("OLD"), name=F.lit("OLD"), ctype=F.lit("OLD"), reason=F.lit("OLD")).col
    noise = (F.when(o["o_orderkey"] % 7 == 0, F.concat(F.lit("<!-- was: "), old_dg1, old_obx, F.lit(" -->")))
             .when(o["o_orderkey"] % 7 == 1, F.concat(F.lit("<Note><![CDATA[<!-- "), old_dg1, old_obx, F.lit("]]></Note>")))
             .when(o["o_orderkey"] % 7 == 2, F.lit(f'<{X.OBX} note="a > b" kind=\'none\'/>')))
    strange = _Node(F.concat(F.lit("<ns0:Other><Inner>"), F.concat_ws("", noise, unknown.col, other.col), F.lit("</Inner></ns0:Other>")))
    received = F.date_format(o["o_orderdate"], "yyyy-MM-dd'T'HH:mm:ss'Z'")
    region = F.when(o["o_orderpriority"] == "4-NOT SPECIFIED", F.lit(None).cast("string")).otherwise(F.lit("OKC"))
    text = xml_envelope(region, o["o_orderkey"].cast("string"), received, [msh, pid, known, strange, *beside],
                        [pv1, put(place == 0, lines), put(place == 4, early)], [late])
    return j.select(F.concat(F.lit("ord-"), o["o_orderkey"]).alias("msg_nm"), text.alias("text"))


def hl7_from_customers(customer: DataFrame) -> DataFrame:
    """One message per customer; PID-3 has two repetitions, the first sometimes without an id."""
    c = {k: F.col(k) for k in customer.columns}
    first = F.when(c["c_mktsegment"] == "BUILDING", F.lit("")).otherwise(F.concat(F.lit("C"), c["c_custkey"]))
    pid3 = F.concat(first, F.lit("^^^MR~N"), c["c_nationkey"], F.lit("^^^NAT"))
    segs = [
        segment("MSH", {2: "^~\\&", 3: "WLSRC", 7: "20240105104652", 9: "ADT^A08^ADT_A01", 10: c["c_custkey"], 11: "P", 12: "2.3"}),
        segment("PID", {1: "1", 3: pid3, 8: "U"}),
    ]
    return customer.select(F.concat(F.lit("cus-"), c["c_custkey"]).alias("msg_nm"), F.concat_ws("\r", *segs).alias("text"))


def damage_events(msgs: DataFrame) -> DataFrame:
    """Rewrites some event messages (with event_type and value kept) into rejects: low-value errors
    lose their header, low-value purchases use one sign for two separators, low-value views lose the version."""
    t, et, val = F.col("text"), F.col("event_type"), F.col("value")
    text = (F.when((et == "error") & (val < 4), F.regexp_replace(t, "^MSH", "XXX"))
            .when((et == "purchase") & (val < 4), F.regexp_replace(t, r"^MSH\|\^~\\&", r"MSH|^^\\&"))
            .when((et == "view") & (val < 4), F.regexp_replace(t, r"\|2\.3([\r\n])", "|$1"))
            .otherwise(t))
    return msgs.select("msg_nm", text.alias("text"))


# Separators that a feed may use (field, component, repetition, escape, subcomponent),
# and a text with every sign that some feed would have to escape.
FEEDS = ("|^~\\&", "#^~\\&", "|$~\\&", "!@*%?")
HARD_TEXT = "A|D^M~I\\T&#$!@*%?"


def foreign_events(events: DataFrame) -> DataFrame:
    """Event messages in the separators of one of ``FEEDS`` (by event id); the ED disposition of valuable events is
    ``HARD_TEXT`` and an accent, the bed status READY is partly in hex, both escaped as the feed needs it."""
    msgs = hl7_from_events(events, keep=("event_id",))
    out = None
    for i, own in enumerate(FEEDS):
        escape = {c: f"{own[3]}{code}{own[3]}" for c, code in zip(own, "FSRET")}
        hard = "".join(escape.get(c, c) for c in HARD_TEXT) + f"{own[3]}XC3A9{own[3]}"
        text = F.col("text")
        for usual, sign in zip("|^~\\&", own):  # a feed's own signs are none of the usual ones, so they go one by one
            text = F.replace(text, F.lit(usual), F.lit(sign)) if sign != usual else text
        text = F.replace(F.replace(text, F.lit(f"{own[0]}ADMIT"), F.lit(f"{own[0]}{hard}")), F.lit("READY"), F.lit(f"{own[3]}X5245{own[3]}ADY"))
        last = i == len(FEEDS) - 1
        case = F.col("event_id") % len(FEEDS) == i
        out = F.when(case, text) if out is None else out.otherwise(text) if last else out.when(case, text)
    return msgs.select("msg_nm", out.alias("text"))


def batch_documents(documents: DataFrame, per_file: int = 8) -> DataFrame:
    """Batched files: documents ``doc_id div per_file`` share a file, each part led by a newline."""
    d = documents.select((F.col("doc_id") / per_file).cast("long").alias("file_id"), "doc_id",
                         F.concat(F.lit("\n"), F.col("text")).alias("part"))
    files = d.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("doc_id", "part"))).alias("p"))
    return files.select("file_id", F.array_join(F.transform("p", lambda x: x["part"]), X.BATCH_DELIMITER).alias("text"))


def order_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One document an order: attributes, a comment, repeated lines (parts only where the tax is paid), an empty note."""
    line = F.concat(F.lit("<Line no='"), F.col("l_linenumber"), F.lit("'><Qty>00"), F.col("l_quantity").cast("int"), F.lit("</Qty>"),
                    F.when(F.col("l_tax") > 0, F.concat(F.lit("<Part.Id>"), F.col("l_partkey"), F.lit("</Part.Id>"))).otherwise(""), F.lit("</Line>"))
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*keys, line.alias("s")).alias("line")) \
        .groupBy("o_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    text = F.concat(F.lit("<?xml version='1.0'?>\n<Order status='"), F.col("o_orderstatus"), F.lit("'><!-- <Key>old</Key> --><Key>"), F.col("o_orderkey"),
                    F.lit("</Key><Note>"), F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.col("o_orderpriority")), F.lit("</Note><Lines>"),
                    F.array_join(F.transform(F.coalesce("lines", F.array()), lambda x: x["s"]), ""), F.lit("</Lines></Order>"))
    return orders.join(lines, "o_orderkey", "left").select(text.alias("text"))


def customer_documents(customer: DataFrame) -> DataFrame:
    """One document a customer: tags twice, an address for some, a kind that only some keys have."""
    place = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("<Address kind='home'><Nation>"), F.col("c_nationkey"), F.lit("</Nation></Address>"))).otherwise("")
    key = F.concat(F.lit("<Key"), F.when(F.col("c_custkey") % 2 == 0, " kind='even'").otherwise(""), F.lit(">"), F.col("c_custkey"), F.lit("</Key>"))
    text = F.concat(F.lit("<Customer>"), key, F.lit("<Tag>all</Tag><Tag>"), F.col("c_mktsegment"), F.lit("</Tag>"), place, F.lit("</Customer>"))
    return customer.select(text.alias("text"))
