"""XML message envelopes as native Spark expressions.

One ``from_xml`` call per message turns the envelope into a typed struct;
every extractor then reads struct paths, so a message is parsed once. The
schema below lists the segments at each parent that is known (the envelope, its
payload, ``AdministerPatient`` and its ``VisitGroup``) and the extractors
coalesce over those parents, which is how a path-suffix lookup is expressed
without re-parsing. Repeated nodes (PID-3, DG1, OBX) are arrays, so one node
is a list of one. Malformed XML yields NULL fields and a ``_corrupt_record``.

The same parse keeps the inside of every element that the schema does not know
(``xs_any``). Only a message in which one of these holds a segment that is read is
looked at again: its markup is cut into comments, CDATA sections, instructions and
the rest, comments go, CDATA becomes escaped text, and then every ``<`` left opens a
tag, so that elements are found by structure under any parent. (A VARIANT parse would
read the number 007 as 7, so it is not used.) Not looked for: a segment inside another
segment that is read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from wardline.functions.hl7 import (
    ACUITY_DELIMITER, ADMIT_TRIGGERS, ARRIVAL_TRIGGERS, DISCHARGE_TRIGGERS, ER_DIAGNOSIS_TYPE,
    OBS_ACUITY, OBS_CHIEF_COMPLAINT, TEXT_ACUITY, TEXT_DX, TEXT_VISIT_REASON, blank_to_null, to_long,
)
from wardline.functions.hl7 import convert as hl7_convert
from wardline.functions.timeparse import hl7_time, iso_time

# The 31-character delimiter between envelopes of a batched file.
BATCH_DELIMITER = "*&*&*&*&*&*&*&*&*&*&*&*&*&*&*&*"
CORRUPT = "_corrupt_record"

# Element names of the envelope and of the segments read.
ENVELOPE = "ns0:HL7MessageEnvelope"
REGION = "ns0:OriginatingRegion"
BODID = "ns1:BODID"
RECEIVED = "ns1:ReceivedDateTime"
PAYLOAD = "ns0:MessagePayload"
ADMINISTER = "ns0:AdministerPatient"
VISIT_GROUP = "VisitGroup"
MSH = "ns0:MSH.MessageHeader"
EVN = "ns0:EVN.EventType"
PID = "ns0:PID.PatientIdentification"
PV1 = "ns0:PV1.PatientVisit"
PV2 = "ns0:PV2.AdditionalInformation"
ZPV = "ns0:ZPV.VisitExtension"
DG1 = "ns0:DG1.Diagnosis"
OBX = "ns0:OBX.ObservationResult"
TS = ("ns0:TS.TimeStamp", "TS.1.Time")
CX = ("ns0:CX.ExtendedCompositeIDWithCheckDigit", "CX.1.IDNumber")
CE = ("ns0:CE.CodedElement", "CE.1.Identifier")
HD = ("ns0:HD.HierarchicDesignator", "HD.1.NamespaceID")
XCN = "ns0:XCN.ExtendedCompositeIDNumberAndNameForPersons"
PL = "ns0:PL.PersonLocation"
OI = "ns0:OI.ObservationIdentifier"
XAD = "ns0:XAD.ExtendedAddress"
SAD = ("ns0:SAD.StreetAddress", "SAD.1.StreetOrMailingAddress")


def _s(spec) -> DataType:
    """Nested spec -> Spark type: None leaf, dict struct, [spec] array, (a, b, ...) chain a/b/..."""
    if spec is None:
        return StringType()
    if isinstance(spec, list):
        return ArrayType(_s(spec[0]))
    if isinstance(spec, tuple):
        head, rest = spec[0], spec[1:]
        if isinstance(head, dict):
            return _s(head)
        return StructType([StructField(head, _s(rest) if rest else StringType())])
    return StructType([StructField(k, _s(v)) for k, v in spec.items()])


_SEGMENTS = {
    MSH: {"MSH.9.MessageType": ("ns0:MSG.MessageType", {"MSG.1.MessageCode": None, "MSG.2.TriggerEvent": None})},
    EVN: {"EVN.5.OperatorID": (XCN, {"XCN.1.IDNumber": None, "XCN.14.AssigningFacility": HD})},
    PID: {
        "PID.3.PatientIdentifierList": [CX],
        "PID.7.DatetimeOfBirth": TS,
        "PID.8.Sex": None,
        "PID.29.PatientDeathDateAndTime": TS,
    },
    PV1: {
        "PV1.2.PatientClass": None,
        "PV1.3.AssignedPatientLocation": (PL, {"PL.1.PointOfCare": None, "PL.2.Room": None,
                                               "PL.3.Bed": HD, "PL.5.LocationStatus": None}),
        "PV1.19.VisitNumber": CX,
        "PV1.36.DischargeDisposition": None,
        "PV1.44.AdmitDatetime": TS,
        "PV1.45.DischargeDatetime": TS,
        "PV1.50.AlternateVisitID": CX,
    },
    PV2: {"PV2.2.AccommodationCode": CE, "PV2.38.ModeOfArrivalCode": CE},
    ZPV: {"ZPV.15.EDDisposition": None},
    DG1: [{"DG1.4.DiagnosisDescription": None, "DG1.6.DiagnosisType": None}],
    OBX: [{
        "OBX.3.ObservationIdentifier": (OI, {"OI.1.Identifier": None, "OI.2.Text": None}),
        "OBX.5.ObservationValue_XAD": (XAD, {"XAD.1.StreetAddress": SAD, "XAD.2.OtherDesignation": None,
                                             "XAD.3.City": None, "XAD.9.CountyparishCode": None}),
    }],
}


def _reading(segments: dict) -> dict:
    """``_SEGMENTS`` for one table alone: of the ``segments`` given only the children given are typed, besides what
    :func:`validity` looks at. The others keep their names, so that they are no unknown elements, but stay text:
    the reader spends most of its time on making structs."""
    unread = {seg: [None] if isinstance(spec, list) else None for seg, spec in _SEGMENTS.items()}
    return {**unread, MSH: _SEGMENTS[MSH], PV1: {"PV1.19.VisitNumber": CX}, **segments}


def _observed(xad: dict) -> list:
    """OBX with its identifier and some of its value's children."""
    return [{**_SEGMENTS[OBX][0], "OBX.5.ObservationValue_XAD": (XAD, xad)}]


#: What each of the children, and an ADT row's acuity, read of an envelope.
DX_ONLY = _reading({OBX: _observed({"XAD.1.StreetAddress": SAD, "XAD.2.OtherDesignation": None, "XAD.3.City": None})})
VISIT_REASON_ONLY = _reading({OBX: _observed({"XAD.9.CountyparishCode": None})})
ER_COMPLAINT_ONLY = _reading({DG1: _SEGMENTS[DG1]})
ACUITY_ONLY = _reading({OBX: _observed({"XAD.2.OtherDesignation": None})})

#: Fixed value: the reader's name for the insides of elements that a schema does not list.
UNKNOWN = "xs_any"


def envelope_schema(segments: dict | None = None) -> StructType:
    """Schema of one envelope for ``from_xml`` (plus the corrupt-record column)."""
    segments = segments or _SEGMENTS
    rest = {UNKNOWN: [None]}  # behind the names of its element: the reader takes what they leave
    group = {**segments, **rest}
    payload = {**segments, ADMINISTER: {**segments, VISIT_GROUP: [group], **rest}, **rest}
    return _s({REGION: None, BODID: None, RECEIVED: None, **segments, PAYLOAD: payload, **rest, CORRUPT: None})


def parse(text: Column, segments: dict | None = None) -> Column:
    """Envelope text -> struct (NULL fields and ``_corrupt_record`` when malformed)."""
    return F.from_xml(text, envelope_schema(segments), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


SEGMENT_KEYS = {MSH: "msh", EVN: "evn", PID: "pid", PV1: "pv1", PV2: "pv2", ZPV: "zpv", DG1: "dg1"}

#: What XML text consists of, if only comments, CDATA sections and instructions count apart: elsewhere a ``<`` opens
#: a tag, since no attribute's value may hold one. Every loop is possessive, so that nothing is tried twice.
MARKUP = r"""<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|<\?[\s\S]*?\?>|(?:[^<]++|<(?!!--|!\[CDATA\[|\?))++"""


def tags_and_text(text: Column) -> Column:
    """The document with no ``<`` but those that open a tag: comments and instructions dropped, CDATA as escaped text."""
    def plain(t: Column) -> Column:
        inside = F.substr(t, F.lit(10), F.length(t) - 12)
        escaped = F.replace(F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(t.startswith("<![CDATA["), escaped).when(~t.startswith("<!--") & ~t.startswith("<?"), t).otherwise("")

    cut = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(MARKUP), F.lit(0)), plain), "")
    return F.when(text.contains("<!") | text.contains("<?"), cut).otherwise(text)


def root_of(tags: Column) -> Column:
    """The opening tag of a root that binds the document's prefixes, under which cut elements can be parsed."""
    prefixes = F.array_distinct(F.regexp_extract_all(tags, F.lit(r"""\sxmlns:([^\s=:"'<>]+)\s*="""), F.lit(1)))
    return F.concat(F.lit("<w"), F.array_join(F.transform(prefixes, lambda p: F.concat(F.lit(" xmlns:"), p, F.lit('="urn:any"'))), ""), F.lit(">"))


def _anywhere(tags: Column, root: Column, seg: str, spec) -> Column:
    """All ``seg`` elements (the first, or an array for repeated segments) wherever they sit, in document order.

    The elements are cut out and parsed on their own, below ``root``; a document that does not name them is not searched.
    """
    name = seg.replace(".", r"\.")
    inside = r"""[^<>"'/]*+(?:(?:"[^"]*+"|'[^']*+'|/(?!>))[^<>"'/]*+)*+"""
    held = rf"(?:[^<]++|<(?!/{name}\s*+>))*+"  # by whole runs of text: a lazy dot costs far more for each sign
    every = F.regexp_extract_all(tags, F.lit(rf"<{name}(?=[\s/>]){inside}(?:/>|>{held}</{name}\s*+>)"), F.lit(0))
    repeated = isinstance(_s(spec), ArrayType)
    wrapped = F.concat(root, F.array_join(every if repeated else F.slice(every, 1, 1), ""), F.lit("</w>"))
    schema = StructType([StructField(seg, _s(spec))])
    return F.when(tags.contains(f"<{seg}"), F.from_xml(wrapped, schema, {"mode": "PERMISSIVE"})[seg])


def _member(field: str):
    return lambda x: x[field]


def _known(env: Column) -> tuple[list[Column], Column]:
    """The parents that hold segments, outermost last, and the array of visit groups."""
    payload = env[PAYLOAD]
    admin = payload[ADMINISTER]
    return [admin, payload, env], admin[VISIT_GROUP]


def strange(env: Column) -> Column:
    """The insides of all elements that the schema does not know and that hold a segment which is read."""
    parents, groups = _known(env)
    none = F.array().cast("array<string>")
    of_groups = F.flatten(F.filter(F.transform(groups, _member(UNKNOWN)), lambda x: x.isNotNull()))
    every = [F.coalesce(p[UNKNOWN], none) for p in parents] + [F.coalesce(of_groups, none)]
    names = "|".join(n.replace(".", r"\.") for n in (*SEGMENT_KEYS, OBX))
    return F.filter(F.concat(*every), lambda x: x.rlike(f"<(?:{names})"))


def locate(env: Column, text: Column) -> Column:
    """The document's tags and text if a segment may sit below an element that the schema does not know, else NULL."""
    return F.when(env[CORRUPT].isNull() & (F.size(strange(env)) > 0), tags_and_text(text))


def _repeated(env: Column, tags: Column | None, root: Column | None, seg: str, spec) -> Column:
    """All elements of a repeated segment: of the known parents (outermost last, groups after
    ``AdministerPatient``) or, if other parents hold segments, all of the document."""
    parents, groups = _known(env)
    none = F.array().cast(_s(spec))
    in_groups = F.flatten(F.filter(F.transform(groups, _member(seg)), lambda x: x.isNotNull()))
    known = F.concat(*[F.coalesce(c, none) for c in (parents[0][seg], in_groups, parents[1][seg], parents[2][seg])])
    return known if tags is None else F.when(tags.isNotNull(), F.coalesce(_anywhere(tags, root, seg, spec), known)).otherwise(known)


def normalize(env: Column, tags: Column | None = None, root: Column | None = None, segments: dict | None = None) -> Column:
    """P8/P9 once per message: each segment taken from whichever known parent holds it,
    else (given :func:`locate`'s column and, if it was cut before, :func:`root_of`'s) from anywhere in the document.

    struct<region, bodid, received, corrupt, msh, evn, pid, pv1, pv2, zpv, dg1, obx>;
    extractors read this flat struct, so the parent lookup is not repeated per field.
    Of fewer ``segments`` parsed, those that stayed text are left out.
    """
    segments = segments or _SEGMENTS
    parents, groups = _known(env)
    if tags is not None and root is None:
        root = root_of(tags)
    parts = [env[REGION].alias("region"), env[BODID].alias("bodid"), env[RECEIVED].alias("received"),
             env[CORRUPT].alias("corrupt")]
    for seg, k in {**SEGMENT_KEYS, OBX: "obx"}.items():
        spec = segments[seg]
        if spec in (None, [None]):
            continue
        if isinstance(spec, list):  # repeated
            parts.append(_repeated(env, tags, root, seg, spec).alias(k))
            continue
        # of several groups the last one that has the segment
        in_groups = F.try_element_at(F.filter(F.transform(groups, _member(seg)), lambda x: x.isNotNull()), F.lit(-1))
        found = [parents[0][seg], in_groups, parents[1][seg], parents[2][seg]]
        if tags is not None:
            found.append(F.when(tags.isNotNull(), _anywhere(tags, root, seg, spec)))
        parts.append(F.coalesce(*found).alias(k))
    return F.struct(*parts)


def validity(m: Column) -> Column:
    """NULL when the envelope parsed, else the quarantine reason (``m`` is the normalized struct)."""
    return F.when(m.isNull() | (m["region"].isNull() & m["corrupt"].isNull() & m["msh"].isNull() & m["pv1"].isNull()),
                  F.lit("null_text")).when(m["corrupt"].isNotNull(), F.lit("malformed_xml"))


def _path(c: Column, *names: str) -> Column:
    for n in names:
        c = c[n]
    return c


def segment(m: Column, seg: str) -> Column:
    """A segment of the normalized struct."""
    return m[SEGMENT_KEYS[seg]]


def observations(m: Column) -> Column:
    return m["obx"]


def _leaf(c: Column, *names: str) -> Column:
    return blank_to_null(_path(c, *names))


def trigger(m: Column) -> Column:
    return _leaf(segment(m, MSH), "MSH.9.MessageType", "ns0:MSG.MessageType", "MSG.2.TriggerEvent")


def _time(seg: Column, name: str) -> Column:
    return hl7_time(_leaf(seg, name, *TS))


def encounter_id(m: Column) -> Column:
    return to_long(_leaf(segment(m, PV1), "PV1.19.VisitNumber", *CX))


def message_time(m: Column) -> Column:
    return iso_time(_leaf(m, "received"))


def _obx_is(o: Column, code: str, text: str) -> Column:
    oi = o["OBX.3.ObservationIdentifier"][OI]
    return (oi["OI.1.Identifier"] == code) & (oi["OI.2.Text"] == text)


def _xad(o: Column) -> Column:
    return o["OBX.5.ObservationValue_XAD"][XAD]


def acuity(m: Column) -> Column:
    hits = F.filter(observations(m), lambda o: _obx_is(o, OBS_ACUITY, TEXT_ACUITY))
    vals = F.transform(hits, lambda o: blank_to_null(_xad(o)["XAD.2.OtherDesignation"]))
    return blank_to_null(F.array_join(vals, ACUITY_DELIMITER))


def adt_raw(m: Column) -> dict[str, Column]:
    """E1, first step: every ADT column as raw text read from the envelope struct."""
    msh, evn, pid, pv1, pv2, zpv = (segment(m, s) for s in (MSH, EVN, PID, PV1, PV2, ZPV))
    trig = trigger(m)
    loc = pv1["PV1.3.AssignedPatientLocation"][PL]
    xcn = evn["EVN.5.OperatorID"][XCN]
    return {
        "msg_typ": _leaf(msh, "MSH.9.MessageType", "ns0:MSG.MessageType", "MSG.1.MessageCode"),
        "msg_src": _leaf(m, "region"),
        "trigger_evnt": trig,
        "msg_tm": _leaf(m, "received"),
        "bod_id": _leaf(m, "bodid"),
        "pat_mrn_id": blank_to_null(F.get(pid["PID.3.PatientIdentifierList"], 0)[CX[0]][CX[1]]),
        "pat_enc_csn_id": _leaf(pv1, "PV1.19.VisitNumber", *CX),
        "birth_date": _leaf(pid, "PID.7.DatetimeOfBirth", *TS),
        "death_date": _leaf(pid, "PID.29.PatientDeathDateAndTime", *TS),
        "pat_class_abbr": _leaf(pv1, "PV1.2.PatientClass"),
        "hosp_admsn_time": F.when(trig.isin(*ADMIT_TRIGGERS), _leaf(pv1, "PV1.44.AdmitDatetime", *TS)),
        "hosp_disch_time": F.when(trig.isin(*DISCHARGE_TRIGGERS), _leaf(pv1, "PV1.45.DischargeDatetime", *TS)),
        "department_abbr": _leaf(loc, "PL.1.PointOfCare"),
        "loc_abbr": _leaf(xcn, "XCN.14.AssigningFacility", *HD),
        "room_nm": _leaf(loc, "PL.2.Room"),
        "bed_label": _leaf(loc, "PL.3.Bed", *HD),
        "bed_status": _leaf(loc, "PL.5.LocationStatus"),
        "sex_abbr": _leaf(pid, "PID.8.Sex"),
        "means_of_arrv_abbr": _leaf(pv2, "PV2.38.ModeOfArrivalCode", *CE),
        "acuity_level_abbr": acuity(m),
        "ed_disposition_abbr": _leaf(zpv, "ZPV.15.EDDisposition"),
        "disch_disp_abbr": _leaf(pv1, "PV1.36.DischargeDisposition"),
        "adt_arrival_time": F.when(trig.isin(*ARRIVAL_TRIGGERS), _leaf(pv1, "PV1.44.AdmitDatetime", *TS)),
        "hsp_account_id": _leaf(pv1, "PV1.50.AlternateVisitID", *CX),
        "accommodation_abbr": _leaf(pv2, "PV2.2.AccommodationCode", *CE),
        "user_id": _leaf(xcn, "XCN.1.IDNumber"),
    }


def convert(name: str, raw: Column) -> Column:
    """E1, second step: the received time is ISO (zone honoured, not localised); other times as HL7."""
    if name == "msg_tm":
        return iso_time(raw)
    return hl7_convert(name, raw)


def adt_columns(m: Column) -> dict[str, Column]:
    return {k: convert(k, v) for k, v in adt_raw(m).items()}


def child_header(m: Column) -> tuple[Column, Column, Column]:
    """Region, received time, encounter; rows need all three."""
    return _leaf(m, "region"), message_time(m), encounter_id(m)


def dx_rows(m: Column) -> Column:
    hits = F.filter(observations(m), lambda o: _obx_is(o, OBS_CHIEF_COMPLAINT, TEXT_DX))
    rows = F.transform(hits, lambda o: F.struct(
        blank_to_null(_xad(o)["XAD.1.StreetAddress"][SAD[0]][SAD[1]]).alias("dx_icd_cd"),
        blank_to_null(_xad(o)["XAD.2.OtherDesignation"]).alias("dx_name"),
        blank_to_null(_xad(o)["XAD.3.City"]).alias("dx_code_type")))
    return F.filter(rows, lambda r: r["dx_icd_cd"].isNotNull() | r["dx_name"].isNotNull() | r["dx_code_type"].isNotNull())


def visit_reasons(m: Column) -> Column:
    hits = F.filter(observations(m), lambda o: _obx_is(o, OBS_CHIEF_COMPLAINT, TEXT_VISIT_REASON))
    return F.filter(F.transform(hits, lambda o: blank_to_null(_xad(o)["XAD.9.CountyparishCode"])), lambda r: r.isNotNull())


def er_complaint(m: Column) -> Column:
    first = F.get(segment(m, DG1), 0)
    return F.when(first["DG1.6.DiagnosisType"] == ER_DIAGNOSIS_TYPE, blank_to_null(first["DG1.4.DiagnosisDescription"]))


def split_batch(text: Column) -> Column:
    """Batched file -> array of envelopes; one leading newline stripped per part, empty parts dropped."""
    parts = F.split(text, r"\Q" + BATCH_DELIMITER + r"\E")
    stripped = F.transform(parts, lambda p: F.when(p.startswith("\n"), F.substr(p, F.lit(2))).otherwise(p))
    return F.filter(stripped, lambda p: F.octet_length(p) > 0)  # known without a look at every sign, as a length is not


def flatten_struct(c: Column, dtype: StructType, prefix: str = "") -> list[Column]:
    """P10: one column per leaf, named by its dotted path; for a repeated node the last element
    that has the leaf wins, leaf by leaf."""
    return [read(c).alias(name) for name, read in leaf_paths(dtype, prefix)]


def leaf_paths(dtype: StructType, prefix: str = "") -> list:
    """(dotted path, function from the struct to the leaf) of every leaf."""
    return list(_leaves(dtype, prefix))


def _leaves(dtype: StructType, prefix: str):
    """(dotted name, function from the struct to the leaf)."""
    for f in dtype.fields:
        name = f"{prefix}.{f.name}" if prefix else f.name
        t, many = f.dataType, isinstance(f.dataType, ArrayType)
        t = t.elementType if many else t
        inner = _leaves(t, name) if isinstance(t, StructType) else [(name, lambda x: x)]
        for leaf, read in inner:
            yield leaf, _last_of(f.name, read) if many else _child_of(f.name, read)


def _child_of(field: str, read):
    return lambda c: read(c[field])


def _last_of(field: str, read):
    return lambda c: F.try_element_at(F.filter(F.transform(c[field], read), lambda x: x.isNotNull()), F.lit(-1))
