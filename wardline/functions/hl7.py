"""HL7 v2 pipe messages as native Spark column expressions.

A message is never handed to Python. The text is split into segments once;
the first segment of each id that is read (MSH, EVN, PID, PV1, PV2, ZPV,
DG1) is picked and split into fields, and the repeating OBX segments come out
as an array of field arrays. Field addressing then is plain array access:

* field ``n`` of a segment is ``fields[n]`` (``fields[0]`` is the id);
  for MSH it is ``fields[n-1]`` because MSH-1 is the field separator itself;
* a whole field means its first repetition (``~``), left encoded;
* component ``c`` is the ``c``-th ``^`` piece of the first repetition;
* empty text reads as NULL, as does anything missing.

A message names its own separators in MSH-1 and MSH-2. One that uses others than
``|^~\\&``, or that holds escape sequences, is rewritten once (:func:`canonical`):
its separators become the usual ones, and a sign that is data but looks like one of
them becomes a mark (a code point reserved for such use), which the readers of a field
turn back. So every reader below knows one set of separators only, and a whole field
of several components leaves with these. Highlighting, charset and site escapes
stay as they are.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions.timeparse import hl7_time

# Separators, segment break, the default encoding characters.
FIELD_SEP = r"\|"
REPETITION_SEP = "~"
COMPONENT_SEP = r"\^"
SEGMENT_BREAK = r"[\r\n]+"
DEFAULT_ENCODING = "^~\\&"
DEFAULT_HEADER = "MSH|" + DEFAULT_ENCODING
# Signs with a meaning in a message, the marks (noncharacters, never in text) that stand
# for them where they are data, and the escape code of each separator.
SIGNS = "|^~\\&\r\n"
MARKS = "".join(chr(0xFDD0 + i) for i in range(len(SIGNS)))
ESCAPES = "FSRET"
ESCAPED = r"\\(?:[FSTRE]|X(?:[0-9A-Fa-f]{2})+)\\|[^\\]+|\\"

# Observation codes and texts, the ER diagnosis type, the
# acuity delimiter and the constant message source of the HL7 feed.
OBS_CHIEF_COMPLAINT = "8661-1"
TEXT_DX = "CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED"
TEXT_VISIT_REASON = "CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100"
OBS_ACUITY = "11283-9"
TEXT_ACUITY = "ACUITY ASSESSMENT AT FIRST ENCOUNTER"
ER_DIAGNOSIS_TYPE = "10800;EPT"
ACUITY_DELIMITER = "|||"
HL7_SOURCE = "STL"

# Trigger events that carry each visit time.
ARRIVAL_TRIGGERS = ("A04",)
ADMIT_TRIGGERS = ("A01", "A11")
DISCHARGE_TRIGGERS = ("A03", "A13")

SINGLE_SEGMENTS = ("EVN", "PID", "PV1", "PV2", "ZPV", "DG1")


def separators(text: Column) -> tuple[Column, Column]:
    """MSH-1, and MSH-2 as it stands (component, repetition, escape, subcomponent, maybe truncation)."""
    sep = F.substring(text, 4, 1)
    return sep, F.call_function("substring_index", F.substr(text, F.lit(5)), sep, F.lit(1))


def canonical(text: Column) -> Column:
    """The message with the default separators, its escape sequences decoded; most messages are this already."""
    plain = text.startswith(DEFAULT_HEADER + "|") & ~F.substr(text, F.lit(len(DEFAULT_HEADER) + 1)).contains("\\")
    return F.when(plain | ~text.startswith("MSH"), text).otherwise(_rewritten(text))


def _as_data(x: Column) -> Column:
    """Signs that would be read as separators, as marks."""
    return F.translate(x, SIGNS, MARKS)


def _rewritten(text: Column) -> Column:
    sep, encoding = separators(text)
    own = F.concat(sep, F.substring(encoding, 1, 4))
    raw = F.substr(text, F.length(encoding) + 5)
    # at once: own separators to the default ones, default ones that are data here to marks
    at_once = F.call_function("translate", raw, F.concat(own, F.lit(SIGNS[:5])), F.lit(SIGNS[:5] + MARKS[:5]))
    # one by one, which is several times faster: if no separator is a default one out of its place
    signs = [F.substring(text, 4 + i, 1) for i in range(5)]
    apart, one_by_one = F.lit(True), raw
    for i, sign in enumerate(signs):
        apart &= (sign == SIGNS[i]) | ~F.lit(SIGNS[:5]).contains(sign)
        apart &= (sign != signs[0]) if i else F.lit(True)
        one_by_one = F.replace(one_by_one, F.when(sign == SIGNS[i], "").otherwise(SIGNS[i]), F.lit(MARKS[i]))
    for i, sign in enumerate(signs):
        one_by_one = F.replace(one_by_one, F.when(sign == SIGNS[i], "").otherwise(sign), F.lit(SIGNS[i]))
    body = F.when(apart, one_by_one).otherwise(at_once)

    def plain(t: Column) -> Column:
        code = F.substring(t, 2, 1)
        out = F.when(~t.startswith("\\") | (t == "\\"), t)
        for i, c in enumerate(ESCAPES):
            out = out.when(code == c, _as_data(F.substr(own, F.lit(i + 1), F.lit(1))))
        return out.otherwise(_as_data(F.decode(F.unhex(F.substr(t, F.lit(3), F.length(t) - 3)), "UTF-8")))

    decoded = F.array_join(F.transform(F.regexp_extract_all(body, F.lit(ESCAPED), F.lit(0)), plain), "")
    return F.concat(F.lit(DEFAULT_HEADER), F.when(apart & ~raw.contains(signs[3]), one_by_one).otherwise(decoded))


def literal(x: Column) -> Column:
    """A value's marks as the signs they stand for."""
    return F.translate(x, MARKS, SIGNS)


def literal_held(x: Column) -> Column:
    """:func:`literal` of a value that an earlier projection holds, so that it costs nothing to name it thrice:
    marks are no ASCII, and a value without them is not rewritten sign by sign."""
    return F.when(F.length(x) == F.octet_length(x), x).otherwise(literal(x))


def lines(text: Column) -> Column:
    """The message's segments, one string each (empty lines dropped)."""
    return F.split(canonical(text), SEGMENT_BREAK)


def segment_fields(segs: Column, seg: str) -> Column:
    """Fields of the first ``seg`` segment, index 0 = the segment id (MSH must lead the message)."""
    if seg == "MSH":
        first = F.get(segs, 0)
        return F.split(F.when(first.startswith("MSH|"), first), FIELD_SEP)
    return F.split(F.get(F.filter(segs, lambda s: s.startswith(seg + "|")), 0), FIELD_SEP)


def repeating_segments(segs: Column, seg: str = "OBX") -> Column:
    """All ``seg`` segments in order, each as its field array."""
    return F.transform(F.filter(segs, lambda s: s.startswith(seg + "|")), lambda s: F.split(s, FIELD_SEP))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def field(fields: Column, n: int, seg: str = "") -> Column:
    """Raw field ``n`` (all repetitions), NULL when absent."""
    return F.get(fields, n - 1 if seg == "MSH" else n)


def whole(fields: Column, n: int, seg: str = "") -> Column:
    """Field ``n`` as one value: its first repetition, still encoded; empty -> NULL."""
    return literal(cut_whole(fields, n, seg))


def cut_whole(fields: Column, n: int, seg: str = "") -> Column:
    return blank_to_null(F.get(F.split(field(fields, n, seg), REPETITION_SEP), 0))


def components(fields: Column, n: int, seg: str = "") -> Column:
    """The components of the first repetition of field ``n``."""
    return F.split(F.get(F.split(field(fields, n, seg), REPETITION_SEP), 0), COMPONENT_SEP)


def part(parts: Column, c: int) -> Column:
    """Component ``c``; empty -> NULL."""
    return literal(cut_part(parts, c))


def cut_part(parts: Column, c: int) -> Column:
    return blank_to_null(F.get(parts, c - 1))


def component(fields: Column, n: int, c: int, seg: str = "") -> Column:
    """Component ``c`` of the first repetition of field ``n`` (P5); empty -> NULL."""
    return part(components(fields, n, seg), c)


def to_long(x: Column) -> Column:
    """Numeric text -> BIGINT, anything else -> NULL."""
    return x.try_cast("bigint")


def normalize(text: Column) -> Column:
    """P2 as written upstream: first ``|2.3`` -> ``|2.5`` and ``\\n`` -> ``\\r``.

    Not needed for positional reads; kept for callers that forward text to
    tools expecting carriage-return segment breaks.
    """
    patched = F.regexp_replace(text, r"^([\s\S]*?)\|2\.3", "$1|2.5")
    return F.regexp_replace(patched, "\n", "\r")


def observation_parts(segs: Column) -> Column:
    """Every OBX as struct<c3, c5>: the components of the first repetition of OBX-3
    (identifier, text, ...) and OBX-5 (the value), split once per observation."""
    def comps(fields: Column, n: int) -> Column:
        return F.split(F.get(F.split(F.get(fields, n), REPETITION_SEP), 0), COMPONENT_SEP)

    return F.transform(repeating_segments(segs, "OBX"),
                       lambda f: F.struct(comps(f, 3).alias("c3"), comps(f, 5).alias("c5")))


def parse_lines(segs: Column) -> Column:
    """P4 over split segments: the parts every extractor reads.

    struct<msh, evn, pid, pv1, pv2, zpv, dg1: array<string>, obx: array<struct<c3, c5: array<string>>>>
    """
    parts = [segment_fields(segs, "MSH").alias("msh")]
    parts += [segment_fields(segs, s).alias(s.lower()) for s in SINGLE_SEGMENTS]
    parts.append(observation_parts(segs).alias("obx"))
    return F.struct(*parts)


def parse(text: Column) -> Column:
    """Message text -> parsed struct (see :func:`parse_lines`)."""
    return parse_lines(lines(text))


def validity(text: Column) -> Column:
    """NULL when the message is accepted, else the reason it is quarantined.

    The separators are the message's own; they must be four or five different signs, none of them
    a letter, a digit or a blank.
    """
    up_to = partial(F.call_function, "substring_index")
    sep = F.substring(text, 4, 1)
    # the first line up to its twelfth separator: all that is checked
    first = F.substring_index(F.substring_index(up_to(text, sep, F.lit(12)), "\r", 1), "\n", 1)
    _, encoding = separators(first)
    signs = F.concat(sep, encoding)
    usual = text.startswith(DEFAULT_HEADER + "|")
    usable = usual | (F.length(encoding).between(4, 5) & ~signs.rlike(r"(?s)(.).*\1|[\p{L}\p{N}\s]"))
    # read with the message's own separators: no escape sequence adds or hides one, or is empty
    version = up_to(first, sep, F.lit(-1))
    version = up_to(up_to(version, F.substring(encoding, 2, 1), F.lit(1)), F.substring(encoding, 1, 1), F.lit(1))
    return (
        F.when(text.isNull(), F.lit("null_text"))
        .when(~text.startswith("MSH") | ~sep.rlike(r"^[^\p{L}\p{N}\s]"), F.lit("not_hl7"))
        .when(~usable, F.lit("encoding"))
        .when(up_to(first, sep, F.lit(11)) == first, F.lit("short_header"))
        .when(version == "", F.lit("no_version"))
    )


def is_valid(text: Column) -> Column:
    return validity(text).isNull()


def _obx_is(o: Column, code: str, text: str) -> Column:
    return (F.get(o["c3"], 0) == code) & (F.get(o["c3"], 1) == text)


def _obx_value(o: Column, c: int) -> Column:
    return literal(blank_to_null(F.get(o["c5"], c - 1)))


def acuity(p: Column) -> Column:
    """E5: OBX-5.2 of every acuity observation joined by ``|||``; none -> NULL."""
    return literal(cut_acuity(p))


def cut_acuity(p: Column) -> Column:
    vals = F.transform(F.filter(p["obx"], lambda o: _obx_is(o, OBS_ACUITY, TEXT_ACUITY)), lambda o: cut_part(o["c5"], 2))
    return blank_to_null(F.array_join(vals, ACUITY_DELIMITER))


def trigger(p: Column) -> Column:
    return component(p["msh"], 9, 2, "MSH")


def adt_parts(p: Column) -> dict[str, Column]:
    """The fields of which an ADT row reads several components, each split once."""
    return {"type": components(p["msh"], 9, "MSH"), "patient": components(p["pid"], 3),
            "place": components(p["pv1"], 3), "operator": components(p["evn"], 5)}


# Output columns that need a conversion after the raw text is cut out.
TIME_COLUMNS = ("msg_tm", "birth_date", "death_date", "hosp_admsn_time", "hosp_disch_time", "adt_arrival_time")
LONG_COLUMNS = ("pat_enc_csn_id", "hsp_account_id")


def adt_raw(p: Column, msg_src: str = HL7_SOURCE, parts: Column | None = None) -> dict[str, Column]:
    """E1, first step: every ADT column as raw text cut from the parsed message; ``parts`` is a
    struct of :func:`adt_parts`, for which a projection before this one cut them.

    Visit times are already gated by the trigger event (E6-E8); times and ids
    are converted by :func:`convert`.
    """
    return {k: literal(v) for k, v in adt_cut(p, msg_src, parts).items()}


def adt_cut(p: Column, msg_src: str = HL7_SOURCE, parts: Column | None = None) -> dict[str, Column]:
    """:func:`adt_raw` with the marks still in the values."""
    msh, evn, pid, pv1, pv2, zpv = (p[k] for k in ("msh", "evn", "pid", "pv1", "pv2", "zpv"))
    c = parts if parts is not None else adt_parts(p)
    event = cut_part(c["type"], 2)
    return {
        "msg_typ": cut_part(c["type"], 1),
        "msg_src": F.lit(msg_src),
        "trigger_evnt": event,
        "msg_tm": cut_whole(msh, 7, "MSH"),
        "bod_id": cut_whole(msh, 10, "MSH"),
        "pat_mrn_id": cut_part(c["patient"], 1),
        "pat_enc_csn_id": cut_whole(pv1, 19),
        "birth_date": cut_whole(pid, 7),
        "death_date": cut_whole(pid, 29),
        "pat_class_abbr": cut_whole(pv1, 2),
        "hosp_admsn_time": F.when(event.isin(*ADMIT_TRIGGERS), cut_whole(pv1, 44)),
        "hosp_disch_time": F.when(event.isin(*DISCHARGE_TRIGGERS), cut_whole(pv1, 45)),
        "department_abbr": cut_part(c["place"], 1),
        "loc_abbr": cut_part(c["operator"], 14),
        "room_nm": cut_part(c["place"], 2),
        "bed_label": cut_part(c["place"], 3),
        "bed_status": cut_part(c["place"], 5),
        "sex_abbr": cut_whole(pid, 8),
        "means_of_arrv_abbr": cut_whole(pv2, 38),
        "acuity_level_abbr": cut_acuity(p),
        "ed_disposition_abbr": cut_whole(zpv, 15),
        "disch_disp_abbr": cut_whole(pv1, 36),
        "adt_arrival_time": F.when(event.isin(*ARRIVAL_TRIGGERS), cut_whole(pv1, 44)),
        "hsp_account_id": cut_whole(pv1, 50),
        "accommodation_abbr": cut_whole(pv2, 2),
        "user_id": cut_part(c["operator"], 1),
    }


def convert(name: str, raw: Column) -> Column:
    """E1, second step: raw text -> typed value (C1/C2 for times, P11 for ids)."""
    if name in TIME_COLUMNS:
        return hl7_time(raw)
    if name in LONG_COLUMNS:
        return to_long(raw)
    return raw


def adt_columns(p: Column, msg_src: str = HL7_SOURCE) -> dict[str, Column]:
    """E1 in one step (raw text and conversion composed), by output name."""
    return {k: convert(k, v) for k, v in adt_raw(p, msg_src).items()}


def message_time(p: Column) -> Column:
    return hl7_time(whole(p["msh"], 7, "MSH"))


def encounter_id(p: Column) -> Column:
    return to_long(whole(p["pv1"], 19))


def child_header(p: Column, msg_src: str = HL7_SOURCE) -> tuple[Column, Column, Column]:
    """(msg_src, msg_tm, pat_enc_csn_id) shared by the three child tables."""
    return F.lit(msg_src), message_time(p), encounter_id(p)


def dx_rows(p: Column) -> Column:
    """array<struct<dx_icd_cd, dx_name, dx_code_type>> of the chief-complaint OBX."""
    hits = F.filter(p["obx"], lambda o: _obx_is(o, OBS_CHIEF_COMPLAINT, TEXT_DX))
    rows = F.transform(hits, lambda o: F.struct(
        _obx_value(o, 1).alias("dx_icd_cd"), _obx_value(o, 2).alias("dx_name"), _obx_value(o, 3).alias("dx_code_type")))
    return F.filter(rows, lambda r: r["dx_icd_cd"].isNotNull() | r["dx_name"].isNotNull() | r["dx_code_type"].isNotNull())


def visit_reasons(p: Column) -> Column:
    """array<string> of OBX-5.9 of the visit-reason observations, empties dropped."""
    hits = F.filter(p["obx"], lambda o: _obx_is(o, OBS_CHIEF_COMPLAINT, TEXT_VISIT_REASON))
    return F.filter(F.transform(hits, lambda o: _obx_value(o, 9)), lambda r: r.isNotNull())


def er_complaint(p: Column) -> Column:
    """DG1-4 of the first DG1 when its DG1-6 is the ER diagnosis type, else NULL."""
    dg1 = p["dg1"]
    return F.when(whole(dg1, 6) == ER_DIAGNOSIS_TYPE, whole(dg1, 4))
