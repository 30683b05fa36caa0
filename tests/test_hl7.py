import datetime as dt

from pyspark.sql import functions as F

from frames import collect
from wardline.functions.timeparse import utc_ntz
from wardline.operators import extract as E

# Invented message touching every extracted field except the discharge time.
BASE = [
    "MSH|^~\\&|SRC|FAC|||20240105104652|7|ADT^A04^ADT_A01|9001|T|2.3",
    "EVN|A04|20240105104652||X|77^DOE^JO^^^^^^^^^^^FACX",
    "PID|1||M100^^^E~M200^^^E||||19900203|F|||||||||||||||||||||",
    "PV1|1|EMERGENCY|DEP1^R12^B3^FACX^READY||||||||||||||||55501|||||||||||||||||HOME||||||||20240105100000||||||60001",
    "PV2||PRIVATE",
    "ZPV|||||||||||||||ADMIT",
    "OBX|1|CWE|8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED^LN|1|I10^High pressure^ICD-10-CM||||||F",
    "OBX|2|TX|8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100^LN|2|^^^^^^^^Headache||||||F",
    "OBX|3|CWE|11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN|3|3^Urgent||||||F",
    "DG1|1|ICD-10-CM|I10^High pressure^ICD-10-CM|Headache||10800;EPT",
]
ACUITY = "OBX|9|CWE|11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN|9|{}||||||F"
OTHER_OBX = "OBX|8|TX|9999-9^SOMETHING ELSE^LN|8|x^y^z||||||F"


def msg(lines, sep="\r"):
    return sep.join(lines)


def with_trigger(trig):
    out = list(BASE)
    out[0] = out[0].replace("ADT^A04", f"ADT^{trig}")
    out[3] = out[3].replace("20240105100000|", "20240105100000|20240106120000")
    return out


def parsed(spark, texts):
    df = spark.createDataFrame([(f"m{i}", t) for i, t in enumerate(texts)], "msg_nm string, text string")
    return E.parse_hl7(df)


def adt(spark, texts):
    out = E.adt_detail(parsed(spark, texts))
    ts = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp"]
    return {r["msg_nm"]: r for r in collect(out.select(*[utc_ntz(F.col(c)).alias(c) if c in ts else c for c in out.columns]))}


def test_adt_detail_fields(spark):
    r = adt(spark, [msg(BASE)])["m0"]
    assert r["msg_typ"] == "ADT" and r["trigger_evnt"] == "A04" and r["msg_src"] == "STL"
    assert r["msg_tm"] == dt.datetime(2024, 1, 5, 16, 46, 52)
    assert r["bod_id"] == "9001" and r["pat_mrn_id"] == "M100" and r["pat_enc_csn_id"] == 55501
    assert r["birth_date"] == dt.datetime(1990, 2, 3, 6, 0) and r["death_date"] is None
    assert (r["pat_class_abbr"], r["department_abbr"], r["room_nm"], r["bed_label"], r["bed_status"]) == \
        ("EMERGENCY", "DEP1", "R12", "B3", "READY")
    assert r["loc_abbr"] == "FACX" and r["user_id"] == "77" and r["sex_abbr"] == "F"
    assert r["ed_disposition_abbr"] == "ADMIT" and r["disch_disp_abbr"] == "HOME"
    assert r["accommodation_abbr"] == "PRIVATE" and r["means_of_arrv_abbr"] is None
    assert r["hsp_account_id"] == 60001 and r["acuity_level_abbr"] == "Urgent"
    assert r["adt_arrival_time"] == dt.datetime(2024, 1, 5, 16, 0)
    assert r["hosp_admsn_time"] is None and r["hosp_disch_time"] is None


def test_visit_times_follow_trigger(spark):
    got = adt(spark, [msg(with_trigger(t)) for t in ["A01", "A03", "A04", "A08", "A11", "A13"]])
    admit, disch = dt.datetime(2024, 1, 5, 16, 0), dt.datetime(2024, 1, 6, 18, 0)
    want = {  # (arrival, admission, discharge)
        "m0": (None, admit, None), "m1": (None, None, disch), "m2": (admit, None, None),
        "m3": (None, None, None), "m4": (None, admit, None), "m5": (None, None, disch),
    }
    for k, (arr, adm, dis) in want.items():
        r = got[k]
        assert (r["adt_arrival_time"], r["hosp_admsn_time"], r["hosp_disch_time"]) == (arr, adm, dis), k


def test_line_breaks_and_numbers(spark):
    no_csn = [ln.replace("|55501|", "||") if ln.startswith("PV1") else ln for ln in BASE]
    bad_hsp = [ln.replace("|60001", "|6A001") if ln.startswith("PV1") else ln for ln in BASE]
    composite = [ln.replace("|55501|", "|55501^^^X|") if ln.startswith("PV1") else ln for ln in BASE]
    got = adt(spark, [msg(BASE, "\n"), msg(BASE, "\r\n"), msg(no_csn), msg(bad_hsp), msg(composite)])
    assert got["m0"]["pat_enc_csn_id"] == 55501 and got["m1"]["pat_enc_csn_id"] == 55501
    assert got["m2"]["pat_enc_csn_id"] is None
    assert got["m3"]["hsp_account_id"] is None and got["m3"]["pat_enc_csn_id"] == 55501
    assert got["m4"]["pat_enc_csn_id"] is None


def test_acuity_only_on_match(spark):
    base = [ln for ln in BASE if not ln.startswith("OBX")]
    first = base + [ACUITY.format("1^Low"), OTHER_OBX, OTHER_OBX]
    last = base + [OTHER_OBX, ACUITY.format("2^Mid")]
    repeated = base + [ACUITY.format("1^Low"), OTHER_OBX, ACUITY.format("2^Mid"), ACUITY.format("3^High")]
    empty_val = base + [ACUITY.format(""), ACUITY.format("2^Mid")]
    got = adt(spark, [msg(base), msg(first), msg(last), msg(repeated), msg(empty_val)])
    assert [got[f"m{i}"]["acuity_level_abbr"] for i in range(5)] == [None, "Low", "Mid", "Low|||Mid|||High", "Mid"]


def test_children(spark):
    p = parsed(spark, [msg(BASE)])
    dx = collect(E.encounter_dx(p))
    assert [(r["dx_icd_cd"], r["dx_name"], r["dx_code_type"], r["pat_enc_csn_id"]) for r in dx] == \
        [("I10", "High pressure", "ICD-10-CM", 55501)]
    assert [r["encntr_rsn"] for r in collect(E.visit_reason(p))] == ["Headache"]
    assert [r["er_complaint"] for r in collect(E.er_complaint(p))] == ["Headache"]


def test_children_edge_cases(spark):
    empty_dx = [ln.replace("|I10^High pressure^ICD-10-CM|", "||") if ln.startswith("OBX|1") else ln for ln in BASE]
    two_dg1_first_other = [ln for ln in BASE if not ln.startswith("DG1")] + \
        ["DG1|1|ICD-10-CM|X^Y|Other||OTHER", "DG1|2|ICD-10-CM|I10^High pressure|Headache||10800;EPT"]
    no_csn = [ln.replace("|55501|", "||") if ln.startswith("PV1") else ln for ln in BASE]
    bad_time = [ln.replace("20240105104652|7|", "2024|7|") if ln.startswith("MSH") else ln for ln in BASE]
    p = parsed(spark, [msg(empty_dx), msg(two_dg1_first_other), msg(no_csn), msg(bad_time)])
    dx = collect(E.encounter_dx(p))
    assert sorted(r["msg_tm"] is not None for r in dx) == [True]  # only m1 has a dx with values
    er = collect(E.er_complaint(p))
    assert len(er) == 1  # m0 only: m1's first DG1 is not the ER type, m2/m3 lack a header
    assert len(collect(E.visit_reason(p))) == 2  # m0 and m1


def test_validity_and_quarantine(spark):
    encoding = [BASE[0].replace("^~\\&", "~~\\&")] + BASE[1:]
    no_version = [BASE[0].replace("|T|2.3", "|T|")] + BASE[1:]
    short = ["MSH|^~\\&|SRC|FAC"] + BASE[1:]
    df = spark.createDataFrame([(t,) for t in [msg(BASE), "not hl7 at all", None, msg(encoding), msg(no_version),
                                               msg(short), "\r".join(BASE[1:])]], "text string")
    reasons = [r[0] for r in E.with_validity(df, E.HL7).select("reject_reason").collect()]
    assert reasons == [None, "not_hl7", "null_text", "encoding", "no_version", "short_header", "not_hl7"]
    good, bad = E.split_valid(df, E.HL7)
    assert good.count() == 1 and bad.count() == 6


def test_missing_segments_give_nulls(spark):
    r = adt(spark, [msg([BASE[0]])])["m0"]
    assert r["trigger_evnt"] == "A04" and r["pat_enc_csn_id"] is None and r["pat_mrn_id"] is None
    assert r["acuity_level_abbr"] is None


def test_normalize_and_broker_transform(spark):
    from wardline.functions.hl7 import normalize
    from wardline.sources.broker import broker_messages

    df = spark.createDataFrame([("MSH|^~\\&|A|2.3x|2.3\nPID|1",)], "text string")
    assert df.select(normalize(F.col("text"))).first()[0] == "MSH|^~\\&|A|2.5x|2.3\rPID|1"
    recs = spark.createDataFrame([(bytearray(msg(BASE).encode()), "0", 5, "50"), (bytearray(b"junk"), "1", 6, "60")],
                                 "body binary, partition string, sequenceNumber bigint, offset string")
    assert [(r["msg_nm"], r["text"][:3]) for r in broker_messages(recs, keep_rejects=False).collect()] == [("0-5-50", "MSH")]
    assert [r["valid"] for r in broker_messages(recs).collect()] == [True, False]
