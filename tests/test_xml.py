import datetime as dt

from pyspark.sql import functions as F

from frames import collect
from wardline.functions import xmlmsg as X
from wardline.functions.timeparse import utc_ntz
from wardline.operators import extract as E

OBX = ("<ns0:OBX.ObservationResult><OBX.3.ObservationIdentifier><ns0:OI.ObservationIdentifier>"
       "<OI.1.Identifier>{code}</OI.1.Identifier><OI.2.Text>{text}</OI.2.Text></ns0:OI.ObservationIdentifier>"
       "</OBX.3.ObservationIdentifier><OBX.5.ObservationValue_XAD><ns0:XAD.ExtendedAddress>{xad}"
       "</ns0:XAD.ExtendedAddress></OBX.5.ObservationValue_XAD></ns0:OBX.ObservationResult>")
DX = OBX.format(code="8661-1", text="CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED",
                xad="<XAD.1.StreetAddress><ns0:SAD.StreetAddress><SAD.1.StreetOrMailingAddress>I10"
                    "</SAD.1.StreetOrMailingAddress></ns0:SAD.StreetAddress></XAD.1.StreetAddress>"
                    "<XAD.2.OtherDesignation>High &amp; pressure</XAD.2.OtherDesignation><XAD.3.City>ICD-10-CM</XAD.3.City>")
RSN = OBX.format(code="8661-1", text="CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100",
                 xad="<XAD.9.CountyparishCode>Headache</XAD.9.CountyparishCode>")
ACU = OBX.format(code="11283-9", text="ACUITY ASSESSMENT AT FIRST ENCOUNTER", xad="<XAD.2.OtherDesignation>{v}</XAD.2.OtherDesignation>")


def envelope(obx=(DX, RSN, ACU.replace("{v}", "3")), trigger="A04", csn="55501", region="OKC"):
    reg = f"<ns0:OriginatingRegion>{region}</ns0:OriginatingRegion>" if region else ""
    return (
        '<ns0:HL7MessageEnvelope xmlns:ns0="urn:a" xmlns:ns1="urn:b">' + reg +
        "<ns1:BODID>b-1</ns1:BODID><ns1:ReceivedDateTime>2024-01-05T10:46:52Z</ns1:ReceivedDateTime>"
        "<ns0:MessagePayload><ns0:AdministerPatient>"
        "<ns0:MSH.MessageHeader><MSH.9.MessageType><ns0:MSG.MessageType><MSG.1.MessageCode>ADT</MSG.1.MessageCode>"
        f"<MSG.2.TriggerEvent>{trigger}</MSG.2.TriggerEvent></ns0:MSG.MessageType></MSH.9.MessageType></ns0:MSH.MessageHeader>"
        "<ns0:PID.PatientIdentification>"
        "<PID.3.PatientIdentifierList><ns0:CX.ExtendedCompositeIDWithCheckDigit><CX.1.IDNumber>M100</CX.1.IDNumber>"
        "</ns0:CX.ExtendedCompositeIDWithCheckDigit></PID.3.PatientIdentifierList>"
        "<PID.3.PatientIdentifierList><ns0:CX.ExtendedCompositeIDWithCheckDigit><CX.1.IDNumber>M200</CX.1.IDNumber>"
        "</ns0:CX.ExtendedCompositeIDWithCheckDigit></PID.3.PatientIdentifierList>"
        "<PID.7.DatetimeOfBirth><ns0:TS.TimeStamp><TS.1.Time>19900203</TS.1.Time></ns0:TS.TimeStamp></PID.7.DatetimeOfBirth>"
        "</ns0:PID.PatientIdentification>"
        "<ns0:DG1.Diagnosis><DG1.4.DiagnosisDescription>Headache</DG1.4.DiagnosisDescription>"
        "<DG1.6.DiagnosisType>10800;EPT</DG1.6.DiagnosisType></ns0:DG1.Diagnosis>"
        "<VisitGroup><ns0:PV1.PatientVisit><PV1.2.PatientClass>EMERGENCY</PV1.2.PatientClass>"
        f"<PV1.19.VisitNumber><ns0:CX.ExtendedCompositeIDWithCheckDigit><CX.1.IDNumber>{csn}</CX.1.IDNumber>"
        "</ns0:CX.ExtendedCompositeIDWithCheckDigit></PV1.19.VisitNumber>"
        "<PV1.44.AdmitDatetime><ns0:TS.TimeStamp><TS.1.Time>20240105100000</TS.1.Time></ns0:TS.TimeStamp></PV1.44.AdmitDatetime>"
        "</ns0:PV1.PatientVisit>" + "".join(obx) +
        "</VisitGroup></ns0:AdministerPatient></ns0:MessagePayload></ns0:HL7MessageEnvelope>"
    )


def frame(spark, texts):
    return spark.createDataFrame([(f"m{i}", t) for i, t in enumerate(texts)], "msg_nm string, text string")


def test_adt_and_children(spark):
    good, bad = E.split_valid(E.parse_xml(frame(spark, [envelope()])), E.XML)
    a = E.adt_detail(good, E.XML)
    r = collect(a.select(*[utc_ntz(F.col(c)).alias(c) if t == "timestamp" else c for c, t in a.dtypes]))[0]
    assert r["msg_src"] == "OKC" and r["bod_id"] == "b-1" and r["pat_mrn_id"] == "M100"
    assert r["msg_tm"] == dt.datetime(2024, 1, 5, 10, 46, 52)  # zoned ISO, not localised
    assert r["birth_date"] == dt.datetime(1990, 2, 3, 6, 0)
    assert r["adt_arrival_time"] == dt.datetime(2024, 1, 5, 16, 0) and r["acuity_level_abbr"] == "3"
    assert r["pat_enc_csn_id"] == 55501
    dx = collect(E.encounter_dx(good, E.XML))
    assert [(d["dx_icd_cd"], d["dx_name"], d["dx_code_type"]) for d in dx] == [("I10", "High & pressure", "ICD-10-CM")]
    assert [v["encntr_rsn"] for v in collect(E.visit_reason(good, E.XML))] == ["Headache"]
    assert [v["er_complaint"] for v in collect(E.er_complaint(good, E.XML))] == ["Headache"]


def test_obx_counts_and_headers(spark):
    texts = [envelope(obx=()), envelope(obx=(RSN,)), envelope(obx=(RSN, DX, RSN)),
             envelope(csn="X1"), envelope(region=None), "<broken><xml>", None]
    good, bad = E.split_valid(E.parse_xml(frame(spark, texts)), E.XML)
    assert sorted(r["reject_reason"] for r in collect(bad)) == ["malformed_xml", "null_text"]
    rs = collect(E.visit_reason(good, E.XML))
    assert sorted(r["encntr_rsn"] for r in rs) == ["Headache"] * 3  # m1 once, m2 twice; m3/m4 lack a header
    assert len(collect(E.adt_detail(good, E.XML))) == 5


def test_acuity_all_matches(spark):
    t = envelope(obx=(ACU.replace("{v}", "1"), DX, ACU.replace("{v}", "2")))
    good, _ = E.split_valid(E.parse_xml(frame(spark, [t])), E.XML)
    assert collect(E.adt_detail(good, E.XML))[0]["acuity_level_abbr"] == "1|||2"


def test_split_batches(spark):
    d = X.BATCH_DELIMITER
    texts = ["a", "\na" + d + "\nb" + d + "\nc", "a" + d + "b" + d, "", "\n\nx" + d + "y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "file_id int, text string")
    got = {}
    for r in sorted(collect(E.explode_batches(df)), key=lambda r: r["part_no"]):
        got.setdefault(r["file_id"], []).append((r["part_no"], r["text"]))
    assert got[0] == [(0, "a")]
    assert got[1] == [(0, "a"), (1, "b"), (2, "c")]
    assert got[2] == [(0, "a"), (1, "b")]
    assert 3 not in got
    assert got[4] == [(0, "\nx"), (1, "y")]


def test_file_drop_stream_names_and_archive(spark, tmp_path):
    import os

    from wardline.session import scratch_path
    from wardline.sources.files import read_text_named

    root = scratch_path(spark, "drop")
    os.makedirs(f"{root}/in/day1", exist_ok=True)
    with open(f"{root}/in/day1/msg-a.xml", "w") as f:
        f.write(envelope() + X.BATCH_DELIMITER + "\n" + envelope(trigger="A01"))
    s = read_text_named(spark, f"{root}/in", archive_dir=f"{root}/archive", glob="*.xml")
    q = E.explode_batches(s).writeStream.format("memory").queryName("drop_test") \
        .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT msg_nm, part_no FROM drop_test ORDER BY part_no").collect()
    assert [(r[0], r[1]) for r in got] == [("msg-a.xml", 0), ("msg-a.xml", 1)]
    # a finished file is moved away when the next batch ends
    with open(f"{root}/in/day1/msg-b.xml", "w") as f:
        f.write(envelope())
    for _ in range(2):
        E.explode_batches(read_text_named(spark, f"{root}/in", archive_dir=f"{root}/archive", glob="*.xml")).writeStream.format("noop") \
            .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination()
        with open(f"{root}/in/day1/msg-c.xml", "w") as f:
            f.write(envelope())
    moved = [f for _, _, names in os.walk(f"{root}/archive") for f in names]
    assert "msg-a.xml" in moved and not os.path.exists(f"{root}/in/day1/msg-a.xml")


def test_flatten_last_repetition_wins(spark):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    schema = StructType([StructField("A", StructType([StructField("B", StringType())])),
                         StructField("R", ArrayType(StructType([StructField("V", StringType())])))])
    df = spark.createDataFrame([("<x><A><B>1</B></A><R><V>a</V></R><R><V>b</V></R></x>",)], "t string")
    out = df.select(F.from_xml("t", schema).alias("m")).select(*X.flatten_struct(F.col("m"), schema))
    assert out.columns == ["A.B", "R.V"] and tuple(out.first()) == ("1", "b")


def test_segments_under_unknown_parents_are_found(spark):
    t = envelope().replace("<ns0:MessagePayload><ns0:AdministerPatient>",
                           "<ns0:MessagePayload><ns0:AdministerPatient><ns0:Elsewhere>") \
        .replace("<ns0:DG1.Diagnosis>", "</ns0:Elsewhere><ns0:DG1.Diagnosis>") \
        .replace("<VisitGroup><ns0:PV1.PatientVisit>", "<VisitGroup><Deeper><ns0:PV1.PatientVisit>") \
        .replace("</ns0:PV1.PatientVisit>", "</ns0:PV1.PatientVisit></Deeper>")
    good, _ = E.split_valid(E.parse_xml(frame(spark, [t])), E.XML)
    r = collect(E.adt_detail(good, E.XML))[0]
    assert (r["trigger_evnt"], r["pat_mrn_id"], r["pat_enc_csn_id"], r["pat_class_abbr"]) == ("A04", "M100", 55501, "EMERGENCY")


def _observed(spark, texts):
    good, _ = E.split_valid(E.parse_xml(frame(spark, texts)), E.XML)
    reasons = {m: [] for m in range(len(texts))}
    for r in collect(good.select("msg_nm", F.transform(F.col("_msg")["obx"], lambda o: o["OBX.5.ObservationValue_XAD"][X.XAD]["XAD.9.CountyparishCode"]).alias("r"))):
        reasons[int(r["msg_nm"][1:])] = r["r"]
    return reasons


def test_observations_wherever_they_sit(spark):
    def rsn(v):
        return RSN.replace("Headache", v)

    base = envelope(obx=(rsn("g"),))
    beside = base.replace("<VisitGroup>", rsn("a") + "<VisitGroup>")
    strange = envelope(obx=()).replace("<VisitGroup>", "<ns0:Other><Deep>" + rsn("o") + "</Deep></ns0:Other><VisitGroup>")
    all_three = beside.replace("<VisitGroup>", "<ns0:Other>" + rsn("o") + "</ns0:Other><VisitGroup>")
    two_groups = base.replace("</VisitGroup>", "</VisitGroup><VisitGroup>" + rsn("h") + rsn("i") + "</VisitGroup>")
    got = _observed(spark, [base, beside, strange, all_three, two_groups, envelope(obx=())])
    assert got == {0: ["g"], 1: ["a", "g"], 2: ["o"], 3: ["a", "o", "g"], 4: ["g", "h", "i"], 5: []}


def test_diagnosis_and_visit_under_other_parents(spark):
    t = envelope().replace("<ns0:DG1.Diagnosis>", "<ns0:Other><ns0:DG1.Diagnosis>").replace("</ns0:DG1.Diagnosis>", "</ns0:DG1.Diagnosis></ns0:Other>")
    second = envelope(csn="1").replace("</VisitGroup>", "</VisitGroup><VisitGroup>" + RSN + "</VisitGroup>")
    good, _ = E.split_valid(E.parse_xml(frame(spark, [t, second])), E.XML)
    assert [r["er_complaint"] for r in collect(E.er_complaint(good, E.XML))] == ["Headache"] * 2
    assert sorted(r["pat_enc_csn_id"] for r in collect(E.adt_detail(good, E.XML))) == [1, 55501]


def test_flatten_takes_the_last_element_that_has_the_leaf(spark):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    leaf = StructType([StructField("A", StringType()), StructField("B", StringType()), StructField("N", ArrayType(StringType()))])
    schema = StructType([StructField("R", ArrayType(leaf))])
    texts = ["<x><R><A>1</A><B>2</B><N>p</N><N>q</N></R><R><A>3</A></R></x>", "<x></x>", "<x><R></R></x>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(F.from_xml("t", schema).alias("m")).select(*X.flatten_struct(F.col("m"), schema))
    assert out.columns == ["R.A", "R.B", "R.N"]
    assert [tuple(r) for r in out.collect()] == [("3", "2", "q"), (None,) * 3, (None,) * 3]


def test_unreadable_bytes_are_rejected_by_name(spark, tmp_path):
    import os

    from wardline.jobs import ingest_xml, paths
    from wardline.session import scratch_path

    root = scratch_path(spark, "bytes")
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/good.xml", "w") as f:
        f.write(envelope() + X.BATCH_DELIMITER + envelope(csn="2"))
    with open(f"{root}/in/bad.xml", "wb") as f:
        f.write(b"<a>\xff\xfe</a>")
    ingest_xml(spark, f"{root}/in", f"{root}/out").awaitTermination()
    assert {r.pat_enc_csn_id for r in spark.read.parquet(paths(f"{root}/out")["adt_hist"]).collect()} == {55501, 2}
    rejects = spark.read.parquet(f"{root}/out/quarantine").collect()
    assert [(r.msg_nm, r.reject_reason) for r in rejects] == [("bad.xml", "null_text")]


PARTS = ("<ns0:PV1.PatientVisit/>", "text", "<ns0:PV1.PatientVisit note='1'><x/></ns0:PV1.PatientVisit>", "<![CDATA[<ns0:OBX.ObservationResult>]]>", "<!-- <x> -->",
         "<ns0:OBX.ObservationResult/>", "<ns0:DG1.Diagnosis>a<b>c</b></ns0:DG1.Diagnosis>", "<ns0:PID.PatientIdentification>t</ns0:PID.PatientIdentification>", "<x>", "&amp;",
         "<ns0:EVN.EventType><ns0:OBX.ObservationResult><OBX.5.ObservationValue_XAD/></ns0:OBX.ObservationResult></ns0:EVN.EventType>", "<ns0:MSH.MessageHeader/>",
         "<ns0:Other><ns0:DG1.Diagnosis><DG1.4.DiagnosisDescription>q</DG1.4.DiagnosisDescription><DG1.6.DiagnosisType>10800;EPT</DG1.6.DiagnosisType></ns0:DG1.Diagnosis></ns0:Other>",
         "<VisitGroup><ns0:PV1.PatientVisit><PV1.19.VisitNumber>7</PV1.19.VisitNumber></ns0:PV1.PatientVisit></VisitGroup>", "<ns1:BODID><x>1</x></ns1:BODID>", "")


def test_one_table_s_parse_gives_what_the_whole_parse_gives(spark):
    """Every odd part is put at each place between two tags of an order's envelope, in turn."""
    import re

    from wardline.plans import carriers as C

    order = [(i, 1, "F", 1.0, dt.datetime(1995, 1, 1), "1-URGENT") for i in range(10)]
    lines = [(i, 5, 6, n, 3.0, 0.1, 0.1, k, "O") for i in range(10) for n, k in enumerate("RAN", 1)]
    o = spark.createDataFrame(order, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    li = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    docs = [r.text for r in C.xml_from_orders(o, li).orderBy("msg_nm").collect()]
    texts = [d[:at.start() + 1] + PARTS[(k + i) % len(PARTS)] + d[at.start() + 1:] for i, d in enumerate(docs) for k, at in enumerate(re.finditer("><", d))]
    msgs = spark.createDataFrame([(str(n), t) for n, t in enumerate([*docs, *texts, None, "", "<a/>"])], "msg_nm string, text string").repartition(4)
    columns = ("msg_nm", "acuity_level_abbr")

    def rows(make, segments=None, **kw):
        good, bad = E.split_valid(E.parse_xml(msgs, segments=segments), E.XML)
        return sorted(map(str, make(good, E.XML, **kw).select(*(columns if kw else "*")).collect())), sorted(map(str, bad.select("msg_nm", "reject_reason").collect()))

    for make, segments, kw in ((E.encounter_dx, X.DX_ONLY, {}), (E.visit_reason, X.VISIT_REASON_ONLY, {}), (E.er_complaint, X.ER_COMPLAINT_ONLY, {}),
                               (E.adt_detail, X.ACUITY_ONLY, {"columns": columns})):
        whole = rows(make, **({"columns": None} if kw else {}))
        assert whole[0] and whole[1]
        assert rows(make, segments, **kw) == whole
        structs = str(X.envelope_schema(segments)).count("StructType"), str(X.envelope_schema()).count("StructType")
        assert 2 * structs[0] < structs[1]  # what the reader is slow at
