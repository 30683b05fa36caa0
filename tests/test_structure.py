"""Messages read by their own structure: separators, escapes, addresses as data, XML under any parent, paths without a schema."""

import pytest
from frames import collect
from pyspark.sql import functions as F

from wardline.functions import hl7 as H
from wardline.functions import xmlmsg as X
from wardline.operators import extract as E
from wardline.operators import flatten as FL
from wardline.operators import segments as SG

HEAD = "MSH|^~\\&|A|B|||20240105||ADT^A04|7|P|2.3\r"


def frame(spark, texts):
    return spark.createDataFrame([(f"m{i}" if len(texts) < 10 else f"m{i:02d}", t) for i, t in enumerate(texts)], "msg_nm string, text string")


@pytest.mark.parametrize("text,first,second", [
    (HEAD + "PID|1||M1^X^^E~Z", "M1", "X"),
    (HEAD + "PID|1||a\\F\\b\\S\\c^\\T\\\\R\\\\E\\", "a|b^c", "&~\\"),
    (HEAD + "PID|1||\\XC3A9\\^x\\X0D0A\\y", "é", "x\r\ny"),
    (HEAD + "PID|1||\\H\\bold\\N\\^\\Zsite\\", "\\H\\bold\\N\\", "\\Zsite\\"),  # left as they are
    (HEAD + "PID|1||C:\\dir^\\", "C:\\dir", "\\"),  # a lone sign escapes nothing
    (HEAD.translate(str.maketrans("|^", "#$")) + "PID#1##a|b^c$\\F\\\\S\\|", "a|b^c", "#$|"),
    (HEAD.translate(str.maketrans("|^~\\&", "!@*%?")) + "PID!1!!a|b^c~d\\e&f@%F%%S%%R%%E%%T%*rep", "a|b^c~d\\e&f", "!@*%?"),
    (HEAD.translate(str.maketrans("|^", "^|")) + "PID^1^^x|\\S\\\\F\\", "x", "|^"),  # the usual signs in other roles
])
def test_separators_and_escapes(spark, text, first, second):
    for t in (text, text.replace("\r", "\n")):
        m = H.parse(F.col("text"))
        row = frame(spark, [t]).select(H.component(m["pid"], 3, 1).alias("a"), H.component(m["pid"], 3, 2).alias("b"), H.validity(F.col("text")).alias("v"),
                                       H.trigger(m).alias("t")).first()
        assert tuple(row) == (first, second, None, "A04")


@pytest.mark.parametrize("text,reason", [
    ("MSH|^^\\&|A|B|||2024||ADT^A04|7|P|2.3", "encoding"), ("MSH|^~\\|A|B|||2024||ADT^A04|7|P|2.3", "encoding"), ("MSH|^~|&|A", "encoding"),
    ("MSH|^~\\&A|A|B|||2024||ADT^A04|7|P|2.3", "encoding"), ("MSHX^~\\&XA", "not_hl7"), ("MSH ^~\\& A", "not_hl7"), ("MSH", "not_hl7"), ("", "not_hl7"),
    (None, "null_text"), ("MSH#^~\\&#A", "short_header"), ("MSH#^~\\&#A#B###2024##ADT^A04#7#P#", "no_version"),
    ("MSH|^~\\&#|A|B|||2024||ADT^A04|7|P|2.7", None)])
def test_validity_by_own_separators(spark, text, reason):
    assert frame(spark, [text]).select(H.validity(F.col("text"))).first()[0] == reason


def test_segment_table(spark):
    text = HEAD + "PID|1||a^^b~c|\r\rZZ1|x\\S\\y\rZZ1|\r"
    rows = SG.segment_table(frame(spark, [text, None])).where("segment <> 'MSH'").orderBy("segment_no", "field", "repetition", "component").collect()
    assert [(r.segment_no, r.segment, r.field, r.repetition, r.component, r.value) for r in rows] == [
        (2, "PID", 1, 1, 0, "1"), (2, "PID", 1, 1, 1, "1"), (2, "PID", 3, 1, 0, "a^^b"), (2, "PID", 3, 1, 1, "a"), (2, "PID", 3, 1, 3, "b"),
        (2, "PID", 3, 2, 0, "c"), (2, "PID", 3, 2, 1, "c"), (3, "ZZ1", 1, 1, 0, "x^y"), (3, "ZZ1", 1, 1, 1, "x^y")]
    head = SG.segment_table(frame(spark, [HEAD])).where("component = 0").collect()
    assert {r.field: r.value for r in head} == {2: "^~\\&", 3: "A", 4: "B", 7: "20240105", 9: "ADT^A04", 10: "7", 11: "P", 12: "2.3"}


def test_a_site_adds_a_segment_by_data(spark):
    msgs = frame(spark, [HEAD + "PV1|1||||||||||||||||||12\rZBD|7^Ward A~8|first\rZBD|9|second", HEAD + "ZZZ|1"])
    own = spark.createDataFrame([("ward", "ZBD", 1, 2, None, None, False), ("beds", "ZBD", 1, 1, None, None, True)], SG.ADDRESS)
    rows = {r["msg_nm"]: r for r in collect(SG.adt_by_address(msgs, SG.adt_addresses(spark).unionByName(own)))}
    assert (rows["m0"]["ward"], rows["m0"]["beds"], rows["m0"]["pat_enc_csn_id"]) == ("Ward A", "7|||9", 12)
    assert (rows["m1"]["ward"], rows["m1"]["beds"], rows["m1"]["trigger_evnt"]) == (None, None, "A04")
    usual = {r["msg_nm"]: r for r in collect(E.adt_detail(E.parse_hl7(msgs)))}
    for name, row in usual.items():
        assert {k: rows[name][k] for k in row} == row


# ---------------------------------------------------------------- XML

OPEN = '<ns0:HL7MessageEnvelope xmlns:ns0="urn:a" xmlns:ns1="urn:b" xmlns:ns7="urn:c">'


def obx(icd, attributes=""):
    return (f"<{X.OBX}{attributes}><OBX.3.ObservationIdentifier><{X.OI}><OI.1.Identifier>{H.OBS_CHIEF_COMPLAINT}</OI.1.Identifier><OI.2.Text>{H.TEXT_DX}</OI.2.Text>"
            f"</{X.OI}></OBX.3.ObservationIdentifier><OBX.5.ObservationValue_XAD><{X.XAD}><XAD.2.OtherDesignation>{icd}</XAD.2.OtherDesignation></{X.XAD}></OBX.5.ObservationValue_XAD></{X.OBX}>")


def names(spark, *inside):
    msgs = frame(spark, [OPEN + x + "</ns0:HL7MessageEnvelope>" for x in inside])
    rows = E.parse_xml(msgs).select("msg_nm", F.transform(X.dx_rows(F.col(E.PARSED)), lambda r: r["dx_name"]).alias("n")).orderBy("msg_nm").collect()
    return [r.n for r in rows]


def test_only_elements_give_rows(spark):
    known = f"<{X.PAYLOAD}><{X.ADMINISTER}>%s</{X.ADMINISTER}></{X.PAYLOAD}>"
    cases = {
        known % f"<!-- {obx('OLD')} -->{obx('new')}": ["new"],
        known % f"<Note><![CDATA[{obx('QUOTED')}]]></Note>{obx('new')}": ["new"],
        known % f"<W><!-- {obx('OLD')} --></W>{obx('new')}": ["new"],
        known % f"<W><![CDATA[ <!-- ]]>{obx('in')}<![CDATA[ --> {obx('QUOTED')}]]></W>": ["in"],
        known % f"<W><{X.OBX} note=\"a > b\" x='/>'/>{obx('in')}</W>": ["in"],
        known % f"<W a='>'><V ns7:k=\"{X.OBX}\"><ns7:U>{obx('deep', ' ns7:s=&quot;1&quot;'.replace('&quot;', chr(34)))}</ns7:U></V></W>": ["deep"],
        known % f"<W>&lt;{X.OBX}&gt;</W>{obx('new')}": ["new"],
        f"<{X.PAYLOAD}>{obx('payload')}</{X.PAYLOAD}>": ["payload"], obx("top"): ["top"],
        f"<Any>{obx('one')}</Any><Any><?pi <x>?>{obx('two')}</Any>": ["one", "two"],
        known % f"{obx('a')}<{X.VISIT_GROUP}>{obx('b')}</{X.VISIT_GROUP}><{X.VISIT_GROUP}>{obx('c')}</{X.VISIT_GROUP}>": ["a", "b", "c"],
        known % f"<W>{obx('new &amp; &lt;old&gt;')}</W>": ["new & <old>"],
    }
    for got, want in zip(names(spark, *cases), cases.values(), strict=True):
        assert got == want


def test_long_tags_and_segments_are_cut_in_one_pass(spark):
    """No pattern tries a sign twice or calls itself for each one; neither a long tag nor a long segment is too much."""
    blanks, held = " " * 30_000, "x/" * 200_000 + "<b/>" * 5_000
    inside = [f"<W{blanks}><!-- {obx('OLD')} -->{obx('new', blanks)}</W>", f"<W>{obx('a')}{obx('long', ' k=' + chr(39) + 'x' + chr(39))}<Z>{held}</Z></W>",
              f"<W><{X.OBX}><Z>{held}</Z></{X.OBX} >{obx('last')}<![CDATA[{held}]]></W>"]
    assert names(spark, *inside) == [["new"], ["a", "long"], ["last"]]


def test_flatten_without_a_schema(spark):
    texts = ["<?xml version='1.0'?><A><B k='1'>007</B><C><D>x</D></C><C><D>y</D><E/></C><C><E>z</E></C></A>", "<A><B>8</B><F.G>q</F.G></A>",
             "<Z>only<Y>1</Y></Z>", "<bad>", "", None, "<A><!-- <B>no</B> --><F><G>r</G></F><B><![CDATA[<T>]]></B></A>"]
    rows = collect(FL.flatten_documents(frame(spark, texts), "text", "msg_nm").orderBy("msg_nm"))
    assert [{k: v for k, v in r.items() if v is not None and k != "msg_nm"} for r in rows] == [
        {"A.B": "007", "A.B.@k": "1", "A.C.D": "y", "A.C.E": "z"}, {"A.B": "8", "A.F.G": "q"}, {"Z": "only", "Z.Y": "1"}, {}, {}, {},
        {"A.B": "<T>", "A.F.G": "r"}]
    assert collect(FL.flatten_documents(frame(spark, [None, "<bad>"]), "text", "msg_nm")) == [{"msg_nm": "m0"}, {"msg_nm": "m1"}]
    with_schema = FL.flatten_documents(frame(spark, ["<A><B>1</B></A>"]), schema=FL.discover(frame(spark, texts)))
    assert with_schema.first()["A.B"] == "1"
