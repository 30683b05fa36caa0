"""Plan shape checks: the properties the design relies on at scale."""

from wardline.operators import extract as E
from wardline.operators import latest as LT
from wardline.plans import carriers as C
from wardline.operators import seed as SD
from wardline.plans import queries as Q
from wardline.plans import seed_roles as SR

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_is_narrow_and_python_free(spark):
    msgs = Q.land(spark, C.hl7_from_events(Q.table(spark, SF, "events")), "plan-hl7")
    for fmt, m in ((E.HL7, msgs), (E.XML, Q.land(spark, C.xml_from_events(Q.table(spark, SF, "events")), "plan-xml"))):
        good, _ = E.split_valid(E.parse(m, fmt), fmt)
        for df in E.fan_out(good, fmt).values():
            p = plan(df)
            assert "Exchange" not in p, p
            assert "EvalPython" not in p and "PythonUDF" not in p


def test_top1_is_limited_before_the_shuffle(spark):
    ev = Q.table(spark, SF, "events")
    for df in (LT.latest_with_ties(ev, ["user_id"], "ts"), LT.latest_one(ev, ["user_id"], ["ts", "event_id"])):
        p = plan(df)
        assert p.count("WindowGroupLimit") == 2 and "Partial" in p and "Final" in p, p


def test_retention_uses_anti_and_semi_joins(spark):
    p = plan(Q.retention_child(spark, SF))
    assert "LeftAnti" in p and "LeftSemi" in p and "Window" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(SD.seed_adt(SR.roles(spark, SF), SR.RULES))
    assert "l_extendedprice" not in p and "o_totalprice" not in p and "c_name" not in p
    p = plan(Q.retention_master(spark, SF))
    assert "o_totalprice" not in p


def test_rendering_events_needs_no_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(C.damage_events(C.hl7_from_events(events, keep=("event_type", "value"))))
    assert "Exchange" not in p and "Join" not in p


def test_validity_filter_reaches_the_scan_for_hl7(spark):
    msgs = Q.land(spark, C.hl7_from_events(Q.table(spark, SF, "events")), "plan-hl7b")
    good, _ = E.split_valid(E.parse_hl7(msgs), E.HL7)
    p = plan(E.adt_detail(good))
    assert p.index("Filter") > p.index("Project")  # the filter sits below the projections, next to the scan
