"""What the scans of HL7 messages cost: no generated method that the JVM leaves to its interpreter, no row sorted that need not be."""

from pyspark.sql import functions as F

from wardline.functions import hl7
from wardline.operators import extract as E
from wardline.operators import segments as SG
from wardline.plans import carriers as C
from wardline.plans import queries as Q
from wardline.session import scratch_path

#: Bytes of a method that the JVM compiles at most.
COMPILED = 8000


def events(spark):
    return spark.range(40).selectExpr(
        "bigint(id) AS event_id", "TIMESTAMP_NTZ'2024-01-05 10:00:00' AS ts", "id % 3 AS user_id",
        "element_at(array('view', 'click', 'signup', 'error'), int(id % 4) + 1) AS event_type", "double(id * 3) AS value", "'' AS props")


def largest_method(df) -> int:
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size()))


def test_methods_are_short_enough_to_be_compiled(spark):
    path = scratch_path(spark, "cost")
    C.foreign_events(events(spark)).write.parquet(path)  # from files, as landed messages are
    msgs = spark.read.parquet(path)
    events(spark).write.parquet(f"{path}-events")
    stored = spark.read.parquet(f"{path}-events")
    for df in (C.foreign_events(stored), C.hl7_from_events(stored, ("event_type", "value")), Q.portable(E.adt_detail(Q._accepted(msgs, E.HL7)))):
        assert largest_method(df) <= COMPILED


def test_header_is_checked_without_decoding_it(spark):
    assert "regexp_extract_all" not in str(hl7.validity(F.col("text")))


def test_values_are_counted_in_a_hash_table(spark, monkeypatch):
    monkeypatch.setattr(Q, "table", lambda *_: events(spark))
    plan = Q.hl7_segment_table(spark, "")._jdf.queryExecution().sparkPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate" in lowest and "Sort" not in lowest


def test_hits_of_a_message_are_one_list(spark):
    msgs = C.hl7_from_events(events(spark))
    twice = msgs.unionByName(msgs.where("msg_nm = 'evt-30'"))  # a name that comes twice is one row
    rows = SG.by_address(twice, SG.adt_addresses(spark))
    assert "min_by" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {r["msg_nm"]: r for r in rows.collect()}
    assert len(got) == 40 and got["evt-30"]["pat_mrn_id"] == "M0" and got["evt-30"]["acuity_level_abbr"] == "Level 4|||Level 4|||Level 5|||Level 5"
