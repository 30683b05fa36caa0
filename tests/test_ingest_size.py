"""Batches of an ingest at size: what is cached of a message, and how much one trigger takes."""

from wardline.operators import extract as E
from wardline.plans import carriers as C
from wardline.plans import queries as Q
from wardline.streaming import ingest as I

SF = "/root/testdata/sf0.001"


def _messages(spark, render):
    return render(Q.table(spark, SF, "orders").limit(60), Q.table(spark, SF, "lineitem"))


def test_tables_from_cut_columns_are_those_from_the_parse(spark):
    for fmt, render in ((E.HL7, C.hl7_from_orders), (E.XML, C.xml_from_orders)):
        odd = spark.createDataFrame([("bad", "no message"), ("none", None)], "msg_nm string, text string")
        messages = Q.land(spark, _messages(spark, render).unionByName(odd), "cut")
        checked = E.with_validity(E.parse(messages, fmt), fmt).persist()
        good = checked.where("reject_reason IS NULL")
        cut = E.cut_once(good, fmt)
        assert E.PARSED not in cut.columns  # a cache of it holds no parse
        want, got = E.fan_out(good, fmt), E.fan_out_cut(cut)
        assert list(want) == list(got)
        for name in want:
            assert got[name].dtypes == want[name].dtypes
            a, b = (sorted(map(str, f[name].collect())) for f in (want, got))
            assert a == b and (a or name == "encntr_er_complnt_hist")


def test_a_larger_drop_is_taken_in_larger_but_bounded_batches(spark):
    cores = spark.sparkContext.defaultParallelism
    assert Q.files_per_trigger(spark, 0) == Q.files_per_trigger(spark, 8) == Q.FILES_PER_TRIGGER
    assert Q.files_per_trigger(spark, 12 * Q.BATCHES) == min(12, Q.FILES_PER_TRIGGER * cores)
    assert Q.files_per_trigger(spark, 1_000_000) == Q.FILES_PER_TRIGGER * cores


def test_a_batch_of_one_file_is_dealt_over_the_cores(spark):
    assert I.on_every_core(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_spread_makes_tasks_by_rows(spark, monkeypatch):
    events = Q.table(spark, SF, "events")
    monkeypatch.setattr(Q, "ROWS_PER_TASK", 100)
    assert Q.spread(events).rdd.getNumPartitions() == -(-events.count() // 100)


def test_latest_to_warehouse_tells_the_latest_of_the_warehouse(spark):
    rows = Q.latest_to_warehouse(spark, SF).collect()
    best = {}
    for r in rows:
        best[r["pat_enc_csn_id"]] = max(best.get(r["pat_enc_csn_id"], r["msg_tm"]), r["msg_tm"])
    assert {r["is_latest"] for r in rows} == {True, False}
    assert all(r["is_latest"] == (r["msg_tm"] == best[r["pat_enc_csn_id"]]) for r in rows)
