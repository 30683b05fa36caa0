import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardline.functions.timeparse import hl7_time, iso_time, utc_ntz

# Reference truth table (UTC results of localising US/Central wall clocks).
CASES = [
    ("20220408104652", dt.datetime(2022, 4, 8, 15, 46, 52)),
    ("202204081046", dt.datetime(2022, 4, 8, 15, 46)),
    ("19880815", dt.datetime(1988, 8, 15, 5, 0)),
    ("20221106013000", dt.datetime(2022, 11, 6, 7, 30)),   # repeated hour: standard offset
    ("20220313023000", dt.datetime(2022, 3, 13, 8, 30)),   # skipped hour
    ("20221106005959", dt.datetime(2022, 11, 6, 5, 59, 59)),
    ("20221106020000", dt.datetime(2022, 11, 6, 8, 0)),
    ("20220313015959", dt.datetime(2022, 3, 13, 7, 59, 59)),
    ("20220313030000", dt.datetime(2022, 3, 13, 8, 0)),
    ("20240105104652-0500", None),
    ("20240105104652Z", None),
    ("20240105104652.123", None),
    ("2024010510", None),
    ("202401", None),
    ("2022", None),
    ("2022-04-08T10:46:52", dt.datetime(2022, 4, 8, 15, 46, 52)),
    ("2022-04-08 10:46:52", dt.datetime(2022, 4, 8, 15, 46, 52)),
    ("2022-04-08T10:46", dt.datetime(2022, 4, 8, 15, 46)),
    ("2022-04-08T10:46:52.25", dt.datetime(2022, 4, 8, 15, 46, 52, 250000)),
    ("1988-08-15", dt.datetime(1988, 8, 15, 5, 0)),
    ("2022-04-08T10:46:52Z", None),
    ("2022-13-08T10:46:52", None),
    ("12:30", None),
    ("2022-04", None),
    ("garbage", None),
    ("", None),
    (None, None),
    ("20241345", None),
]


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York"])
def test_truth_table(spark, session_tz):
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame([(x,) for x, _ in CASES], "x string")
        got = [r[0] for r in df.select(utc_ntz(hl7_time(F.col("x")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [want for _, want in CASES]


RECEIVED = [
    ("2024-01-05T10:46:52Z", dt.datetime(2024, 1, 5, 10, 46, 52)),
    ("2024-01-05T10:46:52-05:00", dt.datetime(2024, 1, 5, 15, 46, 52)),
    ("2024-01-05T10:46:52.5+0100", dt.datetime(2024, 1, 5, 9, 46, 52, 500000)),
    ("2024-01-05T10:46:52", dt.datetime(2024, 1, 5, 10, 46, 52)),
    ("20240105104652", dt.datetime(2024, 1, 5, 10, 46, 52)),
    ("20240105", dt.datetime(2024, 1, 5)),
    ("12:30", None), ("2022", None), ("2022-04", None), ("", None), (None, None), ("x", None),
]


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York"])
def test_received_times(spark, session_tz):
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame([(x,) for x, _ in RECEIVED], "x string")
        got = [r[0] for r in df.select(utc_ntz(iso_time(F.col("x")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [want for _, want in RECEIVED]


def test_xml_times_do_not_depend_on_the_session_zone(spark):
    """A received time without a zone is UTC, one with a zone is honoured, wherever the session runs."""
    from wardline.functions.timeparse import iso_time, utc_ntz

    texts = ["2024-07-01T10:00:00", "2024-07-01T10:00:00Z", "2024-07-01T10:00:00-05:00", "20240701100000", "2024-03-10T02:30:00", "2024-11-03T01:30:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    got = {}
    try:
        for zone in ("UTC", "America/Chicago", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.createDataFrame([(t,) for t in texts], "t string").select(utc_ntz(iso_time(F.col("t"))).cast("string")).collect()
            got[zone] = [r[0] for r in rows]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got["UTC"] == ["2024-07-01 10:00:00", "2024-07-01 10:00:00", "2024-07-01 15:00:00", "2024-07-01 10:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00"]
    assert got["America/Chicago"] == got["Asia/Kolkata"] == got["UTC"]
