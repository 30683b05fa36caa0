"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then three timed runs; the median counts.
A run executes the whole plan (rendering the messages from the driver
tables, landing them, parsing, writing) into Spark's no-op sink.

``parse_only`` times the engine alone: messages rendered from the driver tables
are landed once (untimed), then parsed from the stored text to the ADT table
(``*_adt``) or, parsed once and cached, to all four tables (``*_four_tables``),
the way one micro-batch of a message drop is processed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.operators import extract as E  # noqa: E402
from wardline.plans import carriers as C  # noqa: E402
from wardline.plans.queries import QUERIES, land, spread, table  # noqa: E402
from wardline.session import build_session  # noqa: E402

HEADLINE = ["hl7_adt_detail", "hl7_dx", "xml_adt_detail", "stream_ingest_fanout", "seed_adt",
            "retention_master", "retention_child", "upsert_merge"]
PARSE_ROWS = {"hl7_adt_detail": "events", "hl7_dx": "orders", "xml_adt_detail": "events",
              "stream_ingest_fanout": "events"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2))
    spark.sparkContext.setLogLevel("ERROR")
    times, rates = {}, {}
    for name in [q for q in HEADLINE if q in QUERIES]:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        if name in PARSE_ROWS:
            n = spark.read.parquet(f"{sf_dir}/{PARSE_ROWS[name]}.parquet").count()
            rates[name] = round(n / times[name], 1)
    parse_only, parse_rates = {}, {}
    landed = {
        "hl7_events": (E.HL7, land(spark, C.hl7_from_events(spread(table(spark, sf_dir, "events"))), "bench-hl7e")),
        "hl7_orders": (E.HL7, land(spark, C.hl7_from_orders(table(spark, sf_dir, "orders"),
                                                            table(spark, sf_dir, "lineitem")), "bench-hl7o")),
        "xml_events": (E.XML, land(spark, C.xml_from_events(spread(table(spark, sf_dir, "events"))), "bench-xmle")),
    }
    for name, (fmt, msgs) in landed.items():
        n = msgs.count()

        def fan_out_all():
            # as one streaming micro-batch does it: parse once, cache, four writes
            parsed = E.with_validity(E.parse(msgs, fmt), fmt).persist()
            try:
                good = parsed.where("reject_reason IS NULL")
                for df in E.fan_out(good, fmt).values():
                    df.write.format("noop").mode("overwrite").save()
            finally:
                parsed.unpersist()

        def adt_only():
            good, _ = E.split_valid(E.parse(msgs, fmt), fmt)
            E.adt_detail(good, fmt).write.format("noop").mode("overwrite").save()

        for label, fn in (("adt", adt_only), ("four_tables", fan_out_all)):
            fn()
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn()
                samples.append(time.perf_counter() - t0)
            key = f"{name}_{label}"
            parse_only[key] = round(statistics.median(samples), 3)
            parse_rates[key] = round(n / parse_only[key], 1)
    # messages with children: one cached parse for the four tables against a parse for each
    fmt, msgs = landed["hl7_orders"]
    one = parse_only["hl7_orders_four_tables"]

    def four_parses():
        for build in (E.adt_detail, E.encounter_dx, E.er_complaint, E.visit_reason):
            good, _ = E.split_valid(E.parse(msgs, fmt), fmt)
            build(good, fmt).write.format("noop").mode("overwrite").save()

    four_parses()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        four_parses()
        samples.append(time.perf_counter() - t0)
    parses = {"one_parse_sec": one, "four_parses_sec": round(statistics.median(samples), 3)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "messages_per_sec": rates,
                      "parse_only": parse_only, "parse_only_messages_per_sec": parse_rates, "sf": float(m.group(1)) if m else sf_dir,
                      "one_parse_versus_four": parses, "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
