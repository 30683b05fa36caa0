"""The relational seed inputs played by the driver tables, whole and uncut.

Rows that a rule drops and codes that a look-up misses come from the key values,
so that every table is read in full. The oracle SQL states the results in its
own way, straight from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.seed import SeedRules

# Fixed parameters of the registered seed check.
AS_OF = "1999-01-01"
RULES = SeedRules(as_of=AS_OF, start="1996-01-01", area_pattern="% AREA", excluded_sites=(3, 7))


def _named(df: DataFrame, code: str, prefix: str, name: str) -> DataFrame:
    return df.select(F.expr(code).alias("code"), F.concat(F.lit(prefix), F.col(name)).alias("name"))


def roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from wardline.plans.queries import table

    orders, lines, customers, suppliers, nations, regions, parts = (
        table(spark, sf_dir, x) for x in ("orders", "lineitem", "customer", "supplier", "nation", "region", "part"))
    priority = "CAST(substring(o_orderpriority, 1, 1) AS INT)"
    return {
        "encounters": orders.selectExpr(
            "o_orderkey AS encounter_id", "o_custkey AS patient_id", "o_orderdate AS admitted_at",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAYS END AS discharged_at", "o_orderdate AS arrived_at",
            "o_orderkey + 1000000 AS account_id", "CASE o_orderstatus WHEN 'P' THEN 3 ELSE 1 END AS admission_status",
            *[f"{priority} AS {x}" for x in ("class_code", "disposition_code", "acuity_code", "arrival_code", "ed_disposition_code")]),
        "movements": lines.selectExpr(
            "l_orderkey AS encounter_id", "l_shipdate AS happened_at", "l_linenumber AS type_code",
            "CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END AS subtype_code", "l_suppkey AS unit_id", "l_partkey AS room_id",
            "l_partkey AS bed_id", "l_linenumber AS position", "concat('U', l_suppkey) AS user_id", "l_linenumber * 6 AS accommodation_code"),
        "patients": customers.selectExpr(
            "c_custkey AS patient_id", "concat('MRN', c_custkey) AS mrn",
            "CAST(date_add(DATE'1950-01-01', c_nationkey) AS TIMESTAMP_NTZ) AS born",
            "CASE WHEN c_acctbal < -500 THEN TIMESTAMP_NTZ'2000-01-01 00:00:00' END AS died", "c_nationkey * 2 AS sex_code"),
        "test_flags": customers.selectExpr(
            "c_custkey AS patient_id", "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Y' WHEN 'BUILDING' THEN NULL ELSE 'N' END AS test_flag"),
        "units": suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("s_suppkey AS unit_id", "concat('DEP', s_suppkey) AS unit_name", "s_nationkey AS site_id", "n_name AS site_name",
                    "CASE r_name WHEN 'ASIA' THEN r_name ELSE concat(r_name, ' AREA') END AS area_name"),
        "rooms": parts.selectExpr("p_partkey AS room_id", "p_name AS room_name"),
        "beds": parts.selectExpr("p_partkey AS bed_id", "p_brand AS bed_name", "p_size AS status_code"),
        "class_names": regions.selectExpr("r_regionkey + 1 AS code", "lower(r_name) AS name"),
        "disposition_names": _named(regions, "r_regionkey + 1", "D-", "r_name"),
        "acuity_names": _named(regions, "r_regionkey + 1", "L-", "r_name"),
        "sex_names": nations.selectExpr("n_nationkey AS code", "substring(n_name, 1, 1) AS name"),
        "arrival_names": _named(regions, "r_regionkey + 1", "ARR ", "r_name"),
        "ed_disposition_names": _named(regions, "r_regionkey + 1", "ED ", "r_name"),
        "bed_status_names": nations.selectExpr("n_nationkey AS code", "n_name AS name"),
        "accommodation_names": _named(nations, "n_nationkey", "ACC ", "n_name"),
        "diagnoses": lines.selectExpr("l_orderkey AS encounter_id", "l_partkey * 2 AS diagnosis_id"),
        "diagnosis_codes": parts.selectExpr("p_partkey AS diagnosis_id", "concat('ICD', p_partkey) AS code"),
        "diagnosis_names": parts.selectExpr("p_partkey AS diagnosis_id", "p_name AS name"),
        "complaints": lines.selectExpr("l_orderkey AS encounter_id", "concat('C', l_linestatus, l_returnflag) AS complaint"),
        "visit_reasons": lines.selectExpr("l_orderkey AS encounter_id", "l_suppkey % 40 AS reason_id"),
        "reason_names": nations.selectExpr("n_nationkey AS reason_id", "concat('RSN ', n_name) AS name"),
    }


def seed_msg_tm() -> Column:
    """The seed's stamp as an instant (UTC midnight of the as-of day), session-zone independent."""
    return F.to_timestamp(F.lit(AS_OF + " 00:00:00+0000"), "yyyy-MM-dd HH:mm:ssZ")
