"""One-time seeding of the history tables from relational tables.

The inputs go by neutral role names (``ROLES``). The plan is: cut encounters and
movements down to those that count, take each encounter's last movement, and
only then attach names, from one list of look-ups. Join strategies are left to
Catalyst and AQE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.latest import latest_one

# Fixed values of the seed rule: movement types that are kept (admission,
# discharge, transfer in, patient update, census), the cancelled movement
# subtype, the flag of test patients, the cancelled admission status, the
# literal of message columns, the source and the code system.
MOVEMENT_TYPES = (1, 2, 3, 5, 6)
CANCELLED_MOVEMENT = 2
TEST_PATIENT = "Y"
CANCELLED_ADMISSION = 3
SEED_LITERAL = "ETL"
SEED_SOURCE = "STL"
DX_CODE_TYPE = "ICD-10-CM"

#: The input tables and the columns that are read of them.
ROLES = {
    "encounters": "encounter_id patient_id admitted_at discharged_at arrived_at account_id class_code disposition_code "
                  "acuity_code arrival_code ed_disposition_code admission_status",
    "movements": "encounter_id happened_at type_code subtype_code unit_id room_id bed_id position user_id accommodation_code",
    "patients": "patient_id mrn born died sex_code",
    "test_flags": "patient_id test_flag",
    "units": "unit_id unit_name site_id site_name area_name",
    "rooms": "room_id room_name",
    "beds": "bed_id bed_name status_code",
    **{f"{kind}_names": "code name" for kind in ("class", "disposition", "acuity", "sex", "arrival", "ed_disposition",
                                                 "bed_status", "accommodation")},
    "diagnoses": "encounter_id diagnosis_id",
    "diagnosis_codes": "diagnosis_id code",
    "diagnosis_names": "diagnosis_id name",
    "complaints": "encounter_id complaint",
    "visit_reasons": "encounter_id reason_id",
    "reason_names": "reason_id name",
}

#: Look-ups: output column, role, the code that is looked up, and what is made of the name.
LOOKUPS: tuple[tuple[str, str, str, object], ...] = (
    ("pat_class_abbr", "class_names", "class_code", F.upper),
    ("disch_disp_abbr", "disposition_names", "disposition_code", None),
    ("acuity_level_abbr", "acuity_names", "acuity_code", lambda name: F.substr(name, F.lit(3))),  # without its two-letter prefix
    ("sex_abbr", "sex_names", "sex_code", None),
    ("means_of_arrv_abbr", "arrival_names", "arrival_code", None),
    ("ed_disposition_abbr", "ed_disposition_names", "ed_disposition_code", None),
    ("bed_status", "bed_status_names", "status_code", None),
    ("accommodation_abbr", "accommodation_names", "accommodation_code", None),
)

#: Output columns that are another name of an input column.
RENAMED = {"pat_mrn_id": "mrn", "pat_enc_csn_id": "encounter_id", "birth_date": "born", "death_date": "died",
           "hosp_admsn_time": "admitted_at", "hosp_disch_time": "discharged_at", "department_abbr": "unit_name",
           "loc_abbr": "site_name", "room_nm": "room_name", "bed_label": "bed_name", "adt_arrival_time": "arrived_at",
           "hsp_account_id": "account_id", "user_id": "user_id"}


@dataclass(frozen=True)
class SeedRules:
    """What a site decides: dates, the areas (LIKE pattern) and sites it seeds, and movement types."""

    as_of: date | str
    start: date | str
    area_pattern: str
    excluded_sites: Sequence[int]
    days_kept: int = 2
    movement_types: Sequence[int] = MOVEMENT_TYPES

    def day(self, which: str) -> Column:
        return F.lit(str(getattr(self, which))).cast("date")


def eligible_encounters(t: Mapping[str, DataFrame], rules: SeedRules) -> DataFrame:
    """Encounters admitted since the start and not long discharged, of living patients who are no test patients."""
    gone = F.to_date("discharged_at") < F.date_sub(rules.day("as_of"), rules.days_kept)
    current = t["encounters"].where((F.to_date("admitted_at") >= rules.day("start")) & ~F.coalesce(gone, F.lit(False))
                                    & (F.col("admission_status") != CANCELLED_ADMISSION))
    real = t["test_flags"].where(F.col("test_flag") != TEST_PATIENT).select("patient_id")
    return current.join(t["patients"].where(F.col("died").isNull()), "patient_id").join(real, "patient_id", "left_semi")


def eligible_movements(t: Mapping[str, DataFrame], rules: SeedRules) -> DataFrame:
    """Movements of the period into known rooms and beds of the seeded areas, with their unit's names."""
    day = F.to_date("happened_at")
    units = t["units"].where(F.col("area_name").like(rules.area_pattern) & ~F.col("site_id").isin(*rules.excluded_sites))
    kept = t["movements"].where(day.between(rules.day("start"), F.date_sub(rules.day("as_of"), 1))
                                & F.col("type_code").isin(*rules.movement_types) & (F.col("subtype_code") != CANCELLED_MOVEMENT))
    return (kept.join(units.select("unit_id", "unit_name", "site_name"), "unit_id")
            .join(t["rooms"].select("room_id", "room_name"), "room_id").join(t["beds"].select("bed_id", "bed_name", "status_code"), "bed_id"))


def seed_adt(t: Mapping[str, DataFrame], rules: SeedRules, msg_tm: Column | None = None) -> DataFrame:
    """One row per eligible encounter and patient number, with the place of its last movement.

    Equal positions are told apart by time, unit, room and bed, so that the choice is reproducible (D22).
    """
    placed = eligible_encounters(t, rules).join(eligible_movements(t, rules), "encounter_id")
    rows = latest_one(placed, ["encounter_id", "mrn"], ["position", "happened_at", "unit_id", "room_id", "bed_id"])
    for column, role, code, made in LOOKUPS:
        name = made(F.col("name")) if made else F.col("name")
        rows = rows.join(t[role].select(F.col("code").alias(code), name.alias(column)), code, "left")
    fixed = {"msg_typ": F.lit(SEED_LITERAL), "msg_src": F.lit(SEED_SOURCE), "trigger_evnt": F.lit(SEED_LITERAL),
             "msg_tm": F.current_timestamp() if msg_tm is None else msg_tm, "msg_nm": F.lit(SEED_LITERAL), "bod_id": F.lit(SEED_LITERAL)}
    return rows.select(*[c.alias(k) for k, c in fixed.items()], *[F.col(c).alias(k) for k, c in RENAMED.items()],
                       *[column for column, *_ in LOOKUPS]).distinct()


_CARRIED = ("msg_src", "msg_tm", "pat_enc_csn_id")


def _of_seeded(adt: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts of the seeded encounters, with what children carry of the visit row."""
    return adt.select(*_CARRIED).join(facts.withColumnRenamed("encounter_id", "pat_enc_csn_id"), "pat_enc_csn_id")


def seed_dx(adt: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Coded and named diagnoses of the seeded encounters."""
    coded = t["diagnosis_codes"].join(t["diagnosis_names"].select("diagnosis_id", F.col("name").alias("dx_name")), "diagnosis_id")
    return _of_seeded(adt, t["diagnoses"]).join(coded, "diagnosis_id").select(
        *_CARRIED, F.col("code").alias("dx_icd_cd"), "dx_name", F.lit(DX_CODE_TYPE).alias("dx_code_type"))


def seed_er(adt: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct ER complaints of the seeded encounters."""
    return _of_seeded(adt, t["complaints"]).select(*_CARRIED, F.col("complaint").alias("er_complaint")).distinct()


def seed_visit_reason(adt: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct named visit reasons of the seeded encounters."""
    return (_of_seeded(adt, t["visit_reasons"]).join(t["reason_names"], "reason_id")
            .select(*_CARRIED, F.col("name").alias("encntr_rsn")).distinct())


CHILDREN = {"encntr_dx_hist": seed_dx, "encntr_er_complnt_hist": seed_er, "encntr_visit_rsn_hist": seed_visit_reason}
