"""The prescription fact: medications LEFT JOIN patients LEFT JOIN
(encounters LEFT JOIN organizations).

All three joins are equi LEFT OUTER joins on keys that are unique on the
right side, so the fact has exactly one row per staged medication.  No
broadcast hints: dimension sizes grow with the data.  Spark broadcasts a side
by its estimated size at planning (``autoBroadcastJoinThreshold``) or by its
measured size at run time, shuffles otherwise, and splits a hot key's
partition on the medication side; ``hotjoin`` has a join that salts hot keys
beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.operators.stage import SMOKE_ROWS

# Output column names and order of the joined projections.
ENC_COLUMNS = [
    "encounter_id", "patient_id", "organization_id", "provider_id", "payer_id",
    "encounter_class", "encounter_code", "encounter_description", "reason_code",
    "reason_description", "start_timestamp", "stop_timestamp", "base_encounter_cost",
    "total_claim_cost", "payer_coverage",
]
ORG_COLUMNS = [
    "organization_name", "address", "city", "state", "zip_code", "phone",
    "latitude", "longitude", "revenue", "utilization",
]

# (side, source column, fact column) in fact order; m = medications,
# p = patients, eo = encounters joined with organizations.
FACT_COLUMNS = [
    ("m", "medication_id", "medication_id"),
    ("m", "medication_code", "medication_code"),
    ("m", "medication_description", "medication_description"),
    ("m", "reason_code", "reason_code"),
    ("m", "reason_description", "reason_description"),
    ("m", "start_timestamp", "start_timestamp"),
    ("m", "stop_timestamp", "stop_timestamp"),
    ("m", "dispenses", "dispenses"),
    ("m", "base_cost", "base_cost"),
    ("m", "payer_coverage", "payer_coverage"),
    ("m", "total_cost", "total_cost"),
    ("p", "patient_id", "patient_id"),
    ("p", "birth_date", "birth_date"),
    ("p", "death_date", "death_date"),
    ("p", "marital_status", "marital_status"),
    ("p", "race", "race"),
    ("p", "ethnicity", "ethnicity"),
    ("p", "gender", "gender"),
    ("p", "birthplace", "birthplace"),
    ("p", "address", "address"),
    ("p", "city", "city"),
    ("p", "state", "state"),
    ("p", "county", "county"),
    ("p", "fips_code", "fips_code"),
    ("p", "zip_code", "zip_code"),
    ("p", "latitude", "latitude"),
    ("p", "longitude", "longitude"),
    ("p", "healthcare_expenses", "healthcare_expenses"),
    ("p", "healthcare_coverage", "healthcare_coverage"),
    ("p", "income", "income"),
    ("eo", "encounter_id", "encounter_id"),
    ("eo", "encounter_class", "encounter_class"),
    ("eo", "encounter_code", "encounter_code"),
    ("eo", "encounter_description", "encounter_description"),
    ("eo", "reason_code", "encounter_reason_code"),
    ("eo", "reason_description", "encounter_reason_description"),
    ("eo", "start_timestamp", "encounter_start_timestamp"),
    ("eo", "stop_timestamp", "encounter_stop_timestamp"),
    ("eo", "base_encounter_cost", "base_encounter_cost"),
    ("eo", "total_claim_cost", "total_claim_cost"),
    ("eo", "payer_coverage", "encounter_payer_coverage"),
    ("eo", "organization_id", "organization_id"),
    ("eo", "organization_name", "organization_name"),
    ("eo", "address", "organization_address"),
    ("eo", "city", "organization_city"),
    ("eo", "state", "organization_state"),
    ("eo", "zip_code", "organization_zip_code"),
    ("eo", "phone", "phone"),
    ("eo", "latitude", "organization_latitude"),
    ("eo", "longitude", "organization_longitude"),
    ("eo", "revenue", "revenue"),
    ("eo", "utilization", "utilization"),
]
FACT_NAMES = [name for _, _, name in FACT_COLUMNS]

# What the table and its columns mean to someone who reads them.
FACT_DOC = (
    "One row for each prescription that passed cleaning, with who received it, at which encounter it was written and "
    "where. A patient, encounter or organization that is unknown or was rejected leaves its columns NULL."
)
COLUMN_DOCS = {
    "medication_id": "surrogate key of the prescription: MD5 of patient, drug code and encounter; unique, never NULL",
    "medication_code": "code of the prescribed drug",
    "medication_description": "name and strength of the prescribed drug",
    "reason_code": "diagnosis code for which the drug was prescribed, if any was recorded",
    "reason_description": "that diagnosis in words",
    "start_timestamp": "when the prescription starts (UTC); its day is the partition",
    "stop_timestamp": "when it ends (UTC); NULL while it goes on",
    "dispenses": "how often the drug was dispensed, at least once",
    "base_cost": "price of dispensing the drug once",
    "payer_coverage": "part of the total cost that the insurer pays",
    "total_cost": "cost of all dispenses, at most a tenth over base cost times dispenses",
    "patient_id": "patient who received the drug; NULL when unknown or rejected",
    "birth_date": "patient's day of birth",
    "death_date": "patient's day of death; NULL for the living",
    "marital_status": "patient's marital status: M, S, D or W",
    "race": "patient's primary race",
    "ethnicity": "patient's primary ethnicity",
    "gender": "patient's gender: M or F",
    "birthplace": "town where the patient was born",
    "address": "patient's street address",
    "city": "patient's city",
    "state": "patient's state",
    "county": "patient's county",
    "fips_code": "FIPS code of the patient's county",
    "zip_code": "patient's postal code",
    "latitude": "latitude of the patient's address",
    "longitude": "longitude of the patient's address",
    "healthcare_expenses": "what the patient has paid for health care over a lifetime",
    "healthcare_coverage": "what insurers have paid for the patient over a lifetime",
    "income": "patient's yearly income",
    "encounter_id": "visit at which the drug was prescribed; NULL when unknown or rejected",
    "encounter_class": "kind of visit, such as emergency or wellness",
    "encounter_code": "code of the visit's procedure",
    "encounter_description": "that procedure in words",
    "encounter_reason_code": "diagnosis code for which the visit took place, if any",
    "encounter_reason_description": "that diagnosis in words",
    "encounter_start_timestamp": "when the visit began (UTC)",
    "encounter_stop_timestamp": "when it ended (UTC)",
    "base_encounter_cost": "price of the visit without anything done in it",
    "total_claim_cost": "price of the visit with everything done in it",
    "encounter_payer_coverage": "part of the visit's cost that the insurer pays",
    "organization_id": "organization named by the visit, kept even if that organization was rejected",
    "organization_name": "name of the organization",
    "organization_address": "its street address",
    "organization_city": "its city",
    "organization_state": "its state, two capital letters",
    "organization_zip_code": "its postal code",
    "phone": "its first telephone number",
    "organization_latitude": "latitude of the organization",
    "organization_longitude": "longitude of the organization",
    "revenue": "its revenue so far",
    "utilization": "number of visits to it so far",
}


def fact_docs() -> dict[str, str]:
    """Column descriptions that are stored with the fact; the table's own stands with its first column as table_comment."""
    return dict(COLUMN_DOCS)


def enc_org(encounters: DataFrame, organizations: DataFrame) -> DataFrame:
    """Encounters LEFT JOIN organizations; organization_id comes from the encounter."""
    e, o = encounters.alias("e"), organizations.alias("o")
    joined = e.join(o, F.col("e.organization_id") == F.col("o.organization_id"), "left")
    return joined.select(*[F.col(f"e.{c}") for c in ENC_COLUMNS], *[F.col(f"o.{c}") for c in ORG_COLUMNS])


def build_fact(
    medications: DataFrame,
    patients: DataFrame,
    encounters_orgs: DataFrame,
    test_run: bool = False,
) -> DataFrame:
    m, p, eo = medications.alias("m"), patients.alias("p"), encounters_orgs.alias("eo")
    fact = (
        m.join(p, F.col("m.patient_id") == F.col("p.patient_id"), "left")
        .join(eo, F.col("m.encounter_id") == F.col("eo.encounter_id"), "left")
        .select(*[F.col(f"{side}.{src}").alias(name) for side, src, name in FACT_COLUMNS])
    )
    if test_run:
        fact = fact.orderBy("medication_id").limit(SMOKE_ROWS)
    return fact
