"""The four entity tables as data.

Fixed values: column names and order, required columns, rule names and
their order, accepted value sets, staged column names and types, and the
declared tests must equal the source pipeline's for equal results, so they
are stated here plainly, in their original order.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from pillbox.functions.strings import first_phone
from pillbox.plans.spec import ColumnTest, Rule, Staged, TableSpec

C = F.col
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"
NUMERIC = "decimal(38,9)"  # staged NUMERIC: 38 digits, scale 9


def _schema(fields: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


def _staged(rows: list[tuple[str, str, str]]) -> tuple[Staged, ...]:
    return tuple(Staged(s, n, t) for s, n, t in rows)


def _tests(rows: list[tuple]) -> tuple[ColumnTest, ...]:
    out = []
    for r in rows:
        col, kind = r[0], r[1]
        if kind == "accepted_values":
            out.append(ColumnTest(col, kind, values=tuple(r[2])))
        elif kind == "accepted_range":
            out.append(ColumnTest(col, kind, min_value=r[2]))
        else:
            out.append(ColumnTest(col, kind))
    return tuple(out)


def _nonneg(c: str):
    return lambda: C(c) >= 0


def _stop_after_start():
    return C("STOP").isNull() | (C("STOP") >= C("START"))


# ---------------------------------------------------------------- fixed values
ENCOUNTER_CLASSES = ["ambulatory", "emergency", "inpatient", "wellness", "urgentcare"]
GENDERS = ["M", "F"]
MARITAL_STATUSES = ["M", "S", "D", "W"]
STATE_PATTERN = "^[A-Z]{2}$"
COST_TOLERANCE = 1.1  # a Python float: the upper bound is computed in double
# ------------------------------------------------------------------------------

ENCOUNTERS = TableSpec(
    name="encounters",
    schema=_schema(
        [
            ("Id", StringType()),
            ("START", TimestampType()),
            ("STOP", TimestampType()),
            ("PATIENT", StringType()),
            ("ORGANIZATION", StringType()),
            ("PROVIDER", StringType()),
            ("PAYER", StringType()),
            ("ENCOUNTERCLASS", StringType()),
            ("CODE", StringType()),
            ("DESCRIPTION", StringType()),
            ("BASE_ENCOUNTER_COST", DecimalType(38, 18)),
            ("TOTAL_CLAIM_COST", DecimalType(38, 18)),
            ("PAYER_COVERAGE", DecimalType(38, 18)),
            ("REASONCODE", StringType()),
            ("REASONDESCRIPTION", StringType()),
        ]
    ),
    required=(
        "Id", "START", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS",
        "CODE", "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
    ),
    rules=(
        Rule("Id_isUnique", unique_key=("Id",)),
        Rule("encounter_class_set", lambda: C("ENCOUNTERCLASS").isin(ENCOUNTER_CLASSES)),
        Rule("base_cost_nonNeg", _nonneg("BASE_ENCOUNTER_COST")),
        Rule("total_cost_nonNeg", _nonneg("TOTAL_CLAIM_COST")),
        Rule("payer_coverage_nonNeg", _nonneg("PAYER_COVERAGE")),
        Rule("date_range_stop_after_start", _stop_after_start),
        Rule("base_cost_<=_total", lambda: C("BASE_ENCOUNTER_COST") <= C("TOTAL_CLAIM_COST")),
        Rule("payer_amnt_<=_total", lambda: C("PAYER_COVERAGE") <= C("TOTAL_CLAIM_COST")),
    ),
    stage_key=("Id",),
    staged_model="stg_encounters_data",
    staged=_staged(
        [
            ("Id", "encounter_id", "string"),
            ("PATIENT", "patient_id", "string"),
            ("ORGANIZATION", "organization_id", "string"),
            ("PROVIDER", "provider_id", "string"),
            ("PAYER", "payer_id", "string"),
            ("ENCOUNTERCLASS", "encounter_class", "string"),
            ("CODE", "encounter_code", "string"),
            ("DESCRIPTION", "encounter_description", "string"),
            ("REASONCODE", "reason_code", "string"),
            ("REASONDESCRIPTION", "reason_description", "string"),
            ("START", "start_timestamp", "timestamp"),
            ("STOP", "stop_timestamp", "timestamp"),
            ("BASE_ENCOUNTER_COST", "base_encounter_cost", NUMERIC),
            ("TOTAL_CLAIM_COST", "total_claim_cost", NUMERIC),
            ("PAYER_COVERAGE", "payer_coverage", NUMERIC),
        ]
    ),
    tests=_tests(
        [
            ("encounter_id", "unique"),
            ("encounter_id", "not_null"),
            ("patient_id", "not_null"),
            ("organization_id", "not_null"),
            ("provider_id", "not_null"),
            ("payer_id", "not_null"),
            ("encounter_class", "not_null"),
            ("encounter_class", "accepted_values", ENCOUNTER_CLASSES),
            ("encounter_code", "not_null"),
            ("encounter_description", "not_null"),
            ("start_timestamp", "not_null"),
            ("base_encounter_cost", "not_null"),
            ("base_encounter_cost", "accepted_range", 0),
            ("total_claim_cost", "not_null"),
            ("total_claim_cost", "accepted_range", 0),
            ("payer_coverage", "not_null"),
            ("payer_coverage", "accepted_range", 0),
        ]
    ),
    read_options={"timestampFormat": TS_FORMAT},
)

MEDICATIONS = TableSpec(
    name="medications",
    schema=_schema(
        [
            ("START", TimestampType()),
            ("STOP", TimestampType()),
            ("PATIENT", StringType()),
            ("PAYER", StringType()),
            ("ENCOUNTER", StringType()),
            ("CODE", StringType()),
            ("DESCRIPTION", StringType()),
            ("BASE_COST", DecimalType(38, 18)),
            ("PAYER_COVERAGE", DecimalType(38, 18)),
            ("DISPENSES", IntegerType()),
            ("TOTALCOST", DecimalType(38, 18)),
            ("REASONCODE", StringType()),
            ("REASONDESCRIPTION", StringType()),
        ]
    ),
    required=(
        "START", "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION",
        "BASE_COST", "PAYER_COVERAGE", "DISPENSES", "TOTALCOST",
    ),
    rules=(
        Rule("base_cost_nonNeg", _nonneg("BASE_COST")),
        Rule("payer_coverage_nonNeg", _nonneg("PAYER_COVERAGE")),
        Rule("dispenses_nonNeg", _nonneg("DISPENSES")),
        Rule("totalcost_nonNeg", _nonneg("TOTALCOST")),
        Rule("date_range_stop_after_start", _stop_after_start),
        Rule("payer_coverage_<=_totalcost", lambda: C("PAYER_COVERAGE") <= C("TOTALCOST")),
        Rule("dispenses_positive", lambda: C("DISPENSES") > 0),
        Rule(
            "totalcost_consistent_with_base_and_dispenses",
            lambda: (C("TOTALCOST") >= C("BASE_COST"))
            & (C("TOTALCOST") <= C("BASE_COST") * C("DISPENSES") * COST_TOLERANCE),
        ),
    ),
    stage_key=("PATIENT", "CODE", "ENCOUNTER"),
    staged_model="stg_medications_data",
    surrogate=("medication_id", ("PATIENT", "CODE", "ENCOUNTER")),
    staged=_staged(
        [
            ("PATIENT", "patient_id", "string"),
            ("PAYER", "payer_id", "string"),
            ("ENCOUNTER", "encounter_id", "string"),
            ("CODE", "medication_code", "string"),
            ("DESCRIPTION", "medication_description", "string"),
            ("REASONCODE", "reason_code", "string"),
            ("REASONDESCRIPTION", "reason_description", "string"),
            ("START", "start_timestamp", "timestamp"),
            ("STOP", "stop_timestamp", "timestamp"),
            ("DISPENSES", "dispenses", "bigint"),
            ("BASE_COST", "base_cost", NUMERIC),
            ("PAYER_COVERAGE", "payer_coverage", NUMERIC),
            ("TOTALCOST", "total_cost", NUMERIC),
        ]
    ),
    tests=_tests(
        [
            ("medication_id", "unique"),
            ("medication_id", "not_null"),
            ("patient_id", "not_null"),
            ("payer_id", "not_null"),
            ("encounter_id", "not_null"),
            ("medication_code", "not_null"),
            ("medication_description", "not_null"),
            ("start_timestamp", "not_null"),
            ("dispenses", "not_null"),
            ("dispenses", "accepted_range", 1),
            ("base_cost", "not_null"),
            ("base_cost", "accepted_range", 0),
            ("payer_coverage", "not_null"),
            ("payer_coverage", "accepted_range", 0),
            ("total_cost", "not_null"),
            ("total_cost", "accepted_range", 0),
        ]
    ),
    read_options={"timestampFormat": TS_FORMAT},
)

ORGANIZATIONS = TableSpec(
    name="organizations",
    schema=_schema(
        [
            ("Id", StringType()),
            ("NAME", StringType()),
            ("ADDRESS", StringType()),
            ("CITY", StringType()),
            ("STATE", StringType()),
            ("ZIP", StringType()),
            ("LAT", DoubleType()),
            ("LON", DoubleType()),
            ("PHONE", StringType()),
            ("REVENUE", DecimalType(38, 18)),
            ("UTILIZATION", IntegerType()),
        ]
    ),
    required=("Id", "NAME", "ADDRESS", "CITY", "REVENUE", "UTILIZATION"),
    rules=(
        Rule("Id_isUnique", unique_key=("Id",)),
        Rule("revenue_nonNeg", _nonneg("REVENUE")),
        Rule("utilization_nonNeg", _nonneg("UTILIZATION")),
        Rule("lat_valid_range", lambda: C("LAT").isNull() | ((C("LAT") >= -90) & (C("LAT") <= 90))),
        Rule("lon_valid_range", lambda: C("LON").isNull() | ((C("LON") >= -180) & (C("LON") <= 180))),
        Rule("state_valid_format", lambda: C("STATE").isNull() | C("STATE").rlike(STATE_PATTERN)),
    ),
    stage_key=("Id",),
    staged_model="stg_organizations_data",
    staged=_staged(
        [
            ("Id", "organization_id", "string"),
            ("NAME", "organization_name", "string"),
            ("ADDRESS", "address", "string"),
            ("CITY", "city", "string"),
            ("STATE", "state", "string"),
            ("ZIP", "zip_code", "string"),
            ("PHONE", "phone", "string"),
            ("LAT", "latitude", "double"),
            ("LON", "longitude", "double"),
            ("REVENUE", "revenue", NUMERIC),
            ("UTILIZATION", "utilization", "bigint"),
        ]
    ),
    tests=_tests(
        [
            ("organization_id", "unique"),
            ("organization_id", "not_null"),
            ("organization_name", "not_null"),
            ("address", "not_null"),
            ("city", "not_null"),
            ("revenue", "not_null"),
            ("revenue", "accepted_range", 0),
            ("utilization", "not_null"),
            ("utilization", "accepted_range", 0),
        ]
    ),
    rewrite=lambda: {"PHONE": first_phone(C("PHONE"))},
)

PATIENTS = TableSpec(
    name="patients",
    schema=_schema(
        [
            ("Id", StringType()),
            ("BIRTHDATE", DateType()),
            ("DEATHDATE", DateType()),
            ("SSN", StringType()),
            ("DRIVERS", StringType()),
            ("PASSPORT", StringType()),
            ("PREFIX", StringType()),
            ("FIRST", StringType()),
            ("MIDDLE", StringType()),
            ("LAST", StringType()),
            ("SUFFIX", StringType()),
            ("MAIDEN", StringType()),
            ("MARITAL", StringType()),
            ("RACE", StringType()),
            ("ETHNICITY", StringType()),
            ("GENDER", StringType()),
            ("BIRTHPLACE", StringType()),
            ("ADDRESS", StringType()),
            ("CITY", StringType()),
            ("STATE", StringType()),
            ("COUNTY", StringType()),
            ("FIPS", StringType()),
            ("ZIP", StringType()),
            ("LAT", DoubleType()),
            ("LON", DoubleType()),
            ("HEALTHCARE_EXPENSES", DecimalType(38, 18)),
            ("HEALTHCARE_COVERAGE", DecimalType(38, 18)),
            ("INCOME", DecimalType(38, 2)),
        ]
    ),
    required=(
        "Id", "BIRTHDATE", "SSN", "FIRST", "LAST", "RACE", "ETHNICITY", "GENDER",
        "BIRTHPLACE", "ADDRESS", "CITY", "STATE", "HEALTHCARE_EXPENSES",
        "HEALTHCARE_COVERAGE", "INCOME",
    ),
    rules=(
        Rule("duplicate_ids", unique_key=("Id",)),
        Rule("valid_gender", lambda: C("GENDER").isin(GENDERS)),
        Rule("valid_marital", lambda: C("MARITAL").isNull() | C("MARITAL").isin(MARITAL_STATUSES)),
        Rule("healthcare_expenses_nonNeg", _nonneg("HEALTHCARE_EXPENSES")),
        Rule("healthcare_coverage_nonNeg", _nonneg("HEALTHCARE_COVERAGE")),
        Rule("income_nonNeg", _nonneg("INCOME")),
    ),
    stage_key=("Id",),
    staged_model="stg_patients_data",
    staged=_staged(
        [
            ("Id", "patient_id", "string"),
            ("BIRTHDATE", "birth_date", "date"),
            ("DEATHDATE", "death_date", "date"),
            ("SSN", "ssn", "string"),
            ("DRIVERS", "drivers_license", "string"),
            ("PASSPORT", "passport", "string"),
            ("PREFIX", "name_prefix", "string"),
            ("FIRST", "first_name", "string"),
            ("MIDDLE", "middle_name", "string"),
            ("LAST", "last_name", "string"),
            ("SUFFIX", "name_suffix", "string"),
            ("MAIDEN", "maiden_name", "string"),
            ("MARITAL", "marital_status", "string"),
            ("RACE", "race", "string"),
            ("ETHNICITY", "ethnicity", "string"),
            ("GENDER", "gender", "string"),
            ("BIRTHPLACE", "birthplace", "string"),
            ("ADDRESS", "address", "string"),
            ("CITY", "city", "string"),
            ("STATE", "state", "string"),
            ("COUNTY", "county", "string"),
            ("FIPS", "fips_code", "string"),
            ("ZIP", "zip_code", "string"),
            ("LAT", "latitude", "double"),
            ("LON", "longitude", "double"),
            ("HEALTHCARE_EXPENSES", "healthcare_expenses", NUMERIC),
            ("HEALTHCARE_COVERAGE", "healthcare_coverage", NUMERIC),
            ("INCOME", "income", NUMERIC),
        ]
    ),
    tests=_tests(
        [
            ("patient_id", "unique"),
            ("patient_id", "not_null"),
            ("birth_date", "not_null"),
            ("ssn", "not_null"),
            ("first_name", "not_null"),
            ("last_name", "not_null"),
            ("marital_status", "accepted_values", MARITAL_STATUSES),
            ("race", "not_null"),
            ("ethnicity", "not_null"),
            ("gender", "not_null"),
            ("gender", "accepted_values", GENDERS),
            ("birthplace", "not_null"),
            ("address", "not_null"),
            ("city", "not_null"),
            ("state", "not_null"),
            ("healthcare_expenses", "not_null"),
            ("healthcare_expenses", "accepted_range", 0),
            ("healthcare_coverage", "not_null"),
            ("healthcare_coverage", "accepted_range", 0),
            ("income", "not_null"),
            ("income", "accepted_range", 0),
        ]
    ),
    read_options={"dateFormat": DATE_FORMAT},
)

SPECS = {s.name: s for s in (ENCOUNTERS, MEDICATIONS, ORGANIZATIONS, PATIENTS)}
