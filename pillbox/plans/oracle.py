"""DuckDB SQL for the correctness gate.

Each query in ``__spark_entry__.queries()`` has an equivalent SQL text
here, run by DuckDB over the same test tables.  The raw-table derivation,
normalisation, rule predicates, dedupe order, staging casts, declared tests
and the star join are written out here, column lists included; nothing is
imported from the code under test.
"""

from __future__ import annotations

# ------------------------------------------------- fixed values: input columns
COLUMNS = {
    "encounters": [
        "Id", "START", "STOP", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS", "CODE",
        "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE", "REASONCODE",
        "REASONDESCRIPTION",
    ],
    "medications": [
        "START", "STOP", "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST", "PAYER_COVERAGE",
        "DISPENSES", "TOTALCOST", "REASONCODE", "REASONDESCRIPTION",
    ],
    "organizations": [
        "Id", "NAME", "ADDRESS", "CITY", "STATE", "ZIP", "LAT", "LON", "PHONE", "REVENUE", "UTILIZATION",
    ],
    "patients": [
        "Id", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "MIDDLE", "LAST",
        "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS", "CITY", "STATE",
        "COUNTY", "FIPS", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "INCOME",
    ],
}
# every other input column is a number, a date or a timestamp
TEXT_COLUMNS = {
    "encounters": [
        "Id", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS", "CODE", "DESCRIPTION",
        "REASONCODE", "REASONDESCRIPTION",
    ],
    "medications": [
        "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION",
    ],
    "organizations": [
        "Id", "NAME", "ADDRESS", "CITY", "STATE", "ZIP", "PHONE",
    ],
    "patients": [
        "Id", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "MIDDLE", "LAST", "SUFFIX", "MAIDEN", "MARITAL",
        "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS", "CITY", "STATE", "COUNTY", "FIPS", "ZIP",
    ],
}
REQUIRED = {
    "encounters": [
        "Id", "START", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS", "CODE", "DESCRIPTION",
        "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
    ],
    "medications": [
        "START", "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST", "PAYER_COVERAGE",
        "DISPENSES", "TOTALCOST",
    ],
    "organizations": [
        "Id", "NAME", "ADDRESS", "CITY", "REVENUE", "UTILIZATION",
    ],
    "patients": [
        "Id", "BIRTHDATE", "SSN", "FIRST", "LAST", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
        "CITY", "STATE", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "INCOME",
    ],
}
KEYS = {
    "encounters": ["Id"],
    "medications": ["PATIENT", "CODE", "ENCOUNTER"],
    "organizations": ["Id"],
    "patients": ["Id"],
}
# ------------------------------------- fixed values: staged columns (source, name, type)
STAGED = {
    "encounters": [
        ("Id", "encounter_id", "VARCHAR"),
        ("PATIENT", "patient_id", "VARCHAR"),
        ("ORGANIZATION", "organization_id", "VARCHAR"),
        ("PROVIDER", "provider_id", "VARCHAR"),
        ("PAYER", "payer_id", "VARCHAR"),
        ("ENCOUNTERCLASS", "encounter_class", "VARCHAR"),
        ("CODE", "encounter_code", "VARCHAR"),
        ("DESCRIPTION", "encounter_description", "VARCHAR"),
        ("REASONCODE", "reason_code", "VARCHAR"),
        ("REASONDESCRIPTION", "reason_description", "VARCHAR"),
        ("START", "start_timestamp", "TIMESTAMP"),
        ("STOP", "stop_timestamp", "TIMESTAMP"),
        ("BASE_ENCOUNTER_COST", "base_encounter_cost", "DECIMAL(38,9)"),
        ("TOTAL_CLAIM_COST", "total_claim_cost", "DECIMAL(38,9)"),
        ("PAYER_COVERAGE", "payer_coverage", "DECIMAL(38,9)"),
    ],
    "medications": [
        ("PATIENT", "patient_id", "VARCHAR"),
        ("PAYER", "payer_id", "VARCHAR"),
        ("ENCOUNTER", "encounter_id", "VARCHAR"),
        ("CODE", "medication_code", "VARCHAR"),
        ("DESCRIPTION", "medication_description", "VARCHAR"),
        ("REASONCODE", "reason_code", "VARCHAR"),
        ("REASONDESCRIPTION", "reason_description", "VARCHAR"),
        ("START", "start_timestamp", "TIMESTAMP"),
        ("STOP", "stop_timestamp", "TIMESTAMP"),
        ("DISPENSES", "dispenses", "BIGINT"),
        ("BASE_COST", "base_cost", "DECIMAL(38,9)"),
        ("PAYER_COVERAGE", "payer_coverage", "DECIMAL(38,9)"),
        ("TOTALCOST", "total_cost", "DECIMAL(38,9)"),
    ],
    "organizations": [
        ("Id", "organization_id", "VARCHAR"),
        ("NAME", "organization_name", "VARCHAR"),
        ("ADDRESS", "address", "VARCHAR"),
        ("CITY", "city", "VARCHAR"),
        ("STATE", "state", "VARCHAR"),
        ("ZIP", "zip_code", "VARCHAR"),
        ("PHONE", "phone", "VARCHAR"),
        ("LAT", "latitude", "DOUBLE"),
        ("LON", "longitude", "DOUBLE"),
        ("REVENUE", "revenue", "DECIMAL(38,9)"),
        ("UTILIZATION", "utilization", "BIGINT"),
    ],
    "patients": [
        ("Id", "patient_id", "VARCHAR"),
        ("BIRTHDATE", "birth_date", "DATE"),
        ("DEATHDATE", "death_date", "DATE"),
        ("SSN", "ssn", "VARCHAR"),
        ("DRIVERS", "drivers_license", "VARCHAR"),
        ("PASSPORT", "passport", "VARCHAR"),
        ("PREFIX", "name_prefix", "VARCHAR"),
        ("FIRST", "first_name", "VARCHAR"),
        ("MIDDLE", "middle_name", "VARCHAR"),
        ("LAST", "last_name", "VARCHAR"),
        ("SUFFIX", "name_suffix", "VARCHAR"),
        ("MAIDEN", "maiden_name", "VARCHAR"),
        ("MARITAL", "marital_status", "VARCHAR"),
        ("RACE", "race", "VARCHAR"),
        ("ETHNICITY", "ethnicity", "VARCHAR"),
        ("GENDER", "gender", "VARCHAR"),
        ("BIRTHPLACE", "birthplace", "VARCHAR"),
        ("ADDRESS", "address", "VARCHAR"),
        ("CITY", "city", "VARCHAR"),
        ("STATE", "state", "VARCHAR"),
        ("COUNTY", "county", "VARCHAR"),
        ("FIPS", "fips_code", "VARCHAR"),
        ("ZIP", "zip_code", "VARCHAR"),
        ("LAT", "latitude", "DOUBLE"),
        ("LON", "longitude", "DOUBLE"),
        ("HEALTHCARE_EXPENSES", "healthcare_expenses", "DECIMAL(38,9)"),
        ("HEALTHCARE_COVERAGE", "healthcare_coverage", "DECIMAL(38,9)"),
        ("INCOME", "income", "DECIMAL(38,9)"),
    ],
}
MODELS = {
    "encounters": "stg_encounters_data",
    "medications": "stg_medications_data",
    "organizations": "stg_organizations_data",
    "patients": "stg_patients_data",
}
# ------------------------------------ fixed values: declared tests (column, test, argument)
TESTS = {
    "encounters": [
        ("encounter_id", "unique", None),
        ("encounter_id", "not_null", None),
        ("patient_id", "not_null", None),
        ("organization_id", "not_null", None),
        ("provider_id", "not_null", None),
        ("payer_id", "not_null", None),
        ("encounter_class", "not_null", None),
        ("encounter_class", "accepted_values", ["ambulatory", "emergency", "inpatient", "wellness", "urgentcare"]),
        ("encounter_code", "not_null", None),
        ("encounter_description", "not_null", None),
        ("start_timestamp", "not_null", None),
        ("base_encounter_cost", "not_null", None),
        ("base_encounter_cost", "accepted_range", 0),
        ("total_claim_cost", "not_null", None),
        ("total_claim_cost", "accepted_range", 0),
        ("payer_coverage", "not_null", None),
        ("payer_coverage", "accepted_range", 0),
    ],
    "medications": [
        ("medication_id", "unique", None),
        ("medication_id", "not_null", None),
        ("patient_id", "not_null", None),
        ("payer_id", "not_null", None),
        ("encounter_id", "not_null", None),
        ("medication_code", "not_null", None),
        ("medication_description", "not_null", None),
        ("start_timestamp", "not_null", None),
        ("dispenses", "not_null", None),
        ("dispenses", "accepted_range", 1),
        ("base_cost", "not_null", None),
        ("base_cost", "accepted_range", 0),
        ("payer_coverage", "not_null", None),
        ("payer_coverage", "accepted_range", 0),
        ("total_cost", "not_null", None),
        ("total_cost", "accepted_range", 0),
    ],
    "organizations": [
        ("organization_id", "unique", None),
        ("organization_id", "not_null", None),
        ("organization_name", "not_null", None),
        ("address", "not_null", None),
        ("city", "not_null", None),
        ("revenue", "not_null", None),
        ("revenue", "accepted_range", 0),
        ("utilization", "not_null", None),
        ("utilization", "accepted_range", 0),
    ],
    "patients": [
        ("patient_id", "unique", None),
        ("patient_id", "not_null", None),
        ("birth_date", "not_null", None),
        ("ssn", "not_null", None),
        ("first_name", "not_null", None),
        ("last_name", "not_null", None),
        ("marital_status", "accepted_values", ["M", "S", "D", "W"]),
        ("race", "not_null", None),
        ("ethnicity", "not_null", None),
        ("gender", "not_null", None),
        ("gender", "accepted_values", ["M", "F"]),
        ("birthplace", "not_null", None),
        ("address", "not_null", None),
        ("city", "not_null", None),
        ("state", "not_null", None),
        ("healthcare_expenses", "not_null", None),
        ("healthcare_expenses", "accepted_range", 0),
        ("healthcare_coverage", "not_null", None),
        ("healthcare_coverage", "accepted_range", 0),
        ("income", "not_null", None),
        ("income", "accepted_range", 0),
    ],
}
# --------------------------------- fixed values: fact columns (side, source, name)
FACT = [
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

# --------------------------------------------------------------- raw tables
RAW_SQL = {
    "patients": """
SELECT
  c_custkey AS _k,
  'P' || CAST(CASE WHEN c_custkey % 89 = 1 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS "Id",
  CASE WHEN c_custkey % 97 = 5 THEN NULL
       ELSE DATE '1930-01-01' + CAST(c_custkey * 131 % 25000 AS INTEGER) END AS "BIRTHDATE",
  CASE WHEN c_custkey % 13 = 0 THEN
       (CASE WHEN c_custkey % 97 = 5 THEN NULL
             ELSE DATE '1930-01-01' + CAST(c_custkey * 131 % 25000 AS INTEGER) END) + 21000 END AS "DEATHDATE",
  '999-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS "SSN",
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'S' || CAST(c_custkey AS VARCHAR) END AS "DRIVERS",
  CASE WHEN c_custkey % 4 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR) || 'X' END AS "PASSPORT",
  CASE WHEN c_custkey % 2 = 0 THEN 'Mr.' ELSE 'Ms.' END AS "PREFIX",
  c_name AS "FIRST",
  CAST(NULL AS VARCHAR) AS "MIDDLE",
  n_name AS "LAST",
  CASE WHEN c_custkey % 50 = 0 THEN 'null' END AS "SUFFIX",
  CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN '  ' END AS "MAIDEN",
  CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'S' WHEN 2 THEN 'D' WHEN 3 THEN 'W'
       WHEN 4 THEN NULL WHEN 5 THEN 'M' ELSE 'X' END AS "MARITAL",
  CASE c_custkey % 5 WHEN 0 THEN 'white' WHEN 1 THEN 'black' WHEN 2 THEN 'asian'
       WHEN 3 THEN 'native' ELSE 'other' END AS "RACE",
  CASE WHEN c_custkey % 6 = 0 THEN 'hispanic' ELSE 'nonhispanic' END AS "ETHNICITY",
  CASE WHEN c_custkey % 31 = 7 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "GENDER",
  n_name || ' Town' AS "BIRTHPLACE",
  '  ' || CAST(c_custkey AS VARCHAR) || ' ' || c_mktsegment || ' Street ' AS "ADDRESS",
  n_name AS "CITY",
  r_name AS "STATE",
  n_name || ' County' AS "COUNTY",
  lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR), 5, '0') AS "FIPS",
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS "ZIP",
  CAST(c_nationkey * 3 - 36 AS DOUBLE) AS "LAT",
  CAST(c_nationkey * 7 - 90 AS DOUBLE) AS "LON",
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS "HEALTHCARE_EXPENSES",
  CAST((c_custkey % 1000) * 25 AS DECIMAL(38,18)) AS "HEALTHCARE_COVERAGE",
  CAST(CASE WHEN c_custkey % 211 = 17 THEN -1000 ELSE 20000 + c_custkey * 37 % 80000 END AS DECIMAL(38,2)) AS "INCOME"
FROM customer
LEFT JOIN (SELECT * FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) g ON c_nationkey = g.n_nationkey
""",
    "encounters": """
SELECT
  o_orderkey AS _k,
  'E' || CAST(CASE WHEN o_orderkey % 97 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS "Id",
  CAST(o_orderdate AS TIMESTAMP) AS "START",
  CAST(max_ship AS TIMESTAMP) AS "STOP",
  'P' || CAST(o_custkey AS VARCHAR) AS "PATIENT",
  'O' || CAST(min_supp AS VARCHAR) AS "ORGANIZATION",
  'D' || CAST(o_custkey % 100 AS VARCHAR) AS "PROVIDER",
  'Y' || CAST(o_custkey % 10 AS VARCHAR) AS "PAYER",
  CASE WHEN o_orderkey % 5 = 0 THEN ' ' || cls || ' ' ELSE cls END AS "ENCOUNTERCLASS",
  substr(o_orderpriority, 1, 1) AS "CODE",
  substr(o_orderpriority, 3) AS "DESCRIPTION",
  CAST(CASE WHEN o_orderkey % 101 = 7
            THEN -(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2)))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2)) END AS DECIMAL(38,18)) AS "BASE_ENCOUNTER_COST",
  CAST(sum_ext AS DECIMAL(38,18)) AS "TOTAL_CLAIM_COST",
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(38,18)) AS "PAYER_COVERAGE",
  CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE ' ' || o_orderstatus || ' ' END AS "REASONCODE",
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS "REASONDESCRIPTION"
FROM (
  SELECT o.*,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'urgentcare'
         WHEN '3-MEDIUM' THEN 'inpatient' WHEN '4-NOT SPECIFIED' THEN 'outpatient'
         ELSE CASE WHEN o_orderstatus = 'F' THEN 'ambulatory' ELSE 'wellness' END END AS cls,
    a.min_supp, a.max_ship, a.sum_ext
  FROM orders o
  LEFT JOIN (
    SELECT l_orderkey, min(l_suppkey) AS min_supp, max(l_shipdate) AS max_ship,
           sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_ext
    FROM lineitem GROUP BY l_orderkey
  ) a ON o.o_orderkey = a.l_orderkey
) x
""",
    "medications": """
SELECT
  l_orderkey AS _k,
  CAST(o_orderdate AS TIMESTAMP) AS "START",
  CAST(CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS TIMESTAMP) AS "STOP",
  'P' || CAST(o_custkey AS VARCHAR) AS "PATIENT",
  'Y' || CAST(o_custkey % 10 AS VARCHAR) AS "PAYER",
  'E' || CAST(l_orderkey AS VARCHAR) AS "ENCOUNTER",
  CAST(l_partkey AS VARCHAR) AS "CODE",
  p_name AS "DESCRIPTION",
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS "BASE_COST",
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(38,18)) AS "PAYER_COVERAGE",
  CAST(l_quantity AS INTEGER) AS "DISPENSES",
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS "TOTALCOST",
  CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS "REASONCODE",
  CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' END AS "REASONDESCRIPTION"
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
""",
    "organizations": """
SELECT
  s_suppkey AS _k,
  'O' || CAST(CASE WHEN s_suppkey % 41 = 1 AND s_suppkey > 1 THEN s_suppkey - 1 ELSE s_suppkey END AS VARCHAR) AS "Id",
  s_name AS "NAME",
  CASE WHEN s_suppkey % 47 = 3 THEN '   ' ELSE CAST(s_suppkey AS VARCHAR) || ' Supply Road' END AS "ADDRESS",
  n_name AS "CITY",
  CASE WHEN s_suppkey % 29 = 3 THEN NULL
       WHEN s_suppkey % 13 = 7 THEN lower(substr(r_name, 1, 2))
       ELSE upper(substr(r_name, 1, 2)) END AS "STATE",
  lpad(CAST(s_suppkey * 7 % 100000 AS VARCHAR), 5, '0') AS "ZIP",
  CASE WHEN s_suppkey % 31 = 5 THEN CAST(95.5 AS DOUBLE) ELSE CAST(s_nationkey * 3 - 36 AS DOUBLE) END AS "LAT",
  CASE WHEN s_suppkey % 37 = 11 THEN CAST(-181.25 AS DOUBLE) ELSE CAST(s_nationkey * 7 - 90 AS DOUBLE) END AS "LON",
  '555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')
    || CASE WHEN s_suppkey % 3 = 0 THEN ' Or 555-' || lpad(CAST((s_suppkey + 1) % 10000 AS VARCHAR), 4, '0') ELSE '' END AS "PHONE",
  CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS "REVENUE",
  CAST(s_suppkey % 500 AS INTEGER) AS "UTILIZATION"
FROM supplier
LEFT JOIN (SELECT * FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) g ON s_nationkey = g.n_nationkey
""",
}

# Violations by key: column, what stands there, and the keys (modulus, remainder) where it does.  Together with
# those in the texts above each rule, required column and declared test has rows that fail it.
PLANTS = {
    "patients": [
        ("Id", "null", 131, 1),
        ("SSN", "null", 137, 2),
        ("FIRST", "null", 139, 3),
        ("LAST", "null", 149, 4),
        ("RACE", "null", 151, 5),
        ("ETHNICITY", "null", 157, 6),
        ("GENDER", "null", 163, 7),
        ("BIRTHPLACE", "null", 167, 8),
        ("ADDRESS", "null", 173, 9),
        ("CITY", "null", 179, 10),
        ("STATE", "null", 181, 11),
        ("HEALTHCARE_EXPENSES", "null", 191, 12),
        ("HEALTHCARE_COVERAGE", "null", 193, 13),
        ("HEALTHCARE_COVERAGE", "negative", 223, 19),
        ("INCOME", "null", 197, 14),
    ],
    "encounters": [
        ("Id", "null", 211, 1),
        ("START", "null", 223, 2),
        ("PATIENT", "null", 227, 3),
        ("PROVIDER", "null", 229, 4),
        ("PAYER", "null", 233, 5),
        ("ENCOUNTERCLASS", "null", 239, 6),
        ("CODE", "null", 241, 7),
        ("DESCRIPTION", "null", 251, 8),
        ("BASE_ENCOUNTER_COST", "null", 257, 9),
        ("TOTAL_CLAIM_COST", "negative", 103, 9),
        ("PAYER_COVERAGE", "null", 263, 10),
        ("PAYER_COVERAGE", "negative", 107, 11),
    ],
    "medications": [
        ("START", "null", 149, 6),
        ("PATIENT", "null", 151, 7),
        ("PAYER", "null", 157, 8),
        ("ENCOUNTER", "null", 163, 9),
        ("CODE", "null", 167, 10),
        ("DESCRIPTION", "null", 173, 11),
        ("BASE_COST", "null", 179, 12),
        ("BASE_COST", "negative", 131, 3),
        ("PAYER_COVERAGE", "null", 181, 13),
        ("PAYER_COVERAGE", "negative", 137, 4),
        ("DISPENSES", "null", 191, 14),
        ("DISPENSES", "negative", 113, 1),
        ("DISPENSES", "zero", 127, 2),
        ("TOTALCOST", "null", 193, 15),
        ("TOTALCOST", "negative", 139, 5),
    ],
    "organizations": [
        ("Id", "null", 38, 15),
        ("NAME", "null", 33, 10),
        ("ADDRESS", "null", 34, 12),
        ("CITY", "null", 35, 12),
        ("REVENUE", "null", 36, 13),
        ("UTILIZATION", "null", 39, 14),
        ("UTILIZATION", "negative", 19, 4),
    ],
}
_PLANTED = {"null": "NULL", "negative": "-abs({c})", "zero": "0"}


def raw_sql(t: str) -> str:
    """A raw table: the text above with the violations put in."""
    cases: dict[str, str] = {}
    for column, what, modulus, remainder in PLANTS[t]:
        cases[column] = cases.get(column, "") + f"WHEN _k % {modulus} = {remainder} THEN {_PLANTED[what].format(c=q(column))} "
    replaced = ", ".join(f"CASE {whens}ELSE {q(c)} END AS {q(c)}" for c, whens in cases.items())
    return f"SELECT * EXCLUDE (_k) REPLACE ({replaced}) FROM ({RAW_SQL[t]})"


# ---------------------------------------------------- rule predicates (SQL)
REQUIRED_SQL = {t: " AND ".join(f'"{c}" IS NOT NULL' for c in REQUIRED[t]) for t in REQUIRED}

RULE_SQL = {
    "encounters": [
        ("Id_isUnique", None),
        ("encounter_class_set", "\"ENCOUNTERCLASS\" IN ('ambulatory', 'emergency', 'inpatient', 'wellness', 'urgentcare')"),
        ("base_cost_nonNeg", '"BASE_ENCOUNTER_COST" >= 0'),
        ("total_cost_nonNeg", '"TOTAL_CLAIM_COST" >= 0'),
        ("payer_coverage_nonNeg", '"PAYER_COVERAGE" >= 0'),
        ("date_range_stop_after_start", '"STOP" IS NULL OR "STOP" >= "START"'),
        ("base_cost_<=_total", '"BASE_ENCOUNTER_COST" <= "TOTAL_CLAIM_COST"'),
        ("payer_amnt_<=_total", '"PAYER_COVERAGE" <= "TOTAL_CLAIM_COST"'),
    ],
    "medications": [
        ("base_cost_nonNeg", '"BASE_COST" >= 0'),
        ("payer_coverage_nonNeg", '"PAYER_COVERAGE" >= 0'),
        ("dispenses_nonNeg", '"DISPENSES" >= 0'),
        ("totalcost_nonNeg", '"TOTALCOST" >= 0'),
        ("date_range_stop_after_start", '"STOP" IS NULL OR "STOP" >= "START"'),
        ("payer_coverage_<=_totalcost", '"PAYER_COVERAGE" <= "TOTALCOST"'),
        ("dispenses_positive", '"DISPENSES" > 0'),
        (
            "totalcost_consistent_with_base_and_dispenses",
            '"TOTALCOST" >= "BASE_COST" AND CAST("TOTALCOST" AS DOUBLE) '
            '<= CAST("BASE_COST" * "DISPENSES" AS DOUBLE) * CAST(1.1 AS DOUBLE)',
        ),
    ],
    "organizations": [
        ("Id_isUnique", None),
        ("revenue_nonNeg", '"REVENUE" >= 0'),
        ("utilization_nonNeg", '"UTILIZATION" >= 0'),
        ("lat_valid_range", '"LAT" IS NULL OR ("LAT" >= -90 AND "LAT" <= 90)'),
        ("lon_valid_range", '"LON" IS NULL OR ("LON" >= -180 AND "LON" <= 180)'),
        ("state_valid_format", "\"STATE\" IS NULL OR regexp_matches(\"STATE\", '^[A-Z]{2}$')"),
    ],
    "patients": [
        ("duplicate_ids", None),
        ("valid_gender", "\"GENDER\" IN ('M', 'F')"),
        ("valid_marital", "\"MARITAL\" IS NULL OR \"MARITAL\" IN ('M', 'S', 'D', 'W')"),
        ("healthcare_expenses_nonNeg", '"HEALTHCARE_EXPENSES" >= 0'),
        ("healthcare_coverage_nonNeg", '"HEALTHCARE_COVERAGE" >= 0'),
        ("income_nonNeg", '"INCOME" >= 0'),
    ],
}

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def q(c: str) -> str:
    return f'"{c}"'


def _cols(t: str) -> list[str]:
    return COLUMNS[t]


def _collist(t: str, prefix: str = "") -> str:
    return ", ".join(prefix + q(c) for c in _cols(t))


def _order_all(cols: list[str]) -> str:
    return ", ".join(f"{q(c)} ASC NULLS FIRST" for c in cols)


def _norm_expr(c: str) -> str:
    return f"CASE WHEN {q(c)} IN ('', 'null') THEN NULL ELSE trim({q(c)}) END"


def _split(t: str):
    rules = RULE_SQL[t]
    idx = [i for i, (_, p) in enumerate(rules) if p is None]
    if not idx:
        return rules, None, []
    i = idx[0]
    return rules[:i], rules[i][0], rules[i + 1 :]


def _first_fail(rules) -> str:
    if not rules:
        return "CAST(NULL AS VARCHAR)"
    whens = " ".join(f"WHEN NOT COALESCE(({p}), false) THEN '{n}'" for n, p in rules)
    return f"CASE {whens} END"


def table_ctes(t: str) -> list[str]:
    """CTEs <t>_raw, _norm, _tag, _elig, _surv, _out, _clean."""
    strings = TEXT_COLUMNS[t]
    norm = ", ".join(
        (f"{_norm_expr(c)} AS {q(c)}" if c in strings else q(c)) for c in _cols(t)
    )
    ctes = [f"{t}_raw AS ({raw_sql(t)})", f"{t}_norm0 AS (SELECT {norm} FROM {t}_raw)"]
    if t == "organizations":
        phone = "split_part(\"PHONE\", ' Or ', 1)"
        ctes.append(f"{t}_norm AS (SELECT * REPLACE ({phone} AS \"PHONE\") FROM {t}_norm0)")
    else:
        ctes.append(f"{t}_norm AS (SELECT * FROM {t}_norm0)")
    pre, dd, post = _split(t)
    pre_whens = " ".join(f"WHEN NOT COALESCE(({p}), false) THEN '{n}'" for n, p in pre)
    ctes.append(
        f"{t}_tag AS (SELECT *, CASE WHEN NOT ({REQUIRED_SQL[t]}) THEN 'required_not_null' {pre_whens} END AS _status FROM {t}_norm)"
    )
    ctes.append(f"{t}_elig AS (SELECT {_collist(t)} FROM {t}_tag WHERE _status IS NULL)")
    if dd:
        key = ", ".join(q(k) for k in KEYS[t])
        ctes.append(
            f"{t}_surv AS (SELECT {_collist(t)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {_order_all(_cols(t))}) AS _rn FROM {t}_elig) WHERE _rn = 1)"
        )
    else:
        ctes.append(f"{t}_surv AS (SELECT * FROM {t}_elig)")
    ctes.append(f"{t}_out AS (SELECT *, COALESCE({_first_fail(post)}, 'keep') AS outcome FROM {t}_surv)")
    ctes.append(f"{t}_clean AS (SELECT {_collist(t)} FROM {t}_out WHERE outcome = 'keep')")
    return ctes


def staged_columns(t: str) -> str:
    cols = [f"TRY_CAST({q(source)} AS {type_}) AS {q(name)}" for source, name, type_ in STAGED[t]]
    if t == "medications":
        joined = ", ".join(f"COALESCE(CAST({q(k)} AS VARCHAR), '{NULL_TOKEN}')" for k in KEYS[t])
        cols.insert(0, f"md5(concat_ws('-', {joined})) AS \"medication_id\"")
    return ", ".join(cols)


def staged_select(t: str, source: str) -> str:
    key = ", ".join(q(k) for k in KEYS[t])
    keyed = " AND ".join(f"{q(k)} IS NOT NULL" for k in KEYS[t])
    return (
        f"SELECT {staged_columns(t)} FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {_order_all(_cols(t))}) AS _rn FROM {source} WHERE {keyed}) WHERE _rn = 1)"
    )


def staged_ctes(source_suffix: str = "_clean", test_run: bool = False) -> list[str]:
    out = []
    for t in COLUMNS:
        body = staged_select(t, f"{t}{source_suffix}")
        if test_run:
            first = "medication_id" if t == "medications" else STAGED[t][0][1]
            body = f"SELECT * FROM ({body}) ORDER BY {q(first)} LIMIT 100"
        out.append(f"stg_{t} AS ({body})")
    return out


def projected_ctes() -> list[str]:
    """The staged columns of all normalised rows, without key filter and dedupe."""
    return [f"stg_{t} AS (SELECT {staged_columns(t)} FROM {t}_norm)" for t in COLUMNS]


ENC_COLS = [
    "encounter_id", "patient_id", "organization_id", "provider_id", "payer_id", "encounter_class",
    "encounter_code", "encounter_description", "reason_code", "reason_description", "start_timestamp",
    "stop_timestamp", "base_encounter_cost", "total_claim_cost", "payer_coverage",
]
ORG_COLS = [
    "organization_name", "address", "city", "state", "zip_code", "phone", "latitude", "longitude",
    "revenue", "utilization",
]


def fact_ctes(test_run: bool = False) -> list[str]:
    eo = ", ".join([f"e.{q(c)}" for c in ENC_COLS] + [f"o.{q(c)}" for c in ORG_COLS])
    fact_cols = ", ".join(f"{side}.{q(src)} AS {q(name)}" for side, src, name in FACT)
    fact = (
        f"SELECT {fact_cols} FROM stg_medications m "
        f"LEFT JOIN stg_patients p ON m.patient_id = p.patient_id "
        f"LEFT JOIN enc_org eo ON m.encounter_id = eo.encounter_id"
    )
    if test_run:
        fact = f"SELECT * FROM ({fact}) ORDER BY medication_id LIMIT 100"
    return [
        f"enc_org AS (SELECT {eo} FROM stg_encounters e LEFT JOIN stg_organizations o ON e.organization_id = o.organization_id)",
        f"fact AS ({fact})",
    ]


def with_all(select: str, tables=tuple(COLUMNS), staged: bool = False, fact: bool = False, test_run: bool = False) -> str:
    ctes = []
    for t in tables:
        ctes += table_ctes(t)
    if staged or fact:
        ctes += staged_ctes(test_run=test_run)
    if fact:
        ctes += fact_ctes(test_run=test_run)
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ------------------------------------------------------------- audit pieces
def audit_select(t: str) -> str:
    pre, dd, post = _split(t)
    parts = []
    for i, (name, pred) in enumerate(RULE_SQL[t]):
        if pred is None:
            removed = f"(SELECT count(*) FROM {t}_elig) - (SELECT count(*) FROM {t}_surv)"
        elif (name, pred) in pre:
            removed = f"(SELECT count(*) FROM {t}_tag WHERE _status = '{name}')"
        else:
            removed = f"(SELECT count(*) FROM {t}_out WHERE outcome = '{name}')"
        parts.append(
            f"SELECT '{t}' AS table_name, CAST({i + 1} AS INTEGER) AS rule_order, '{name}' AS rule, "
            f"CAST({removed} AS BIGINT) AS removed"
        )
    return " UNION ALL ".join(parts)


def summary_select(t: str) -> str:
    return (
        f"SELECT '{t}' AS table_name, "
        f"CAST((SELECT count(*) FROM {t}_tag) AS BIGINT) AS original, "
        f"CAST((SELECT count(*) FROM {t}_tag WHERE _status = 'required_not_null') AS BIGINT) AS null_removed, "
        f"CAST((SELECT count(*) FROM {t}_tag) - (SELECT count(*) FROM {t}_tag WHERE _status = 'required_not_null') "
        f"- (SELECT count(*) FROM {t}_clean) AS BIGINT) AS malformed_removed, "
        f"CAST((SELECT count(*) FROM {t}_clean) AS BIGINT) AS final"
    )


def rejects_select(t: str) -> str:
    cols = _collist(t)
    pre, dd, post = _split(t)
    parts = [
        f"SELECT _status AS rule, {cols} FROM {t}_tag WHERE _status IS NOT NULL",
        f"SELECT outcome AS rule, {cols} FROM {t}_out WHERE outcome <> 'keep'",
    ]
    if dd:
        parts.append(f"SELECT '{dd}' AS rule, * FROM (SELECT {cols} FROM {t}_elig EXCEPT SELECT {cols} FROM {t}_surv)")
    return "SELECT DISTINCT * FROM (" + " UNION ALL ".join(parts) + ")"


# ---------------------------------------------------------- data tests SQL
def test_failures(t: str, kinds: set[str]) -> list[str]:
    """One SELECT for each declared test of the kinds, over the CTE stg_<t>."""
    out = []
    for column, kind, arg in TESTS[t]:
        if kind not in kinds:
            continue
        c, model, name = q(column), f"stg_{t}", kind
        if kind == "not_null":
            n = f"(SELECT count(*) FROM {model} WHERE {c} IS NULL)"
        elif kind == "accepted_values":
            name = "accepted_values:" + ",".join(arg)
            vals = ", ".join(f"'{v}'" for v in arg)
            n = f"(SELECT count(*) FROM {model} WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}))"
        elif kind == "accepted_range":
            name = f"accepted_range:min={arg}"
            n = f"(SELECT count(*) FROM {model} WHERE {c} IS NOT NULL AND {c} < {arg})"
        else:
            n = f"(SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
        out.append(f"SELECT '{MODELS[t]}' AS model, '{column}' AS column_name, '{name}' AS test, CAST({n} AS BIGINT) AS failures")
    return out
