"""Registered queries (one per operator family) and their DuckDB oracles.

Every query derives its input from the test tables of one scale-factor
folder and runs over whole tables.  Queries that exercise sinks write to
a fresh folder under the session's shared checkpoint directory and read
the written table back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, StringType, StructField

from pillbox.functions.casts import payment_type_description, rename, safe_cast, surrogate_key
from pillbox.functions.strings import first_phone, normalise
from pillbox.operators import analytics
from pillbox.operators.dedupe import dedupe
from pillbox.operators.fact import build_fact, enc_org, fact_docs
from pillbox.operators.hotjoin import salted_left_join
from pillbox.operators.quality import run_tests
from pillbox.operators.rules import apply_rules, prepare, rejects_sample
from pillbox.operators.sinks import (
    DAY,
    PACKED,
    PARTITION_COL,
    SMALL,
    SchemaChangeError,
    append,
    changed_rows,
    check_schema,
    copy_table,
    land,
    overwrite,
    read_merged,
    schema_diff_frame,
    upsert,
    with_docs,
    write_fact,
)
from pillbox.operators.stage import project, stage
from pillbox.plans import oracle as O
from pillbox.plans.etl import TABLES, clean_tables, create_views, run_pipeline, stage_stored, testdata_model
from pillbox.plans.specs import COST_TOLERANCE, SPECS, STATE_PATTERN, TS_FORMAT
from pillbox.session import scratch_path
from pillbox.sources.csv import locate_input, read_damaged, read_raw, write_csv
from pillbox.sources.tables import read_fact, read_rejects, read_table
from pillbox.sources.testdata import raw_table, raw_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _model(spark, sf_dir, **kw):
    return testdata_model(spark, sf_dir, **kw)


# ------------------------------------------------------------ cleaning (D, F, I)
for _t in TABLES:

    def _clean(spark, sf_dir, t=_t):
        return _model(spark, sf_dir).cleaned[t].clean

    def _audit(spark, sf_dir, t=_t):
        return _model(spark, sf_dir).cleaned[t].audit

    def _rejects(spark, sf_dir, t=_t):
        return _model(spark, sf_dir).cleaned[t].rejects

    def _stage(spark, sf_dir, t=_t):
        return _model(spark, sf_dir).staged[t]

    register(f"clean_{_t}", O.with_all(f"SELECT * FROM {_t}_clean", tables=[_t]))(_clean)
    register(f"audit_{_t}", O.with_all(O.audit_select(_t), tables=[_t]))(_audit)
    register(f"rejects_{_t}", O.with_all(O.rejects_select(_t), tables=[_t]))(_rejects)
    register(f"stage_{_t}", O.with_all(f"SELECT * FROM stg_{_t}", staged=True))(_stage)


# H-L3: the first rejected rows per rule (the level-2 display; the row
# limit is the feature), in a total order so the sample is deterministic
REJECTS_SAMPLE_ROWS = 5


def _rejects_sample_sql(t: str) -> str:
    cols = ", ".join(O.q(c) for c in O.COLUMNS[t])
    order = O._order_all(O.COLUMNS[t])
    return O.with_all(
        f"SELECT rule, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY {order}) AS _rn "
        f"FROM ({O.rejects_select(t)})) WHERE _rn <= {REJECTS_SAMPLE_ROWS}",
        tables=[t],
    )


for _t in TABLES:

    def _sample(spark, sf_dir, t=_t):
        return rejects_sample(_model(spark, sf_dir).cleaned[t], REJECTS_SAMPLE_ROWS)

    register(f"rejects_sample_{_t}", _rejects_sample_sql(_t))(_sample)


@register("summary_all", O.with_all(" UNION ALL ".join(O.summary_select(t) for t in TABLES)))
def summary_all(spark, sf_dir):
    cleaned = _model(spark, sf_dir).cleaned
    return reduce(DataFrame.unionByName, [cleaned[t].summary for t in TABLES])


# ------------------------------------------------------- keys, dedupe, joins
@register(
    "surrogate_key",
    O.with_all(
        "SELECT \"PATIENT\", \"CODE\", \"ENCOUNTER\", md5(concat_ws('-', "
        f"COALESCE(CAST(\"PATIENT\" AS VARCHAR), '{O.NULL_TOKEN}'), "
        f"COALESCE(CAST(\"CODE\" AS VARCHAR), '{O.NULL_TOKEN}'), "
        f"COALESCE(CAST(\"ENCOUNTER\" AS VARCHAR), '{O.NULL_TOKEN}'))) AS medication_id FROM medications_norm",
        tables=["medications"],
    ),
)
def q_surrogate_key(spark, sf_dir):
    m = prepare(raw_table(spark, sf_dir, "medications"), SPECS["medications"])
    return m.select("PATIENT", "CODE", "ENCOUNTER", surrogate_key("PATIENT", "CODE", "ENCOUNTER").alias("medication_id"))


@register(
    "dedupe_lineitem",
    O.with_all(
        f"SELECT {O._collist('medications')} FROM (SELECT *, row_number() OVER (PARTITION BY \"PATIENT\", \"CODE\", "
        f"\"ENCOUNTER\" ORDER BY {O._order_all(O.COLUMNS['medications'])}) AS _rn FROM medications_norm) WHERE _rn = 1",
        tables=["medications"],
    ),
)
def q_dedupe_lineitem(spark, sf_dir):
    m = prepare(raw_table(spark, sf_dir, "medications"), SPECS["medications"])
    return dedupe(m, ["PATIENT", "CODE", "ENCOUNTER"])


@register("join_enc_org", O.with_all("SELECT * FROM enc_org", fact=True))
def q_join_enc_org(spark, sf_dir):
    return _model(spark, sf_dir).enc_org


@register(
    "join_med_patient",
    O.with_all(
        "SELECT m.medication_id, m.patient_id AS medication_patient_id, p.patient_id, p.gender, p.city, p.state, "
        "p.healthcare_expenses FROM stg_medications m LEFT JOIN stg_patients p ON m.patient_id = p.patient_id",
        staged=True,
    ),
)
def q_join_med_patient(spark, sf_dir):
    st = _model(spark, sf_dir).staged
    m, p = st["medications"].alias("m"), st["patients"].alias("p")
    return m.join(p, F.col("m.patient_id") == F.col("p.patient_id"), "left").select(
        F.col("m.medication_id"),
        F.col("m.patient_id").alias("medication_patient_id"),
        F.col("p.patient_id"),
        F.col("p.gender"),
        F.col("p.city"),
        F.col("p.state"),
        F.col("p.healthcare_expenses"),
    )


@register("fact_full", O.with_all("SELECT * FROM fact", fact=True))
def q_fact_full(spark, sf_dir):
    return _model(spark, sf_dir).fact


_ORPHANS_SQL = (
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, "
    "CAST(count(patient_id) AS BIGINT) AS n_with_patient, "
    "CAST(count(encounter_id) AS BIGINT) AS n_with_encounter, "
    "CAST(count(organization_id) AS BIGINT) AS n_with_organization_id, "
    "CAST(count(organization_name) AS BIGINT) AS n_with_organization "
    "FROM fact"
)


@register("fact_orphans", O.with_all(_ORPHANS_SQL, fact=True))
def q_fact_orphans(spark, sf_dir):
    f = _model(spark, sf_dir).fact
    return f.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("patient_id").alias("n_with_patient"),
        F.count("encounter_id").alias("n_with_encounter"),
        F.count("organization_id").alias("n_with_organization_id"),
        F.count("organization_name").alias("n_with_organization"),
    )


# ----------------------------------------------------------- data tests (K)
# The declared tests of one kind run on the staged columns of the normalised raw
# rows (no cleaning, key filter or dedupe), where violations occur, and
# all of them on the staged clean tables (dq_clean_all, where all must be zero).
ALL_KINDS = {"not_null", "unique", "accepted_values", "accepted_range"}


def _dq_sql(kinds: set[str], cleaned: bool) -> str:
    ctes = [c for t in TABLES for c in O.table_ctes(t)] + (O.staged_ctes() if cleaned else O.projected_ctes())
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(x for t in TABLES for x in O.test_failures(t, kinds))


def _dq_query(kinds: set[str], cleaned: bool) -> Query:
    def run(spark, sf_dir):
        out = []
        for t in TABLES:
            spec = SPECS[t]
            if any(x.kind in kinds for x in spec.tests):
                staged = _model(spark, sf_dir).staged[t] if cleaned else project(prepare(raw_table(spark, sf_dir, t), spec), spec)
                out.append(run_tests(staged, spec, kinds=kinds))
        return reduce(DataFrame.unionByName, out)

    return run


for _kind in sorted(ALL_KINDS):
    register(f"dq_{_kind}", _dq_sql({_kind}, cleaned=False))(_dq_query({_kind}, cleaned=False))
register("dq_uncleaned_all", _dq_sql(ALL_KINDS, cleaned=False))(_dq_query(ALL_KINDS, cleaned=False))
register("dq_clean_all", _dq_sql(ALL_KINDS, cleaned=True))(_dq_query(ALL_KINDS, cleaned=True))


# staging itself drops rows without a key and keeps one of each key: here from rows that were not cleaned
def _stage_uncleaned_sql(t: str) -> str:
    return "WITH " + ",\n".join(O.table_ctes(t)) + "\n" + O.staged_select(t, f"{t}_norm")


for _t in TABLES:

    def _stage_uncleaned(spark, sf_dir, t=_t):
        return stage(prepare(raw_table(spark, sf_dir, t), SPECS[t]), SPECS[t])

    register(f"stage_uncleaned_{_t}", _stage_uncleaned_sql(_t))(_stage_uncleaned)


# --------------------------------------------------------- scalar functions (J)
@register(
    "phone_first",
    O.with_all(
        "SELECT \"Id\", \"PHONE\" AS phone_raw, split_part(p, ' Or ', 1) AS phone "
        "FROM (SELECT \"Id\", \"PHONE\", CASE WHEN \"PHONE\" IN ('', 'null') THEN NULL ELSE trim(\"PHONE\") END AS p "
        "FROM organizations_raw)",
        tables=["organizations"],
    ),
)
def q_phone_first(spark, sf_dir):
    o = raw_table(spark, sf_dir, "organizations")
    return o.select("Id", F.col("PHONE").alias("phone_raw"), first_phone(normalise(F.col("PHONE"))).alias("phone"))


@register(
    "state_format",
    O.with_all(
        "SELECT \"Id\", \"STATE\", (\"STATE\" IS NULL OR regexp_matches(\"STATE\", '^[A-Z]{2}$')) AS state_ok "
        "FROM organizations_norm",
        tables=["organizations"],
    ),
)
def q_state_format(spark, sf_dir):
    o = prepare(raw_table(spark, sf_dir, "organizations"), SPECS["organizations"])
    return o.select("Id", "STATE", (F.col("STATE").isNull() | F.col("STATE").rlike(STATE_PATTERN)).alias("state_ok"))


@register(
    "cost_tolerance",
    O.with_all(
        "SELECT \"PATIENT\", \"CODE\", \"ENCOUNTER\", \"BASE_COST\", \"DISPENSES\", \"TOTALCOST\", "
        "(\"TOTALCOST\" >= \"BASE_COST\" AND CAST(\"TOTALCOST\" AS DOUBLE) <= "
        "CAST(\"BASE_COST\" * \"DISPENSES\" AS DOUBLE) * CAST(1.1 AS DOUBLE)) AS within_tolerance "
        "FROM medications_norm",
        tables=["medications"],
    ),
)
def q_cost_tolerance(spark, sf_dir):
    m = prepare(raw_table(spark, sf_dir, "medications"), SPECS["medications"])
    c = F.col
    ok = (c("TOTALCOST") >= c("BASE_COST")) & (c("TOTALCOST") <= c("BASE_COST") * c("DISPENSES") * COST_TOLERANCE)
    return m.select("PATIENT", "CODE", "ENCOUNTER", "BASE_COST", "DISPENSES", "TOTALCOST", ok.alias("within_tolerance"))


@register(
    "safe_cast_mix",
    O.with_all(
        "SELECT \"Id\", TRY_CAST(\"ZIP\" AS INTEGER) AS zip_int, TRY_CAST(\"SSN\" AS INTEGER) AS ssn_int, "
        "TRY_CAST(\"FIPS\" AS BIGINT) AS fips_bigint, TRY_CAST(CAST(\"BIRTHDATE\" AS VARCHAR) AS DATE) AS birth_date, "
        "TRY_CAST(\"FIRST\" AS DATE) AS first_date, TRY_CAST(\"INCOME\" AS DECIMAL(38,9)) AS income, "
        "TRY_CAST(\"HEALTHCARE_EXPENSES\" AS DECIMAL(5,2)) AS expenses_small, "
        "TRY_CAST(\"LAT\" AS VARCHAR) AS lat_text FROM patients_norm",
        tables=["patients"],
    ),
)
def q_safe_cast_mix(spark, sf_dir):
    p = prepare(raw_table(spark, sf_dir, "patients"), SPECS["patients"])
    c = F.col
    return p.select(
        "Id",
        c("ZIP").try_cast("int").alias("zip_int"),
        c("SSN").try_cast("int").alias("ssn_int"),
        c("FIPS").try_cast("bigint").alias("fips_bigint"),
        c("BIRTHDATE").cast("string").try_cast("date").alias("birth_date"),
        c("FIRST").try_cast("date").alias("first_date"),
        c("INCOME").try_cast("decimal(38,9)").alias("income"),
        c("HEALTHCARE_EXPENSES").try_cast("decimal(5,2)").alias("expenses_small"),
        c("LAT").try_cast("string").alias("lat_text"),
    )


@register(
    "decode_code",
    O.with_all(
        "SELECT \"PATIENT\", \"CODE\", \"ENCOUNTER\", \"DISPENSES\", "
        "CASE TRY_CAST(\"DISPENSES\" % 8 AS INTEGER) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' "
        "WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' "
        "ELSE 'EMPTY' END AS payment_type_description FROM medications_norm",
        tables=["medications"],
    ),
)
def q_decode_code(spark, sf_dir):
    m = prepare(raw_table(spark, sf_dir, "medications"), SPECS["medications"])
    return m.select(
        "PATIENT", "CODE", "ENCOUNTER", "DISPENSES",
        payment_type_description(F.col("DISPENSES") % 8).alias("payment_type_description"),
    )


# Column renames applied in one projection (the stray schema-fix analysis).
RENAMES = {
    "Id": "encounter_key",
    "START": "start_datetime",
    "STOP": "stop_datetime",
    "PATIENT": "patient_key",
    "ORGANIZATION": "organization_key",
    "ENCOUNTERCLASS": "encounter_class",
    "BASE_ENCOUNTER_COST": "base_cost",
}


@register(
    "rename_columns",
    O.with_all(
        "SELECT " + ", ".join(
            f"{O.q(c)} AS {O.q(RENAMES.get(c, c))}" for c in O.COLUMNS["encounters"]
        ) + " FROM encounters_clean",
        tables=["encounters"],
    ),
)
def q_rename_columns(spark, sf_dir):
    e = _model(spark, sf_dir).cleaned["encounters"].clean
    return rename(e, RENAMES)


# -------------------------------------------------------------- sinks (A, B)
_M4_SQL = (
    "SELECT patient_id, count(*) AS n_prescriptions, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum, "
    "CAST(sum(payer_coverage) AS DECIMAL(38,9)) AS payer_coverage_sum, "
    "round(CAST(sum(payer_coverage) AS DOUBLE) / CAST(sum(total_cost) AS DOUBLE), 6) AS coverage_ratio "
    "FROM fact GROUP BY patient_id"
)


@register(
    "append_tables",
    O.with_all(
        f"SELECT {O._collist('organizations')} FROM organizations_out WHERE outcome = 'keep' UNION ALL "
        f"SELECT {O._collist('organizations')} FROM organizations_out WHERE outcome <> 'keep'",
        tables=["organizations"],
    ),
)
def q_append_tables(spark, sf_dir):
    """CTAS of the cleaned rows, then INSERT INTO with the rejected survivors."""
    out = _model(spark, sf_dir).cleaned["organizations"].outcomes
    path = scratch_path(spark, "append")
    overwrite(out.filter(F.col("outcome") == "keep").drop("outcome"), path)
    append(out.filter(F.col("outcome") != "keep").drop("outcome"), path)
    return spark.read.parquet(path)


@register("ctas_copy", O.with_all("SELECT * FROM stg_patients", staged=True))
def q_ctas_copy(spark, sf_dir):
    staged = _model(spark, sf_dir).staged["patients"]
    src = scratch_path(spark, "ctas-src")
    overwrite(staged, src)
    return copy_table(spark, src, scratch_path(spark, "ctas-dst"))


def _csv_roundtrip(table: str) -> Query:
    def run(spark, sf_dir):
        path = scratch_path(spark, f"csv-{table}")
        write_csv(raw_table(spark, sf_dir, table), path)
        return apply_rules(read_raw(spark, path, SPECS[table]), SPECS[table], level=0).clean

    return run


for _t in TABLES:
    register(f"csv_roundtrip_{_t}", O.with_all(f"SELECT * FROM {_t}_clean", tables=[_t]))(_csv_roundtrip(_t))


# Each order as a line of text, every fifth kind damaged in its own way: a bad time, a bad number, a line that ends
# early, a line with more cells, and a sound one.
_LINES_SQL = """
    (SELECT o_orderkey, o_orderkey % 5 AS k, CASE o_orderkey % 5 WHEN 0 THEN 'not a time' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END
            || ',,P' || o_custkey || ',Y1,E' || o_orderkey || ',C1' AS head,
            ',Some drug,10.5,1,' || CASE o_orderkey % 5 WHEN 1 THEN 'many' ELSE CAST(o_orderkey % 9 AS VARCHAR) END || ',30.25,r,why' AS tail FROM orders)
"""


@register(
    "csv_malformed_rejects",
    f"""
    SELECT head || CASE k WHEN 2 THEN '' WHEN 3 THEN tail || ',more,cells' ELSE tail END AS line,
           CASE k WHEN 2 THEN 'too few cells' WHEN 3 THEN 'too many cells' ELSE 'bad values' END AS reason,
           CASE k WHEN 0 THEN 'START' WHEN 1 THEN 'DISPENSES' ELSE '' END AS columns
    FROM {_LINES_SQL} WHERE k <> 4
    """,
)
def q_csv_malformed_rejects(spark, sf_dir):
    """The damaged ones of the lines of ``csv_malformed``, whole and with the reason."""
    return read_damaged(spark, _malformed_lines(spark, sf_dir), SPECS["medications"], header="false")


@register(
    "csv_malformed",
    """
    SELECT 'E' || o_orderkey AS "ENCOUNTER", CASE WHEN k <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS "START",
           'P' || o_custkey AS "PATIENT", CASE WHEN k NOT IN (1, 2) THEN CAST(o_orderkey % 9 AS INTEGER) END AS "DISPENSES",
           CASE WHEN k <> 2 THEN CAST(10.5 AS DECIMAL(38,18)) END AS "BASE_COST", CASE WHEN k <> 2 THEN 'why' END AS "REASONDESCRIPTION"
    FROM (SELECT *, o_orderkey % 5 AS k FROM orders)
    """,
)
def q_csv_malformed(spark, sf_dir):
    read = read_raw(spark, _malformed_lines(spark, sf_dir), SPECS["medications"], header="false")
    return read.select("ENCOUNTER", "START", "PATIENT", "DISPENSES", "BASE_COST", "REASONDESCRIPTION")


def _malformed_lines(spark, sf_dir) -> str:
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    k, key = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    start = F.when(k == 0, F.lit("not a time")).otherwise(F.date_format("o_orderdate", TS_FORMAT))
    head = F.concat_ws(",", start, F.lit(""), F.concat(F.lit("P"), F.col("o_custkey").cast("string")), F.lit("Y1"), F.concat(F.lit("E"), key), F.lit("C1"))
    dispenses = F.when(k == 1, F.lit("many")).otherwise((F.col("o_orderkey") % 9).cast("string"))
    tail = F.concat_ws(",", F.lit("Some drug"), F.lit("10.5"), F.lit("1"), dispenses, F.lit("30.25"), F.lit("r"), F.lit("why"))
    line = F.when(k == 2, head).when(k == 3, F.concat_ws(",", head, tail, F.lit("more"), F.lit("cells"))).otherwise(F.concat_ws(",", head, tail))
    path = scratch_path(spark, "csv-malformed")
    o.select(line).write.text(path)
    return path


@register(
    "schema_guard",
    O.with_all(
        "SELECT * FROM (VALUES ('city', NULL, 'string', 'removed'), ('income', 'double', 'decimal(38,9)', 'type_changed'), "
        "('visits', 'int', NULL, 'added')) v(column_name, incoming_type, target_type, change), "
        "(SELECT count(*) AS stored_rows FROM stg_patients)",
        staged=True,
    ),
)
def q_schema_guard(spark, sf_dir):
    """The stored staging model refuses a changed one: what differs, and the rows that stay as they were."""
    staged = _model(spark, sf_dir).staged["patients"]
    path = scratch_path(spark, "schema-guard")
    overwrite(staged, path)
    changed = staged.drop("city").withColumn("income", F.col("income").cast("double")).withColumn("visits", F.lit(1))
    stored = spark.read.parquet(path)
    try:
        check_schema(changed.schema, stored.schema)
        overwrite(changed, path)
    except SchemaChangeError:
        pass
    diff = schema_diff_frame(spark, changed.schema, stored.schema)
    return diff.crossJoin(F.broadcast(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored_rows"))))


@register(
    "land_modes",
    O.with_all(
        "SELECT 'first' AS landing, * FROM stg_organizations UNION ALL SELECT 'again' AS landing, * FROM stg_organizations "
        "UNION ALL SELECT 'forced' AS landing, * REPLACE (utilization + 1 AS utilization) FROM stg_organizations",
        staged=True,
    ),
)
def q_land_modes(spark, sf_dir):
    """Land a table, land a revision on top (it stays out), and force the revision."""
    staged = _model(spark, sf_dir).staged["organizations"]
    revised = staged.withColumn("utilization", F.col("utilization") + 1)
    seen = []
    for landing, df, force in (("first", staged, False), ("again", revised, False), ("forced", revised, True)):
        path = scratch_path(spark, "land")
        if landing != "first":
            land(staged, path)
        land(df, path, force=force)
        seen.append(spark.read.parquet(path).select(F.lit(landing).alias("landing"), "*"))
    return reduce(DataFrame.unionByName, seen)


@register("fact_from_stored", O.with_all(f"SELECT * FROM ({_M4_SQL})", fact=True))
def q_fact_from_stored(spark, sf_dir):
    """Through stored tables: raw tables cleaned to Parquet, staged from there, joined, stored, and the cost per patient."""
    out = scratch_path(spark, "stored")
    clean_tables(spark, raw_tables(spark, sf_dir), f"{out}/raw")
    st = stage_stored(spark, f"{out}/raw")
    overwrite(build_fact(st["medications"], st["patients"], enc_org(st["encounters"], st["organizations"])), f"{out}/fact", **SMALL)
    return analytics.m4_patient_cost(read_table(spark, f"{out}/fact"))


def _rejects_digest_sql(t: str) -> str:
    texts = ", ".join(f"COALESCE({O.q(c)}, '~')" for c in O.TEXT_COLUMNS[t])
    return f"SELECT '{t}' AS table_name, rule, md5(concat_ws('|', {texts})) AS texts_md5, count(*) AS n_rows FROM ({O.rejects_select(t)}) GROUP BY ALL"


def _digests(fields: list[StructField]) -> tuple[Column, Column]:
    """(md5 of the joined texts, md5 of all else that tells rows of such texts apart), 16 bytes each.

    All else is the values that are no text, and the lengths of the texts where the joined ones are unclear: that takes
    a text with the separator in it, or one that looks like a null.
    """
    texts = [F.col(f.name) for f in fields if isinstance(f.dataType, StringType)]
    # equal values are equal texts: the two zeros of a float become one
    values = [F.col(f.name) + F.lit(0.0) if isinstance(f.dataType, FractionalType) and not isinstance(f.dataType, DecimalType) else F.col(f.name) for f in fields if not isinstance(f.dataType, StringType)]
    joined = lambda columns: F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    unclear = reduce(lambda a, b: a | b, [F.coalesce(c.contains("|") | (c == "~"), F.lit(False)) for c in texts])
    lengths = F.when(unclear, joined([F.length(c) for c in texts]))
    return tuple(F.unhex(F.md5(c)) for c in (joined(texts), joined([lengths, *values])))


def _counted_by_texts(kept: DataFrame, fields: list[StructField], distinct: bool) -> DataFrame:
    """rule, md5 of the joined texts, n_rows: how many rows, or ``distinct`` ones, a rule has of such texts.

    Two digests go in place of a row, which is several times as wide.  Equal rows meet by them, so that distinct rows and
    their groups are both made where these lie.
    """
    md5, rest = _digests(fields)
    if distinct:
        rows = kept.select(md5.alias("md5"), rest.alias("rest"), "rule").repartition("md5").distinct()
    else:
        rows = kept.select(md5.alias("md5"), "rule")
    return rows.groupBy("rule", "md5").agg(F.count(F.lit(1)).alias("n_rows"))


@register("pipeline_rejects", O.with_all(" UNION ALL ".join(_rejects_digest_sql(t) for t in TABLES)))
def q_pipeline_rejects(spark, sf_dir):
    """The rejected rows that a written run keeps: the union of what rejects_* return, by a digest of their texts."""
    out = scratch_path(spark, "rejects")
    clean_tables(spark, raw_tables(spark, sf_dir), out)
    parts = []
    for t in TABLES:
        kept = read_rejects(spark, f"{out}/{t}")
        # the outcome tables of the others have equal rows once
        counted = _counted_by_texts(kept, SPECS[t].schema.fields, distinct=SPECS[t].split_rules()[1] is None)
        parts.append(counted.select(F.lit(t).alias("table_name"), "rule", F.lower(F.hex("md5")).alias("texts_md5"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


@register(
    "safe_cast_text",
    """
    SELECT o_orderkey, TRY_CAST(t AS TIMESTAMP) AS as_timestamp, TRY_CAST(d AS DOUBLE) AS as_double
    FROM (SELECT o_orderkey,
                 CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d 03:04:05') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
                      WHEN 2 THEN strftime(o_orderdate, '%Y-13-%d 00:00:00') WHEN 3 THEN 'no time' ELSE '' END AS t,
                 CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.25' WHEN 1 THEN '-' || CAST(o_orderkey AS VARCHAR) || 'e2'
                      WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || ' pieces' ELSE '' END AS d
          FROM orders)
    """,
)
def q_safe_cast_text(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select("o_orderkey", "o_orderdate")
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    day = lambda pattern: F.date_format("o_orderdate", pattern)
    text = F.when(k % 5 == 0, day("yyyy-MM-dd '03:04:05'")).when(k % 5 == 1, day("yyyy-MM-dd")).when(k % 5 == 2, day("yyyy-'13'-dd '00:00:00'")).when(k % 5 == 3, "no time").otherwise("")
    number = F.when(k % 4 == 0, F.concat(key, F.lit(".25"))).when(k % 4 == 1, F.concat(F.lit("-"), key, F.lit("e2"))).when(k % 4 == 2, F.concat(key, F.lit(" pieces"))).otherwise("")
    return o.select("o_orderkey", safe_cast(text, "timestamp").alias("as_timestamp"), safe_cast(number, "double").alias("as_double"))


_VIEW_SQL = (
    "SELECT p.state, count(*) AS n_medications, count(DISTINCT m.medication_code) AS n_codes, CAST(sum(m.total_cost) AS DECIMAL(38,9)) AS total_cost_sum "
    "FROM {m} m JOIN {p} p ON m.patient_id = p.patient_id GROUP BY p.state"
)


@register("staged_view_sql", O.with_all(_VIEW_SQL.format(m="stg_medications", p="stg_patients"), staged=True))
def q_staged_view_sql(spark, sf_dir):
    """The staging models as named views, asked in SQL."""
    create_views(spark, _model(spark, sf_dir))
    return spark.sql(_VIEW_SQL.format(m=SPECS["medications"].staged_model, p=SPECS["patients"].staged_model))


UPSERT_CUTOFF = "1997-01-01"  # rows starting on/after it are re-delivered, one day later


@register(
    "upsert_merge",
    O.with_all(
        f"SELECT *, CAST(start_timestamp AS DATE) AS start_date FROM fact WHERE start_timestamp < TIMESTAMP '{UPSERT_CUTOFF}' "
        f"UNION ALL SELECT * REPLACE (start_timestamp + INTERVAL 1 DAY AS start_timestamp, 'revised' AS reason_description), "
        f"CAST(start_timestamp + INTERVAL 1 DAY AS DATE) AS start_date FROM fact WHERE start_timestamp >= TIMESTAMP '{UPSERT_CUTOFF}'",
        fact=True,
    ),
)
def q_upsert_merge(spark, sf_dir):
    """First load: the whole fact.  Second load: every row from the cutoff
    on, revised and moved one day later; matched keys are replaced (and
    leave their old day), the rest is kept.  The revised rows come from the stored table, so the fact is made once."""
    path = scratch_path(spark, "fact-upsert")
    upsert(spark, path, _model(spark, sf_dir).fact)
    late = read_fact(spark, path, UPSERT_CUTOFF).drop(PARTITION_COL).withColumns(
        {
            "start_timestamp": F.col("start_timestamp") + F.expr("INTERVAL 1 DAY"),
            "reason_description": F.lit("revised"),
        }
    )
    upsert(spark, path, late)
    return read_merged(spark, path)


SMALL_START, SMALL_END = "1996-03-01", "1996-03-04"  # a late correction of three days


@register(
    "upsert_small_batch",
    O.with_all(
        "SELECT * EXCLUDE (late) REPLACE (CASE WHEN late THEN start_timestamp + INTERVAL 40 DAY ELSE start_timestamp END AS start_timestamp, "
        "CASE WHEN late THEN 'corrected' ELSE reason_description END AS reason_description), "
        "CAST(CASE WHEN late THEN start_timestamp + INTERVAL 40 DAY ELSE start_timestamp END AS DATE) AS start_date FROM (SELECT *, "
        f"COALESCE(start_timestamp >= TIMESTAMP '{SMALL_START}' AND start_timestamp < TIMESTAMP '{SMALL_END}', false) AS late FROM fact)",
        fact=True,
    ),
)
def q_upsert_small_batch(spark, sf_dir):
    """The whole fact, then a merge of three days that go to another month: it reads the key buckets of the batch and two months."""
    fact = _model(spark, sf_dir).fact
    path = scratch_path(spark, "fact-small-batch")
    upsert(spark, path, fact)
    first, end = (F.lit(x).cast("timestamp") for x in (SMALL_START, SMALL_END))
    late = read_fact(spark, path, SMALL_START, SMALL_END).drop(PARTITION_COL).where((F.col("start_timestamp") >= first) & (F.col("start_timestamp") < end))
    upsert(spark, path, late.withColumns({"start_timestamp": F.col("start_timestamp") + F.expr("INTERVAL 40 DAY"), "reason_description": F.lit("corrected")}))
    return read_merged(spark, path)


@register(
    "upsert_null_day",
    O.with_all(
        "SELECT * REPLACE (CASE WHEN medication_code < '5' THEN NULL ELSE start_timestamp END AS start_timestamp), "
        "CASE WHEN medication_code < '5' THEN NULL ELSE CAST(start_timestamp AS DATE) END AS start_date FROM fact",
        fact=True,
    ),
)
def q_upsert_null_day(spark, sf_dir):
    """A first batch of rows without a day, then all others, both from the stored fact."""
    stored, path = scratch_path(spark, "fact-rows"), scratch_path(spark, "fact-null-day")
    overwrite(_model(spark, sf_dir).fact, stored, **SMALL)
    fact = read_table(spark, stored)
    early = F.col("medication_code") < "5"
    upsert(spark, path, fact.filter(early).withColumn("start_timestamp", F.lit(None).cast("timestamp")))
    upsert(spark, path, fact.filter(~early))
    return read_merged(spark, path)


PRUNE_START, PRUNE_END = "1996-01-01", "1997-01-01"


@register(
    "partition_pruned_read",
    O.with_all(
        f"SELECT *, CAST(start_timestamp AS DATE) AS start_date FROM fact "
        f"WHERE start_timestamp >= TIMESTAMP '{PRUNE_START}' AND start_timestamp < TIMESTAMP '{PRUNE_END}'",
        fact=True,
    ),
)
def q_partition_pruned_read(spark, sf_dir):
    fact = _model(spark, sf_dir).fact
    path = scratch_path(spark, "fact-pruned")
    write_fact(fact, path)
    return read_fact(spark, path, PRUNE_START, PRUNE_END)


@register(
    "partition_pruned_offset",
    O.with_all(
        "SELECT *, CAST(start_timestamp AS DATE) AS start_date FROM fact "
        "WHERE start_timestamp >= TIMESTAMP '1996-03-01 03:00:00' AND start_timestamp < TIMESTAMP '1996-04-02 04:00:00'",
        fact=True,
    ),
)
def q_partition_pruned_offset(spark, sf_dir):
    """Bounds with an offset: the days are those of the same instants in the session zone."""
    path = scratch_path(spark, "fact-offset")
    write_fact(_model(spark, sf_dir).fact, path)
    return read_fact(spark, path, "1996-03-01T01:00:00-02:00", "1996-04-01T23:00:00-05:00")


@register(
    "packed_days",
    O.with_all(
        "SELECT CAST(start_timestamp AS DATE) AS start_date, count(*) AS n_rows, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum, "
        "any_value(n_day) >= any_value(least_rows) AS own_partition FROM (SELECT *, ceil(n_all / n_days) AS least_rows FROM "
        "(SELECT start_timestamp, total_cost, count(*) OVER (PARTITION BY CAST(start_timestamp AS DATE)) AS n_day, (SELECT count(*) FROM fact WHERE start_timestamp IS NOT NULL) AS n_all, "
        "(SELECT count(DISTINCT CAST(start_timestamp AS DATE)) FROM fact) AS n_days FROM fact)) "
        "WHERE start_timestamp >= TIMESTAMP '1996-02-10' AND start_timestamp < TIMESTAMP '1996-11-20' GROUP BY 1",
        fact=True,
    ),
)
def q_packed_days(spark, sf_dir):
    """Days of at least the mean size in partitions of their own, smaller ones by month; a range that begins and ends within months."""
    fact = _model(spark, sf_dir).fact
    path = scratch_path(spark, "fact-packed")

    def mean_rows(sizes):
        known = [n for d, n in sizes.items() if d is not None]
        return -(-sum(known) // max(1, len(known)))

    write_fact(fact, path, pack_rows=mean_rows)
    own = spark.read.parquet(path).where(~F.col(PACKED)).select(F.col(PARTITION_COL).alias("own_day")).distinct()
    days = read_fact(spark, path, "1996-02-10", "1996-11-20").groupBy(PARTITION_COL).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost").cast("decimal(38,9)").alias("total_cost_sum")
    )
    return days.join(own, F.col(PARTITION_COL) == F.col("own_day"), "left").withColumn("own_partition", F.col("own_day").isNotNull()).drop("own_day")


# ------------------------------------------------------------ analyses (M)
def _m5_sql(source: str) -> str:
    """Every month of the calendar between the first and the last, zeros where no row is; rows without a month apart."""
    return (
        "SELECT month, n_prescriptions, total_cost_sum, "
        "lag(n_prescriptions) OVER w AS prev_n_prescriptions, n_prescriptions - lag(n_prescriptions) OVER w AS change FROM "
        "(SELECT c.month, count(f.start_timestamp) AS n_prescriptions, CAST(COALESCE(sum(f.total_cost), 0) AS DECIMAL(38,9)) AS total_cost_sum FROM "
        "(SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS TIMESTAMP) AS month FROM "
        f"(SELECT date_trunc('month', start_timestamp) AS m FROM {source})) c LEFT JOIN {source} f ON date_trunc('month', f.start_timestamp) = c.month GROUP BY c.month) "
        "WINDOW w AS (ORDER BY month) UNION ALL "
        "SELECT NULL, n, total, NULL, NULL FROM (SELECT count(*) AS n, CAST(COALESCE(sum(total_cost), 0) AS DECIMAL(38,9)) AS total "
        f"FROM {source} WHERE start_timestamp IS NULL) WHERE n > 0"
    )


_M_SQL = {
    "m1_cost_demographics": (
        "SELECT medication_code, gender, state, date_trunc('month', start_timestamp) AS month, "
        "count(*) AS n_prescriptions, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum, "
        "CAST(sum(base_cost) AS DECIMAL(38,9)) AS base_cost_sum, "
        "round(CAST(sum(base_cost) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS avg_base_cost "
        "FROM fact GROUP BY ALL"
    ),
    "m2_geo": (
        "SELECT organization_state, organization_city, organization_id, count(*) AS n_prescriptions, "
        "count(DISTINCT patient_id) AS n_patients, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum "
        "FROM fact GROUP BY ALL"
    ),
    "m3_provider": (
        "SELECT o.organization_state, n_organizations, revenue_sum, utilization_sum, n_prescriptions, "
        "payer_coverage_sum, total_cost_sum, "
        "round(CAST(payer_coverage_sum AS DOUBLE) / CAST(total_cost_sum AS DOUBLE), 6) AS coverage_ratio FROM "
        "(SELECT organization_state, count(*) AS n_organizations, CAST(sum(revenue) AS DECIMAL(38,9)) AS revenue_sum, "
        " CAST(sum(utilization) AS BIGINT) AS utilization_sum FROM "
        " (SELECT DISTINCT organization_state, organization_id, revenue, utilization FROM fact WHERE organization_id IS NOT NULL) "
        " GROUP BY organization_state) o "
        "JOIN (SELECT organization_state, count(*) AS n_prescriptions, "
        " CAST(sum(payer_coverage) AS DECIMAL(38,9)) AS payer_coverage_sum, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum "
        " FROM fact WHERE organization_id IS NOT NULL GROUP BY organization_state) c "
        "ON o.organization_state IS NOT DISTINCT FROM c.organization_state"
    ),
    "m4_patient_cost": _M4_SQL,
    "m5_monthly_trend": _m5_sql("fact"),
    "m6_code_city": (
        "SELECT city, medication_code, count(*) AS n_prescriptions, CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum, "
        "round(CAST(sum(total_cost) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS avg_total_cost, "
        "min(total_cost) AS min_total_cost, max(total_cost) AS max_total_cost FROM fact GROUP BY ALL"
    ),
}

for _name, _fn in analytics.ANALYSES.items():

    def _run(spark, sf_dir, fn=_fn):
        return fn(_model(spark, sf_dir).fact)

    register(_name, O.with_all(_M_SQL[_name], fact=True))(_run)


@register(
    "m1_rollup",
    O.with_all(
        "SELECT date_trunc('month', start_timestamp) AS month, state, gender, medication_code, "
        "CAST(grouping(date_trunc('month', start_timestamp), state, gender, medication_code) AS BIGINT) AS level, count(*) AS n_prescriptions, "
        "CAST(sum(total_cost) AS DECIMAL(38,9)) AS total_cost_sum, round(CAST(sum(base_cost) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS avg_base_cost "
        "FROM fact GROUP BY ROLLUP (date_trunc('month', start_timestamp), state, gender, medication_code)",
        fact=True,
    ),
)
def q_m1_rollup(spark, sf_dir):
    return analytics.m1_rollup(_model(spark, sf_dir).fact)


@register("m5_missing_months", O.with_all(_m5_sql("(SELECT * FROM fact WHERE month(start_timestamp) NOT IN (2, 3, 8))"), fact=True))
def q_m5_missing_months(spark, sf_dir):
    """The trend of prescriptions that pause in three months of every year (the pause is what is shown)."""
    fact = _model(spark, sf_dir).fact
    return analytics.m5_monthly_trend(fact.where(~F.month("start_timestamp").isin(2, 3, 8)))


@register(
    "m2_sketch_years",
    O.with_all(
        "SELECT organization_state, organization_city, CAST(year(start_timestamp) AS INTEGER) AS year, count(*) AS n_prescriptions, "
        "count(DISTINCT patient_id) AS n_patients, true AS estimate_within_error FROM fact GROUP BY ALL",
        fact=True,
    ),
)
def q_m2_sketch_years(spark, sf_dir):
    """Patients by place and year from stored monthly sketches, beside the exact count; both read the columns they need from one stored table."""
    stored, path = scratch_path(spark, "m2-rows"), scratch_path(spark, "m2-sketches")
    overwrite(_model(spark, sf_dir).fact.select("organization_state", "organization_city", "start_timestamp", "patient_id"), stored, **SMALL)
    fact = read_table(spark, stored)
    overwrite(analytics.m2_monthly_sketches(fact), path)
    keys = ["organization_state", "organization_city"]
    by_year = analytics.m2_merged(read_table(spark, path), *keys, F.year("month").alias("year"))
    exact = fact.groupBy(*keys, F.year("start_timestamp").alias("year")).agg(F.countDistinct("patient_id").alias("n_patients"))
    same = reduce(lambda x, y: x & y, [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (*keys, "year")])
    both = by_year.alias("s").join(exact.alias("e"), same)
    close = F.abs(F.col("n_patients_estimate") - F.col("n_patients")) <= 1 + analytics.SKETCH_ERROR * F.col("n_patients")
    return both.select("s.organization_state", "s.organization_city", "s.year", "n_prescriptions", "n_patients", close.alias("estimate_within_error"))


_CORRECTED = (
    "(SELECT * REPLACE (CASE WHEN late THEN 'P1' ELSE patient_id END AS patient_id, CASE WHEN late THEN total_cost + 1 ELSE total_cost END AS total_cost) FROM "
    f"(SELECT *, COALESCE(start_timestamp >= TIMESTAMP '{SMALL_START}' AND start_timestamp < TIMESTAMP '{SMALL_END}', false) AS late FROM fact))"
)


@register("m4_refreshed", O.with_all(_M4_SQL.replace("FROM fact", f"FROM {_CORRECTED}"), fact=True))
def q_m4_refreshed(spark, sf_dir):
    """Cost per patient before a merge, brought up to date by the rows of the partitions that the merge rewrote."""
    fact = _model(spark, sf_dir).fact
    path = scratch_path(spark, "fact-refresh")
    before = upsert(spark, path, fact)
    sums = {"total_cost_sum": "total_cost", "payer_coverage_sum": "payer_coverage"}
    first, stored = scratch_path(spark, "m4-before"), ["patient_id", "n_prescriptions", *sums]
    overwrite(analytics.m4_patient_cost(read_merged(spark, path)).select(*stored), first)
    late = read_fact(spark, path, SMALL_START, SMALL_END).drop(PARTITION_COL)
    after = upsert(spark, path, late.withColumns({"patient_id": F.lit("P1"), "total_cost": (F.col("total_cost") + 1).cast(late.schema["total_cost"].dataType)}))
    now = analytics.refreshed(read_table(spark, first), changed_rows(spark, path, before, after), ["patient_id"], sums, "n_prescriptions")
    return now.withColumn("coverage_ratio", F.round(F.col("payer_coverage_sum").cast("double") / F.col("total_cost_sum").cast("double"), 6))


@register(
    "join_hot_organization",
    O.with_all(
        "SELECT e.encounter_id, e.organization_id, o.organization_name, o.city, o.utilization FROM "
        "(SELECT encounter_id, CASE CAST(substr(encounter_id, 2) AS BIGINT) % 6 WHEN 0 THEN 'O1' WHEN 3 THEN 'O1' WHEN 1 THEN NULL ELSE organization_id END AS organization_id "
        "FROM stg_encounters) e LEFT JOIN stg_organizations o ON e.organization_id = o.organization_id",
        staged=True,
    ),
)
def q_join_hot_organization(spark, sf_dir):
    """E1 where a third of the encounters name one organization and a sixth none."""
    st = _model(spark, sf_dir).staged
    k = F.substr(F.col("encounter_id"), F.lit(2)).cast("bigint") % 6
    hot = F.when(k.isin(0, 3), F.lit("O1")).when(k == 1, F.lit(None)).otherwise(F.col("organization_id"))
    e = st["encounters"].select("encounter_id", hot.alias("organization_id"))
    o = st["organizations"].select(F.col("organization_id").alias("id"), "organization_name", "city", "utilization")
    return salted_left_join(e, o, "organization_id", "id").drop("id")


@register(
    "clustered_by_any_key",
    O.with_all(
        "SELECT *, CAST(start_timestamp AS DATE) AS start_date FROM fact WHERE city = 'NATION_11' "
        "UNION ALL SELECT *, CAST(start_timestamp AS DATE) AS start_date FROM fact WHERE patient_id = (SELECT min(patient_id) FROM fact)",
        fact=True,
    ),
)
def q_clustered_by_any_key(spark, sf_dir):
    """The fact in a space-filling order of its three cluster keys, asked by the third and by the second key alone."""
    path = scratch_path(spark, "fact-space-filling")
    write_fact(_model(spark, sf_dir).fact, path, space_filling=True)
    fact = read_fact(spark, path)
    least = read_fact(spark, path).agg(F.min("patient_id").alias("least"))
    return fact.where(F.col("city") == "NATION_11").unionByName(fact.join(F.broadcast(least), F.col("patient_id") == F.col("least")).drop("least"))


@register("inputs_by_name", O.with_all("SELECT * FROM organizations_clean", tables=["organizations"]))
def q_inputs_by_name(spark, sf_dir):
    """A folder with the input, and others whose names begin or end alike: exactly the named one is read."""
    root, raw = scratch_path(spark, "inputs"), raw_table(spark, sf_dir, "organizations")
    for name in ("organizations.csv", "organizations.csv.old", "old-organizations.csv"):
        write_csv(raw if name == "organizations.csv" else raw.withColumn("NAME", F.lit("another")), f"{root}/{name}")
    return apply_rules(read_raw(spark, locate_input(spark, root, "organizations"), SPECS["organizations"]), SPECS["organizations"], level=0).clean


@register("pipeline_run", O.with_all(" UNION ALL ".join(O.summary_select(t) for t in TABLES)))
def q_pipeline_run(spark, sf_dir):
    """The whole stored run by its arguments, with the declared tests as the gate before the fact; its cleaning summary."""
    return run_pipeline(spark, sf_dir, scratch_path(spark, "run"), source="testdata")["summary"]


@register(
    "docs_read_back",
    O.with_all(
        "SELECT column_name, description, (SELECT count(*) FROM fact) AS n_rows FROM (VALUES "
        + ", ".join("('{}', '{}')".format(c, d.replace("'", "''")) for c, d in fact_docs().items()) + ") v(column_name, description)",
        fact=True,
    ),
)
def q_docs_read_back(spark, sf_dir):
    """The descriptions of the fact's columns as its stored files hold them, and its rows."""
    path = scratch_path(spark, "docs")
    overwrite(with_docs(_model(spark, sf_dir).fact, fact_docs()), path)
    stored = read_table(spark, path)
    found = [(f.name, f.metadata["comment"]) for f in stored.schema.fields if "comment" in f.metadata]
    n = stored.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.crossJoin(F.broadcast(spark.createDataFrame(found, "column_name string, description string"))).select("column_name", "description", "n_rows")


@register("limit_smoke", O.with_all("SELECT * FROM fact", fact=True, test_run=True))
def q_limit_smoke(spark, sf_dir):
    """Smoke mode: every staging model and the fact keep their first 100
    rows in key order (the row cap is the feature under test)."""
    return _model(spark, sf_dir, test_run=True).fact
