"""End-to-end flow: clean -> stage -> test -> star join -> upsert.

``build_model`` wires the lazy DataFrames (what the queries use);
``run_pipeline`` materialises them.  In the written run every input is
scanned once: the outcome table (see ``rules.outcome_table``) is stored
partitioned by ``outcome``, the cleaned table is its partition-pruned
``keep`` part, and the audit is a small aggregation over the written
table.  Written tables also cut the lineage: a lost
executor later recomputes from Parquet, not from the CSV.
"""

from __future__ import annotations

import weakref
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.operators.fact import FACT_DOC, build_fact, enc_org, fact_docs
from pillbox.operators.quality import run_tests
from pillbox.operators.rules import OUTCOME, Cleaned, apply_rules, audit_from_outcome_table, outcome_table
from pillbox.operators.sinks import SMALL, overwrite, upsert, with_docs
from pillbox.operators.stage import cleaned_key_unique, stage
from pillbox.plans.specs import SPECS
from pillbox.session import own_session
from pillbox.sources.csv import locate_input, read_raw
from pillbox.sources.tables import read_clean

TABLES = ("encounters", "medications", "organizations", "patients")


@dataclass
class Model:
    raw: dict[str, DataFrame]
    cleaned: dict[str, Cleaned]
    staged: dict[str, DataFrame]
    enc_org: DataFrame
    fact: DataFrame
    extra: dict = field(default_factory=dict)


def build_model(raws: dict[str, DataFrame], test_run: bool = False, level: int = 2) -> Model:
    cleaned = {t: apply_rules(raws[t], SPECS[t], level=level) for t in TABLES}
    staged = {
        t: stage(cleaned[t].clean, SPECS[t], test_run=test_run, key_unique=cleaned_key_unique(SPECS[t]))
        for t in TABLES
    }
    eo = enc_org(staged["encounters"], staged["organizations"])
    fact = build_fact(staged["medications"], staged["patients"], eo, test_run=test_run)
    return Model(raws, cleaned, staged, eo, fact)


_MODELS: weakref.WeakKeyDictionary[SparkSession, dict] = weakref.WeakKeyDictionary()


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder: a rewritten input has another state."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((st.getPath().toString(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(path)))


def testdata_model(spark: SparkSession, sf_dir: str, test_run: bool = False, level: int = 2) -> Model:
    """The lazy model over one test folder, built once per session and state of the folder.

    Only the *plan* is kept (no data is cached), as long as its session lives:
    building it costs thousands of driver-to-JVM calls, and every query over the
    same folder shares it.
    """
    from pillbox.sources.testdata import raw_tables

    plans = _MODELS.setdefault(spark, {})
    key, state = (sf_dir, test_run, level), _state(spark, sf_dir)
    if key not in plans or plans[key][0] != state:
        plans[key] = state, build_model(raw_tables(spark, sf_dir, part_first=True), test_run=test_run, level=level)
    return plans[key][1]


def clean_to(spark: SparkSession, raw: DataFrame, table: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write one cleaned outcome table; return its (audit, summary)."""
    spec = SPECS[table]
    cleaned = apply_rules(raw, spec, level=0)
    overwrite(outcome_table(cleaned), path, partition_by=[OUTCOME], **SMALL)
    return audit_from_outcome_table(spec, spark.read.parquet(path))


def clean_tables(spark: SparkSession, raws: dict[str, DataFrame], out: str, parallel: int = 4) -> tuple[DataFrame, DataFrame]:
    """Write the outcome table of every raw table under ``out``; return (audit, summary) read from them.

    The cleaning jobs are independent and are submitted concurrently (Spark schedules their tasks side by side).
    """
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        frames = dict(zip(TABLES, pool.map(lambda t: clean_to(spark, raws[t], t, f"{out}/{t}"), TABLES)))
    return tuple(reduce(DataFrame.unionByName, [frames[t][i] for t in TABLES]) for i in (0, 1))


def stage_stored(spark: SparkSession, out: str, test_run: bool = False) -> dict[str, DataFrame]:
    """The staging models over the stored cleaned tables."""
    return {
        t: stage(read_clean(spark, f"{out}/{t}"), SPECS[t], test_run=test_run, key_unique=cleaned_key_unique(SPECS[t]))
        for t in TABLES
    }


def create_views(spark: SparkSession, model: Model) -> list[str]:
    """Name the models of a run for SQL: temp views stg_<table>_data, enc_org and fact."""
    frames = {SPECS[t].staged_model: df for t, df in model.staged.items()} | {"enc_org": model.enc_org, "fact": model.fact}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def run_pipeline(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    source: str = "csv",
    test_run: bool = False,
    strict_tests: bool = True,
    parallel: int = 4,
) -> dict[str, DataFrame]:
    """Run everything and return the audit, summary and test-result tables.

    ``source='csv'`` reads exactly ``<in_dir>/<table>.csv`` (a file or a folder of parts); ``source='testdata'``
    derives the raw tables from the star-schema test tables in ``in_dir``.
    Rejected rows stay, in full and with the rule that removed them, beside the
    cleaned ones (``read_rejects``).
    """
    spark = own_session(spark)
    out = out_dir.rstrip("/")
    if source == "csv":
        raws = {t: read_raw(spark, locate_input(spark, in_dir, t), SPECS[t]) for t in TABLES}
    else:
        from pillbox.sources.testdata import raw_tables

        raws = raw_tables(spark, in_dir)

    audit, summary = clean_tables(spark, raws, f"{out}/raw", parallel)
    overwrite(audit.coalesce(1), f"{out}/audit/rules")
    overwrite(summary.coalesce(1), f"{out}/audit/summary")

    staged = stage_stored(spark, f"{out}/raw", test_run)
    tests = reduce(DataFrame.unionByName, [run_tests(staged[t], SPECS[t]) for t in TABLES])
    overwrite(tests.coalesce(1), f"{out}/audit/tests")
    tests = spark.read.parquet(f"{out}/audit/tests")
    if strict_tests:
        failed = tests.filter(F.col("failures") > 0).collect()  # at most one row per declared test
        if failed:
            raise AssertionError(f"data tests failed: {[r.asDict() for r in failed]}")

    eo = enc_org(staged["encounters"], staged["organizations"])
    fact = build_fact(staged["medications"], staged["patients"], eo, test_run=test_run)
    upsert(spark, f"{out}/fact", with_docs(fact, fact_docs(), FACT_DOC))
    return {
        "audit": spark.read.parquet(f"{out}/audit/rules"),
        "summary": spark.read.parquet(f"{out}/audit/summary"),
        "tests": tests,
    }
