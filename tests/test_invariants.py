"""Whole-table invariants on the sf0.001 test tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.functions.casts import decode, payment_type_description
from pillbox.operators.dedupe import dedupe
from pillbox.operators.quality import run_tests
from pillbox.operators.stage import stage
from pillbox.plans.etl import TABLES
from pillbox.plans.etl import testdata_model as model_of
from pillbox.plans.specs import SPECS
from tests.conftest import SF_SMALL


def test_audit_balances_and_fact_shape(spark):
    m = model_of(spark, SF_SMALL)
    for t in TABLES:
        s = m.cleaned[t].summary.collect()[0]
        removed = m.cleaned[t].audit.agg(F.sum("removed")).collect()[0][0]
        assert s.original == s.null_removed + removed + s.final
        assert s.final == m.cleaned[t].clean.count()
    fact = m.fact
    assert fact.count() == m.staged["medications"].count()
    assert fact.select("medication_id").distinct().count() == fact.count()
    assert len(fact.columns) == 52


def test_clean_tables_pass_every_declared_test(spark):
    m = model_of(spark, SF_SMALL)
    res = reduce(DataFrame.unionByName, [run_tests(m.staged[t], SPECS[t]) for t in TABLES])
    assert res.count() == 63
    assert res.filter("failures > 0").count() == 0


def test_planted_violation_is_reported(spark):
    m = model_of(spark, SF_SMALL)
    pats = m.cleaned["patients"].clean
    bad = pats.limit(1).withColumn("Id", F.lit("planted")).withColumn("GENDER", F.lit("Q")).withColumn("INCOME", F.lit(-1).cast("decimal(38,2)"))
    staged = stage(pats.unionByName(bad), SPECS["patients"])
    res = {(r.column_name, r.test): r.failures for r in run_tests(staged, SPECS["patients"]).collect()}
    assert res[("gender", "accepted_values:M,F")] == 1
    assert res[("income", "accepted_range:min=0")] == 1
    assert res[("patient_id", "unique")] == 0
    assert res[("patient_id", "not_null")] == 0


def test_dedupe_picks_smallest_row(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, None), ("a", 1, "y"), ("b", None, "z"), ("b", 3, "z")], "k string, n int, s string"
    )
    got = sorted(tuple(r) for r in dedupe(df, ["k"]).collect())
    assert got == [("a", 1, None), ("b", None, "z")]  # ascending, NULLs first


def test_decode(spark):
    df = spark.createDataFrame([("1",), ("6",), ("7",), ("x",), (None,)], "c string")
    got = [r[0] for r in df.select(payment_type_description(F.col("c"))).collect()]
    assert got == ["Credit card", "Voided trip", "EMPTY", "EMPTY", "EMPTY"]
    assert df.select(decode(F.col("c"), {1: "one"})).collect()[0][0] == "one"
