"""Every rule, required column and declared test meets rows that fail it (sf0.01)."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.operators.quality import run_tests
from pillbox.operators.rules import apply_rules, audit_from_outcome_table, outcome_table, prepare
from pillbox.operators.stage import project
from pillbox.plans.etl import TABLES
from pillbox.plans.specs import SPECS
from pillbox.session import own_session
from pillbox.sources.testdata import raw_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def own(spark):
    return own_session(spark)


@pytest.mark.parametrize("table", TABLES)
def test_every_rule_removes_rows(own, table):
    c = apply_rules(raw_table(own, SF, table), SPECS[table], level=1)
    assert {r.rule: r.removed for r in c.audit.collect() if r.removed == 0} == {}
    assert c.summary.first().null_removed > 0


@pytest.mark.parametrize("table", TABLES)
def test_every_required_column_is_missing_somewhere(own, table):
    df = prepare(raw_table(own, SF, table), SPECS[table])
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in SPECS[table].required]).first().asDict()
    assert [c for c, n in counts.items() if n == 0] == []


def test_every_declared_test_fails_somewhere(own):
    frames = [run_tests(project(prepare(raw_table(own, SF, t), SPECS[t]), SPECS[t]), SPECS[t]) for t in TABLES]
    rows = reduce(DataFrame.unionByName, frames).collect()
    assert len(rows) == 63
    # the surrogate key replaces null parts by a token, so it is never null
    assert [(r.column_name, r.test) for r in rows if r.failures == 0] == [("medication_id", "not_null")]


@pytest.mark.parametrize("table", TABLES)
def test_stored_outcomes_give_the_same_audit(own, table):
    spec = SPECS[table]
    c = apply_rules(raw_table(own, SF, table), spec, level=1)
    audit, summary = audit_from_outcome_table(spec, outcome_table(c))
    assert audit.collect() == c.audit.collect() and summary.collect() == c.summary.collect()
