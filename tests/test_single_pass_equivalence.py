"""The single-pass audit equals filtering rule by rule and counting."""

import pytest
from pyspark.sql import functions as F

from pillbox.operators.dedupe import dedupe
from pillbox.operators.rules import apply_rules, prepare
from pillbox.plans.specs import SPECS
from pillbox.sources.testdata import raw_table
from tests.conftest import SF_SMALL


def sequential_counts(df, spec):
    df = prepare(df, spec)
    original = df.count()
    for c in spec.required:
        df = df.filter(F.col(c).isNotNull())
    removed = {}
    for r in spec.rules:
        kept = dedupe(df, r.unique_key) if r.is_dedupe else df.filter(r.keep())
        removed[r.name] = df.count() - kept.count()
        df = kept
    return original, removed, df


@pytest.mark.parametrize("table", sorted(SPECS))
def test_single_pass_equals_sequential(spark, table):
    spec = SPECS[table]
    raw = raw_table(spark, SF_SMALL, table)
    original, removed, final_df = sequential_counts(raw, spec)
    c = apply_rules(raw, spec, level=1)
    assert {r.rule: r.removed for r in c.audit.collect()} == removed
    s = c.summary.collect()[0]
    assert s.original == original and s.final == final_df.count()
    assert c.clean.exceptAll(final_df).count() == 0 and final_df.exceptAll(c.clean).count() == 0
