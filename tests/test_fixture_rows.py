"""Edge rows per table: per-row outcome, audit counts, fact consequences."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pillbox.operators.rules import NULL_STEP, OUTCOME, STATUS, apply_rules
from pillbox.plans.etl import build_model
from pillbox.plans.specs import SPECS
from pillbox.sources.csv import read_raw
from tests import fixtures_csv as FX


@pytest.fixture(scope="module")
def raws(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    out = {}
    for t, text in FX.CSV.items():
        p = os.path.join(d, f"{t}.csv")
        with open(p, "w") as f:
            f.write(text)
        out[t] = read_raw(spark, p, SPECS[t])
    return out


def outcomes_by(cleaned, label_col):
    """label -> outcome ('keep', 'null' or rule) for every input row."""
    pre = cleaned.tagged.filter(F.col(STATUS).isNotNull()).select(
        label_col, F.when(F.col(STATUS) == NULL_STEP, "null").otherwise(F.col(STATUS)).alias("o")
    )
    post = cleaned.outcomes.select(label_col, F.col(OUTCOME).alias("o"))
    return {r[0]: r[1] for r in pre.union(post).collect()}


@pytest.mark.parametrize(
    "table,label,expected,summary",
    [
        ("encounters", "Id", FX.ENCOUNTERS_EXPECTED, FX.ENCOUNTERS_SUMMARY),
        ("medications", "DESCRIPTION", FX.MEDICATIONS_EXPECTED, FX.MEDICATIONS_SUMMARY),
        ("organizations", "Id", FX.ORGANIZATIONS_EXPECTED, FX.ORGANIZATIONS_SUMMARY),
        ("patients", "Id", FX.PATIENTS_EXPECTED, FX.PATIENTS_SUMMARY),
    ],
)
def test_outcomes_and_summary(raws, table, label, expected, summary):
    c = apply_rules(raws[table], SPECS[table], level=2)
    got = outcomes_by(c, label)
    for k, v in expected.items():
        assert got[k] == v, (table, k, got[k], v)
    s = c.summary.collect()[0]
    assert (s.original, s.null_removed, s.malformed_removed, s.final) == summary
    audit = {r.rule: r.removed for r in c.audit.collect()}
    assert s.original == s.null_removed + sum(audit.values()) + s.final


def test_encounter_values(raws):
    rows = {r.Id: r for r in apply_rules(raws["encounters"], SPECS["encounters"]).clean.collect()}
    assert rows["e1"].START == dt.datetime(2020, 1, 1, 10, 0)
    assert rows["e2"].REASONCODE is None and rows["e2"].REASONDESCRIPTION == "r"


def test_organization_values(raws):
    rows = {r.Id: r for r in apply_rules(raws["organizations"], SPECS["organizations"]).clean.collect()}
    assert rows["o1"].PHONE == "555-1000" and rows["o1"].ZIP == "02101"
    assert rows["o2"].STATE is None and rows["o2"].LAT is None
    assert rows["o7"].ADDRESS == ""


def test_patient_duplicates(raws):
    c = apply_rules(raws["patients"], SPECS["patients"], level=2)
    clean = c.clean.collect()
    assert sorted(r.Id for r in clean) == ["p1", "p2"]
    audit = {r.rule: r.removed for r in c.audit.collect()}
    assert audit["duplicate_ids"] == 1
    # an exact duplicate equals its survivor: EXCEPT DISTINCT shows nothing
    assert c.rejects.filter(F.col("rule") == "duplicate_ids").count() == 0


def test_fact_from_fixtures(raws):
    m = build_model(raws, level=0)
    staged = m.staged["medications"].collect()
    assert len(staged) == 3
    fact = {r.medication_code: r for r in m.fact.collect()}
    assert len(fact) == 3
    orphan = fact["m8"]
    assert orphan.patient_id is None and orphan.encounter_id is None and orphan.organization_id is None
    plain = fact["m1"]
    assert plain.patient_id == "p1" and plain.encounter_id == "e1" and plain.organization_name == "Clinic"
    assert plain.organization_state == "MA" and plain.phone == "555-1000"
