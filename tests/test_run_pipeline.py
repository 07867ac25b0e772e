"""The materialised run: CSV in, outcome tables, audit, tests and fact out."""

import os

from pyspark.sql import functions as F

from pillbox.operators.sinks import read_merged
from pillbox.plans.etl import run_pipeline
from pillbox.sources.tables import read_clean, read_rejects
from tests import fixtures_csv as FX


def test_run_pipeline_on_csv(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    in_dir = os.path.join(base, "in")
    os.makedirs(in_dir)
    for t, text in FX.CSV.items():
        with open(os.path.join(in_dir, f"{t}.csv"), "w") as f:
            f.write(text)
    out = os.path.join(base, "out")
    res = run_pipeline(spark, in_dir, out, source="csv")
    summary = {r.table_name: (r.original, r.null_removed, r.malformed_removed, r.final) for r in res["summary"].collect()}
    assert summary == {
        "encounters": FX.ENCOUNTERS_SUMMARY,
        "medications": FX.MEDICATIONS_SUMMARY,
        "organizations": FX.ORGANIZATIONS_SUMMARY,
        "patients": FX.PATIENTS_SUMMARY,
    }
    assert res["tests"].count() == 63 and res["tests"].filter("failures > 0").count() == 0
    assert read_clean(spark, f"{out}/raw/encounters").count() == 2
    rejects = {r.Id: (r.rule, r.DESCRIPTION) for r in read_rejects(spark, f"{out}/raw/encounters").collect()}
    assert {i: "null" if rule == "required_not_null" else rule for i, (rule, _) in rejects.items()} == {i: r for i, r in FX.ENCOUNTERS_EXPECTED.items() if r != "keep"}
    assert rejects["e8"] == ("required_not_null", "No patient")  # in full, not only its key
    fact = read_merged(spark, f"{out}/fact")
    assert fact.count() == 3
    assert all(f.metadata.get("comment") for f in fact.schema if f.name != "start_date")
    assert "prescription" in fact.schema["medication_id"].metadata["table_comment"]
    assert fact.filter(F.col("medication_code") == "m8").collect()[0].patient_id is None
    # re-running merges the same keys: still 3 rows
    run_pipeline(spark, in_dir, out, source="csv")
    assert read_merged(spark, f"{out}/fact").count() == 3
