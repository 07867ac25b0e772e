"""Upsert, schema guard, pruned reads, docs, landing."""

import datetime as dt
import inspect
import os
import re

import pytest
from pyspark.sql import functions as F

from pillbox.operators import sinks
from pillbox.operators.sinks import (
    SchemaChangeError,
    check_schema,
    land,
    read_merged,
    schema_diff_frame,
    upsert,
    vacuum,
    versions,
    with_docs,
    write_fact,
)
from pillbox.sources.tables import read_fact

SCHEMA = "medication_id string, medication_code string, patient_id string, city string, start_timestamp timestamp, v int"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ts(d):
    return dt.datetime.fromisoformat(d)


def test_upsert_replace_insert_keep_and_move(spark, tmp_dir):
    first = _rows(spark, [
        ("k1", "c", "p", "x", ts("2020-01-01 10:00"), 1),
        ("k2", "c", "p", "x", ts("2020-01-01 11:00"), 1),
        ("k3", "c", "p", "x", ts("2020-01-02 09:00"), 1),
    ])
    upsert(spark, tmp_dir, first)
    second = _rows(spark, [
        ("k3", "c", "p", "x", ts("2020-01-03 09:00"), 2),  # moves from 01-02 (which empties) to 01-03
        ("k4", "c", "p", "x", ts("2020-01-01 12:00"), 2),  # new key
        ("k1", "c", "p", "x", ts("2020-01-01 10:00"), 2),  # replaced in place
    ])
    upsert(spark, tmp_dir, second)
    got = {r.medication_id: (r.v, str(r.start_date)) for r in read_merged(spark, tmp_dir).collect()}
    assert got == {
        "k1": (2, "2020-01-01"),
        "k2": (1, "2020-01-01"),
        "k3": (2, "2020-01-03"),
        "k4": (2, "2020-01-01"),
    }
    # idempotent
    upsert(spark, tmp_dir, second)
    assert read_merged(spark, tmp_dir).count() == 4
    assert versions(spark, tmp_dir) == [1, 2, 3]
    assert vacuum(spark, tmp_dir) == [1, 2] and read_merged(spark, tmp_dir).count() == 4


def test_upsert_refuses_duplicates_and_schema_change(spark, tmp_dir):
    one = _rows(spark, [("k1", "c", "p", "x", ts("2020-01-01 10:00"), 1)])
    dup = _rows(spark, [("k9", "c", "p", "x", ts("2020-01-01 10:00"), 1)] * 2)
    with pytest.raises(ValueError):  # on the first load
        upsert(spark, tmp_dir, dup)
    assert versions(spark, tmp_dir) == []
    upsert(spark, tmp_dir, one)
    with pytest.raises(ValueError):
        upsert(spark, tmp_dir, dup)
    # refused before the batch is computed: this one cannot be
    broken = one.withColumn("extra", F.raise_error(F.lit("computed")).cast("int"))
    with pytest.raises(SchemaChangeError):
        upsert(spark, tmp_dir, broken)
    assert versions(spark, tmp_dir) == [1]


def test_upsert_null_day(spark, tmp_dir):
    upsert(spark, tmp_dir, _rows(spark, [("k1", "c", "p", "x", None, 1)]))
    upsert(spark, tmp_dir, _rows(spark, [("k2", "c", "p", "x", ts("2020-01-01 10:00"), 2)]))
    upsert(spark, tmp_dir, _rows(spark, [("k1", "c", "p", "x", ts("2020-01-02 10:00"), 3), ("k3", "c", "p", "x", None, 3)]))
    got = {r.medication_id: (r.v, r.start_date and str(r.start_date)) for r in read_merged(spark, tmp_dir).collect()}
    assert got == {"k1": (3, "2020-01-02"), "k2": (2, "2020-01-01"), "k3": (3, None)}


def test_upsert_that_dies_before_its_manifest_changes_nothing(spark, tmp_dir, monkeypatch):
    first = _rows(spark, [("k1", "c", "p", "x", ts("2020-01-01 10:00"), 1), ("k2", "c", "p", "x", ts("2020-01-02 10:00"), 1)])
    second = _rows(spark, [("k1", "c", "p", "x", ts("2020-01-05 10:00"), 2)])
    upsert(spark, tmp_dir, first)
    manifest = sinks._manifest
    monkeypatch.setattr(sinks, "_manifest", lambda s, p, v: manifest(s, p, v).withColumn("commit", F.raise_error(F.lit("lost")).cast("int")) if not inspect.stack()[1].function.startswith("read") else manifest(s, p, v))
    with pytest.raises(Exception, match="lost"):
        upsert(spark, tmp_dir, second)
    monkeypatch.undo()
    assert versions(spark, tmp_dir) == [1]
    assert sorted((r.medication_id, r.v) for r in read_merged(spark, tmp_dir).collect()) == [("k1", 1), ("k2", 1)]
    upsert(spark, tmp_dir, second)  # the rest of the failed run is written over
    assert sorted((r.medication_id, r.v) for r in read_merged(spark, tmp_dir).collect()) == [("k1", 2), ("k2", 1)]
    assert [(r.medication_id, r.v) for r in read_merged(spark, tmp_dir, 1).orderBy("medication_id").collect()] == [("k1", 1), ("k2", 1)]


def test_upsert_leaves_no_scratch(spark, tmp_dir):
    from pillbox.session import checkpoint_root

    upsert(spark, tmp_dir, _rows(spark, [("k1", "c", "p", "x", ts("2020-01-01 10:00"), 1)]))
    left = os.listdir(checkpoint_root(spark).replace("file:", "") + "/pillbox")
    assert not [x for x in left if x.startswith("upsert-batch")]


def test_schema_diff_frame(spark):
    a = _rows(spark, []).schema
    b = _rows(spark, []).withColumn("v", F.col("v").cast("bigint")).drop("city").schema
    rows = {r.column_name: r.change for r in schema_diff_frame(spark, a, b).collect()}
    assert rows == {"city": "added", "v": "type_changed"}
    check_schema(a, a)


def _prunes(df):
    return re.search(r"PartitionFilters: \[[^\]]*start_date#\d+ >= ", df._jdf.queryExecution().executedPlan().toString())


def test_pruned_read_lists_only_days_in_range(spark, tmp_dir):
    df = _rows(spark, [(f"k{i}", "c", "p", "x", ts(f"2020-01-{i:02d} 10:00"), i) for i in range(1, 11)])
    write_fact(df, tmp_dir)
    r = read_fact(spark, tmp_dir, "2020-01-03", "2020-01-05")
    assert sorted(x.v for x in r.collect()) == [3, 4]
    assert _prunes(r)


def test_docs_and_land(spark, tmp_dir):
    df = with_docs(_rows(spark, [("k1", "c", "p", "x", ts("2020-01-01 10:00"), 1)]), {"v": "a value"})
    land(df, tmp_dir)
    land(df.withColumn("v", F.lit(5)), tmp_dir)  # exists: skipped
    back = spark.read.parquet(tmp_dir)
    assert back.collect()[0].v == 1
    assert back.schema["v"].metadata.get("comment") == "a value"
    land(df.withColumn("v", F.lit(5)), tmp_dir, force=True)
    assert spark.read.parquet(tmp_dir).collect()[0].v == 5


def test_read_fact_bounds_with_an_offset(spark, tmp_dir):
    write_fact(_rows(spark, [("k1", "c", "p", "x", ts("2020-01-02 02:00"), 1), ("k2", "c", "p", "x", ts("2020-01-02 05:00"), 2)]), tmp_dir)
    r = read_fact(spark, tmp_dir, "2020-01-01T00:00:00Z", "2020-01-01T23:00:00-05:00")
    assert [x.v for x in r.collect()] == [1]
    assert _prunes(r)
    assert [x.v for x in read_fact(spark, tmp_dir, "2020-01-01T22:00:00-05:00", dt.datetime(2020, 1, 3)).collect()] == [2]


def test_locate_input_is_exact_and_reads_all_parts(spark, tmp_dir):
    from pillbox.plans.specs import SPECS
    from pillbox.sources.csv import locate_input, read_raw
    from tests import fixtures_csv as FX

    base = tmp_dir.replace("file:", "")
    os.makedirs(os.path.join(base, "organizations.csv"))
    header, *rows = FX.ORGANIZATIONS.strip().splitlines()
    for name, part in (("organizations.csv/a.csv", rows[:3]), ("organizations.csv/b.csv", rows[3:]), ("medications-old.csv", rows), ("medications.csv", rows[:1]), ("org_1.txt", rows[:2]), ("org_2.txt", rows[2:])):
        with open(os.path.join(base, name), "w") as f:
            f.write("\n".join([header, *part]) + "\n")
    assert [x.rsplit("/", 1)[1] for x in locate_input(spark, base, "medications")] == ["medications.csv"]
    spec = SPECS["organizations"]
    assert read_raw(spark, locate_input(spark, base, "organizations"), spec).count() == len(rows)
    assert read_raw(spark, locate_input(spark, base, "organizations", "org_*.txt"), spec).count() == len(rows)
    for table, pattern in (("encounters", None), ("medic", None), ("patients", "{table}*.csv")):
        with pytest.raises(FileNotFoundError):
            locate_input(spark, base, table, pattern)
