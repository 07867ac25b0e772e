"""Merged tables: packed days, the key index, two writers."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pillbox.operators import sinks
from pillbox.operators.sinks import ConcurrentMergeError, keys_of, read_merged, upsert, vacuum, versions, write_fact
from pillbox.sources.tables import read_fact

SCHEMA = "medication_id string, medication_code string, patient_id string, city string, start_timestamp timestamp, v int"


def _rows(spark, rows):
    """(key, day of 2020 or None, v)"""
    at = lambda d: None if d is None else dt.datetime(2020, 1, 1, 10) + dt.timedelta(days=d)
    return spark.createDataFrame([(k, "c", "p", "x", at(d), v) for k, d, v in rows], SCHEMA)


def _seen(df):
    return {r.medication_id: (None if r.start_date is None else (r.start_date - dt.date(2020, 1, 1)).days, r.v) for r in df.collect()}


def _parts(spark, path):
    live = sinks._days(sinks._manifest(spark, path, versions(spark, path)[-1]))
    return {(r._day - dt.date(2020, 1, 1)).days: (r.packed, (r.start_date - dt.date(2020, 1, 1)).days, r.n_rows) for r in live.collect() if r._day}


def test_two_writers_from_one_version(spark, tmp_dir, monkeypatch):
    upsert(spark, tmp_dir, _rows(spark, [("a", 0, 1), ("b", 40, 1)]))
    seen = versions(spark, tmp_dir)
    upsert(spark, tmp_dir, _rows(spark, [("a", 0, 2)]))
    monkeypatch.setattr(sinks, "versions", lambda *_: seen)  # the second writer listed the versions before the first was done
    with pytest.raises(ConcurrentMergeError):
        upsert(spark, tmp_dir, _rows(spark, [("b", 40, 3)]))
    monkeypatch.undo()
    assert versions(spark, tmp_dir) == [1, 2] and _seen(read_merged(spark, tmp_dir)) == {"a": (0, 2), "b": (40, 1)}
    upsert(spark, tmp_dir, _rows(spark, [("b", 40, 3)]))
    assert _seen(read_merged(spark, tmp_dir)) == {"a": (0, 2), "b": (40, 3)}
    monkeypatch.setattr(sinks, "versions", lambda *_: [])  # both believe they make the first version
    with pytest.raises(ConcurrentMergeError):
        upsert(spark, tmp_dir, _rows(spark, [("z", 1, 1)]))
    monkeypatch.undo()
    assert _seen(read_merged(spark, tmp_dir)) == {"a": (0, 2), "b": (40, 3)}
    assert vacuum(spark, tmp_dir) == [1, 1, 2] and len(_seen(read_merged(spark, tmp_dir))) == 2


def test_random_merges_equal_a_dict(spark, tmp_dir):
    rnd = random.Random(6)
    truth: dict[str, tuple] = {}
    for merge in range(5):
        batch = {f"k{rnd.randrange(60)}": (rnd.choice([None, *range(0, 90, 4), 3, 3, 3, 3]), merge) for _ in range(40 if merge < 2 else 6)}
        upsert(spark, tmp_dir, _rows(spark, [(k, *x) for k, x in batch.items()]), pack_rows=5)
        truth |= batch
        assert _seen(read_merged(spark, tmp_dir)) == truth
        sizes = {}
        for d, _ in truth.values():
            if d is not None:
                sizes[d] = sizes.get(d, 0) + 1
        parts = _parts(spark, tmp_dir)
        assert {d: n for d, (_, _, n) in parts.items()} == sizes  # counts kept by arithmetic are the true ones
        assert all(part == d for d, (packed, part, _) in parts.items() if not packed)
        index = keys_of(spark, tmp_dir, versions(spark, tmp_dir)[-1], range(sinks.MIN_BUCKETS)).collect()
        assert len(index) == len(truth) and {r.medication_id: r._day and (r._day - dt.date(2020, 1, 1)).days for r in index} == {k: d for k, (d, _) in truth.items()}
    assert {p for p, _, _ in _parts(spark, tmp_dir).values()} == {True, False}
    vacuum(spark, tmp_dir)
    assert _seen(read_merged(spark, tmp_dir)) == truth


def test_a_day_leaves_and_enters_the_shared_partition(spark, tmp_dir):
    upsert(spark, tmp_dir, _rows(spark, [(f"a{i}", 4, 0) for i in range(4)] + [("b", 5, 0), ("c", 50, 0)]), pack_rows=3)
    assert _parts(spark, tmp_dir) == {4: (False, 4, 4), 5: (True, 0, 1), 50: (True, 31, 1)}
    upsert(spark, tmp_dir, _rows(spark, [("a0", 50, 1), ("a1", 50, 1)]), pack_rows=3)
    assert _parts(spark, tmp_dir) == {4: (True, 0, 2), 5: (True, 0, 1), 50: (False, 50, 3)}
    assert _seen(read_merged(spark, tmp_dir)) == {"a0": (50, 1), "a1": (50, 1), "a2": (4, 0), "a3": (4, 0), "b": (5, 0), "c": (50, 0)}


def test_a_small_batch_reads_its_buckets_only(spark, tmp_dir, monkeypatch):
    upsert(spark, tmp_dir, _rows(spark, [(f"k{i}", i % 90, 0) for i in range(300)]))
    plan = keys_of(spark, tmp_dir, 1, [3, 7])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(3,7\)", plan)
    assert {r.bucket for r in keys_of(spark, tmp_dir, 1, [3, 7]).collect()} == {3, 7}
    # a merge asks for the buckets of its keys
    buckets = {r.medication_id: r.bucket for r in keys_of(spark, tmp_dir, 1, range(sinks.MIN_BUCKETS)).collect()}
    mine, asked = [k for k, b in buckets.items() if b in (3, 7)], []
    monkeypatch.setattr(sinks, "keys_of", lambda s, p, v, some: asked.append(sorted(some)) or keys_of(s, p, v, some))
    upsert(spark, tmp_dir, _rows(spark, [(k, 5, 1) for k in mine]))
    assert asked == [[3, 7]]
    assert {k for k, x in _seen(read_merged(spark, tmp_dir)).items() if x == (5, 1)} == set(mine)


def test_months_in_range_only(spark, tmp_dir):
    write_fact(_rows(spark, [(f"k{i}", i, i) for i in range(90)] + [(f"x{i}", 45, i) for i in range(9)] + [("n", None, 0)]), tmp_dir, pack_rows=5)
    read = read_fact(spark, tmp_dir, "2020-02-10", "2020-02-20")
    assert sorted(set(r.start_date.day for r in read.collect())) == list(range(10, 20))
    folders = {re.search(r"packed=(\w+)/start_date=([^/]*)", r.f).groups() for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    assert folders == {("true", "2020-02-01"), ("false", "2020-02-15")}
    assert read_fact(spark, tmp_dir, None, "2020-01-02").count() == 1 and read_merged(spark, tmp_dir).count() == 100


def test_first_load_without_rows(spark, tmp_dir):
    upsert(spark, tmp_dir, _rows(spark, []))
    upsert(spark, tmp_dir, _rows(spark, [("a", 1, 1)]))
    upsert(spark, tmp_dir, _rows(spark, []))
    assert _seen(read_merged(spark, tmp_dir)) == {"a": (1, 1)} and versions(spark, tmp_dir) == [1, 2, 3]


def test_another_key_is_refused(spark, tmp_dir):
    upsert(spark, tmp_dir, _rows(spark, [("a", 1, 1)]))
    with pytest.raises(ValueError, match="merged on"):
        upsert(spark, tmp_dir, _rows(spark, [("a", 1, 1)]), key="patient_id")
