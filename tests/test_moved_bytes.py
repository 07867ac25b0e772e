"""What is made once, pushed below joins, moved once or not read at all."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from pillbox.operators import sinks
from pillbox.operators.rules import KEEP, OUTCOME, WRITTEN_COUNT, apply_rules
from pillbox.operators.sinks import read_merged, upsert, write_fact
from pillbox.plans.catalogue import QUERIES, _counted_by_texts
from pillbox.plans.spec import Rule, TableSpec
from pillbox.session import own_session
from pillbox.sources.tables import read_fact
from tests.conftest import SF_SMALL

SCHEMA = "medication_id string, medication_code string, patient_id string, city string, start_timestamp timestamp, v int"


def _rows(spark, rows):
    """(key, day of 2020 or None, v)"""
    at = lambda d: None if d is None else dt.datetime(2020, 1, 1, 10) + dt.timedelta(days=d)
    return spark.createDataFrame([(k, "c", "p", "x", at(d), v) for k, d, v in rows], SCHEMA)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fact_is_made_once_for_sizes_cuts_and_ranges(spark, tmp_dir):
    """A row is made by a function that counts its calls: sizes, cut points and ranging must not call it again."""
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            made.add(1)
            yield r

    rows = _rows(spark, [(f"k{i}", i % 40, i) for i in range(400)])
    fact = spark.createDataFrame(rows.rdd.mapPartitions(count), rows.schema)
    write_fact(fact, tmp_dir, pack_rows=lambda sizes: max(sizes.values()), space_filling=True)
    assert made.value == 400
    assert read_fact(spark, tmp_dir).count() == 400


def test_merge_reads_only_partitions_that_keep_rows_and_joins_only_those_that_lose_some(spark, tmp_dir, monkeypatch):
    upsert(spark, tmp_dir, _rows(spark, [("a", 0, 1), ("b", 0, 1), ("c", 40, 1), ("d", 80, 1), ("e", 80, 1), ("n", None, 1)]))
    asked = []
    rows_of = sinks._rows_of
    monkeypatch.setattr(sinks, "_rows_of", lambda s, p, schema, parts: asked.append({d and d.month for _, d, _ in parts}) or rows_of(s, p, schema, parts))
    # January is emptied, March loses one of two, February only gains
    upsert(spark, tmp_dir, _rows(spark, [("a", 41, 2), ("b", 42, 2), ("d", 82, 2)]))
    assert asked == [{2}, {3}]
    monkeypatch.undo()
    day = lambda d: d and (d - dt.date(2020, 1, 1)).days
    got = {r.medication_id: (day(r.start_date), r.v) for r in read_merged(spark, tmp_dir).collect()}
    assert got == {"a": (41, 2), "b": (42, 2), "c": (40, 1), "d": (82, 2), "e": (80, 1), "n": (None, 1)}


def test_duplicates_are_told_by_keys_not_by_hashes(spark, monkeypatch):
    distinct = _rows(spark, [("a", 0, 1), ("b", 0, 1), (None, 0, 1)])
    assert not sinks._has_duplicates(distinct, "medication_id")
    assert sinks._has_duplicates(distinct.union(distinct.where("medication_id = 'b'")), "medication_id")
    assert sinks._has_duplicates(distinct.union(distinct.where("medication_id IS NULL")), "medication_id")
    monkeypatch.setattr(sinks.F, "xxhash64", lambda *_: F.lit(7))  # all hashes meet
    assert not sinks._has_duplicates(distinct, "medication_id")


def test_rules_on_one_side_hold_below_the_join(spark):
    """Rejected rows of one side of a join do not enter it, where only clean rows are asked for."""
    spec = TableSpec(
        name="t", schema=StructType([StructField("k", StringType()), StructField("a", IntegerType()), StructField("b", IntegerType())]),
        required=("k",), rules=(Rule("a_pos", lambda: F.col("a") > 0), Rule("ab", lambda: F.col("a") <= F.col("b"))),
        stage_key=("k",), staged=(), staged_model="t",
    )
    left = spark.createDataFrame([("x", 1), ("y", -1), (None, 5), ("z", 9)], "k string, a int")
    right = spark.createDataFrame([("x", 2), ("y", 3), ("z", 1)], "k2 string, b int")
    clean = apply_rules(left.join(right, left.k == right.k2, "left").select("k", "a", "b"), spec, level=0).clean
    assert sorted(tuple(r) for r in clean.collect()) == [("x", 1, 2)]
    plan = _plan(clean)
    assert "a#" in plan[plan.index("Join"):] and "> 0)" in plan[plan.index("Join"):]


def test_outcomes_of_a_key_after_one_shuffle_of_the_rows(spark):
    spec = TableSpec(
        name="t", schema=StructType([StructField("Id", StringType()), StructField("a", StringType()), StructField("v", IntegerType())]),
        required=("Id",), rules=(Rule("early", lambda: F.col("a") != F.lit("bad")), Rule("once", unique_key=("Id",)), Rule("late", lambda: F.col("v") > 0)),
        stage_key=("Id",), staged=(), staged_model="t",
    )
    rows = [("k", "b", 1), ("k", "a", 2), ("k", "a", 2), ("k", "bad", 0), ("m", "a", -1), ("m", "b", 1), (None, "a", 1), (None, "a", 1), ("n", None, 1)]
    resolved = apply_rules(spark.createDataFrame(rows, spec.schema), spec, level=0).resolved
    got = {(r.Id, r.a, r.v): (r[OUTCOME], r[WRITTEN_COUNT]) for r in resolved.collect()}
    assert got == {
        ("k", "a", 2): (KEEP, 2), ("k", "b", 1): ("once", 1), ("k", "bad", 0): ("early", 1), ("m", "a", -1): ("late", 1), ("m", "b", 1): ("once", 1),
        (None, "a", 1): ("required_not_null", 2), ("n", None, 1): ("early", 1),
    }
    plan = resolved._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def _shuffled_on_demand(plan):
    """The column names of every repartition of a plan."""
    children = plan.children()
    out = [i for k in range(children.size()) for i in _shuffled_on_demand(children.apply(k))]
    if plan.nodeName() == "RepartitionByExpression":
        out.append([plan.output().apply(k).name() for k in range(plan.output().size())])
    return out


def test_rejected_rows_are_shuffled_by_digest(spark):
    counted = QUERIES["pipeline_rejects"](own_session(spark), SF_SMALL)
    assert _shuffled_on_demand(counted._jdf.queryExecution().optimizedPlan()) == [["md5", "rest", "rule"]]


def test_distinct_rows_of_equal_texts_are_told_apart(spark):
    """Against distinct rows compared whole, among them texts that join to the same and values of several types."""
    kinds = {"a": StringType(), "b": StringType(), "c": StringType(), "i": IntegerType(), "x": DecimalType(38, 18), "d": DoubleType(), "t": TimestampType()}
    fields = [StructField(n, k) for n, k in kinds.items()]
    at = dt.datetime(2020, 1, 1, 10)
    texts = [("p", "q", "r"), ("p|q", "r", None), ("p", "q|r", None), ("p", "q|r", "~"), ("p|q", "r", "~"), ("~", None, "~"), (None, "~", "~"), (None, None, None), ("", "", ""), ("é|", "", ""), ("", "|é", "")]
    values = [(1, 1, 0.0, at), (1, 1, -0.0, at), (1, 1, 1.5, at), (2, 1, 0.0, at), (None, 1, 0.0, at), (1, None, 0.0, at), (1, 1, 0.0, None), (None, None, None, None), (1, 1, 0.0, at + dt.timedelta(microseconds=1))]
    rows = [(rule, *t, *v) for rule in ("one", "two") for t in texts for v in values] * 2
    kept = spark.createDataFrame(rows, "rule string, a string, b string, c string, i int, x int, d double, t timestamp").withColumn("x", F.col("x").cast("decimal(38,18)"))
    joined = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in "abc"])).alias("md5")
    for distinct, whole in ((True, kept.distinct()), (False, kept)):
        want = {(r.rule, r.md5): r.n for r in whole.groupBy("rule", joined).agg(F.count(F.lit(1)).alias("n")).collect()}
        counted = _counted_by_texts(kept, fields, distinct)
        assert _shuffled_on_demand(counted._jdf.queryExecution().optimizedPlan()) == [["md5", "rest", "rule"]] * distinct
        got = {(r.rule, r.md5.hex()): r.n_rows for r in counted.collect()}
        assert got == want and len(want) < 2 * len(texts)
