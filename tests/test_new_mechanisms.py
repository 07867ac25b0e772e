"""Space-filling clustering, salted join, refresh by change, sketches, calendar, damaged lines, rules evaluated once."""

import datetime as dt
import io
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pillbox.operators import analytics
from pillbox.operators.hotjoin import hot_keys, salted_left_join
from pillbox.operators.rules import ONCE, apply_rules
from pillbox.operators.sinks import changed_rows, cut_points, interleaved, read_merged, upsert, write_fact
from pillbox.plans.specs import SPECS
from pillbox.sources.csv import read_damaged, read_raw

FACT = "medication_id string, medication_code string, patient_id string, city string, start_timestamp timestamp, total_cost decimal(12,2)"


def _fact(spark, n, seed=3):
    rnd = random.Random(seed)
    rows = [
        (f"m{i}", f"c{rnd.randrange(200):03d}", f"p{rnd.randrange(3000):04d}", f"t{rnd.randrange(150):03d}", dt.datetime(2020, 1, 1 + rnd.randrange(3), 8), None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FACT).withColumn("total_cost", F.lit(1).cast("decimal(12,2)"))


def _groups_that_may_hold(spark, path, column, value):
    """Row groups whose statistics do not exclude the value, of all row groups."""
    hit = total = 0
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).collect():
        meta = pq.ParquetFile(io.BytesIO(bytes(r.content))).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return hit, total


def test_space_filling_order_skips_by_every_key(spark, tmp_dir):
    fact = _fact(spark, 30_000)
    # small row groups: Parquet looks at their size every 100 rows at first
    small = {"parquet.block.size": 1 << 14, "parquet.page.size": 1 << 12}
    for name, curved in (("line", False), ("curve", True)):
        write_fact(fact, f"{tmp_dir}/{name}", pack_rows=1, space_filling=curved, **{k: str(v) for k, v in small.items()})
    assert read_merged(spark, f"{tmp_dir}/line").exceptAll(read_merged(spark, f"{tmp_dir}/curve")).count() == 0
    share = {}
    for column, value in (("patient_id", "p1500"), ("city", "t075")):
        for name in ("line", "curve"):
            hit, total = _groups_that_may_hold(spark, f"{tmp_dir}/{name}", column, value)
            assert total > 50
            share[column, name] = hit / total
        assert share[column, "curve"] < 0.6 * share[column, "line"], share


def test_interleaved_cells(spark):
    df = spark.createDataFrame([(a, b) for a in "abcd" for b in "wxyz"] + [(None, "z")], "a string, b string")
    cuts = {"a": ["a", "b", "c"], "b": ["w", "x", "y"]}
    got = {(r.a, r.b): r.z for r in df.withColumn("z", interleaved(cuts, bits=2)).collect()}
    for i, a in enumerate("abcd"):
        for j, b in enumerate("wxyz"):
            assert got[a, b] == sum(((i >> k & 1) << (2 * k + 1)) + ((j >> k & 1) << (2 * k)) for k in range(2))
    assert got[None, "z"] == got["a", "z"]
    found = cut_points(df, ["a", "b"], bits=1)
    assert {c: len(v) for c, v in found.items()} == {"a": 1, "b": 1}
    assert cut_points(df.where("false"), ["a"]) == {"a": []}


def test_salted_join_spreads_hot_and_missing_keys(spark):
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), *[(f"k{i}", i) for i in range(0, 400)], (None, 5)], "name string, v int")
    assert hot_keys(left, "k", 0.2) == ["hot"]
    plain = left.join(right, F.col("k") == F.col("name"), "left")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = salted_left_join(left, right, "k", "name", share=0.05, salts=16)
        assert joined.columns == ["id", "k", "name", "v"]
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
        largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert largest(plain) >= 6000  # all hot rows, twice each, in one task
        assert largest(joined) <= 2500
        # only missing keys, and no row at all
        assert salted_left_join(left.where("k is null"), right, "k", "name").where("name is null").count() == 3000
        assert salted_left_join(left.where("false"), right, "k", "name").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _counts(df):
    return {r.patient_id: (r.n, r.total) for r in df.collect()}


def test_refresh_equals_recompute_and_reads_changed_partitions_only(spark, tmp_dir):
    rows = [(f"k{i}", "c", f"p{i % 7}", "x", dt.datetime(2020, 1 + i % 12, 3, 10), None) for i in range(120)]
    fact = spark.createDataFrame(rows, FACT).withColumn("total_cost", F.col("medication_id").substr(2, 9).cast("decimal(12,2)"))
    agg = lambda df: df.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("total"))
    upsert(spark, tmp_dir, fact)
    before = spark.createDataFrame(agg(read_merged(spark, tmp_dir)).collect(), agg(fact).schema)
    # p3 loses all its rows to p9, and a row goes to another month
    late = fact.where("patient_id = 'p3' or medication_id = 'k24'").withColumn("patient_id", F.when(F.col("patient_id") == "p3", "p9").otherwise(F.col("patient_id")))
    late = late.withColumn("start_timestamp", F.when(F.col("medication_id") == "k24", F.lit(dt.datetime(2020, 5, 9))).otherwise(F.col("start_timestamp")))
    upsert(spark, tmp_dir, late)
    changes = changed_rows(spark, tmp_dir, 1, 2)
    after = analytics.refreshed(before, changes, ["patient_id"], {"total": "total_cost"}, "n")
    assert _counts(after) == _counts(agg(read_merged(spark, tmp_dir))) and "p3" not in _counts(after)
    # a merge of one month leaves eleven alone
    upsert(spark, tmp_dir, fact.where("medication_id = 'k24'").withColumn("start_timestamp", F.lit(dt.datetime(2020, 5, 9))))
    months = {r.m for r in changed_rows(spark, tmp_dir, 2, 3).select(F.month("start_timestamp").alias("m")).distinct().collect()}
    assert months == {5}
    assert changed_rows(spark, tmp_dir, 2, 2).count() == 0


def test_calendar_of_months(spark):
    rows = [(dt.datetime(2020, m, 5), i) for m, n in ((1, 3), (4, 2), (5, 1)) for i in range(n)] + [(None, 9)] * 2
    fact = spark.createDataFrame(rows, "start_timestamp timestamp, total_cost int").withColumn("total_cost", F.col("total_cost").cast("decimal(12,2)"))
    got = [(r.month and r.month.month, r.n_prescriptions, r.prev_n_prescriptions, r.change) for r in analytics.m5_monthly_trend(fact).orderBy("month").collect()]
    assert got == [(None, 2, None, None), (1, 3, None, None), (2, 0, 3, -3), (3, 0, 0, 0), (4, 2, 0, 2), (5, 1, 2, -1)]
    assert analytics.m5_monthly_trend(fact.where("false")).collect() == []


def test_rollup_levels(spark):
    rows = [("c1", "F", "AA", dt.datetime(2020, 1, 1), 1), ("c1", None, "AA", dt.datetime(2020, 1, 2), 2), ("c2", "F", "BB", dt.datetime(2020, 2, 1), 4)]
    fact = spark.createDataFrame(rows, "medication_code string, gender string, state string, start_timestamp timestamp, cost int")
    fact = fact.withColumns({"total_cost": F.col("cost").cast("decimal(12,2)"), "base_cost": F.col("cost").cast("decimal(12,2)")})
    out = analytics.m1_rollup(fact).collect()
    assert {level: sum(int(r.total_cost_sum) for r in out if r.level == level) for level in (0, 1, 3, 7, 15)} == dict.fromkeys((0, 1, 3, 7, 15), 7)
    # a missing gender is not the total over genders
    assert sorted((r.level, int(r.total_cost_sum)) for r in out if r.state == "AA" and r.gender is None) == [(0, 2), (1, 2), (3, 3)]


def test_sketches_merge(spark):
    fact = spark.range(40_000).select(
        F.lit("S").alias("organization_state"), F.lit("C").alias("organization_city"),
        F.make_date(F.lit(2020), (F.col("id") % 12 + 1).cast("int"), F.lit(1)).cast("timestamp").alias("start_timestamp"),
        (F.col("id") % 9001).cast("string").alias("patient_id"),
    )
    merged = analytics.m2_merged(analytics.m2_monthly_sketches(fact), "organization_state").first()
    assert merged.n_prescriptions == 40_000 and abs(merged.n_patients_estimate - 9001) <= analytics.SKETCH_ERROR * 9001


def test_damaged_lines(spark, tmp_dir):
    spec = SPECS["medications"]
    good = "2020-01-01T00:00:00Z,,P1,Y1,E1,C1,Drug,10.5,1,2,30.25,r,why"
    lines = {
        good: None,
        good.replace("30.25", "dear").replace(",2,", ",two,"): ("bad values", "DISPENSES,TOTALCOST"),
        "2020-01-01T00:00:00Z,,P1,Y1,E1": ("too few cells", ""),
        good + ",x": ("too many cells", ""),
        good.replace("Drug", '"Dr, ""ug"""'): None,
        good.replace("Drug", '"Dr, ug"').replace("10.5", "ten"): ("bad values", "BASE_COST"),
    }
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(tmp_dir)
    got = {r.line: (r.reason, r["columns"]) for r in read_damaged(spark, tmp_dir, spec, header="false").collect()}
    assert got == {k: v for k, v in lines.items() if v}
    assert read_raw(spark, tmp_dir, spec, header="false").count() == len(lines)


@pytest.mark.parametrize("table", ["medications", "encounters"])
def test_rules_read_columns_made_once(spark, tmp_dir, table):
    """The filter of the rules stays above the projection that makes the columns; below it no cell is trimmed a second time."""
    spec = SPECS[table]
    spark.createDataFrame([(",",)], "v string").write.text(tmp_dir)
    raw = read_raw(spark, tmp_dir, spec)
    plan = apply_rules(raw, spec).clean._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    filters = [x for x in lines if re.search(r"\bFilter\b", x)]
    assert filters and all("trim(" not in x for x in filters)
    assert any(ONCE in x and "trim(" in x for x in lines if "Project" in x)
