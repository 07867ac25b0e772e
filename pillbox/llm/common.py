"""Helpers that the operators share: scratch tables, components, record batches."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def ascii_lower(col):
    """Lower-case A-Z only.  ``lower`` is the same on ASCII text, and much faster."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation),
    fixes values that depend on the partitioning, and gives Catalyst the real
    size, by which it alone decides whether a join side may be broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, component = smallest node of it).

    ``edges`` has columns a, b of one integer type; loops and repeats are
    fine, an empty table gives an empty result, nodes with a null end are
    ignored.  Alternating large-star and small-star steps: every step is one
    map-side combined minimum per node and one equi-join (whose skewed
    partitions Spark splits), so a hub never becomes one task's list.  Links
    stay distributed; the driver sees one count a round, and the end is compared link by link.
    """
    e = edges.select("a", "b").where("a <> b")
    e = materialise(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
            .select("x.*").where("a <> b").distinct()
        )
        e = materialise(small, "edges")
        # stable when every node hangs on one smaller node and no such node hangs on another: the links are those of the
        # round before (both are sets: as many of them, and none that is new)
        n = e.count()
        if before and n == before[0] and e.join(before[1], ["a", "b"], "left_anti").isEmpty():
            break
        before = n, e
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def others(df: DataFrame, *own: str) -> list[str]:
    """The columns of the input that stay beside columns of our own names; names differ by more than case."""
    taken = {o.lower() for o in own}
    return [c for c in df.columns if c.lower() not in taken]


def unused(df: DataFrame, prefix: str) -> str:
    """A name like ``prefix`` that no column of the input begins with."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def numbered_columns(df: DataFrame, names: list[str]) -> list:
    """These columns as c0, c1, ...: a Python function over batches takes no name that holds a dot or a backtick."""
    return [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)]


def numbered_types(df: DataFrame, names: list[str]) -> list[str]:
    return [f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(names)]


def let(value, body):
    """``body`` of the value, evaluated once a row.

    A lambda's variable is bound, so whatever Catalyst moves (a filter on the result is pushed below the projection
    that made its inputs), the value is not worked out again for each element of the lambdas inside.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slices(batches, rows: int = 512):
    """Arrow batches in slices of at most ``rows`` rows, so that what a task holds beside the batch stays small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def slices_of_bytes(batches, column: str, limit: int = 1 << 20):
    """Arrow batches in slices whose texts have about ``limit`` bytes together; a longer text is a slice of its own."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(sizes.searchsorted((sizes[i - 1] if i else 0) + limit, "right")))
            yield b.slice(i, j - i)
            i = j


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
