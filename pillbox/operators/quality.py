"""Declared column tests over a staged table.

Row-level tests of a model are counted in one global aggregate, ``unique``
tests by value (map-side combined, so a hot value does not pile up in one
task).  The result has one row per declared test: model, column_name, test,
failures.
``failures`` follows the usual convention: failing rows for row tests,
duplicated values for ``unique``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pillbox.plans.spec import ColumnTest, TableSpec


def failing(t: ColumnTest) -> Column:
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":  # NULL passes
        return c.isNotNull() & ~c.isin(list(t.values))
    if t.kind == "accepted_range":  # inclusive minimum, NULL passes
        return c.isNotNull() & (c < F.lit(t.min_value))
    raise ValueError(t.kind)


def test_name(t: ColumnTest) -> str:
    if t.kind == "accepted_values":
        return "accepted_values:" + ",".join(str(v) for v in t.values)
    if t.kind == "accepted_range":
        return f"accepted_range:min={t.min_value}"
    return t.kind


def run_tests(df: DataFrame, spec: TableSpec, model: str | None = None, kinds: set[str] | None = None) -> DataFrame:
    """The declared tests of one model, or those of the given kinds.

    Row-level tests are one global aggregate: a row a task is shuffled,
    whatever the columns.  Each ``unique`` test counts its column's values,
    combined before the shuffle, and then those that occur more than once.
    """
    model = model or spec.staged_model
    wanted = [t for t in spec.tests if kinds is None or t.kind in kinds]
    row_tests = [t for t in wanted if t.kind != "unique"]
    parts = []
    if row_tests:
        wide = df.agg(*[F.count_if(failing(t)).alias(f"t{i}") for i, t in enumerate(row_tests)])
        rows = [
            F.struct(F.lit(t.column).alias("column_name"), F.lit(test_name(t)).alias("test"), F.col(f"t{i}").cast("bigint").alias("failures"))
            for i, t in enumerate(row_tests)
        ]
        parts.append(wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for t in wanted:
        if t.kind == "unique":
            values = df.filter(F.col(t.column).isNotNull()).groupBy(t.column).count()
            failures = values.agg(F.count_if(F.col("count") > 1).cast("bigint").alias("failures"))
            parts.append(failures.select(F.lit(t.column).alias("column_name"), F.lit(test_name(t)).alias("test"), "failures"))
    if not parts:
        raise ValueError(f"{model} declares no test of the kinds {sorted(kinds or ())}")
    return reduce(DataFrame.unionByName, parts).select(F.lit(model).alias("model"), "column_name", "test", "failures")


def failing_rows(df: DataFrame, t: ColumnTest) -> DataFrame:
    """The rows behind one row-level test (for inspection)."""
    if t.kind == "unique":
        dups = df.filter(F.col(t.column).isNotNull()).groupBy(t.column).count().filter("count > 1")
        return df.join(dups.select(t.column), t.column, "left_semi")
    return df.filter(failing(t))
