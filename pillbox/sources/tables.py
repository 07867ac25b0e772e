"""Reading written tables: cleaned outcome tables and the partitioned fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.operators.rules import KEEP, OUTCOME, WRITTEN_COUNT
from pillbox.operators.sinks import PARTITION_COL, read_merged


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table: the ``outcome=keep`` partition of an outcome table."""
    return spark.read.parquet(path).filter(F.col(OUTCOME) == KEEP).drop(OUTCOME, WRITTEN_COUNT)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows of an outcome table: rule, rows_represented and the input columns."""
    df = spark.read.parquet(path).filter(F.col(OUTCOME) != KEEP)
    return df.select(F.col(OUTCOME).alias("rule"), WRITTEN_COUNT, *[c for c in df.columns if c not in (OUTCOME, WRITTEN_COUNT)])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_fact(
    spark: SparkSession,
    path: str,
    start: str | dt.date | dt.datetime | None = None,
    end: str | dt.date | dt.datetime | None = None,
) -> DataFrame:
    """Fact rows with ``start <= start_timestamp < end``.

    A predicate on ``start_timestamp`` alone does not prune the derived
    partitions, so the matching one on the partitions is added: the scan
    lists only the days and months in range (PartitionFilters), the day and
    timestamp predicates keep the exact bounds.  The day is that of the same
    timestamp in the session zone, so a bound with an offset prunes as it filters.
    """
    bounds = [None if b is None else F.lit(str(b)).cast("timestamp") for b in (start, end)]
    first, last = (None if b is None else F.to_date(b) for b in bounds)
    df = read_merged(spark, path, first=first, last=last)
    if first is not None:
        df = df.filter((F.col(PARTITION_COL) >= first) & (F.col("start_timestamp") >= bounds[0]))
    if last is not None:
        df = df.filter((F.col(PARTITION_COL) <= last) & (F.col("start_timestamp") < bounds[1]))
    return df
