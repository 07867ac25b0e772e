"""Left equi-join whose hot keys are measured and salted.

A key that holds a third of the left rows is one task's work in a plain shuffle join; AQE splits such a partition only
where it has measured that very shuffle.  Here the hot keys are counted first (map-side combined, so a hot key is a row
a task), the left rows of these keys are spread over ``salts`` tasks, and the few right rows they meet are copied as often.
Left rows without a key match nothing and are spread as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_pb_salt"


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """The keys that hold at least ``share`` of the rows: at most 1 / share of them, whatever the size of the table."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return [r.key for r in counts.join(F.broadcast(total), F.col("n") >= F.col("total") * share).select("key").collect()]


def salted_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = 0.01, salts: int = 32) -> DataFrame:
    """All columns of both; every left row once for each right row of its key, or once with nulls.

    The salt of a row is a hash of the row itself, so a task that runs again deals the same rows to the same partitions.
    """
    hot = hot_keys(left, left_key, share)
    spread = F.col(left_key).isNull() | F.col(left_key).isin(hot) if hot else F.col(left_key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col(right_key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))) if hot else None
    copies = F.array(F.lit(0)) if copies is None else copies.otherwise(F.array(F.lit(0)))
    a = left.withColumn(SALT, salt.cast("int")).alias("a")
    b = right.withColumn(SALT, F.explode(copies)).alias("b")
    same = (F.col(f"a.{left_key}") == F.col(f"b.{right_key}")) & (F.col(f"a.{SALT}") == F.col(f"b.{SALT}"))
    return a.join(b, same, "left").select(*[F.col(f"a.`{c}`") for c in left.columns], *[F.col(f"b.`{c}`") for c in right.columns])
