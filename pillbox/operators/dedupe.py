"""Deterministic key dedupe as an aggregation.

``row_number() over (partition by key) = 1`` needs an order, and a window
sends every row of a key to one task: a key holding a third of the rows
becomes a third of the job in one task.  Instead we keep the smallest row
per key (all non-key columns compared in schema order, ascending, NULLs
first) with ``min(struct(...))``.  ``min`` is combined map-side, so a hot
key is reduced to one row per input partition before the shuffle.

The survivor is the same row the ordered window picks with
``ORDER BY c1 ASC NULLS FIRST, c2 ASC NULLS FIRST, ...``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACKED = "_pb_row"


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    packed = F.min(F.struct(*[F.col(c) for c in rest])).alias(_PACKED)
    return df.groupBy(*keys).agg(packed).select(*[F.col(k) for k in keys], *[F.col(f"{_PACKED}.{c}").alias(c) for c in rest]).select(*cols)
