"""Staging: key filter, key dedupe, safe-cast-and-rename projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.functions.casts import safe_cast, surrogate_key
from pillbox.operators.dedupe import dedupe
from pillbox.plans.spec import TableSpec

SMOKE_ROWS = 100  # fixed value: the smoke-run row cap


def staged_projection(spec: TableSpec) -> list:
    cols = []
    if spec.surrogate:
        name, parts = spec.surrogate
        cols.append(surrogate_key(*parts).alias(name))
    cols += [safe_cast(F.col(s.source), s.type).alias(s.name) for s in spec.staged]
    return cols


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The staged columns of every row, without key filter and dedupe (what the declared tests look at before cleaning)."""
    return df.select(*staged_projection(spec))


def stage(df: DataFrame, spec: TableSpec, test_run: bool = False, key_unique: bool = False) -> DataFrame:
    """Stage a cleaned raw table.

    ``key_unique=True`` skips the dedupe shuffle when the caller knows the
    input is already unique on ``spec.stage_key`` (our cleaner guarantees it
    for tables whose rules include a dedupe on the same key); the result is
    identical because dedupe of unique rows is the identity.
    ``test_run`` keeps the first 100 rows in key order (smoke mode).
    """
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.stage_key]))
    if not key_unique:
        keyed = dedupe(keyed, spec.stage_key)
    out = keyed.select(*staged_projection(spec))
    if test_run:
        out = out.orderBy(spec.staged_columns[0]).limit(SMOKE_ROWS)
    return out


def cleaned_key_unique(spec: TableSpec) -> bool:
    """True when cleaning already made the staging key unique."""
    return any(r.is_dedupe and tuple(r.unique_key) == tuple(spec.stage_key) for r in spec.rules)
