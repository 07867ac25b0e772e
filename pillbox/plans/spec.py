"""Declarative description of one entity table.

A ``TableSpec`` is plain data: the positional input schema, the required
columns, the ordered validity rules, the staged projection and the
declared column tests.  Nothing here triggers a Spark action; predicates
are zero-argument callables so Columns are only built inside a session.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """A named row-level validity rule.

    ``keep`` returns a boolean Column; a row is removed when it is FALSE
    *or NULL* (filter semantics).  A rule with ``unique_key`` instead keeps
    one row per key (deterministic survivor: smallest row over all columns).
    """

    name: str
    keep: Callable[[], Column] | None = None
    unique_key: tuple[str, ...] | None = None

    @property
    def is_dedupe(self) -> bool:
        return self.unique_key is not None


@dataclass(frozen=True)
class Staged:
    """One staged output column: source column, output name, safe-cast type."""

    source: str
    name: str
    type: str


@dataclass(frozen=True)
class ColumnTest:
    """A declared data test on a staged column.

    kind: ``not_null`` | ``unique`` | ``accepted_values`` | ``accepted_range``
    """

    column: str
    kind: str
    values: tuple = ()
    min_value: float | int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    required: tuple[str, ...]
    rules: tuple[Rule, ...]
    stage_key: tuple[str, ...]
    staged: tuple[Staged, ...]
    staged_model: str
    tests: tuple[ColumnTest, ...] = ()
    surrogate: tuple[str, tuple[str, ...]] | None = None
    read_options: dict = field(default_factory=dict)
    # extra column rewrites applied after string normalisation (e.g. phone)
    rewrite: Callable[[], dict[str, Column]] | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def staged_columns(self) -> list[str]:
        head = [self.surrogate[0]] if self.surrogate else []
        return head + [s.name for s in self.staged]

    def split_rules(self) -> tuple[list[Rule], Rule | None, list[Rule]]:
        """Rules before the dedupe rule, the dedupe rule, rules after it."""
        dedupes = [i for i, r in enumerate(self.rules) if r.is_dedupe]
        if len(dedupes) > 1:
            raise ValueError(f"{self.name}: at most one dedupe rule is supported")
        if not dedupes:
            return list(self.rules), None, []
        i = dedupes[0]
        return list(self.rules[:i]), self.rules[i], list(self.rules[i + 1 :])
