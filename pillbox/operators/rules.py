"""Cleaning without a chain of filters: required fields, ordered rules, audit, rejects.

The source pipeline filters once per rule and counts before and after
each filter (about 30 full re-reads per table).  Here every row gets the
name of the *first* rule it fails, computed in one projection:

* rules before the dedupe rule and the required-field check tag the input;
* the dedupe rule keeps one row per key among rows that passed so far, by a
  map-side combined aggregation (a hot key is reduced before the shuffle;
  the survivor is the smallest row, as in ``dedupe``);
* rules after it tag the survivors.

Survivors tagged ``keep`` are the clean table.  Counts are exact, because a
row is counted under the first rule it fails, which is what the sequential
filters remove.  Rule order still matters for dedupe: a duplicate whose
survivor fails a later rule is lost even if its twin would pass, as in the
source.

A result reads its input once: ``clean`` by one aggregation on the key,
``audit`` and ``summary`` by one on (key, status), ``rejects`` by one on
the whole row, in which the rows of a key lie together.  They are
separate plans; a run that wants all of them stores ``resolved`` and derives
them from it (``outcome_table``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pillbox.functions.strings import normalise_strings
from pillbox.operators.dedupe import dedupe
from pillbox.plans.spec import Rule, TableSpec

STATUS = "_pb_status"
ONCE = "_pb_once"
PLACE, PLACES = "_pb_place", 1 << 30  # where rows that must meet do
OUTCOME = "outcome"
KEEP = "keep"
NULL_STEP = "required_not_null"
WRITTEN_COUNT = "rows_represented"


@dataclass
class Cleaned:
    clean: DataFrame
    outcomes: DataFrame  # deduped rows that passed required fields, tagged OUTCOME
    tagged: DataFrame  # every input row with STATUS (required / pre-dedupe rules)
    per_row: DataFrame | None = None  # grouped rows: columns, STATUS, _n (rows represented), OUTCOME
    audit: DataFrame | None = None  # table_name, rule_order, rule, removed
    summary: DataFrame | None = None  # table_name, original, null_removed, malformed_removed, final
    resolved: DataFrame | None = None  # distinct rows: columns, OUTCOME (keep or the rule that removed it), WRITTEN_COUNT
    rejects: DataFrame | None = None  # rule, <input columns>; distinct rows per rule


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """String normalisation plus table-specific rewrites, one Project each."""
    out = normalise_strings(df)
    if spec.rewrite is not None:
        out = out.withColumns(spec.rewrite())
    return out


def required_ok(spec: TableSpec) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.required])


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first rule whose predicate is FALSE or NULL, else NULL."""
    out = None
    for r in rules:
        fails = ~F.coalesce(r.keep(), F.lit(False))
        out = F.when(fails, F.lit(r.name)) if out is None else out.when(fails, F.lit(r.name))
    return out if out is not None else F.lit(None).cast("string")


def _status(spec: TableSpec, pre: list[Rule]) -> Column:
    out = F.when(~required_ok(spec), F.lit(NULL_STEP))
    for r in pre:
        out = out.when(~F.coalesce(r.keep(), F.lit(False)), F.lit(r.name))
    return out


def _on_numbers(df: DataFrame, spec: TableSpec, pre: list[Rule]) -> list[Column]:
    """The required fields and rules that name no text column, which would have to be trimmed once more to be looked at."""
    numbers = df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, StringType)])
    out = [F.col(c).isNotNull() for c in spec.required if c in numbers.columns]
    for rule in pre:
        try:
            numbers.select(rule.keep())
        except AnalysisException:
            continue
        out.append(rule.keep())
    return out


def apply_rules(df: DataFrame, spec: TableSpec, level: int = 2, prepared: bool = False) -> Cleaned:
    """Clean ``df`` (raw columns of ``spec``).

    level 0: clean only; 1: + audit and summary; 2: + rejected rows.
    All outputs are lazy DataFrames sharing one logical plan prefix.
    """
    base = df if prepared else prepare(df, spec)
    cols = base.columns
    pre, dd, post = spec.split_rules()
    status = F.col(STATUS)

    # The partition number is not a function of the row, so Catalyst does not push a filter on it below the projection
    # that makes it.  All columns are thus worked out once a row, and the rules read them; pushed further down, each rule
    # would repeat the making of every column it names.
    def tag(rows: DataFrame) -> DataFrame:
        return rows.withColumn(ONCE, F.spark_partition_id()).withColumn(STATUS, _status(spec, pre))

    tagged = tag(base)
    passed = status.isNull() & (F.col(ONCE) >= 0)
    # Where only clean rows go on, what the rules say of numbers and times is a filter of its own as well, which Catalyst
    # takes apart and pushes below the joins that made the input: rejected rows are then not shuffled there.
    eligible = tag(reduce(DataFrame.filter, _on_numbers(base, spec, pre), base)).filter(passed).drop(STATUS, ONCE)
    if dd is None:
        # every row once: outcome of the post rules for rows that passed so far
        per_row = tagged.withColumn("_n", F.lit(1)).withColumn(
            OUTCOME, F.when(status.isNull(), F.coalesce(first_failure(post), F.lit(KEEP)))
        )
        survivors = eligible
    else:
        # one aggregation serves the dedupe and the audit: group by key and
        # pre-status, count the rows, and keep the smallest eligible row
        # (map-side combined, so hot keys are reduced before the shuffle)
        key = list(dd.unique_key)
        rest = [c for c in cols if c not in key]
        grouped = tagged.groupBy(*key, STATUS).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(F.when(status.isNull(), F.struct(*[F.col(c) for c in rest]))).alias("_row"),
        )
        unpacked = grouped.select(*key, STATUS, "_n", *[F.col(f"_row.{c}").alias(c) for c in rest])
        per_row = unpacked.withColumn(
            OUTCOME, F.when(status.isNull(), F.coalesce(first_failure(post), F.lit(KEEP)))
        )
        # The clean rows come from the key-only dedupe (the same smallest
        # row): grouped by the key alone, Catalyst can prove the key unique
        # and drop joins whose dimension columns a query never uses.  Each
        # query runs one of the two aggregations, never both.
        survivors = dedupe(eligible, key)
    outcomes = survivors.withColumn(OUTCOME, F.coalesce(first_failure(post), F.lit(KEEP)))
    clean = outcomes.filter(F.col(OUTCOME) == KEEP).drop(OUTCOME)
    result = Cleaned(clean=clean, outcomes=outcomes, tagged=tagged, per_row=per_row)
    if level >= 1:
        result.audit, result.summary = _audit_summary(spec, _one_pass_counts(spec, per_row))
    result.resolved = _resolve(tagged, cols, dd, post)
    if level >= 2:
        rejected = result.resolved.filter(F.col(OUTCOME) != KEEP).select(F.col(OUTCOME).alias("rule"), *cols)
        result.rejects = rejected if dd is not None else rejected.distinct()
    return result


def _resolve(tagged: DataFrame, cols: list[str], dd: Rule | None, post: list[Rule]) -> DataFrame:
    """Every input row with its outcome; equal rows of a table with a dedupe rule are one row with their number.

    Of equal rows one may survive, and the copies show nothing that it does
    not, so rows are grouped whole; what is not the smallest row of its key fell to the dedupe rule.  Rows move once: the
    place of a row that may survive is a hash of its key, that of any other a hash of the whole row (nulls in the key do not
    meet in one task), and both groupings keep to these places.  A window's rows of one key spill if they are many.
    """
    status = F.col(STATUS)
    passed = F.coalesce(first_failure(post), F.lit(KEEP))
    if dd is None:
        return tagged.select(*cols, F.coalesce(status, passed).alias(OUTCOME), F.lit(1).cast("bigint").alias(WRITTEN_COUNT))
    key = list(dd.unique_key)
    rest = [c for c in cols if c not in key]
    place = F.when(status.isNull(), F.xxhash64(*key)).otherwise(F.xxhash64(*cols))
    placed = tagged.withColumn(PLACE, F.pmod(place, F.lit(PLACES)).cast("int")).repartition(PLACE)
    whole = placed.groupBy(PLACE, *cols, STATUS).agg(F.count(F.lit(1)).alias(WRITTEN_COUNT))
    # rows with a status sort behind the others of their key and place, and never come first
    order = [status.asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in rest]]
    first = F.row_number().over(Window.partitionBy(PLACE, *key).orderBy(*order)) == 1
    outcome = F.coalesce(status, F.when(first, passed).otherwise(F.lit(dd.name)))
    return whole.select(*cols, outcome.alias(OUTCOME), WRITTEN_COUNT)


def _one_pass_counts(spec: TableSpec, per_row: DataFrame) -> DataFrame:
    """All audit metrics in one aggregation over the tagged / deduped rows.

    ``per_row`` has STATUS (pre-dedupe), ``_n`` (input rows represented) and
    OUTCOME (post-dedupe, NULL when STATUS is set).
    """
    pre, _, post = spec.split_rules()
    status, outcome, n = F.col(STATUS), F.col(OUTCOME), F.col("_n")
    order = {r.name: i + 1 for i, r in enumerate(spec.rules)}

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    return per_row.agg(
        total(F.lit(True)).alias("original"),
        total(status == NULL_STEP).alias("null_removed"),
        total(status.isNull()).alias("eligible"),
        F.count_if(status.isNull()).alias("survivors"),
        F.count_if(outcome == KEEP).alias("final"),
        *[total(status == r.name).alias(_metric(order[r.name])) for r in pre],
        *[F.count_if(outcome == r.name).alias(_metric(order[r.name])) for r in post],
    )


def _metric(i: int) -> str:
    return f"r{i}"


def outcome_table(cleaned: Cleaned) -> DataFrame:
    """What the materialised run writes: every distinct row in full, with 'keep' or the rule that removed it, and how
    many input rows it stands for.  Partitioned by outcome, the cleaned table is the ``outcome=keep`` partition, the
    others are the rejected rows, and every audit number is a sum over this table, so the input is scanned once."""
    return cleaned.resolved


def audit_from_outcome_table(spec: TableSpec, written: DataFrame) -> tuple[DataFrame, DataFrame]:
    pre, dd, post = spec.split_rules()
    outcome, n = F.col(OUTCOME), F.col(WRITTEN_COUNT)
    order = {r.name: i + 1 for i, r in enumerate(spec.rules)}
    early = [NULL_STEP] + [r.name for r in pre]
    duplicate = [dd.name] if dd else []

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    wide = written.agg(
        total(F.lit(True)).alias("original"),
        total(outcome == NULL_STEP).alias("null_removed"),
        total(~outcome.isin(early)).alias("eligible"),
        F.count_if(~outcome.isin(early + duplicate)).alias("survivors"),
        F.count_if(outcome == KEEP).alias("final"),
        *[total(outcome == r.name).alias(_metric(order[r.name])) for r in pre],
        *[F.count_if(outcome == r.name).alias(_metric(order[r.name])) for r in post],
    )
    return _audit_summary(spec, wide)


def _audit_summary(spec: TableSpec, wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-rule rows and the summary row from the one-row metric table."""
    order = {r.name: i + 1 for i, r in enumerate(spec.rules)}

    def removed(r: Rule) -> Column:
        if r.is_dedupe:
            return F.col("eligible") - F.col("survivors")
        return F.col(_metric(order[r.name]))

    rows = [
        F.struct(
            F.lit(spec.name).alias("table_name"),
            F.lit(order[r.name]).alias("rule_order"),
            F.lit(r.name).alias("rule"),
            removed(r).cast("bigint").alias("removed"),
        )
        for r in spec.rules
    ]
    audit = wide.select(F.explode(F.array(*rows)).alias("a")).select("a.*")
    summary = wide.select(
        F.lit(spec.name).alias("table_name"),
        F.col("original").cast("bigint").alias("original"),
        F.col("null_removed").cast("bigint").alias("null_removed"),
        (F.col("original") - F.col("null_removed") - F.col("final")).cast("bigint").alias("malformed_removed"),
        F.col("final").cast("bigint").alias("final"),
    )
    return audit, summary


def rejects_sample(cleaned: Cleaned, n: int = 5) -> DataFrame:
    """First ``n`` rejected rows per rule (the level-2 display), ordered."""
    cols = [c for c in cleaned.rejects.columns if c != "rule"]
    w = Window.partitionBy("rule").orderBy(*[F.col(c).asc_nulls_first() for c in cols])
    return cleaned.rejects.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
