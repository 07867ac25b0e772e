"""Analyses over the prescription fact (plain grouped aggregations).

Money columns stay DECIMAL (exact sums); averages and ratios are emitted
as DOUBLE computed from the exact sums, rounded to a fixed number of
places.  Every aggregation is hash-partial-aggregated before its shuffle,
so a hot group costs one row per input partition, not a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RATIO_PLACES = 6
MONEY_SUM = "decimal(38,9)"


def _ratio(num: Column, den: Column) -> Column:
    return F.round(num.cast("double") / den.cast("double"), RATIO_PLACES)


def m1_cost_demographics(fact: DataFrame) -> DataFrame:
    """Cost by medication, demographic, place and month."""
    month = F.date_trunc("month", F.col("start_timestamp")).alias("month")
    return fact.groupBy("medication_code", "gender", "state", month).agg(
        F.count(F.lit(1)).alias("n_prescriptions"),
        F.sum("total_cost").cast(MONEY_SUM).alias("total_cost_sum"),
        F.sum("base_cost").cast(MONEY_SUM).alias("base_cost_sum"),
        _ratio(F.sum("base_cost"), F.count(F.lit(1))).alias("avg_base_cost"),
    )


def m2_geo(fact: DataFrame) -> DataFrame:
    """Prescribing by organization state, city and organization."""
    return fact.groupBy("organization_state", "organization_city", "organization_id").agg(
        F.count(F.lit(1)).alias("n_prescriptions"),
        F.countDistinct("patient_id").alias("n_patients"),
        F.sum("total_cost").cast(MONEY_SUM).alias("total_cost_sum"),
    )


def m3_provider(fact: DataFrame) -> DataFrame:
    """Organization revenue, utilization and payer coverage by state.

    Two-level aggregation over one scan: per organization first (revenue
    and utilization are attributes of the organization, constant within
    it), then per state.  No self-join, and both levels combine map-side.
    """
    per_org = (
        fact.filter(F.col("organization_id").isNotNull())
        .groupBy("organization_state", "organization_id")
        .agg(
            F.max("revenue").alias("revenue"),
            F.max("utilization").alias("utilization"),
            F.count(F.lit(1)).alias("n_prescriptions"),
            F.sum("payer_coverage").alias("payer_coverage_sum"),
            F.sum("total_cost").alias("total_cost_sum"),
        )
    )
    per_state = per_org.groupBy("organization_state").agg(
        F.count(F.lit(1)).alias("n_organizations"),
        F.sum("revenue").cast(MONEY_SUM).alias("revenue_sum"),
        F.sum("utilization").cast("bigint").alias("utilization_sum"),
        F.sum("n_prescriptions").cast("bigint").alias("n_prescriptions"),
        F.sum("payer_coverage_sum").cast(MONEY_SUM).alias("payer_coverage_sum"),
        F.sum("total_cost_sum").cast(MONEY_SUM).alias("total_cost_sum"),
    )
    return per_state.withColumn(
        "coverage_ratio", _ratio(F.col("payer_coverage_sum"), F.col("total_cost_sum"))
    )


def m4_patient_cost(fact: DataFrame) -> DataFrame:
    """Total cost and payer coverage per patient."""
    return fact.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("n_prescriptions"),
        F.sum("total_cost").cast(MONEY_SUM).alias("total_cost_sum"),
        F.sum("payer_coverage").cast(MONEY_SUM).alias("payer_coverage_sum"),
        _ratio(F.sum("payer_coverage"), F.sum("total_cost")).alias("coverage_ratio"),
    )


def m1_rollup(fact: DataFrame) -> DataFrame:
    """M1 by several granularities: month; with state; with gender; with medication; and all together.

    The finest groups are made first, from one scan (combined map-side); the rollup multiplies these, not the fact rows.
    ``level`` is the grouping id: a bit for each of month, state, gender and medication_code that is summed over,
    which tells a total from a group of rows without a value.
    """
    month = F.date_trunc("month", F.col("start_timestamp")).alias("month")
    finest = fact.groupBy(month, "state", "gender", "medication_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("total"), F.sum("base_cost").alias("base")
    )
    return finest.rollup("month", "state", "gender", "medication_code").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").alias("n_prescriptions"),
        F.sum("total").cast(MONEY_SUM).alias("total_cost_sum"),
        _ratio(F.sum("base"), F.sum("n")).alias("avg_base_cost"),
    )


def m5_monthly_trend(fact: DataFrame) -> DataFrame:
    """Prescriptions per month and the change from the month before.

    The calendar between the first and the last month is the spine: a month
    without prescriptions has a row of zeros, so that ``lag`` is the month before and not the one that
    happens to have rows.  Rows without a month are a row of their own without a change.  Window and
    spine are over the monthly aggregate (a bounded handful of rows), never over the fact rows.
    """
    monthly = fact.groupBy(F.date_trunc("month", F.col("start_timestamp")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("total")
    )
    ends = monthly.agg(F.min("month").alias("first"), F.max("month").alias("last")).where(F.col("first").isNotNull())
    spine = ends.select(F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month"))
    zero = spine.select("month", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast(MONEY_SUM).alias("total"))
    # adding zeros is the outer join with the calendar, by one more small aggregation
    filled = monthly.unionByName(zero).groupBy("month").agg(
        F.sum("n").alias("n_prescriptions"), F.coalesce(F.sum("total"), F.lit(0)).cast(MONEY_SUM).alias("total_cost_sum")
    )
    prev = F.lag("n_prescriptions").over(Window.partitionBy(F.col("month").isNull()).orderBy("month"))
    return filled.select(
        "month",
        "n_prescriptions",
        "total_cost_sum",
        prev.alias("prev_n_prescriptions"),
        (F.col("n_prescriptions") - prev).alias("change"),
    )


def m6_code_city(fact: DataFrame) -> DataFrame:
    """Medication code statistics by patient city."""
    return fact.groupBy("city", "medication_code").agg(
        F.count(F.lit(1)).alias("n_prescriptions"),
        F.sum("total_cost").cast(MONEY_SUM).alias("total_cost_sum"),
        _ratio(F.sum("total_cost"), F.count(F.lit(1))).alias("avg_total_cost"),
        F.min("total_cost").alias("min_total_cost"),
        F.max("total_cost").alias("max_total_cost"),
    )


PATIENT_LG_K = 12  # 2**12 registers: a standard error of about 1.6 %
SKETCH_ERROR = 0.05  # three standard errors


def m2_monthly_sketches(fact: DataFrame) -> DataFrame:
    """Distinct patients of each organization place and month as a mergeable sketch of bounded size (exact sets are not)."""
    month = F.date_trunc("month", F.col("start_timestamp")).alias("month")
    return fact.groupBy("organization_state", "organization_city", month).agg(
        F.count(F.lit(1)).alias("n_prescriptions"), F.hll_sketch_agg("patient_id", PATIENT_LG_K).alias("patients")
    )


def m2_merged(sketches: DataFrame, *keys) -> DataFrame:
    """Stored monthly sketches merged to coarser groups; patients that several months share count once."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_prescriptions").alias("n_prescriptions"), F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("n_patients_estimate")
    )


def refreshed(before: DataFrame, changes: DataFrame, keys: list[str], sums: dict[str, str], count: str) -> DataFrame:
    """A grouped aggregate brought up to date by what changed.

    ``before`` has ``keys``, a row count named ``count`` and sums (name -> summed column of ``changes``); ``changes`` has
    the rows removed and added with ``sign`` -1 and 1.  Groups that no row is left of go.  Sums and counts can be
    taken back; minima, maxima and distinct counts cannot, and are not done here.
    """
    sign = F.col("sign")
    delta = changes.groupBy(*keys).agg(
        F.sum(sign).alias(count), *[F.sum(F.col(c) * sign).cast(before.schema[name].dataType).alias(name) for name, c in sums.items()]
    )
    both = before.select(*keys, count, *sums).unionByName(delta)
    out = both.groupBy(*keys).agg(F.sum(count).alias(count), *[F.sum(name).cast(before.schema[name].dataType).alias(name) for name in sums])
    return out.where(F.col(count) > 0)


ANALYSES = {
    "m1_cost_demographics": m1_cost_demographics,
    "m2_geo": m2_geo,
    "m3_provider": m3_provider,
    "m4_patient_cost": m4_patient_cost,
    "m5_monthly_trend": m5_monthly_trend,
    "m6_code_city": m6_code_city,
}
