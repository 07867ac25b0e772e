"""Mixing sources to target weights by Poisson replication.

A source's target weight is its share of rows to the power ``alpha`` (1 keeps
the mix, 0 makes sources equal) unless weights are given.  With the budget of
``epochs`` times all rows this sets each source's mean repetition rate.  A
document's count inverts the Poisson distribution of that rate at a uniform
number hashed from the seed and the id, so it needs no state and is the same
in every run; the copies are then dealt out and ordered by hashes, which is a
global shuffle without a sort across tasks.

The rates are one row a source.  They are written out first, so that their
true size decides whether the join may broadcast them; beyond that Spark
joins by shuffle and splits a source that holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import materialise, others, quoted, unused

NO_SOURCE = ""  # null sources are one source of their own; so is an empty name


def hashed(digits: int, *parts: Column) -> Column:
    """The first hex digits of an MD5 of the parts, as a long; nulls count as empty."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) of 52 bits."""
    return (hashed(13, *parts).cast("double") + 0.5) / float(1 << 52)


def poisson_cdf(rate: Column) -> tuple[Column, Column]:
    """(first count, cumulative probabilities from there on), wide enough that what is left out is below 1e-15.

    Probabilities are summed from their logarithms, so a high rate does not underflow.
    """
    spread = F.lit(12.0) * F.sqrt(rate) + 25
    low = F.greatest(F.lit(0.0), F.floor(rate - spread)).cast("int")
    high = F.ceil(rate + spread).cast("int")

    def term(k: Column) -> Column:
        # Stirling's series for ln k!, exact to 1e-12 from 10 on; below, the product
        x = k.cast("double")
        series = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
        product = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda a, i: a + F.log(i.cast("double")))
        return F.exp(x * F.log(rate) - rate - F.when(k < 10, product).otherwise(series))

    sums = F.aggregate(
        F.sequence(low, high), F.array().cast("array<double>"),
        lambda a, k: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0.0)) + term(k))),
    )
    return low, sums


def mix_rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None, alpha: float, epochs: float) -> DataFrame:
    """(source, n, rate, low, cdf): counts over all rows, rate = epochs * all rows * target share / n."""
    counts = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(alpha))))
    else:
        given = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]) if weights else F.create_map().cast("map<string,double>")
        weighted = counts.withColumn("weight", F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0)))
    weighted = materialise(weighted, "mix-weights")
    totals = weighted.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_weight")).first()
    if not totals.all_n or not totals.all_weight:
        weighted = weighted.withColumn("rate", F.lit(0.0))
    else:
        weighted = weighted.withColumn("rate", F.lit(float(epochs) * totals.all_n) * (F.col("weight") / totals.all_weight) / F.col("n"))
    low, cdf = poisson_cdf(F.col("rate"))
    rated = F.col("rate") > 0
    return weighted.select("source", "n", "rate", F.when(rated, low).otherwise(0).alias("low"), F.when(rated, cdf).otherwise(F.array(F.lit(1.0))).alias("cdf"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None,
    alpha: float = 0.5, epochs: float = 1.0, seed: int = 42,
) -> DataFrame:
    """The input columns plus copy (from 0) and shuffle_key: each document as often as its Poisson count says.

    Null sources are one source.  Rows with equal ids in one source share one
    draw; with null ids, those with equal texts.  With ``weights``, unnamed sources have
    weight 0 and go.  The order hashes id, copy and text, so only wholly
    repeated rows tie.  Input columns named copy or shuffle_key are replaced;
    an empty table gives an empty result.
    """
    m = unused(docs, "_m")
    rates = materialise(mix_rates(docs, source_col, weights, alpha, epochs).select(F.col("source").alias(f"{m}_source"), F.col("low").alias(f"{m}_low"), F.col("cdf").alias(f"{m}_cdf")), "mix-rates")
    keep = [quoted(c) for c in others(docs, "copy", "shuffle_key")]
    named = docs.select(*keep, F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias(f"{m}_source"))
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    u = uniform(F.lit(seed), F.lit("count"), own, F.col(f"{m}_source"))
    counted = named.join(rates, f"{m}_source").withColumn(f"{m}_u", u)
    count = F.col(f"{m}_low") + F.size(F.filter(f"{m}_cdf", lambda c: c < F.col(f"{m}_u")))
    copies = counted.withColumn(f"{m}_count", count).where(F.col(f"{m}_count") > 0)
    copies = copies.select(*keep, F.explode(F.sequence(F.lit(0), F.col(f"{m}_count") - 1)).alias("copy"))
    keyed = copies.withColumn("shuffle_key", hashed(15, F.lit(seed), F.lit("order"), F.col(id_col), F.col("copy"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")
