"""Property: the aggregation dedupe keeps the row an ordered window keeps."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from pillbox.operators.dedupe import dedupe

SCHEMA = "k string, a int, b string, c decimal(38,18), d timestamp"

rows = st.lists(
    st.tuples(
        st.sampled_from(["x", "y", "z", None]),
        st.one_of(st.none(), st.integers(-3, 3)),
        st.one_of(st.none(), st.sampled_from(["", " ", "a", "b"])),
        st.one_of(st.none(), st.decimals(-5, 5, places=2, allow_nan=False, allow_infinity=False)),
        st.one_of(st.none(), st.sampled_from([dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)])),
    ),
    min_size=0,
    max_size=30,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_dedupe_matches_ordered_window(spark, data):
    data = [(k, a, b, None if c is None else Decimal(c), d) for k, a, b, c, d in data]
    df = spark.createDataFrame(data, SCHEMA)
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_first() for c in df.columns])
    expected = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    got = dedupe(df, ["k"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
