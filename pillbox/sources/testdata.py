"""Derive the four raw healthcare tables from the star-schema test tables.

The test folders hold TPC-H-like tables, not patient records.  Each raw
table is a pure projection/join of them, so its size grows with the scale
factor and every rule fires on real values or on a formula over keys:

* patients       <- customer (+ nation, region): negative balances, ids
                    folded onto a neighbour (duplicates), NULL birth dates
* encounters     <- orders LEFT JOIN per-order line aggregate: orders
                    without lines have no organization (required field),
                    priority '4-NOT SPECIFIED' maps to an unaccepted class,
                    last ship date before the order date breaks the range
* medications    <- lineitem JOIN orders JOIN part: (order, part) repeats
                    are natural staging duplicates; cost rules fire on the
                    real price / quantity / discount columns
* organizations  <- supplier (+ nation, region): negative balances, bad
                    state case, coordinates out of range, several phones

Values with fixed decimals are cast to DECIMAL(18,2) *before* arithmetic so
every engine gets the same digits.  ``nation`` and ``region`` are the only
broadcast sides: their cardinality is fixed by the benchmark definition
(25 and 5 rows at every scale factor).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pillbox.plans.specs import SPECS

C = F.col
S = "string"
D2 = "decimal(18,2)"
RAW_DEC = "decimal(38,18)"


def _read(spark: SparkSession, sf_dir: str, table: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*cols)


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast(S))


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast(S), n, "0")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = _read(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left"))


# Violations by key: column, what stands there, and the keys (modulus, remainder) where it does.  Together with
# those that the builders make, each rule, required column and declared test has rows that fail it.
PLANTS = {
    "patients": [
        ("Id", "null", 131, 1),
        ("SSN", "null", 137, 2),
        ("FIRST", "null", 139, 3),
        ("LAST", "null", 149, 4),
        ("RACE", "null", 151, 5),
        ("ETHNICITY", "null", 157, 6),
        ("GENDER", "null", 163, 7),
        ("BIRTHPLACE", "null", 167, 8),
        ("ADDRESS", "null", 173, 9),
        ("CITY", "null", 179, 10),
        ("STATE", "null", 181, 11),
        ("HEALTHCARE_EXPENSES", "null", 191, 12),
        ("HEALTHCARE_COVERAGE", "null", 193, 13),
        ("HEALTHCARE_COVERAGE", "negative", 223, 19),
        ("INCOME", "null", 197, 14),
    ],
    "encounters": [
        ("Id", "null", 211, 1),
        ("START", "null", 223, 2),
        ("PATIENT", "null", 227, 3),
        ("PROVIDER", "null", 229, 4),
        ("PAYER", "null", 233, 5),
        ("ENCOUNTERCLASS", "null", 239, 6),
        ("CODE", "null", 241, 7),
        ("DESCRIPTION", "null", 251, 8),
        ("BASE_ENCOUNTER_COST", "null", 257, 9),
        ("TOTAL_CLAIM_COST", "negative", 103, 9),
        ("PAYER_COVERAGE", "null", 263, 10),
        ("PAYER_COVERAGE", "negative", 107, 11),
    ],
    "medications": [
        ("START", "null", 149, 6),
        ("PATIENT", "null", 151, 7),
        ("PAYER", "null", 157, 8),
        ("ENCOUNTER", "null", 163, 9),
        ("CODE", "null", 167, 10),
        ("DESCRIPTION", "null", 173, 11),
        ("BASE_COST", "null", 179, 12),
        ("BASE_COST", "negative", 131, 3),
        ("PAYER_COVERAGE", "null", 181, 13),
        ("PAYER_COVERAGE", "negative", 137, 4),
        ("DISPENSES", "null", 191, 14),
        ("DISPENSES", "negative", 113, 1),
        ("DISPENSES", "zero", 127, 2),
        ("TOTALCOST", "null", 193, 15),
        ("TOTALCOST", "negative", 139, 5),
    ],
    "organizations": [
        ("Id", "null", 38, 15),
        ("NAME", "null", 33, 10),
        ("ADDRESS", "null", 34, 12),
        ("CITY", "null", 35, 12),
        ("REVENUE", "null", 36, 13),
        ("UTILIZATION", "null", 39, 14),
        ("UTILIZATION", "negative", 19, 4),
    ],
}


def _conform(df: DataFrame, table: str, key: Column) -> DataFrame:
    """Put the violations in and cast to the raw schema, in schema order."""
    values = {"null": lambda c: F.lit(None), "negative": lambda c: -F.abs(c), "zero": lambda c: F.lit(0)}
    columns = {f.name: C(f.name).cast(f.dataType) for f in SPECS[table].schema.fields}
    planted = {}
    for name, what, modulus, remainder in PLANTS[table]:
        at, value = key % modulus == remainder, values[what](columns[name])
        planted[name] = planted[name].when(at, value) if name in planted else F.when(at, value)
    return df.select(*[
        (planted[f.name].otherwise(columns[f.name]) if f.name in planted else columns[f.name]).cast(f.dataType).alias(f.name)
        for f in SPECS[table].schema.fields
    ])


def patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    x = c.join(_geo(spark, sf_dir), c.c_nationkey == C("n_nationkey"), "left")
    k = C("c_custkey")
    birth = F.when(k % 97 == 5, F.lit(None)).otherwise(
        F.date_add(F.lit("1930-01-01").cast("date"), (k * 131 % 25000).cast("int"))
    )
    out = x.select(
        k.alias("_k"),
        _id("P", F.when(k % 89 == 1, k - 1).otherwise(k)).alias("Id"),
        birth.alias("BIRTHDATE"),
        F.when(k % 13 == 0, F.date_add(birth, 21000)).alias("DEATHDATE"),
        F.concat(F.lit("999-"), _pad(k % 100, 2), F.lit("-"), _pad(k % 10000, 4)).alias("SSN"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(_id("S", k)).alias("DRIVERS"),
        F.when(k % 4 == 0, F.concat(F.lit("X"), k.cast(S), F.lit("X"))).alias("PASSPORT"),
        F.when(k % 2 == 0, F.lit("Mr.")).otherwise(F.lit("Ms.")).alias("PREFIX"),
        C("c_name").alias("FIRST"),
        F.lit(None).cast(S).alias("MIDDLE"),
        C("n_name").alias("LAST"),
        F.when(k % 50 == 0, F.lit("null")).alias("SUFFIX"),
        F.when(k % 9 == 0, F.lit("")).when(k % 9 == 1, F.lit("  ")).alias("MAIDEN"),
        F.when(k % 7 == 0, "M").when(k % 7 == 1, "S").when(k % 7 == 2, "D").when(k % 7 == 3, "W")
        .when(k % 7 == 4, F.lit(None)).when(k % 7 == 5, "M").otherwise("X").alias("MARITAL"),
        F.when(k % 5 == 0, "white").when(k % 5 == 1, "black").when(k % 5 == 2, "asian")
        .when(k % 5 == 3, "native").otherwise("other").alias("RACE"),
        F.when(k % 6 == 0, "hispanic").otherwise("nonhispanic").alias("ETHNICITY"),
        F.when(k % 31 == 7, "U").when(k % 2 == 0, "F").otherwise("M").alias("GENDER"),
        F.concat(C("n_name"), F.lit(" Town")).alias("BIRTHPLACE"),
        F.concat(F.lit("  "), k.cast(S), F.lit(" "), C("c_mktsegment"), F.lit(" Street ")).alias("ADDRESS"),
        C("n_name").alias("CITY"),
        C("r_name").alias("STATE"),
        F.concat(C("n_name"), F.lit(" County")).alias("COUNTY"),
        _pad(C("c_nationkey") * 1000 + k % 1000, 5).alias("FIPS"),
        _pad(k % 100000, 5).alias("ZIP"),
        (C("c_nationkey") * 3 - 36).cast("double").alias("LAT"),
        (C("c_nationkey") * 7 - 90).cast("double").alias("LON"),
        C("c_acctbal").cast(D2).alias("HEALTHCARE_EXPENSES"),
        ((k % 1000) * 25).alias("HEALTHCARE_COVERAGE"),
        F.when(k % 211 == 17, F.lit(-1000)).otherwise(20000 + k * 37 % 80000).alias("INCOME"),
    )
    return _conform(out, "patients", C("_k"))


def _encounter_class(priority: Column, status: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "emergency")
        .when(priority == "2-HIGH", "urgentcare")
        .when(priority == "3-MEDIUM", "inpatient")
        .when(priority == "4-NOT SPECIFIED", "outpatient")
        .when(status == "F", "ambulatory")
        .otherwise("wellness")
    )


def encounters_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(
        spark, sf_dir, "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    )
    lines = (
        _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("min_supp"),
            F.max("l_shipdate").alias("max_ship"),
            F.sum(C("l_extendedprice").cast(D2)).alias("sum_ext"),
        )
    )
    x = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    k = C("o_orderkey")
    total = C("o_totalprice").cast(D2)
    base = total * F.lit(Decimal("0.05"))
    cls = _encounter_class(C("o_orderpriority"), C("o_orderstatus"))
    out = x.select(
        k.alias("_k"),
        _id("E", F.when(k % 97 == 1, k - 1).otherwise(k)).alias("Id"),
        C("o_orderdate").alias("START"),
        C("max_ship").alias("STOP"),
        _id("P", C("o_custkey")).alias("PATIENT"),
        _id("O", C("min_supp")).alias("ORGANIZATION"),
        _id("D", C("o_custkey") % 100).alias("PROVIDER"),
        _id("Y", C("o_custkey") % 10).alias("PAYER"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), cls, F.lit(" "))).otherwise(cls).alias("ENCOUNTERCLASS"),
        F.substr(C("o_orderpriority"), F.lit(1), F.lit(1)).alias("CODE"),
        F.substr(C("o_orderpriority"), F.lit(3)).alias("DESCRIPTION"),
        F.when(k % 101 == 7, -base).otherwise(base).alias("BASE_ENCOUNTER_COST"),
        C("sum_ext").alias("TOTAL_CLAIM_COST"),
        (total * F.lit(Decimal("0.5"))).alias("PAYER_COVERAGE"),
        F.when(C("o_orderstatus") == "P", F.lit("null"))
        .otherwise(F.concat(F.lit(" "), C("o_orderstatus"), F.lit(" "))).alias("REASONCODE"),
        F.when(k % 4 == 0, F.lit("")).otherwise(C("o_orderpriority")).alias("REASONDESCRIPTION"),
    )
    return _conform(out, "encounters", C("_k"))


def medications_raw(spark: SparkSession, sf_dir: str, part_first: bool = False) -> DataFrame:
    """The same rows in both orders of the joins.

    Where only rows that meet the rules go on, the part first: what the rules say of price and quantity then holds before
    the lines are shuffled again.  Where every row goes on, the orders first: their columns are narrower than the part's.
    """
    l = _read(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    # before the joins, for what the lines take through their shuffles
    l = l.withColumn("stop", F.when(C("l_linestatus") == "O", F.lit(None)).otherwise(C("l_shipdate"))).drop("l_linestatus", "l_shipdate")
    # casts of a dimension's values stand before the joins: once for each of its rows, not of the lines
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).withColumn("o_totalprice", C("o_totalprice").cast(D2))
    p = _read(spark, sf_dir, "part", ["p_partkey", "p_name", "p_retailprice"]).withColumn("p_retailprice", C("p_retailprice").cast(D2).cast(RAW_DEC))
    by_order, by_part = (o, l.l_orderkey == o.o_orderkey, "left"), (p, l.l_partkey == p.p_partkey, "left")
    x = l.join(*by_part).join(*by_order) if part_first else l.join(*by_order).join(*by_part)
    flag = C("l_returnflag")
    out = x.select(
        C("l_orderkey").alias("_k"),
        C("o_orderdate").alias("START"),
        C("stop").alias("STOP"),
        _id("P", C("o_custkey")).alias("PATIENT"),
        _id("Y", C("o_custkey") % 10).alias("PAYER"),
        _id("E", C("l_orderkey")).alias("ENCOUNTER"),
        C("l_partkey").cast(S).alias("CODE"),
        C("p_name").alias("DESCRIPTION"),
        C("p_retailprice").alias("BASE_COST"),
        (C("o_totalprice") * C("l_discount").cast("decimal(4,2)")).alias("PAYER_COVERAGE"),
        C("l_quantity").alias("DISPENSES"),
        C("l_extendedprice").cast(D2).alias("TOTALCOST"),
        F.when(flag == "N", F.lit("")).otherwise(flag).alias("REASONCODE"),
        F.when(flag == "R", "returned").when(flag == "A", "accepted").alias("REASONDESCRIPTION"),
    )
    return _conform(out, "medications", C("_k"))


def organizations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    x = s.join(_geo(spark, sf_dir), s.s_nationkey == C("n_nationkey"), "left")
    k = C("s_suppkey")
    region2 = F.substr(C("r_name"), F.lit(1), F.lit(2))
    out = x.select(
        k.alias("_k"),
        _id("O", F.when((k % 41 == 1) & (k > 1), k - 1).otherwise(k)).alias("Id"),
        C("s_name").alias("NAME"),
        F.when(k % 47 == 3, F.lit("   ")).otherwise(F.concat(k.cast(S), F.lit(" Supply Road"))).alias("ADDRESS"),
        C("n_name").alias("CITY"),
        F.when(k % 29 == 3, F.lit(None)).when(k % 13 == 7, F.lower(region2)).otherwise(F.upper(region2)).alias("STATE"),
        _pad(k * 7 % 100000, 5).alias("ZIP"),
        F.when(k % 31 == 5, F.lit(95.5)).otherwise((C("s_nationkey") * 3 - 36).cast("double")).alias("LAT"),
        F.when(k % 37 == 11, F.lit(-181.25)).otherwise((C("s_nationkey") * 7 - 90).cast("double")).alias("LON"),
        F.concat(
            F.lit("555-"), _pad(k % 10000, 4),
            F.when(k % 3 == 0, F.concat(F.lit(" Or 555-"), _pad((k + 1) % 10000, 4))).otherwise(F.lit("")),
        ).alias("PHONE"),
        C("s_acctbal").cast(D2).alias("REVENUE"),
        (k % 500).alias("UTILIZATION"),
    )
    return _conform(out, "organizations", C("_k"))


BUILDERS = {
    "encounters": encounters_raw,
    "medications": medications_raw,
    "organizations": organizations_raw,
    "patients": patients_raw,
}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Lazy raw table."""
    return BUILDERS[table](spark, sf_dir)


def raw_tables(spark: SparkSession, sf_dir: str, part_first: bool = False) -> dict[str, DataFrame]:
    return {t: medications_raw(spark, sf_dir, part_first) if t == "medications" else raw_table(spark, sf_dir, t) for t in BUILDERS}
