"""Typed CSV scan with the positional input schema.

``header=true`` with an explicit schema skips the header line and binds
columns by *position* (field order is part of the contract).  Malformed
cells become NULL (PERMISSIVE), short rows are NULL-padded, surplus
columns dropped.  A missing path fails at analysis (PATH_NOT_FOUND).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pillbox.plans.spec import TableSpec

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    # RFC-4180 quoting: "a ""b""" reads as a "b" (Spark's default escape
    # is a backslash, which would keep the doubled quotes).
    "escape": '"',
}


def read_raw(spark: SparkSession, path: str | list[str], spec: TableSpec, **options) -> DataFrame:
    reader = spark.read.schema(spec.schema)
    for k, v in {**CSV_OPTIONS, **spec.read_options, **options}.items():
        reader = reader.option(k, v)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def read_damaged(spark: SparkSession, path: str | list[str], spec: TableSpec, **options) -> DataFrame:
    """The lines that do not fit the schema: line, reason, columns.

    ``read_raw`` keeps what it can of such a line and says nothing, as the source pipeline does; here its text is kept.
    The reason is ``too many cells``, ``bad values`` (their columns are listed) or ``too few cells``.
    """
    opts = {**CSV_OPTIONS, **spec.read_options, **options}
    reader = spark.read.schema(StructType([*spec.schema.fields, StructField(CORRUPT, StringType())]))
    for k, v in opts.items():
        reader = reader.option(k, v)
    names = spec.columns
    read = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path).where(F.col(CORRUPT).isNotNull())
    # the cells of the line as text, and whether there is one more than there should be
    cells = F.from_csv(CORRUPT, ", ".join([*(f"`{c}` string" for c in names), "`_more` string"]), {**opts, "header": "false"})
    bad = [F.when(F.col(f"_cells.`{c}`").isNotNull() & F.col(f"`{c}`").isNull(), F.lit(c)) for c in names]
    out = read.withColumn("_cells", cells).withColumn("columns", F.array_compact(F.array(*bad)))
    reason = F.when(F.col("_cells._more").isNotNull(), "too many cells").when(F.size("columns") > 0, "bad values").otherwise("too few cells")
    return out.select(F.col(CORRUPT).alias("line"), reason.alias("reason"), F.array_join("columns", ",").alias("columns"))


def locate_input(spark: SparkSession, in_dir: str, table: str, pattern: str | None = None) -> list[str]:
    """Where a table's input lies; a missing input is an error.

    By default exactly ``<in_dir>/<table>.csv``, a file or a folder of parts.
    With a ``pattern`` (a glob; ``{table}`` stands for the name) every match
    belongs to the table, and all are read in one scan.  Paths are looked up
    in the cluster's file system.
    """
    sc = spark.sparkContext
    glob = sc._jvm.org.apache.hadoop.fs.Path(f"{in_dir.rstrip('/')}/{(pattern or '{table}.csv').format(table=table)}")
    fs = glob.getFileSystem(sc._jsc.hadoopConfiguration())
    if pattern is None:
        paths = [glob.toString()] if fs.exists(glob) else []
    else:
        paths = sorted(st.getPath().toString() for st in (fs.globStatus(glob) or []))
    if not paths:
        raise FileNotFoundError(f"no input for {table} under {in_dir}")
    return paths


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a raw table as header CSV in the format ``read_raw`` expects."""
    from pillbox.plans.specs import DATE_FORMAT, TS_FORMAT

    (
        df.write.mode(mode)
        .option("header", "true")
        .option("escape", '"')
        # keep cell text byte-for-byte (the writer trims by default)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("timestampFormat", TS_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )
