"""Materialisation: overwrite, append, land, copy, upsert, schema guard, docs.

Tables are Parquet directories.  The fact table is partitioned by day of
``start_timestamp``: a day of ``PACK_ROWS`` rows or more has its own
partition, smaller days share one a month, so that a table of sparse days is
not thousands of tiny files.  Files are clustered by the cluster keys, so
Parquet min/max statistics skip row groups for filters on those keys.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, StringType, StructField, StructType

PARTITION_COL = "start_date"
CLUSTER_COLS = ("medication_code", "patient_id", "city")  # fixed value: fact cluster keys


class SchemaChangeError(ValueError):
    pass


class ConcurrentMergeError(RuntimeError):
    """Another merge has made the next version first; nothing of this one is visible, and it can be run again."""


SMALL = {"compression": "zstd"}  # of tables that hold every input row, every key or scratch rows: smaller than the default, hardly slower


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, **options) -> None:
    w = df.write.mode("overwrite").options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def land(df: DataFrame, path: str, force: bool = False) -> None:
    """Write only when nothing is at ``path`` yet, unless ``force``."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def copy_table(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """CREATE TABLE dst AS SELECT * FROM src."""
    overwrite(spark.read.parquet(src), dst)
    return spark.read.parquet(dst)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def schema_diff(incoming: StructType, target: StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(column, incoming type, target type, change) for every difference."""
    inc = {f.name.lower(): f for f in incoming.fields}
    tgt = {f.name.lower(): f for f in target.fields}
    out = []
    for name in sorted(set(inc) | set(tgt)):
        a, b = inc.get(name), tgt.get(name)
        if a is None:
            out.append((b.name, None, b.dataType.simpleString(), "removed"))
        elif b is None:
            out.append((a.name, a.dataType.simpleString(), None, "added"))
        elif a.dataType != b.dataType:
            out.append((a.name, a.dataType.simpleString(), b.dataType.simpleString(), "type_changed"))
    return out


def schema_diff_frame(spark: SparkSession, incoming: StructType, target: StructType) -> DataFrame:
    schema = "column_name string, incoming_type string, target_type string, change string"
    return spark.createDataFrame(schema_diff(incoming, target), schema)


def check_schema(incoming: StructType, target: StructType) -> None:
    """on_schema_change='fail': refuse to write when columns differ."""
    diff = schema_diff(incoming, target)
    if diff:
        raise SchemaChangeError(f"schema change refused: {diff}")


def with_docs(df: DataFrame, docs: dict[str, str], table: str | None = None) -> DataFrame:
    """Attach descriptions as field metadata (kept by Parquet); that of the table goes with the first column."""
    out = []
    for i, c in enumerate(df.columns):
        meta = ({"comment": docs[c]} if c in docs else {}) | ({"table_comment": table} if table and i == 0 else {})
        out.append(F.col(c).alias(c, metadata=meta) if meta else F.col(c))
    return df.select(*out)


DAY = "_day"  # the row's day, in the files
PACKED = "packed"  # partition: does it hold the small days of a month?  ``PARTITION_COL`` is then the month's first day
PACK_ROWS = 1 << 17  # a day with fewer rows shares the partition of its month


def with_partition(fact: DataFrame, ts_col: str = "start_timestamp") -> DataFrame:
    return fact.withColumn(DAY, F.to_date(F.col(ts_col)))


def placed(df: DataFrame, big_days: Sequence[dt.date]) -> DataFrame:
    """Adds the partition columns: big days (and rows without a day) for themselves, all others by month."""
    day = F.col(DAY)
    own = day.isNull() | day.isin(list(big_days)) if big_days else day.isNull()
    return df.withColumns({PACKED: ~own, PARTITION_COL: F.when(own, day).otherwise(F.trunc(day, "month"))})


Z_COL, Z_BITS, Z_SAMPLE = "_z", 4, 1 << 14  # the space-filling order: its column, bits of a key, rows its cut points come from


def cut_points(df: DataFrame, cols: Sequence[str], bits: int = Z_BITS, sample: int = Z_SAMPLE) -> dict[str, list]:
    """For each column up to 2**bits - 1 ascending values that part its rows about evenly, from a sample of fixed size.

    The sample is the first rows in a random order, a bounded heap a task.  It decides on the layout only, never on a result.
    """
    rows = df.select(*cols).orderBy(F.rand(42)).limit(sample).collect()  # at most ``sample`` rows of the keys
    cuts = {}
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        step = len(values) / (1 << bits)
        cuts[c] = sorted({values[int(k * step)] for k in range(1, 1 << bits)}) if values else []
    return cuts


def interleaved(cuts: dict[str, list], bits: int = Z_BITS) -> Column:
    """The place on a Z-shaped curve through the cells between the cut points: the bits of the keys' cells in turn."""
    out = F.lit(0)
    for i, (c, points) in enumerate(cuts.items()):
        cell = sum((F.coalesce(F.col(c) > F.lit(p), F.lit(False)).cast("int") for p in points), F.lit(0))
        for bit in range(bits):
            place = bit * len(cuts) + (len(cuts) - 1 - i)
            out = out + F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), place)
    return out


def clustered(df: DataFrame, cluster_cols: Sequence[str] = CLUSTER_COLS, cuts: dict[str, list] | None = None) -> DataFrame:
    """Group the rows of a partition together (AQE rebalance splits a hot one across
    tasks instead of sending it to one) and sort each file by the keys.

    A linear sort lets statistics skip by its first key only.  With ``cuts`` rows are ranged and sorted along a
    space-filling curve, so that each file and row group spans few values of every key.
    """
    if cuts is None:
        return df.hint("rebalance", PACKED, PARTITION_COL).sortWithinPartitions(PACKED, PARTITION_COL, *cluster_cols)
    order = [PACKED, PARTITION_COL, Z_COL, *cluster_cols]
    return df.withColumn(Z_COL, interleaved(cuts)).repartitionByRange(*order).sortWithinPartitions(*order).drop(Z_COL)


def day_sizes(df: DataFrame) -> dict[dt.date | None, int]:
    """Rows of each day: a row a calendar day, bounded by the calendar and not by the data."""
    return {r.day: r.n for r in df.groupBy(F.col(DAY).alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _big(sizes: dict[dt.date | None, int], pack_rows: int) -> list[dt.date]:
    return sorted(d for d, n in sizes.items() if d is not None and n >= pack_rows)


def write_fact(
    fact: DataFrame,
    path: str,
    cluster_cols: Sequence[str] = CLUSTER_COLS,
    pack_rows: int | Callable[[dict[dt.date | None, int]], int] | None = None,
    space_filling: bool = False,
    **options,
) -> None:
    """Write a table partitioned by day, small days by month, clustered linearly or along a space-filling curve.

    The rows are written once to the shared scratch folder, which is emptied of them afterwards: the sizes of the days, the cut
    points and the ranges of the curve come from there, so that what makes the rows runs once.
    ``pack_rows`` may be a function of the sizes of the days; ``options`` go to the Parquet writer.
    """
    from pillbox.session import scratch_path

    spark = fact.sparkSession
    staged_path = scratch_path(spark, "fact-rows")
    try:
        dated = with_partition(fact)
        _stage(dated, staged_path)
        dated = spark.read.schema(dated.schema).parquet(staged_path)
        sizes = day_sizes(dated)
        least = pack_rows(sizes) if callable(pack_rows) else PACK_ROWS if pack_rows is None else pack_rows
        cuts = cut_points(dated, cluster_cols) if space_filling else None
        clustered(placed(dated, _big(sizes, least)), cluster_cols, cuts).write.mode("overwrite").options(**options).partitionBy(PACKED, PARTITION_COL).parquet(path)
    finally:
        _delete(spark, staged_path)


def _stage(rows: DataFrame, path: str) -> None:
    """Rows that are read again a few times and then deleted."""
    overwrite(rows, path, **SMALL)


def partition_range(first: Column | None, last: Column | None) -> Column:
    """Predicate on the partition columns that holds for every partition with a row of these days."""
    out, part = F.lit(True), F.col(PARTITION_COL)
    if first is not None:
        out = out & (part >= F.trunc(first, "month")) & (F.col(PACKED) | (part >= first))
    if last is not None:
        out = out & (part <= last)
    return out


# A merged table is a folder of commits, one of key commits and one of manifests.  A commit holds the rows of the
# partitions that its merge rewrote, a key commit where each key of the rewritten key buckets lives.  Manifest n says
# for every day which partition and commit hold it and how many rows it has, and for every key bucket which commit.
# Nothing is changed in place: a manifest is written aside and renamed to version n, which fails if version n exists.
# A run that dies before that leaves the version before as it was; of two at the same time the later one fails.
COMMIT_COL, BUCKET_COL = "commit", "bucket"
DATA, KEYS, MANIFESTS = "data", "keys", "manifests"
MANIFEST_SCHEMA = f"{DAY} date, {PACKED} boolean, {PARTITION_COL} date, n_rows bigint, {BUCKET_COL} int, {COMMIT_COL} string"
KEYS_A_BUCKET = 1 << 20  # of the first load; the number of buckets stays
MIN_BUCKETS, MAX_BUCKETS = 32, 1 << 16


def _fs_path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a merged table, oldest first."""
    root = _fs_path(spark, path, MANIFESTS)
    if not _fs(spark, root).exists(root):
        return []
    marks = _fs(spark, root).globStatus(_fs_path(spark, path, MANIFESTS, "version=*", "_SUCCESS")) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)


def _manifest_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/version={version}"


def _manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest_path(path, version))


def _table(spark: SparkSession, path: str, version: int) -> dict:
    """What the manifest keeps of the table itself: ``schema`` of the rows, ``key`` and number of ``buckets``."""
    known = json.loads(spark.read.parquet(_manifest_path(path, version)).schema[COMMIT_COL].metadata["table"])
    return known | {"schema": StructType.fromJson(known["schema"])}


def stored_schema(spark: SparkSession, path: str, version: int) -> StructType:
    """Schema of the rows, without the partition columns."""
    return _table(spark, path, version)["schema"]


def _commits(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored rows, with the partition columns' types given: a table with only the NULL day has no value to infer from."""
    parts = [StructField(COMMIT_COL, StringType()), StructField(PACKED, BooleanType()), StructField(PARTITION_COL, DateType())]
    root = f"{path.rstrip('/')}/{DATA}"
    return spark.read.schema(StructType([*schema.fields, StructField(DAY, DateType()), *parts])).option("basePath", root).parquet(root)


def _key_commits(spark: SparkSession, path: str, key: str, schema: StructType) -> DataFrame:
    full = StructType([schema[key], StructField(DAY, DateType()), StructField(COMMIT_COL, StringType()), StructField(BUCKET_COL, IntegerType())])
    root = f"{path.rstrip('/')}/{KEYS}"
    return spark.read.schema(full).option("basePath", root).parquet(root)


def _live(stored: DataFrame, manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The stored rows of the commits that the manifest names for these partition columns.

    A manifest has a row for each calendar day and key bucket, so it is broadcast, and its values prune the scan.
    """
    live = manifest.select(*[F.col(c).alias(f"_m{c}") for c in (*columns, COMMIT_COL)]).distinct()
    same = F.col(COMMIT_COL) == F.col(f"_m{COMMIT_COL}")
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_m{c}"))
    return stored.join(F.broadcast(live), same).drop(*live.columns)


def _days(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col(BUCKET_COL).isNull())


def read_merged(spark: SparkSession, path: str, version: int | None = None, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """The current (or a given) version of a merged table, or a table of ``write_fact``; column ``start_date`` is the row's day.

    ``first`` and ``last`` (dates) leave out partitions that have no row of the days between; rows of other days in the
    partitions read still come.
    """
    known = versions(spark, path)
    if known:
        at = known[-1] if version is None else version
        manifest = _manifest(spark, path, at)
        stored = _commits(spark, path, stored_schema(spark, path, at)).where(partition_range(first, last))
        rows = _live(stored, _days(manifest), (PACKED, PARTITION_COL)).drop(COMMIT_COL)
    else:
        files = spark.read.parquet(path).drop(PACKED, PARTITION_COL).schema
        parts = [StructField(PACKED, BooleanType()), StructField(PARTITION_COL, DateType())]
        rows = spark.read.schema(StructType([*files.fields, *parts])).parquet(path).where(partition_range(first, last))
    return rows.drop(PACKED, PARTITION_COL).withColumnRenamed(DAY, PARTITION_COL)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET_COL)


def keys_of(spark: SparkSession, path: str, version: int, buckets: Sequence[int]) -> DataFrame:
    """(key, day, bucket) of the stored keys in these buckets; no other bucket is read."""
    table = _table(spark, path, version)
    some = F.col(BUCKET_COL).isin([int(b) for b in buckets])
    manifest = _manifest(spark, path, version).where(some)
    return _live(_key_commits(spark, path, table["key"], table["schema"]).where(some), manifest, [BUCKET_COL]).drop(COMMIT_COL)


def _publish(spark: SparkSession, path: str, version: int, rows: list[tuple], table: dict) -> None:
    """Write a manifest aside and rename it to the version; fails if that exists (atomic where the file system's rename is)."""
    meta = {"table": json.dumps(table | {"schema": table["schema"].jsonValue()})}
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA).withColumn(COMMIT_COL, F.col(COMMIT_COL).alias(COMMIT_COL, metadata=meta))
    aside = f"{path.rstrip('/')}/{MANIFESTS}/_writing-{uuid.uuid4().hex}"
    manifest.coalesce(1).write.parquet(aside)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    src, dst = _fs_path(spark, aside), _fs_path(spark, _manifest_path(path, version))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, src).makeQualified(src).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(_fs(spark, src).makeQualified(src), _fs(spark, dst).makeQualified(dst), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        _delete(spark, aside)
        if _fs(spark, dst).exists(dst):
            raise ConcurrentMergeError(f"version {version} of {path} was made by another merge") from e
        raise


def _rows_of(spark: SparkSession, path: str, schema: StructType, parts: set[tuple]) -> DataFrame | None:
    """The stored rows of these (packed, partition, commit), none if there are no such."""
    if not parts:
        return None
    live = spark.createDataFrame(sorted(parts, key=str), f"{PACKED} boolean, {PARTITION_COL} date, {COMMIT_COL} string")
    stored = _commits(spark, path, schema).where(F.col(COMMIT_COL).isin(sorted({c for _, _, c in parts})))
    return _live(stored, live, (PACKED, PARTITION_COL)).drop(PACKED, PARTITION_COL, COMMIT_COL)


def _has_duplicates(rows: DataFrame, key: str) -> bool:
    """Does a key come twice?  Hashes are counted, a fraction of the keys' bytes; only keys whose hash comes twice are compared."""
    h = F.xxhash64(key)
    twice = rows.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h")
    if not twice.limit(1).count():
        return False
    some = rows.select(key, h.alias("_h")).join(twice, "_h", "left_semi")
    return some.groupBy(key).count().filter(F.col("count") > 1).limit(1).count() > 0


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str = "medication_id",
    cluster_cols: Sequence[str] = CLUSTER_COLS,
    pack_rows: int | None = None,
) -> int:
    """Incremental merge on ``key``: matched keys replaced, new keys inserted, all other rows kept.

    Returns the new version.  A schema change is refused before anything is
    computed, duplicate keys in ``updates`` before anything of the table is
    written, on the first load too, and a second merge from the same version with ``ConcurrentMergeError``.

    The update set is written once to the shared scratch folder, which is emptied of it afterwards.  Its keys' buckets of
    the key index say which days matched keys leave; the partitions of these and of the batch's days are written
    anew, and the key buckets of the batch.  The manifest's counts with those that leave and come are the exact sizes of the
    days, which decide on their partitions.  Driver state is a row for each calendar day and key bucket.
    """
    from pillbox.session import scratch_path

    pack_rows = PACK_ROWS if pack_rows is None else pack_rows
    known = versions(spark, path)
    if known:
        table = _table(spark, path, known[-1])
        check_schema(updates.schema, table["schema"])
        if table["key"] != key:
            raise ValueError(f"the table is merged on {table['key']}, not on {key}")
    new = (known[-1] if known else 0) + 1
    root, commit = path.rstrip("/"), f"{new}-{uuid.uuid4().hex[:12]}"
    staged_path = scratch_path(spark, "upsert-batch")
    try:
        _stage(with_partition(updates), staged_path)
        batch = spark.read.schema(with_partition(updates).schema).parquet(staged_path)
        if _has_duplicates(batch, key):
            raise ValueError(f"duplicate {key} values in the update set")
        sizes = day_sizes(batch)
        if not known:
            buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-sum(sizes.values()) // KEYS_A_BUCKET)))
            table = {"schema": updates.schema, "key": key, "buckets": buckets}
        batch_keys = batch.select(key, DAY, _bucket(key, table["buckets"]))
        rows, keys, kept_manifest = batch, batch_keys, []
        if known:
            manifest = _manifest(spark, path, known[-1]).collect()  # calendar days and key buckets
            touched_buckets = sorted(r[0] for r in batch_keys.select(BUCKET_COL).distinct().collect())
            stored_keys = keys_of(spark, path, known[-1], touched_buckets)
            leaving = day_sizes(stored_keys.join(batch.select(key), key, "left_semi"))
            touched_days = set(sizes) | set(leaving)
            months = {d.replace(day=1) for d in touched_days if d is not None}
            days = [r for r in manifest if r[BUCKET_COL] is None]
            # the partitions of the touched days, and the shared ones of their months, which a day may leave or enter
            anew = {(r[PACKED], r[PARTITION_COL], r[COMMIT_COL]) for r in days if r[DAY] in touched_days or (r[PACKED] and r[PARTITION_COL] in months)}
            before, gone = dict.fromkeys(anew, 0), dict.fromkeys(anew, 0)
            for r in days:
                part = (r[PACKED], r[PARTITION_COL], r[COMMIT_COL])
                if part in anew:
                    before[part] += r.n_rows
                    gone[part] += leaving.get(r[DAY], 0)
                    sizes[r[DAY]] = sizes.get(r[DAY], 0) + r.n_rows - leaving.get(r[DAY], 0)
                else:
                    kept_manifest.append(tuple(r))
            kept_manifest += [tuple(r) for r in manifest if r[BUCKET_COL] is not None and r[BUCKET_COL] not in touched_buckets]
            # the counts are exact: a partition that all rows leave is not read, one that no row leaves needs no join
            whole = _rows_of(spark, path, table["schema"], {p for p in anew if not gone[p]})
            part_of = _rows_of(spark, path, table["schema"], {p for p in anew if 0 < gone[p] < before[p]})
            stay = [whole, None if part_of is None else part_of.join(batch.select(key), key, "left_anti")]
            rows = reduce(DataFrame.unionByName, [df for df in stay if df is not None], batch)
            keys = stored_keys.join(batch.select(key), key, "left_anti").unionByName(batch_keys)
        big = _big(sizes, pack_rows)
        clustered(placed(rows, big), cluster_cols).write.options(**SMALL).partitionBy(PACKED, PARTITION_COL).parquet(f"{root}/{DATA}/{COMMIT_COL}={commit}")
        keys.hint("rebalance", BUCKET_COL).sortWithinPartitions(BUCKET_COL, key).write.options(**SMALL).partitionBy(BUCKET_COL).parquet(f"{root}/{KEYS}/{COMMIT_COL}={commit}")
        if not known:
            touched_buckets = sorted(r[0] for r in batch_keys.select(BUCKET_COL).distinct().collect())
        large = set(big)
        at = lambda d: (False, d) if d is None or d in large else (True, d.replace(day=1))
        written = [(d, *at(d), n, None, commit) for d, n in sizes.items() if n]
        _publish(spark, path, new, kept_manifest + written + [(None, None, None, None, b, commit) for b in touched_buckets], table)
    finally:
        _delete(spark, staged_path)
    return new


def changed_rows(spark: SparkSession, path: str, before: int, after: int) -> DataFrame:
    """The rows that version ``after`` adds to version ``before`` (``sign`` 1) and those that it takes away (``sign`` -1).

    From the manifests: partitions that both versions take from the same commit are not read.  A row that stayed in a
    rewritten partition is in the result with both signs.  Both versions must not be vacuumed.
    """
    parts = [
        {(r[PACKED], r[PARTITION_COL], r[COMMIT_COL]) for r in _days(_manifest(spark, path, v)).collect()}  # calendar days
        for v in (before, after)
    ]
    stored = _commits(spark, path, stored_schema(spark, path, after))
    out = None
    for sign, some in ((-1, parts[0] - parts[1]), (1, parts[1] - parts[0])):
        live = spark.createDataFrame(sorted(some, key=str), f"{PACKED} boolean, {PARTITION_COL} date, {COMMIT_COL} string")
        commits = F.col(COMMIT_COL).isin(sorted({c for _, _, c in some}))
        rows = _live(stored.where(commits), live, (PACKED, PARTITION_COL)).drop(PACKED, PARTITION_COL, COMMIT_COL)
        rows = rows.withColumnRenamed(DAY, PARTITION_COL).withColumn("sign", F.lit(sign))
        out = rows if out is None else out.unionByName(rows)
    return out


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Delete older manifests, and the commits that the current version does not use; returns the numbers of the data commits."""
    known = versions(spark, path)
    if not known:
        return []
    manifest = _manifest(spark, path, known[-1])
    gone = {}
    for folder, rows in ((DATA, _days(manifest)), (KEYS, manifest.where(F.col(BUCKET_COL).isNotNull()))):
        used = {r[0] for r in rows.select(COMMIT_COL).distinct().collect()}  # commits in use
        root = _fs_path(spark, path, folder)
        stored = [st.getPath().getName().split("=")[1] for st in _fs(spark, root).listStatus(root)]
        # a commit above the current version belongs to a run that is under way or has failed
        gone[folder] = sorted((c for c in stored if c not in used and int(c.split("-")[0]) <= known[-1]), key=lambda c: int(c.split("-")[0]))
    for v in known[:-1]:
        _delete(spark, _manifest_path(path, v))
    for folder, commits in gone.items():
        for c in commits:
            _delete(spark, f"{path.rstrip('/')}/{folder}/{COMMIT_COL}={c}")
    return [int(c.split("-")[0]) for c in gone[DATA]]
