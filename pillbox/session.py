"""Session construction and the shared scratch location.

Intermediate tables are written under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``).  We only pick our own folder when the
session has none *and* runs in local mode (tests, laptops); on a cluster
a missing setting is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# What a session needs for right results and runtime plans: input timestamps
# carry a literal 'Z', so the session zone is pinned to UTC (text is read in the
# session zone); AQE coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Settings of the session of our own in which the cleaning plans run.  Their long
# CASE chains over many columns make constraint inference cost 8 to 12 s of
# optimizer time a query (measured on fact_full, m4 and rejects_patients), for
# filters that are explicit and pushed down anyway.  Their generated methods
# exceed 8,000 bytes, which HotSpot does not compile unless told to; cut smaller
# they are compiled (3-7x faster cleaning).
PLAN_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_OWN: weakref.WeakKeyDictionary[SparkSession, SparkSession] = weakref.WeakKeyDictionary()
_OURS: weakref.WeakSet[SparkSession] = weakref.WeakSet()


def own_session(spark: SparkSession) -> SparkSession:
    """A session of our own beside the caller's: same application, their settings, ours on top.

    DataFrames keep the session they were made in, so the settings hold when
    the caller runs a result, and the caller's own session stays as it is.
    """
    if spark in _OURS:
        return spark
    own = _OWN.get(spark)
    if own is None:
        own = _OWN[spark] = spark.newSession()
        _OURS.add(own)
    for k, v in {**spark.conf.getAll, **PLAN_CONF}.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def get_session(
    master: str | None = None,
    app: str = "pillbox",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if (master or "").startswith("local"):
        # local mode: the driver JVM is the whole cluster
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (extra or {}).items():
        conf[k] = f"{conf[k]} {v}" if k.endswith("extraJavaOptions") and k in conf else v
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    local = tempfile.mkdtemp(prefix="pillbox-ckpt-", dir=os.environ.get("PILLBOX_TMP", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/pillbox/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to its scratch folder.  Results that were not stored elsewhere read from it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/pillbox")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
