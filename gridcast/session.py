"""Session and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # wide feature plans (60-90 columns, not-null filters across joins) make
    # constraint inference super-linear; the plans do not rely on it
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "gridcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    Session time zone is pinned to UTC: every timestamp in the library is
    wall-clock `timestamp_ntz`, LTZ only appears on the streaming path.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", "12g")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.constraintPropagation.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session built elsewhere."""
    for k, v in RUNTIME_SQL_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster this is the shared folder the operator configured; it is
    read from the session, and a session without it raises. Only under a
    local master (one machine, as in tests) a private folder is created.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="gridcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_STAGED: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; drop_staged deletes what is there."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/gridcast-data/{name}-{uuid.uuid4().hex[:12]}"
    _STAGED.append(path)
    return path


def materialize(df, name: str = "stage"):
    """Cut lineage: write df as parquet under the shared folder, read it back.

    Used where a frame feeds several passes (model fitting, scoring):
    survives executor loss, unlike cache() or localCheckpoint().
    """
    spark = df.sparkSession
    p = shared_path(spark, name)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def drop_staged(spark: SparkSession) -> int:
    """Delete all staged tables, landings, sinks and checkpoints this process wrote (call when results are final)."""
    jvm = spark._jvm
    n = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            fs.delete(path, True)
            n += 1
    return n
