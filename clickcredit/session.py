"""Session helpers: one place that knows how a local/test session is configured.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so cluster configuration always wins.
"""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that only a local or test session needs. Applied only where unset and the
# master is local: on a cluster, parallelism and the rest are the platform's.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}
# Settings that the results or plans rely on. Applied only where unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never JIT-compiles a method over 8000 bytes of bytecode; the URL
    # rules make a large generated method, so let Spark fall back to
    # per-operator code for such a stage instead of running it interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def session_defaults(master: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Settings for a session on ``master``, where nothing else was submitted."""
    local = master == "local" or master.startswith("local[")
    return {**_DEFAULTS, **(_LOCAL_DEFAULTS if local else {}), **(extra or {})}


def get_session(master: str | None = None, app_name: str = "clickcredit",
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    SparkContext._ensure_initialized()  # so that SparkConf sees what spark-submit was given
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    where = submitted.get("spark.master", None)
    if master or not where:
        where = master or os.environ.get("CLICKCREDIT_MASTER", "local[8]")
        builder = builder.master(where)
    for key, value in session_defaults(where, extra).items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared location). Only when
    it is unset (tests, a bare local session) fall back to a folder under /tmp,
    and register it so ``DataFrame.checkpoint()`` uses the same place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = f"/tmp/clickcredit-checkpoints-{uuid.uuid4().hex[:8]}"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever file system the path names."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/clickcredit/{name}-{uuid.uuid4().hex[:12]}"
