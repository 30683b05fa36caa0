"""Session helpers: a tuned builder for local runs and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "wardline") -> SparkSession:
    """Session for tests and benchmarks. Cluster jobs should bring their own session."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor can reach). Only a
    local-mode session without the setting gets a fresh scratch folder, as in
    tests; that folder is then recorded as the session's checkpoint dir.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        path = tempfile.mkdtemp(prefix="wardline-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one run."""
    base = shared_dir(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
