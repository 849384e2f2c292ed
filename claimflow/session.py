"""Session construction and the shared working folder.

On a cluster the session is created by the platform; ``build_session`` is for
local runs and tests. ``shared_dir`` never invents a machine-local folder when
the cluster already names one in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A generated method above ~8 KB of bytecode is never JIT-compiled and runs
    # interpreted; fall back to per-expression codegen for such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Broadcast only sides whose estimated (and, under AQE, measured) size is
    # below this bound; everything larger is shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Parquet is compressed on disk; estimate scans at 3x their file size so
    # the static broadcast decision errs toward a shuffle. AQE re-decides
    # from measured shuffle sizes.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "claimflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CLAIMFLOW_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or an already set checkpoint dir). Where
    neither is set, a local session (runs and tests on one machine) gets a fresh
    temp folder, registered as its checkpoint dir; on a cluster, whose machines
    would not see it, that is an error.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if conf_dir:
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    local = tempfile.mkdtemp(prefix="claimflow-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
