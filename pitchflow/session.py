"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for local runs (tests, bench). On a cluster the caller's own
# session settings apply; nothing here is required for correctness.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods of over 8000 bytes. Fused wide projections are
    # longer; beyond this limit Spark evaluates them by projections cut into short methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchflow") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PITCHFLOW_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the folder every executor can reach, from ``spark.checkpoint.dir``.

    Streaming checkpoints, landing files and written tables of the
    registered queries go below it. When the setting is missing, a
    local-mode session (tests) gets a fresh temporary folder; a cluster
    session must name the shared folder itself.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pitchflow-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder below :func:`shared_dir` for one run."""
    return f"{shared_dir(spark)}/pitchflow/{label}-{uuid.uuid4().hex[:12]}"
