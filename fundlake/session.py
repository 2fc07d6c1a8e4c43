"""Session helpers: building a local session for tests and benches, and
finding the shared folder where lineage-cutting tables are written."""

from __future__ import annotations

import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", app: str = "fundlake", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let AQE keep enough partitions to use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared file system.  Only a local
    session may leave it unset, as tests do; it then gets a fresh temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="fundlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if root.startswith("file:"):
        root = root[len("file:"):]
        root = "/" + root.lstrip("/")
    return root.rstrip("/")


def path_missing(error: AnalysisException) -> bool:
    """True if a read failed because nothing is stored there; any other fault is a fault."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
