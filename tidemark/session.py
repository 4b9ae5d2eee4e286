"""Session helpers: building a local session for tests and preparing any session for the library.

The library never decides where a cluster keeps its shared scratch space. It reads
``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from the session and only
falls back to a fresh local folder when nothing is configured, which is the test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tidemark", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench: AQE on, UTC clock, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings every tidemark job relies on.

    * UTC session clock: commerce timestamps arrive as ``...Z`` instants and all windows are UTC days.
    * A reliable checkpoint directory: taken from the session; a local folder only if none is set.
    * A task that writes several buckets keeps a file open for each, as long as they are few, instead of sorting its rows.
    * Sides of a join that are shuffled by some of its keys already are not shuffled again by all of them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "20")
    if hasattr(spark, "_jsparkSession"):  # without a classic SparkContext (Spark Connect) the server's settings decide
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Unset only in tests / local runs: use a private local folder for this JVM.
        key = sc.applicationId
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        conf_dir = _LOCAL_FALLBACK[key]
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique folder under the shared checkpoint directory (tables, staging, stream checkpoints)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tidemark", *parts, uuid.uuid4().hex[:12]])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
