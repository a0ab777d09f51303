"""Session defaults."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessera")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it is installed at the driver's path."""
    root = str(Path(__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path, shared by driver and executors, that goes when the session's JVM ends:
    below spark.checkpoint.dir, or in a temporary folder of a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tessera-")
    path = f"{shared.rstrip('/')}/tessera/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
