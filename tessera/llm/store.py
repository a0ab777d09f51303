"""Shared-folder tables that cut lineage.

Every iterative operator writes its intermediate results as Parquet below the folder that the
session names in ``spark.checkpoint.dir``, so a lost executor costs at most one task of the step
that was running.  Only a local master (tests, notebooks) may leave it unset; a temporary folder is
used then.

Tables go when the session's JVM ends, or with `scope` when a block of code is left.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one is set where it names none."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


_scopes: list[list[DataFrame]] = []


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Deletes the tables that `materialize` writes inside the block when it is left.  What was
    computed from them must have been written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        release(*_scopes.pop())


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and return the written table; keep: it outlives the scope."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(hadoop_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    if _scopes and not keep:
        _scopes[-1].append(out)
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables written by `materialize` that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_tessera_path", None)
        if path:
            spark = table.sparkSession
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
