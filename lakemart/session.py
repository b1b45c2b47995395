"""Session construction and shared-storage locations.

Lineage cuts and staging tables must live on storage every executor can
reach.  The cluster names that place in ``spark.checkpoint.dir``; we only
invent one (under the system temp dir) when running in local mode, as tests do.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that shape every job in the library.  AQE re-plans joins from
# runtime sizes (broadcast only when the measured side is small), coalesces
# tiny shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "lakemart", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; lakemart needs a shared folder "
            "(HDFS/S3/ABFS) to cut lineage and stage tables on a cluster")
    path = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory.

    Tables staged there may still be read by lazy results, so they go when the
    process ends (see :func:`clear_scratch`), or at once by ``remove_path`` where
    the caller knows that nothing reads them any more.
    """
    root = os.path.join(checkpoint_dir(spark).rstrip("/"), "lakemart-scratch")
    if not _SCRATCH:
        atexit.register(clear_scratch)
    _SCRATCH[root] = spark
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


_SCRATCH: dict[str, SparkSession] = {}


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write, or of a frame made meanwhile, go when it has run.

    Otherwise they stay until the driver happens to collect its garbage, so that a job of many
    writes holds those of all.  (A frame that runs again makes them again.)
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def write_table(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """``df`` as a parquet table at ``path``, read back with its schema."""
    spark = df.sparkSession
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it (driver-side metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch() -> None:
    """Remove the staged tables of this process.  Results that still read them are lost."""
    for root, spark in _SCRATCH.items():
        if spark.sparkContext._jsc is not None:  # else the session is over, and its folder is
            remove_path(spark, root)             # the cluster's to clean
    _SCRATCH.clear()
