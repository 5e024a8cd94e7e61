"""Session builder and shared working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE does the runtime work: it coalesces shuffle partitions, splits skewed join
# partitions and turns a join into a broadcast only after measuring the side.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Plans are built from many small expressions; recording a Python stack for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


_local_root: str | None = None


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="riskloom-")
    return _local_root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the shared root."""
    return f"{shared_root(spark)}/riskloom/{purpose}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver collects its garbage; for frames that run once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


# Rows of a few numbers that share a file if their number is known beforehand.
FILE_ROWS = 50_000


def materialise(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """Write a frame that several steps read to the shared folder once, and read it back.

    This cuts the lineage, survives lost executors, and later steps prune columns again. If the frame is known to have no more
    than ``rows`` narrow rows, they go to as few files: without it a small frame is a file for each shuffle partition, and
    creating one costs a process for its permissions where Hadoop has no native library.
    """
    path = scratch_dir(df.sparkSession, purpose)
    with shuffles_freed(df.sparkSession):
        (df if rows is None else df.coalesce(1 + rows // FILE_ROWS)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the folder of a written frame that nothing reads any more."""
    jvm, conf = frame.sparkSession._jvm, frame.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)
