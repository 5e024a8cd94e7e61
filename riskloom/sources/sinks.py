"""Sinks: table append, insert-if-absent, files by extension, idempotent batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_FORMATS = ("csv", "json", "parquet")
# Text formats keep microseconds; the same options read the files back.
TEXT_OPTIONS = {
    "csv": {"header": "true", "timestampFormat": _MICROS},
    "json": {"ignoreNullFields": "false", "timestampFormat": _MICROS},
}


def append_table(df: DataFrame, path: str, *, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Append over JDBC; one connection per partition, sized by ``numPartitions``."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **(properties or {})).save()


def write_batch(df: DataFrame, batch_id: int, path: str, run: str | None = None) -> None:
    """Micro-batch sink that can be replayed: a batch owns its partition and overwrites only that.

    Batch numbers start again with a new checkpoint, so a stream also names its run.
    """
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}" if run else f"{path}/batch_id={batch_id}")


def write_files(df: DataFrame, path: str, fmt: str | None = None) -> str:
    """Write CSV, JSON or Parquet; the path's extension picks the format."""
    kind = fmt or path.rsplit(".", 1)[-1].lower()
    if kind not in _FORMATS:
        raise ValueError(f"unsupported file format: {kind}")
    df.write.mode("overwrite").format(kind).options(**TEXT_OPTIONS.get(kind, {})).save(path)
    return path


def first_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the first in a total order. The rank limit runs before the shuffle too."""
    rank = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(rank)).filter("__rank = 1").drop("__rank")


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows to add: deduplicated inside the batch (before anything is shuffled), absent from the target."""
    return first_by_key(incoming, key, *order).join(target.select(key).distinct(), key, "left_anti")
