"""Table scans: Parquet by default, partitioned JDBC, typed empty fallback."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become session-zone instants; filters still reach the scan."""
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return with_instants(spark.read.format(fmt).options(**options).load(path))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """An empty typed frame when the path does not exist; every other error propagates."""
    try:
        return with_instants(spark.read.format(fmt).load(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parallel JDBC scan: ``partitions`` range queries instead of one connection."""
    return with_instants(
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **(properties or {}))
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
