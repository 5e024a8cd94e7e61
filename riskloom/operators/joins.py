"""Join operators. No join is hinted: AQE broadcasts a side once it has measured it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import expressions as X

KEY = "transaction_id"


def _keys(table: DataFrame, key: str) -> DataFrame:
    """Distinct keys: repeated ones are folded map-side, before they can pile up in one task."""
    return table.select(key).distinct()


def drop_processed(df: DataFrame, processed: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not in the processed set."""
    return df.join(_keys(processed, key), key, "left_anti")


def split_by_parent(df: DataFrame, parent: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows with a parent, orphans). For persisted batches; ``mark_parent`` needs one pass."""
    keys = _keys(parent, key)
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def mark_parent(df: DataFrame, parent: DataFrame, key: str = KEY, out: str = "accepted") -> DataFrame:
    """Flag rows that have a parent, in one join."""
    known = _keys(parent, key).withColumn(out, F.lit(True))
    return df.join(known, key, "left").withColumn(out, X.flag(F.col(out)))


def keep_ids(df: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is in an id table of any size."""
    return df.join(_keys(ids, key), key, "left_semi")


def raw_with_processed(raw: DataFrame, processed: DataFrame, key: str = KEY) -> DataFrame:
    return raw.join(processed, key, "inner")


def backlog(tx: DataFrame, processed: DataFrame, key: str = KEY) -> DataFrame:
    """How many transactions wait for processing."""
    return drop_processed(tx.select(key), processed, key).agg(F.count("*").alias("unprocessed_count"))


def batch_audit(batch: DataFrame, parent: DataFrame, key: str = KEY) -> DataFrame:
    """Original, valid, skipped and fraud counts of a batch in one pass over a marked join."""
    known = F.col("known")
    return (
        mark_parent(batch.select(key, "is_fraud"), parent, key, "known")
        .agg(
            F.count("*").alias("original_count"),
            F.count_if(known).alias("valid_count"),
            F.count_if(~known).alias("skipped_count"),
            F.count_if(known & X.flag(F.col("is_fraud"))).alias("fraud_count"),
        )
        .withColumn("fraud_pct", F.round(X.ratio(F.col("fraud_count"), F.col("valid_count")) * 100, 2))
    )
