"""Whole-table and grouped statistics: one aggregate each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import expressions as X


def _fraud() -> Column:
    return X.flag(F.col("is_fraud"))


def latest_instant(df: DataFrame, ts: str = "ts") -> Column:
    """The newest timestamp, as a scalar subquery."""
    return df.agg(F.max(ts).alias("m")).scalar()


def filter_recent(df: DataFrame, seconds: int, *, ts: str = "ts", ref: Column | None = None) -> DataFrame:
    """Rows not older than ``seconds`` before ``ref`` (default: the newest row)."""
    ref = latest_instant(df, ts) if ref is None else ref
    return df.filter(F.col(ts) >= ref - F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")))


def tx_statistics(tx: DataFrame) -> DataFrame:
    """Totals and the fraud percentage, NULL-safe on an empty table."""
    return tx.agg(
        F.count("*").alias("total_transactions"), F.count_if(_fraud()).alias("fraud_count")
    ).withColumn(
        "fraud_percentage",
        F.round(X.ratio(F.col("fraud_count"), F.col("total_transactions")) * 100, 2),
    )


def dq_summary(tx: DataFrame, *, seconds: int = 86400, ref: Column | None = None) -> DataFrame:
    """``tx_statistics`` over the most recent rows."""
    return tx_statistics(filter_recent(tx, seconds, ref=ref))


def recent_count(tx: DataFrame, *, seconds: int = 300, ref: Column | None = None) -> DataFrame:
    return filter_recent(tx, seconds, ref=ref).agg(F.count("*").alias("recent_rows"))


def class_distribution(tx: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows per class and each class's share."""
    counts = tx.groupBy(label).agg(F.count("*").alias("n"))
    total = tx.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("share", X.ratio(F.col("n"), total))


def amount_by_label(tx: DataFrame) -> DataFrame:
    """Mean amount, and sum and mean of fraudulent amounts."""
    fraud_amount = F.when(_fraud(), F.col("amount"))
    return tx.agg(
        F.avg("amount").alias("avg_amount"),
        F.sum(fraud_amount).alias("fraud_amount"),
        F.avg(fraud_amount).alias("avg_fraud_amount"),
    )


def distinct_categories(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count_distinct("merchant_category").alias("categories"))


def dataset_summary(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count("*").alias("n_rows"),
        F.count_if(_fraud()).alias("fraud_rows"),
        F.avg(_fraud().cast("double")).alias("fraud_mean"),
        F.avg("amount").alias("amount_mean"),
    )


def fraud_rate_by_segment(tx: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Volume, fraud count, rate and amount per segment."""
    return (
        tx.groupBy(*segments)
        .agg(
            F.count("*").alias("n"),
            F.count_if(_fraud()).alias("fraud_count"),
            F.sum(F.when(_fraud(), F.col("amount")).otherwise(0.0)).alias("fraud_amount"),
        )
        .withColumn("fraud_rate", X.ratio(F.col("fraud_count"), F.col("n")))
    )
