"""The working views derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import expressions as X
from riskloom.ml import evaluate
from riskloom.sources.tables import read_table

CATEGORIES = (
    "gambling", "adult_entertainment", "cash_advance", "atm_withdrawal", "gas_station",
    "jewelry", "electronics", "online", "restaurant", "grocery", "pharmacy", "utilities",
    "online_purchase", "travel", "retail",
)
PAYMENTS = {
    "click": "credit_card", "view": "debit_card", "signup": "paypal",
    "purchase": "apple_pay", "error": "bank_transfer",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical transactions over ``events``: a narrow projection, pruned by whatever uses it."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    twenty = F.lit(20.0)
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (k % len(CATEGORIES)) + 1)
    payment = F.create_map(*[F.lit(x) for pair in PAYMENTS.items() for x in pair])
    far = F.when(k < 3, 8.0).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        user.cast("string").alias("user_id"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        "ts",
        category.alias("merchant_category"),
        F.try_element_at(payment, F.col("event_type")).alias("payment_method"),
        (F.lit(25.0) + user % 24 + (k % 10) / twenty + far).alias("location_lat"),
        (F.lit(-120.0) + user % 50 + (k % 7) / twenty).alias("location_lng"),
        F.concat(F.lit("dev-"), user.cast("string"), F.lit("-"), (k % 4).cast("string")).alias("device_id"),
        X.flag(F.col("event_type").isin("error", "purchase") & (F.col("value") > 100) & (k < 20)).alias("is_fraud"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw transactions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("merchant_category"),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as processed transactions (several per raw one)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("processed_at"),
    )


def training_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run registry derived from the transactions: one run per day and payment method,
    whose metrics are those of a large-amount rule on that slice."""
    tx = transactions(spark, sf_dir).withColumn("day", F.to_date("ts"))
    rule = tx.withColumns(
        {"label": F.col("is_fraud").cast("int"), "prediction": (F.col("amount") > 1000).cast("int")}
    )
    keys = ["day", "payment_method"]
    metrics = evaluate.threshold_metrics(rule, by=keys)
    spans = tx.groupBy(*keys).agg(
        F.min("ts").alias("training_start"), F.max("ts").alias("training_end"),
        F.count("*").alias("training_data_count"),
        F.count_if("is_fraud").alias("training_fraud_count"),
    )
    return metrics.join(spans, keys).select(
        F.concat_ws("-", F.date_format("day", "yyyyMMdd"), "payment_method").alias("run_id"),
        F.col("payment_method").alias("model_name"),
        F.lit("v1.0").alias("model_version"),
        "accuracy",
        F.col("precision").alias("precision_score"),
        F.col("recall").alias("recall_score"),
        "f1_score",
        "training_data_count",
        "training_fraud_count",
        "training_start",
        "training_end",
        F.col("training_end").alias("created_at"),
        F.when(F.col("true_positives") > 0, "completed").otherwise("failed").alias("status"),
    )
