"""Detection jobs for common fraud patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import expressions as X
from riskloom.functions import fixed
from riskloom.operators import behaviour
from riskloom.operators.skew import join_null_safe
from riskloom.sources.sinks import append_table


def risk_alerts(scored: DataFrame, *, threshold: float = 0.25) -> DataFrame:
    """Alerts above a probability threshold, with the reasons that fired."""
    reasons = {
        "high_risk_merchant": F.col("high_risk_merchant"),
        "unusual_amount": F.abs("amount_zscore") > 2,
        "night": F.col("is_night"),
        "round_amount": F.col("amount_round"),
    }
    fired = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in reasons.items()]))
    return scored.filter(F.col("fraud_probability") >= threshold).select(
        "transaction_id",
        "user_id",
        F.lit("score_threshold").alias("alert_type"),
        F.col("fraud_probability").alias("risk_score"),
        X.ratio(F.size(fired), F.lit(len(reasons))).alias("confidence"),
        F.concat_ws(",", fired).alias("alert_reason"),
        F.lit(fixed.MODEL_VERSION).alias("model_version"),
    )


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append alerts to the alert table in its types, stamped with the time."""
    stamped = alerts.withColumn("created_at", F.current_timestamp())
    append_table(stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FRAUD_ALERT.fields]), path)


def detect_card_testing(
    tx: DataFrame, *, small: float = 20.0, horizon: str = "24h", at_least: int = 2
) -> DataFrame:
    """Small amounts in quick succession. Only the small ones are shuffled."""
    counted = behaviour.user_windows(
        tx.filter(F.col("amount") <= small).select("transaction_id", "user_id", "ts", "amount"),
        horizons=(horizon,), amounts=False, recency=False, frequency=False,
    )
    burst = F.col(f"transactions_last_{horizon}") + 1
    return counted.withColumn("small_amounts", burst).filter(burst >= at_least).drop(
        f"transactions_last_{horizon}"
    )


def detect_new_device(tx: DataFrame) -> DataFrame:
    """First use of a device by a user who was already active. Aggregates only, no ordering."""
    when = F.struct("ts", "transaction_id")
    first_use = tx.groupBy("user_id", "device_id").agg(F.min(when).alias("seen"))
    first_ever = tx.groupBy("user_id").agg(F.min(when).alias("start"))
    return (
        first_use.join(first_ever, "user_id")
        .filter(F.col("seen") > F.col("start"))
        .select("user_id", "device_id", F.col("seen.ts").alias("ts"), F.col("seen.transaction_id").alias("transaction_id"))
    )


def detect_geo_outlier(tx: DataFrame, *, km: float = 500.0) -> DataFrame:
    """Transactions far from the user's mean position."""
    home = tx.groupBy("user_id").agg(
        F.avg("location_lat").alias("home_lat"), F.avg("location_lng").alias("home_lng")
    )
    distance = X.haversine_km(
        F.col("location_lat"), F.col("location_lng"), F.col("home_lat"), F.col("home_lng")
    )
    places = tx.select("transaction_id", "user_id", "location_lat", "location_lng")
    return (
        join_null_safe(places, home, ["user_id"])
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") > km)
        .select("transaction_id", "user_id", "distance_km")
    )


def detect_merchant_burst(tx: DataFrame, *, width: str = "1 hour", users: int = 3) -> DataFrame:
    """Merchant categories with many distinct users in one tumbling window."""
    return (
        tx.groupBy("merchant_category", F.window("ts", width).alias("w"))
        .agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"))
        .filter(F.col("users") >= users)
        .select("merchant_category", F.col("w.start").alias("window_start"), "users", "n")
    )


def detect_new_account_spend(
    tx: DataFrame, *, merchants: Sequence[str], amount: float = 500.0, days: int = 7
) -> DataFrame:
    """Large premium purchases by young accounts. The filter runs before the join."""
    opened = tx.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    premium = tx.filter(F.col("merchant_category").isin(*merchants) & (F.col("amount") >= amount))
    age = F.unix_timestamp("ts") - F.unix_timestamp("first_ts")
    return (
        premium.select("transaction_id", "user_id", "ts", "amount", "merchant_category")
        .join(opened, "user_id")
        .filter(age <= days * 86400)
    )
