"""Message and table schemas, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _I, _L, _TS = (
    T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.TimestampType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Message of the streaming scorer.
TRANSACTION = _struct(
    ("transaction_id", _S, False), ("user_id", _S, False), ("amount", _D, False),
    ("timestamp", _TS, False), ("merchant_category", _S, False), ("payment_method", _S, False),
    ("location_lat", _D, True), ("location_lng", _D, True), ("device_id", _S, True),
    ("ip_address", _S, True), ("is_fraud", _B, False), ("fraud_type", _S, True),
)

# Message of the behavioural feature job; its timestamp is text.
TRANSACTION_V2 = _struct(
    ("transaction_id", _S, False), ("user_id", _S, False), ("amount", _D, False),
    ("timestamp", _S, False), ("merchant_category", _S, False), ("is_fraud", _B, False),
    ("hour_of_day", _I, True), ("day_of_week", _I, True),
    ("is_weekend", _B, True), ("is_night", _B, True),
)

# Transactions at rest.
TRANSACTION_TABLE = _struct(
    ("transaction_id", _S, False), ("user_id", _S, False), ("amount", T.DecimalType(12, 2), False),
    ("timestamp", _TS, False), ("merchant_category", _S, False), ("payment_method", _S, False),
    ("location_lat", T.DecimalType(10, 8), True), ("location_lng", T.DecimalType(11, 8), True),
    ("device_id", _S, True), ("ip_address", _S, True), ("is_fraud", _B, False),
    ("fraud_type", _S, True), ("created_at", _TS, True),
)

# Scored transactions: the 31 payload columns.
SCORED = _struct(
    ("transaction_id", _S, False), ("user_id", _S, False), ("amount", T.DecimalType(12, 2), False),
    ("timestamp", _TS, False), ("merchant_category", _S, False), ("payment_method", _S, False),
    ("hour_of_day", _I, True), ("day_of_week", _I, True), ("is_weekend", _B, True),
    ("is_night", _B, True), ("is_holiday", _B, True),
    ("amount_zscore", T.DecimalType(8, 4), True), ("amount_percentile", T.DecimalType(5, 2), True),
    ("days_since_last", T.DecimalType(8, 2), True),
    ("transactions_last_1h", _I, True), ("transactions_last_24h", _I, True),
    ("transactions_last_7d", _I, True), ("transactions_last_30d", _I, True),
    ("user_avg_amount", T.DecimalType(12, 2), True), ("user_std_amount", T.DecimalType(12, 2), True),
    ("high_risk_merchant", _B, True), ("amount_round", _B, True),
    ("geographic_risk", T.DecimalType(5, 2), True), ("velocity_risk", T.DecimalType(5, 2), True),
    ("device_risk", T.DecimalType(5, 2), True), ("ip_risk_score", T.DecimalType(5, 2), True),
    ("device_fingerprint_risk", T.DecimalType(5, 2), True),
    ("is_fraud", _B, False), ("fraud_probability", T.DecimalType(6, 4), True),
    ("model_version", _S, True), ("processed_at", _TS, True),
)

USER_STATS = _struct(
    ("user_id", _S, False), ("total_transactions", _L, False), ("user_avg_amount", _D, True),
    ("user_std_amount", _D, True), ("median_amount", _D, True),
    ("fraud_count", _L, False), ("fraud_rate_pct", _D, True),
)

USER_PROFILE = _struct(
    ("user_id", _S, False), ("total_transactions", _L, False),
    ("total_amount", T.DecimalType(15, 2), True), ("avg_amount", T.DecimalType(12, 2), True),
    ("std_amount", T.DecimalType(12, 2), True), ("median_amount", T.DecimalType(12, 2), True),
    ("first_transaction", _TS, True), ("last_transaction", _TS, True),
    ("avg_days_between_transactions", T.DecimalType(8, 2), True),
    ("preferred_merchants", T.ArrayType(_S), True),
    ("preferred_payment_methods", T.ArrayType(_S), True),
    ("typical_transaction_hours", T.ArrayType(_I), True),
    ("home_location_lat", T.DecimalType(10, 8), True),
    ("home_location_lng", T.DecimalType(11, 8), True),
    ("fraud_count", _L, True), ("fraud_rate", T.DecimalType(6, 4), True),
    ("risk_score", T.DecimalType(6, 4), True),
)

TRAINING_RUN = _struct(
    ("run_id", _S, False), ("model_name", _S, False), ("model_version", _S, True),
    ("algorithm", _S, False), ("training_data_count", _L, True),
    ("training_fraud_count", _L, True), ("training_fraud_rate", T.DecimalType(6, 4), True),
    ("accuracy", T.DecimalType(8, 6), True), ("precision_score", T.DecimalType(8, 6), True),
    ("recall_score", T.DecimalType(8, 6), True), ("f1_score", T.DecimalType(8, 6), True),
    ("auc_roc", T.DecimalType(8, 6), True), ("auc_pr", T.DecimalType(8, 6), True),
    ("hyperparameters", _S, True), ("feature_importance", _S, True),
    ("training_start", _TS, True), ("training_end", _TS, True),
    ("training_seconds", _D, True), ("model_path", _S, True), ("status", _S, True),
    ("created_at", _TS, True),
)

FRAUD_ALERT = _struct(
    ("transaction_id", _S, False), ("user_id", _S, False), ("alert_type", _S, False),
    ("risk_score", T.DecimalType(6, 4), False), ("confidence", T.DecimalType(6, 4), False),
    ("alert_reason", _S, True), ("model_version", _S, True), ("created_at", _TS, True),
)


def required(schema: T.StructType) -> list[str]:
    """Columns a row must fill."""
    return [f.name for f in schema.fields if not f.nullable]
