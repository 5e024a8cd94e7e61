"""Fixed values. They define the results, so they are stated as they are."""

# Merchant categories that count as high risk in the streaming scorer.
HIGH_RISK_SCORER = (
    "gas_station",
    "atm_withdrawal",
    "gambling",
    "adult_entertainment",
    "cash_advance",
    "jewelry",
    "electronics",
)

# Merchant risk scores of the streaming scorer, and its default.
RISK_SCORER = {
    "gambling": 0.9,
    "adult_entertainment": 0.8,
    "cash_advance": 0.9,
    "atm_withdrawal": 0.7,
    "gas_station": 0.6,
    "jewelry": 0.5,
    "electronics": 0.4,
    "online": 0.3,
    "restaurant": 0.1,
    "grocery": 0.1,
    "pharmacy": 0.1,
    "utilities": 0.05,
}
RISK_DEFAULT = 0.2

# Merchant risk scores of the behavioural features (same default);
# the categories listed here are also that pipeline's high-risk set.
RISK_BEHAVIOUR = {
    "atm_withdrawal": 0.8,
    "gas_station": 0.6,
    "online_purchase": 0.7,
    "electronics": 0.5,
    "travel": 0.4,
}

# Holidays as (month, day).
HOLIDAYS = ((1, 1), (7, 4), (12, 25), (11, 4), (12, 31))

# Risk columns that the scorer fills with constants.
CONSTANT_RISKS = {
    "geographic_risk": 0.2,
    "velocity_risk": 0.3,
    "device_risk": 0.1,
    "ip_risk_score": 0.2,
    "device_fingerprint_risk": 0.1,
}

# Weights of the heuristic fraud probability.
SCORE_WEIGHTS = {
    "merchant_risk_score": 0.2,
    "geographic_risk": 0.15,
    "velocity_risk": 0.2,
    "device_risk": 0.15,
}
SCORE_NIGHT = 0.05
SCORE_ROUND = 0.05
SCORE_ZSCORE = 0.1
SCORE_ZSCORE_CAP = 3.0
MODEL_VERSION = "v1.0"

# Null fills of the behavioural feature table.
NULL_FILLS = {
    "user_avg_amount_7d": 0.0,
    "amount_zscore": 0.0,
    "transactions_last_24h": 0,
    "transactions_last_7d": 0,
    "minutes_since_last": 999999.0,
    "user_merchant_frequency": 1,
    "user_hour_frequency": 1,
    "anomaly_score": 0.0,
}
FIRST_TRANSACTION_MINUTES = 999999.0

# Business-impact assumptions.
FRAUD_LOSS_RATE = 0.7
INVESTIGATION_COST = 50.0

# Timestamp text format, microseconds optional.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

# Rolling horizons in seconds.
# Amounts are decimal(12, 2) in the tables.
AMOUNT_LIMIT = 1e10

HORIZONS = {"1h": 3600, "24h": 86400, "7d": 604800, "30d": 2592000}

# Columns of the training extract.
TRAINING_COLUMNS = (
    "transaction_id", "user_id", "amount", "merchant_category", "payment_method",
    "hour_of_day", "day_of_week", "is_weekend", "is_night", "is_holiday",
    "amount_zscore", "amount_percentile", "days_since_last",
    "transactions_last_1h", "transactions_last_24h", "transactions_last_7d", "transactions_last_30d",
    "user_avg_amount", "user_std_amount", "high_risk_merchant", "amount_round",
    "geographic_risk", "velocity_risk", "device_risk", "ip_risk_score",
    "device_fingerprint_risk", "is_fraud", "processed_at",
)

# Feature lists of the two training matrices.
MATRIX_NUMERIC = (
    "amount", "hour_of_day", "day_of_week", "amount_zscore", "amount_percentile",
    "days_since_last", "transactions_last_1h", "transactions_last_24h",
    "transactions_last_7d", "transactions_last_30d", "user_avg_amount",
    "user_std_amount", "geographic_risk", "velocity_risk", "device_risk",
    "ip_risk_score", "device_fingerprint_risk",
)
MATRIX_BOOLEAN = ("is_weekend", "is_night", "is_holiday", "high_risk_merchant", "amount_round")
MATRIX_CATEGORY = ("merchant_category", "payment_method")

MATRIX2_NUMERIC = (
    "amount", "hour_of_day", "day_of_week", "amount_log", "amount_zscore",
    "merchant_risk_score", "transactions_last_24h", "transactions_last_7d",
    "user_avg_amount_7d", "minutes_since_last", "user_merchant_frequency",
    "user_hour_frequency", "anomaly_score",
)
MATRIX2_BOOLEAN = (
    "is_weekend", "is_night", "amount_round", "high_risk_merchant",
    "amount_unusual", "velocity_unusual",
)
MATRIX2_CATEGORY = ("merchant_category",)

# Columns of the behavioural feature table.
ML_TABLE_COLUMNS = (
    "transaction_id", "user_id", "ts", "amount", "merchant_category",
    "hour_of_day", "day_of_week", "is_weekend", "is_night",
    "amount_log", "amount_round", "amount_zscore",
    "high_risk_merchant", "merchant_risk_score",
    "transactions_last_24h", "transactions_last_7d",
    "user_avg_amount_7d", "minutes_since_last",
    "user_merchant_frequency", "user_hour_frequency",
    "anomaly_score", "amount_unusual", "velocity_unusual", "is_fraud",
)
