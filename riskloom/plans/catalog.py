"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


# Means of cents often end exactly on a rounding tie, which engines break differently;
# both sides step off the tie by the same amount before rounding.
_NUDGE = 1e-9


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types both engines print alike: rounded doubles for fractions, zone-less timestamps."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double") + _NUDGE, digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expression: str, digits: int = 6) -> str:
    """SQL rounding twin of ``comparable``; adding zero drops a negative zero."""
    return f"(ROUND(CAST({expression} AS DOUBLE) + CAST(1e-9 AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


_CATEGORIES = (
    "['gambling','adult_entertainment','cash_advance','atm_withdrawal','gas_station','jewelry',"
    "'electronics','online','restaurant','grocery','pharmacy','utilities','online_purchase','travel','retail']"
)

# The canonical transactions, as SQL.
TX = f"""ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
    ROUND(value * 10, 2) AS amount, ts,
    ({_CATEGORIES})[(k % 15) + 1] AS merchant_category,
    CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'debit_card' WHEN 'signup' THEN 'paypal'
      WHEN 'purchase' THEN 'apple_pay' WHEN 'error' THEN 'bank_transfer' END AS payment_method,
    CAST(25 AS DOUBLE) + user_id % 24 + (k % 10) / CAST(20 AS DOUBLE)
      + CASE WHEN k < 3 THEN CAST(8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS location_lat,
    CAST(-120 AS DOUBLE) + user_id % 50 + (k % 7) / CAST(20 AS DOUBLE) AS location_lng,
    'dev-' || user_id || '-' || (k % 4) AS device_id,
    event_type IN ('error', 'purchase') AND value > 100 AND k < 20 AS is_fraud
  FROM ev
)"""

ORDERS = """ord AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount, o_orderdate AS ts,
    o_orderpriority AS merchant_category, o_orderstatus = 'F' AS is_fraud FROM orders
), lines AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line, l_extendedprice AS amount,
    l_shipdate AS processed_at FROM lineitem
)"""

# Per-user statistics and the heuristic score, as SQL.
STATS = """st AS (
  SELECT user_id, COUNT(transaction_id) AS total_transactions, AVG(amount) AS user_avg_amount,
    STDDEV_SAMP(amount) AS user_std_amount, QUANTILE_DISC(amount, 0.5) AS median_amount,
    COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE) * 100 AS fraud_rate_pct
  FROM tx GROUP BY user_id
)"""

_LADDER = """CASE merchant_category WHEN 'gambling' THEN CAST(0.9 AS DOUBLE) WHEN 'adult_entertainment' THEN CAST(0.8 AS DOUBLE)
    WHEN 'cash_advance' THEN CAST(0.9 AS DOUBLE) WHEN 'atm_withdrawal' THEN CAST(0.7 AS DOUBLE)
    WHEN 'gas_station' THEN CAST(0.6 AS DOUBLE) WHEN 'jewelry' THEN CAST(0.5 AS DOUBLE)
    WHEN 'electronics' THEN CAST(0.4 AS DOUBLE) WHEN 'online' THEN CAST(0.3 AS DOUBLE)
    WHEN 'restaurant' THEN CAST(0.1 AS DOUBLE) WHEN 'grocery' THEN CAST(0.1 AS DOUBLE)
    WHEN 'pharmacy' THEN CAST(0.1 AS DOUBLE) WHEN 'utilities' THEN CAST(0.05 AS DOUBLE)
    ELSE CAST(0.2 AS DOUBLE) END"""

LADDER_SCORER = _LADDER
LADDER_BEHAVIOUR = """CASE merchant_category WHEN 'atm_withdrawal' THEN CAST(0.8 AS DOUBLE)
    WHEN 'online_purchase' THEN CAST(0.7 AS DOUBLE) WHEN 'gas_station' THEN CAST(0.6 AS DOUBLE)
    WHEN 'electronics' THEN CAST(0.5 AS DOUBLE) WHEN 'travel' THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) END"""

TEMPORAL = """CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
    dayofweek(ts) IN (0, 6) AS is_weekend, hour(ts) >= 22 OR hour(ts) <= 6 AS is_night,
    hour(ts) < 6 OR hour(ts) > 22 AS is_night_b,
    (month(ts) * 100 + day(ts)) IN (101, 704, 1225, 1104, 1231) AS is_holiday,
    CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day_of_month"""

HIGH_RISK_SCORER = """merchant_category IN ('gas_station', 'atm_withdrawal', 'gambling',
    'adult_entertainment', 'cash_advance', 'jewelry', 'electronics')"""
HIGH_RISK_BEHAVIOUR = """merchant_category IN ('atm_withdrawal', 'gas_station', 'online_purchase',
    'electronics', 'travel')"""
ROUND_SCORER = "(amount % 10 = 0 AND amount >= 100)"


def scored_sql(source: str) -> str:
    """CTE ``risk``: row risk features of ``source``, which carries user_avg_amount and user_std_amount."""
    return f"""feat AS (
  SELECT *, {TEMPORAL}, {HIGH_RISK_SCORER} AS high_risk_merchant, {ROUND_SCORER} AS amount_round,
    {_LADDER} AS merchant_risk_score,
    CASE WHEN user_std_amount > 0 THEN (amount - user_avg_amount) / user_std_amount ELSE CAST(0 AS DOUBLE) END AS amount_zscore,
    CASE WHEN user_avg_amount > 0 THEN CASE WHEN amount > user_avg_amount
        THEN 75 + LEAST(CAST(25 AS DOUBLE), (amount - user_avg_amount) / user_avg_amount * 25)
        ELSE 25 + amount / user_avg_amount * 50 END ELSE CAST(50 AS DOUBLE) END AS amount_percentile
  FROM {source}
), risk AS (
  SELECT *, merchant_risk_score * CAST(0.2 AS DOUBLE) + CAST(0.2 AS DOUBLE) * CAST(0.15 AS DOUBLE)
    + CAST(0.3 AS DOUBLE) * CAST(0.2 AS DOUBLE) + CAST(0.1 AS DOUBLE) * CAST(0.15 AS DOUBLE)
    + CASE WHEN is_night THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    + CASE WHEN amount_round THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    + LEAST(ABS(amount_zscore) / 3, CAST(1 AS DOUBLE)) * CAST(0.1 AS DOUBLE) AS fraud_probability
  FROM feat
)"""


RISK = f"""{TX}, {STATS}, enriched AS (
  SELECT tx.*, st.* EXCLUDE (user_id) FROM tx LEFT JOIN st ON tx.user_id = st.user_id
), {scored_sql('enriched')}"""

_SEC = "CAST(floor(epoch(ts)) AS BIGINT)"
_ROLL = "(PARTITION BY user_id ORDER BY sec RANGE BETWEEN {span} PRECEDING AND CURRENT ROW)"


def rolling(span: int) -> str:
    return _ROLL.format(span=span)


# Rolling behaviour, as SQL.
WINDOWS = f"""base AS (
  SELECT *, {_SEC} AS sec, {TEMPORAL} FROM tx
), win AS (
  SELECT *,
    COUNT(*) OVER {rolling(3600)} - 1 AS transactions_last_1h,
    COUNT(*) OVER {rolling(86400)} - 1 AS transactions_last_24h,
    COUNT(*) OVER {rolling(604800)} - 1 AS transactions_last_7d,
    COUNT(*) OVER {rolling(2592000)} - 1 AS transactions_last_30d,
    AVG(amount) OVER {rolling(86400)} AS user_avg_amount_24h,
    AVG(amount) OVER {rolling(604800)} AS user_avg_amount_7d,
    STDDEV_SAMP(amount) OVER {rolling(604800)} AS user_std_amount_7d,
    MAX(amount) OVER {rolling(604800)} AS user_max_amount_7d,
    LAG(sec) OVER (PARTITION BY user_id ORDER BY ts, transaction_id) AS prev_sec,
    COUNT(*) OVER (PARTITION BY user_id, merchant_category ORDER BY sec) AS user_merchant_frequency,
    COUNT(*) OVER (PARTITION BY user_id, hour_of_day ORDER BY sec) AS user_hour_frequency,
    COUNT(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history_transactions,
    AVG(amount) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history_avg_amount,
    STDDEV_SAMP(amount) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history_std_amount
  FROM base
), beh AS (
  SELECT *,
    CASE WHEN user_std_amount_7d > 0 THEN (amount - user_avg_amount_7d) / user_std_amount_7d ELSE CAST(0 AS DOUBLE) END AS amount_zscore,
    COALESCE((sec - prev_sec) / CAST(60 AS DOUBLE), CAST(999999 AS DOUBLE)) AS minutes_since_last
  FROM win
), anom AS (
  SELECT *, ABS(amount_zscore) > 2 AS amount_unusual, hour_of_day < 6 AS time_unusual,
    transactions_last_24h > 10 AS velocity_unusual, transactions_last_24h > 5 AS velocity_unusual_5,
    user_merchant_frequency = 1 AS merchant_unusual
  FROM beh
), ml AS (
  SELECT *, (CAST(amount_unusual AS INTEGER) + CAST(time_unusual AS INTEGER) + CAST(velocity_unusual AS INTEGER)
      + CAST(merchant_unusual AS INTEGER)) / CAST(4 AS DOUBLE) AS anomaly_score,
    (CAST(amount_unusual AS INTEGER) + CAST(time_unusual AS INTEGER) + CAST(velocity_unusual_5 AS INTEGER)
      + CAST(merchant_unusual AS INTEGER)) / CAST(4 AS DOUBLE) AS anomaly_score_5,
    LN(amount + 1) AS amount_log, amount % 1 = 0 AS amount_round_b,
    {HIGH_RISK_BEHAVIOUR} AS high_risk_merchant, {LADDER_BEHAVIOUR} AS merchant_risk_score
  FROM anom
)"""

# The derived run registry, as SQL.
RUNS = f"""{TX}, runs AS (
  SELECT strftime(CAST(ts AS DATE), '%Y%m%d') || '-' || payment_method AS run_id, payment_method AS model_name,
    'v1.0' AS model_version,
    SUM(CASE WHEN is_fraud = (amount > 1000) THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE) AS accuracy,
    COALESCE(COUNT(*) FILTER (WHERE is_fraud AND amount > 1000)
      / CAST(NULLIF(COUNT(*) FILTER (WHERE amount > 1000), 0) AS DOUBLE), 0) AS precision_score,
    COALESCE(COUNT(*) FILTER (WHERE is_fraud AND amount > 1000)
      / CAST(NULLIF(COUNT(*) FILTER (WHERE is_fraud), 0) AS DOUBLE), 0) AS recall_score,
    COALESCE(2 * COUNT(*) FILTER (WHERE is_fraud AND amount > 1000)
      / CAST(NULLIF(COUNT(*) FILTER (WHERE is_fraud) + COUNT(*) FILTER (WHERE amount > 1000), 0) AS DOUBLE), 0) AS f1_score,
    COUNT(*) AS training_data_count, COUNT(*) FILTER (WHERE is_fraud) AS training_fraud_count,
    MIN(ts) AS training_start, MAX(ts) AS training_end, MAX(ts) AS created_at,
    CASE WHEN COUNT(*) FILTER (WHERE is_fraud AND amount > 1000) > 0 THEN 'completed' ELSE 'failed' END AS status
  FROM tx GROUP BY CAST(ts AS DATE), payment_method
)"""

RUN_COLUMNS = f"""run_id, model_name, model_version, {r('accuracy')} AS accuracy, {r('precision_score')} AS precision_score,
    {r('recall_score')} AS recall_score, {r('f1_score')} AS f1_score, training_data_count, training_fraud_count,
    training_start, training_end, created_at, status"""
