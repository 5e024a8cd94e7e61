"""Queries over the transactions: scalar features, history, windows, detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import fixed
from riskloom.ml import jobs
from riskloom.operators import behaviour, detect, features, history, limits, summaries
from riskloom.plans import catalog as C
from riskloom.plans import views
from riskloom.plans.catalog import comparable, query, r
from riskloom.session import scratch_dir

TX, RISK, WINDOWS = C.TX, C.RISK, C.WINDOWS


@query("parse_timestamp", f"""WITH {TX} SELECT transaction_id, ts, date_trunc('second', ts) AS ts_seconds FROM tx""")
def _parse_timestamp(spark, sf):
    tx = views.transactions(spark, sf).select(
        "transaction_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("seconds"),
    )
    parsed = features.parse_timestamp(features.parse_timestamp(tx, "micros"), "seconds", "ts_seconds")
    return comparable(parsed.select("transaction_id", "ts", "ts_seconds"))


@query("feat_temporal", f"WITH {TX} SELECT transaction_id, {C.TEMPORAL} FROM tx")
def _temporal(spark, sf):
    return features.temporal_features(views.transactions(spark, sf).select("transaction_id", "ts")).drop("ts")


@query("feat_amount", f"""WITH {TX} SELECT transaction_id, {r('amount')} AS amount, {r('LN(amount + 1)')} AS amount_log,
    {C.ROUND_SCORER} AS amount_round, amount % 1 = 0 AS amount_round_b, amount > 1000 AS amount_large,
    amount < 10 AS amount_small FROM tx""")
def _amount(spark, sf):
    return comparable(features.amount_features(views.transactions(spark, sf).select("transaction_id", "amount")))


@query("feat_merchant", f"""WITH {TX} SELECT transaction_id, {C.HIGH_RISK_SCORER} AS high_risk_merchant,
    {C.LADDER_SCORER} AS merchant_risk_score, {C.HIGH_RISK_BEHAVIOUR} AS high_risk_merchant_b,
    {C.LADDER_BEHAVIOUR} AS merchant_risk_score_b FROM tx""")
def _merchant(spark, sf):
    tx = views.transactions(spark, sf).select("transaction_id", "merchant_category")
    second = features.merchant_features(tx).withColumnsRenamed(
        {"high_risk_merchant": "high_risk_merchant_b", "merchant_risk_score": "merchant_risk_score_b"}
    )
    return features.scorer_merchant_features(second).drop("merchant_category")


SCORED_SQL = f"""SELECT transaction_id, user_id, {r('CAST(amount AS DECIMAL(12,2))')} AS amount, ts AS "timestamp",
    merchant_category, payment_method, hour_of_day, day_of_week, is_weekend, is_night, is_holiday,
    {r('CAST(amount_zscore AS DECIMAL(8,4))')} AS amount_zscore,
    {r('CAST(amount_percentile AS DECIMAL(5,2))')} AS amount_percentile,
    {{velocity}},
    {r('CAST(user_avg_amount AS DECIMAL(12,2))')} AS user_avg_amount,
    {r('CAST(user_std_amount AS DECIMAL(12,2))')} AS user_std_amount,
    high_risk_merchant, amount_round, CAST(0.2 AS DOUBLE) AS geographic_risk, CAST(0.3 AS DOUBLE) AS velocity_risk,
    CAST(0.1 AS DOUBLE) AS device_risk, CAST(0.2 AS DOUBLE) AS ip_risk_score,
    CAST(0.1 AS DOUBLE) AS device_fingerprint_risk, is_fraud,
    {r('CAST(fraud_probability AS DECIMAL(6,4))')} AS fraud_probability, 'v1.0' AS model_version FROM risk"""

CONSTANT_VELOCITY = "CAST(1 AS DOUBLE) AS days_since_last, " + ", ".join(
    f"CAST(0 AS INTEGER) AS transactions_last_{h}" for h in ("1h", "24h", "7d", "30d")
)


@query("feat_rt_scored", f"WITH {RISK} {SCORED_SQL.format(velocity=CONSTANT_VELOCITY)}")
def rt_scored(spark, sf):
    tx = views.transactions(spark, sf)
    return comparable(history.score(tx, history.user_stats(tx)).drop("processed_at"))


_FULL = f"""{TX}, {WINDOWS}, enriched AS (
  SELECT * EXCLUDE ({', '.join(('hour_of_day', 'day_of_week', 'is_weekend', 'is_night', 'is_night_b', 'is_holiday', 'month', 'day_of_month', 'amount_zscore'))}),
    history_avg_amount AS user_avg_amount, history_std_amount AS user_std_amount FROM beh
), {C.scored_sql('enriched')}"""

@query("feat_rt_full", f"""WITH {_FULL} SELECT transaction_id, user_id, {r('amount_zscore', 5)} AS amount_zscore,
    {r('amount_percentile', 5)} AS amount_percentile,
    {r('CASE WHEN minutes_since_last < 999999 THEN minutes_since_last / 1440 END', 5)} AS days_since_last,
    transactions_last_1h, transactions_last_24h, transactions_last_7d, transactions_last_30d,
    {r('user_avg_amount', 5)} AS user_avg_amount, {r('user_std_amount', 5)} AS user_std_amount,
    {r('fraud_probability', 5)} AS fraud_probability FROM risk""")
def _rt_full(spark, sf):
    tx = views.transactions(spark, sf)
    windows = behaviour.user_windows(tx, frequency=False, as_of=True)
    risk = history.risk_columns(history.as_of_history(windows))
    return comparable(
        risk.select(
            "transaction_id", "user_id", "amount_zscore", "amount_percentile", "days_since_last",
            "transactions_last_1h", "transactions_last_24h", "transactions_last_7d", "transactions_last_30d",
            "user_avg_amount", "user_std_amount", "fraud_probability",
        ),
        digits=5,
    )


@query("agg_user_stats", f"""WITH {TX}, {C.STATS} SELECT user_id, total_transactions,
    {r('user_avg_amount')} AS user_avg_amount, {r('user_std_amount')} AS user_std_amount,
    {r('median_amount')} AS median_amount, fraud_count, {r('fraud_rate_pct')} AS fraud_rate_pct FROM st""")
def _user_stats(spark, sf):
    return comparable(history.user_stats(views.transactions(spark, sf)))


@query("agg_user_stats_asof", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, history_transactions,
    {r('history_avg_amount', 5)} AS history_avg_amount, {r('history_std_amount', 5)} AS history_std_amount FROM win""")
def _user_stats_asof(spark, sf):
    tx = views.transactions(spark, sf)
    out = history.user_stats_asof(tx.select("transaction_id", "user_id", "ts", "amount"))
    return comparable(
        out.select("transaction_id", "history_transactions", "history_avg_amount", "history_std_amount"), digits=5
    )


@query("join_user_history", f"""WITH {TX}, {C.STATS} SELECT tx.transaction_id, tx.user_id, {r('tx.amount')} AS amount,
    total_transactions, {r('user_avg_amount')} AS user_avg_amount, {r('user_std_amount')} AS user_std_amount
    FROM tx LEFT JOIN (SELECT user_id, COUNT(*) AS total_transactions, AVG(amount) AS user_avg_amount,
      STDDEV_SAMP(amount) AS user_std_amount FROM tx WHERE ts < TIMESTAMP '2024-01-03' GROUP BY user_id) h
    ON tx.user_id = h.user_id""")
def _join_history(spark, sf):
    """Every transaction against the history of the first two days: later users are unknown."""
    tx = views.transactions(spark, sf)
    stats = history.user_stats(tx.filter(F.col("ts") < F.lit("2024-01-03").cast("timestamp")))
    joined = history.enrich(tx.select("transaction_id", "user_id", "amount"), stats)
    return comparable(
        joined.select("transaction_id", "user_id", "amount", "total_transactions", "user_avg_amount", "user_std_amount")
    )


@query("user_profiles", f"""WITH {TX} SELECT user_id, COUNT(*) AS total_transactions, {r('SUM(amount)', 4)} AS total_amount,
    {r('AVG(amount)', 4)} AS avg_amount, MIN(ts) AS first_transaction, MAX(ts) AS last_transaction,
    COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    {r('COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE)', 4)} AS fraud_rate FROM tx GROUP BY user_id""")
def _profiles(spark, sf):
    return comparable(history.user_profiles(views.transactions(spark, sf)), digits=4)


def _ranked_sql(value: str, name: str) -> str:
    return f"""{name} AS (SELECT user_id, string_agg(CAST({value} AS VARCHAR), ',' ORDER BY rn) AS {name} FROM (
      SELECT user_id, {value}, row_number() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, {value}) AS rn
      FROM hours GROUP BY user_id, {value}) WHERE rn <= 3 GROUP BY user_id)"""


@query("profile_preferences", f"""WITH {TX}, hours AS (SELECT *, hour(ts) AS hour_of_day FROM tx),
  {_ranked_sql('merchant_category', 'preferred_merchants')},
  {_ranked_sql('payment_method', 'preferred_payment_methods')},
  {_ranked_sql('hour_of_day', 'typical_transaction_hours')},
  gaps AS (SELECT user_id, AVG(g) / 86400 AS gap FROM (SELECT user_id,
      {C._SEC} - LAG({C._SEC}) OVER (PARTITION BY user_id ORDER BY ts, transaction_id) AS g FROM tx) GROUP BY user_id),
  base AS (SELECT user_id, STDDEV_SAMP(amount) AS sd, QUANTILE_DISC(amount, 0.5) AS med, AVG(location_lat) AS lat,
      AVG(location_lng) AS lng FROM tx GROUP BY user_id)
  SELECT user_id, {r('sd')} AS std_amount, {r('med')} AS median_amount, {r('lat')} AS home_location_lat,
    {r('lng')} AS home_location_lng, {r('gap')} AS avg_days_between_transactions, preferred_merchants,
    preferred_payment_methods, typical_transaction_hours
  FROM base JOIN gaps USING (user_id) JOIN preferred_merchants USING (user_id)
    JOIN preferred_payment_methods USING (user_id) JOIN typical_transaction_hours USING (user_id)""")
def _preferences(spark, sf):
    out = history.profile_preferences(views.transactions(spark, sf))
    arrays = ("preferred_merchants", "preferred_payment_methods", "typical_transaction_hours")
    return comparable(
        out.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in arrays})
    )


@query("profile_table", f"""WITH {RISK}, hours AS (SELECT *, hour(ts) AS hour_of_day FROM tx),
  {_ranked_sql('merchant_category', 'preferred_merchants')},
  {_ranked_sql('hour_of_day', 'typical_transaction_hours')},
  base AS (SELECT user_id, COUNT(*) AS total_transactions, {r('SUM(amount)', 2)} AS total_amount, MIN(ts) AS first_transaction,
    MAX(ts) AS last_transaction, COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    {r('CAST(COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE) AS DECIMAL(6, 4))')} AS fraud_rate FROM tx GROUP BY user_id),
  score AS (SELECT user_id, {r('CAST(AVG(fraud_probability) AS DECIMAL(6, 4))')} AS risk_score FROM risk GROUP BY user_id)
  SELECT * FROM base JOIN score USING (user_id) JOIN preferred_merchants USING (user_id) JOIN typical_transaction_hours USING (user_id)""")
def _profile_table(spark, sf):
    """The typed profile table, written and read back."""
    path = scratch_dir(spark, "profiles")
    history.profile_table(views.transactions(spark, sf)).write.parquet(path)
    table = spark.read.schema(schemas.USER_PROFILE).parquet(path)
    arrays = ("preferred_merchants", "typical_transaction_hours")
    return comparable(
        table.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in arrays}).select(
            "user_id", "total_transactions", "total_amount", "first_transaction", "last_transaction", "fraud_count", "fraud_rate", "risk_score", *arrays
        )
    )


@query("win_velocity", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, transactions_last_1h, transactions_last_24h,
    transactions_last_7d, transactions_last_30d FROM win""")
def _velocity(spark, sf):
    tx = views.transactions(spark, sf)
    out = behaviour.user_windows(
        tx.select("transaction_id", "user_id", "ts", "amount"), amounts=False, recency=False, frequency=False,
    )
    return out.drop("user_id", "ts", "amount")


@query("win_amount_stats", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, {r('user_avg_amount_24h')} AS user_avg_amount_24h,
    {r('user_avg_amount_7d')} AS user_avg_amount_7d, {r('user_std_amount_7d')} AS user_std_amount_7d,
    {r('user_max_amount_7d')} AS user_max_amount_7d FROM win""")
def _amount_stats(spark, sf):
    return comparable(_behaviour(spark, sf).select(
        "transaction_id", "user_avg_amount_24h", "user_avg_amount_7d", "user_std_amount_7d", "user_max_amount_7d"))


def _behaviour(spark, sf):
    tx = views.transactions(spark, sf)
    return behaviour.behaviour_features(
        tx.select("transaction_id", "user_id", "ts", "amount")
    )


@query("win_zscore", f"WITH {TX}, {WINDOWS} SELECT transaction_id, {r('amount_zscore')} AS amount_zscore FROM beh")
def _zscore(spark, sf):
    return comparable(_behaviour(spark, sf).select("transaction_id", "amount_zscore"))


@query("win_recency", f"WITH {TX}, {WINDOWS} SELECT transaction_id, {r('minutes_since_last')} AS minutes_since_last FROM beh")
def _recency(spark, sf):
    return comparable(_behaviour(spark, sf).select("transaction_id", "minutes_since_last"))


@query("win_user_totals", f"""WITH {TX} SELECT transaction_id, COUNT(*) OVER u AS total_transactions,
    {r('AVG(amount) OVER u')} AS user_avg_amount, {r('STDDEV_SAMP(amount) OVER u')} AS user_std_amount,
    CAST(SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END) OVER u AS BIGINT) AS fraud_count
    FROM tx WINDOW u AS (PARTITION BY user_id)""")
def _user_totals(spark, sf):
    out = history.with_user_totals(views.transactions(spark, sf))
    return comparable(
        out.select("transaction_id", "total_transactions", "user_avg_amount", "user_std_amount", "fraud_count")
    )


_HEAVY = (
    C.TX.replace("), tx AS (", "), given AS (", 1)
    + ", tx AS (SELECT * REPLACE (CAST(CAST(user_id AS BIGINT) % 2 AS VARCHAR) AS user_id) FROM given)"
)


@query("win_heavy_users", f"""WITH {_HEAVY}, {WINDOWS} SELECT transaction_id, transactions_last_1h, transactions_last_24h,
    transactions_last_7d, transactions_last_30d, {r('user_avg_amount_24h', 4)} AS user_avg_amount_24h,
    {r('user_avg_amount_7d', 4)} AS user_avg_amount_7d, {r('user_std_amount_7d', 4)} AS user_std_amount_7d,
    {r('user_max_amount_7d', 4)} AS user_max_amount_7d, user_merchant_frequency, user_hour_frequency FROM win""")
def _heavy_users(spark, sf):
    """All windows when two users hold every row."""
    tx = views.transactions(spark, sf).withColumn("user_id", (F.col("user_id").cast("long") % 2).cast("string"))
    out = behaviour.user_windows(tx.select("transaction_id", "user_id", "ts", "amount", "merchant_category"), recency=False)
    return comparable(out.drop("user_id", "ts", "amount", "merchant_category", "hour_of_day", "amount_zscore"), digits=4)


@query("win_frequency", f"WITH {TX}, {WINDOWS} SELECT transaction_id, user_merchant_frequency, user_hour_frequency FROM win")
def _frequency(spark, sf):
    tx = views.transactions(spark, sf)
    rows = tx.select("transaction_id", "user_id", "ts", "amount", "merchant_category")
    return behaviour.frequency_features(rows).select(
        "transaction_id", "user_merchant_frequency", "user_hour_frequency"
    )


@query("feat_anomaly", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, amount_unusual, time_unusual, velocity_unusual,
    merchant_unusual, anomaly_score, velocity_unusual_5, anomaly_score_5 FROM ml""")
def _anomaly(spark, sf):
    tx = views.transactions(spark, sf)
    rows = behaviour.user_windows(features.temporal_features(tx), horizons=("24h",))
    default = features.anomaly_features(rows)
    kept = default.withColumns({"vu": F.col("velocity_unusual"), "score": F.col("anomaly_score")})
    lower = features.anomaly_features(kept, velocity=5)
    return lower.select(
        "transaction_id", "amount_unusual", "time_unusual", F.col("vu").alias("velocity_unusual"), "merchant_unusual",
        F.col("score").alias("anomaly_score"), F.col("velocity_unusual").alias("velocity_unusual_5"),
        F.col("anomaly_score").alias("anomaly_score_5"),
    )


@query("feat_ml_table", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, user_id, ts, {r('amount')} AS amount, merchant_category,
    hour_of_day, day_of_week, is_weekend, is_night_b AS is_night, {r('amount_log')} AS amount_log,
    amount_round_b AS amount_round, {r('amount_zscore')} AS amount_zscore, high_risk_merchant, merchant_risk_score,
    transactions_last_24h, transactions_last_7d, {r('user_avg_amount_7d')} AS user_avg_amount_7d,
    {r('minutes_since_last')} AS minutes_since_last, user_merchant_frequency, user_hour_frequency,
    anomaly_score, amount_unusual, velocity_unusual, is_fraud FROM ml""")
def ml_table(spark, sf):
    tx = views.transactions(spark, sf)
    return comparable(behaviour.build_ml_features(tx))


@query("impute_constant", f"""WITH {TX}, {WINDOWS}, gaps AS (SELECT transaction_id, CASE WHEN transactions_last_24h > 0
      THEN transactions_last_24h END AS t24, user_std_amount_7d, prev_sec, amount_zscore FROM beh)
    SELECT transaction_id, COALESCE(t24, 0) AS transactions_last_24h,
      {r('COALESCE(user_std_amount_7d, 1)')} AS user_std_amount_7d, {r('amount_zscore')} AS amount_zscore FROM gaps""")
def _impute_constant(spark, sf):
    rows = _behaviour(spark, sf).withColumn(
        "transactions_last_24h", F.when(F.col("transactions_last_24h") > 0, F.col("transactions_last_24h"))
    )
    filled = features.fill_constants(
        rows, {"transactions_last_24h": 0, "user_std_amount_7d": 1.0, "amount_zscore": 0.0, "not_a_column": 9}
    )
    return comparable(filled.select("transaction_id", "transactions_last_24h", "user_std_amount_7d", "amount_zscore"))


@query("impute_statistic", f"""WITH {TX}, {WINDOWS}, g AS (SELECT transaction_id, amount,
      CASE WHEN transactions_last_24h > 0 THEN user_avg_amount_24h END AS avg24,
      (sec - prev_sec) / CAST(60 AS DOUBLE) AS gap FROM win),
    s AS (SELECT AVG(amount) AS m, QUANTILE_DISC(gap, 0.5) AS med FROM g)
    SELECT transaction_id, {r('COALESCE(avg24, m)')} AS user_avg_amount_24h, {r('COALESCE(gap, med)')} AS minutes_since_last
    FROM g, s""")
def _impute_statistic(spark, sf):
    rows = _behaviour(spark, sf).withColumns(
        {
            "user_avg_amount_24h": F.when(F.col("transactions_last_24h") > 0, F.col("user_avg_amount_24h")),
            "minutes_since_last": F.nullif("minutes_since_last", F.lit(999999.0)),
        }
    )
    filled = features.fill_statistics(rows, {"user_avg_amount_24h": "amount"}, ["minutes_since_last"])
    return comparable(filled.select("transaction_id", "user_avg_amount_24h", "minutes_since_last"))


@query("scrub_inf", f"""WITH {TX} SELECT transaction_id,
    {r("CASE WHEN amount % 1 = 0 THEN CAST(0 AS DOUBLE) ELSE 1 / (amount % 1) END", 4)} AS inverse_cents FROM tx""")
def _scrub(spark, sf):
    """Inverse of the cents: infinite on whole amounts, then scrubbed."""
    cents = F.col("amount") % 1
    rows = views.transactions(spark, sf).select(
        "transaction_id", F.when(cents == 0, float("inf")).otherwise(1 / F.nullif(cents, F.lit(0.0))).alias("inverse_cents")
    )
    return comparable(features.scrub_infinite(rows, ["inverse_cents"]), digits=4)


@query("filter_recent", f"""WITH {TX} SELECT transaction_id, ts FROM tx
    WHERE ts >= (SELECT MAX(ts) FROM tx) - INTERVAL 7 DAY""")
def _filter_recent(spark, sf):
    tx = views.transactions(spark, sf).select("transaction_id", "ts")
    return comparable(summaries.filter_recent(tx, 7 * 86400))


@query("filter_label", f"WITH {TX} SELECT transaction_id, user_id, {r('amount')} AS amount FROM tx WHERE is_fraud IS NOT NULL AND is_fraud")
def _filter_label(spark, sf):
    tx = views.transactions(spark, sf).filter(F.col("is_fraud").isNotNull() & F.col("is_fraud"))
    return comparable(tx.select("transaction_id", "user_id", "amount"))


@query("filter_id_set", f"""WITH {TX} SELECT transaction_id, user_id FROM tx WHERE user_id IN
    (SELECT user_id FROM tx WHERE is_fraud)""")
def _filter_ids(spark, sf):
    from riskloom.operators.joins import keep_ids

    tx = views.transactions(spark, sf)
    return keep_ids(tx.select("transaction_id", "user_id"), tx.filter("is_fraud"), "user_id").select(
        "transaction_id", "user_id"
    )


@query("dq_summary", f"""WITH {TX} SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    ROUND(COUNT(*) FILTER (WHERE is_fraud) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) * 100, 2) AS fraud_percentage
    FROM tx WHERE ts >= (SELECT MAX(ts) FROM tx) - INTERVAL 1 DAY""")
def _dq(spark, sf):
    return summaries.dq_summary(views.transactions(spark, sf))


@query("tx_statistics", f"""WITH {TX} SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    ROUND(COUNT(*) FILTER (WHERE is_fraud) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) * 100, 2) AS fraud_percentage FROM tx""")
def _statistics(spark, sf):
    return summaries.tx_statistics(views.transactions(spark, sf))


@query("recent_count", f"WITH {TX} SELECT COUNT(*) AS recent_rows FROM tx WHERE ts >= (SELECT MAX(ts) FROM tx) - INTERVAL 6 HOUR")
def _recent_count(spark, sf):
    return summaries.recent_count(views.transactions(spark, sf), seconds=6 * 3600)


@query("class_distribution", f"""WITH {TX} SELECT is_fraud, COUNT(*) AS n,
    {r('COUNT(*) / CAST((SELECT COUNT(*) FROM tx) AS DOUBLE)')} AS share FROM tx GROUP BY is_fraud""")
def _classes(spark, sf):
    return comparable(summaries.class_distribution(views.transactions(spark, sf)))


@query("amount_by_label", f"""WITH {TX} SELECT {r('AVG(amount)', 4)} AS avg_amount,
    {r('SUM(amount) FILTER (WHERE is_fraud)', 4)} AS fraud_amount,
    {r('AVG(amount) FILTER (WHERE is_fraud)', 4)} AS avg_fraud_amount FROM tx""")
def _amount_by_label(spark, sf):
    return comparable(summaries.amount_by_label(views.transactions(spark, sf)), digits=4)


@query("distinct_categories", f"WITH {TX} SELECT COUNT(DISTINCT merchant_category) AS categories FROM tx")
def _distinct(spark, sf):
    return summaries.distinct_categories(views.transactions(spark, sf))


@query("dataset_summary", f"""WITH {TX} SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE is_fraud) AS fraud_rows,
    {r('COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE)')} AS fraud_mean,
    {r('AVG(amount)')} AS amount_mean FROM tx""")
def _dataset(spark, sf):
    return comparable(summaries.dataset_summary(views.transactions(spark, sf)))


@query("fraud_rate_by_segment", f"""WITH {TX} SELECT merchant_category, payment_method, CAST(hour(ts) AS INTEGER) AS hour_of_day,
    COUNT(*) AS n, COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    {r('COALESCE(SUM(amount) FILTER (WHERE is_fraud), 0)')} AS fraud_amount,
    {r('COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE)')} AS fraud_rate
    FROM tx GROUP BY merchant_category, payment_method, hour(ts)""")
def _segments(spark, sf):
    tx = views.transactions(spark, sf).withColumn("hour_of_day", F.hour("ts"))
    out = summaries.fraud_rate_by_segment(tx, ["merchant_category", "payment_method", "hour_of_day"])
    return comparable(out)


@query("newest_n", f"""WITH {TX} SELECT transaction_id, user_id, ts FROM tx ORDER BY ts DESC, transaction_id DESC LIMIT 1000""")
def _newest(spark, sf):
    tx = views.transactions(spark, sf).select("transaction_id", "user_id", "ts")
    return comparable(limits.newest_n(tx, 1000))


@query("sort_by_time", f"WITH {TX} SELECT transaction_id, user_id, ts FROM tx ORDER BY ts, transaction_id")
def _sort(spark, sf):
    tx = views.transactions(spark, sf).select("transaction_id", "user_id", "ts")
    return comparable(limits.sort_by_time(tx))


_EXTRACT_SQL = SCORED_SQL.format(velocity=CONSTANT_VELOCITY).replace(' FROM risk', '')


@query("train_extract", f"""WITH {RISK} SELECT * EXCLUDE ("timestamp", fraud_probability, model_version) FROM (
    {_EXTRACT_SQL} FROM risk WHERE ts >= (SELECT MAX(ts) FROM risk) - INTERVAL 7 DAY)""")
def _extract(spark, sf):
    tx = views.transactions(spark, sf)
    scored = history.score(tx, history.user_stats(tx))
    out = limits.training_extract(
        scored, fixed.TRAINING_COLUMNS, ts="timestamp", seconds=7 * 86400, ref=summaries.latest_instant(tx)
    )
    return comparable(out.drop("processed_at"))


@query("guard_min_rows", f"""WITH {TX}, n AS (SELECT COUNT(*) AS c FROM tx WHERE is_fraud) SELECT 'fraud' AS data,
    LEAST(c, 100) AS rows_seen, CAST(100 AS BIGINT) AS min_rows,
    CASE WHEN c >= 100 THEN 'ok' ELSE 'insufficient_data' END AS status FROM n
    UNION ALL SELECT 'all', LEAST((SELECT COUNT(*) FROM tx), 1000), 1000,
    CASE WHEN (SELECT COUNT(*) FROM tx) >= 1000 THEN 'ok' ELSE 'insufficient_data' END""")
def _guard(spark, sf):
    tx = views.transactions(spark, sf)
    fraud = limits.guard_min_rows(tx.filter("is_fraud"), 100).withColumn("data", F.lit("fraud"))
    return fraud.unionByName(limits.guard_min_rows(tx, 1000).withColumn("data", F.lit("all")))


def _registered(spark, sf):
    """The runs, written to a registry and read back."""
    path, runs = scratch_dir(spark, "registry"), views.training_runs(spark, sf)
    jobs.append_runs(runs.withColumn("algorithm", F.lit("rule")), path)
    return jobs.read_runs(spark, path).select(*runs.columns)


@query("latest_run", f"WITH {C.RUNS} SELECT {C.RUN_COLUMNS} FROM runs ORDER BY training_start DESC, run_id DESC LIMIT 1")
def _latest_run(spark, sf):
    return comparable(limits.latest_run(_registered(spark, sf)))


@query("recent_models", f"""WITH {C.RUNS} SELECT {C.RUN_COLUMNS} FROM runs WHERE status = 'completed'
    ORDER BY training_start DESC, run_id DESC LIMIT 3""")
def _recent_models(spark, sf):
    return comparable(limits.recent_models(_registered(spark, sf)))


@query("beyond_latest_n", f"""WITH {C.RUNS} SELECT {C.RUN_COLUMNS} FROM (SELECT *, row_number() OVER (
    ORDER BY created_at DESC, run_id DESC) AS rn FROM runs WHERE status = 'completed') WHERE rn > 5""")
def _beyond(spark, sf):
    return comparable(limits.beyond_latest_n(_registered(spark, sf)))


_ALERT_REASON = """concat_ws(',', CASE WHEN high_risk_merchant THEN 'high_risk_merchant' END,
      CASE WHEN ABS(amount_zscore) > 2 THEN 'unusual_amount' END, CASE WHEN is_night THEN 'night' END,
      CASE WHEN amount_round THEN 'round_amount' END)"""


@query("risk_alerts", f"""WITH {RISK} SELECT transaction_id, user_id, 'score_threshold' AS alert_type,
    {r('fraud_probability')} AS risk_score,
    (CAST(high_risk_merchant AS INTEGER) + CAST(ABS(amount_zscore) > 2 AS INTEGER) + CAST(is_night AS INTEGER)
      + CAST(amount_round AS INTEGER)) / CAST(4 AS DOUBLE) AS confidence,
    {_ALERT_REASON} AS alert_reason, 'v1.0' AS model_version FROM risk WHERE fraud_probability >= 0.25""")
def _alerts(spark, sf):
    tx = views.transactions(spark, sf)
    risk = history.risk_columns(history.enrich(tx, history.user_stats(tx)))
    return comparable(detect.risk_alerts(risk))


@query("alert_table", f"""WITH {RISK} SELECT transaction_id, user_id, 'score_threshold' AS alert_type,
    {r('CAST(fraud_probability AS DECIMAL(6, 4))')} AS risk_score, {_ALERT_REASON} AS alert_reason, 'v1.0' AS model_version, TRUE AS stamped
    FROM risk WHERE fraud_probability >= 0.25""")
def _alert_table(spark, sf):
    """Alerts appended to the typed alert table and read back."""
    tx = views.transactions(spark, sf)
    path = scratch_dir(spark, "alerts")
    detect.append_alerts(detect.risk_alerts(history.risk_columns(history.enrich(tx, history.user_stats(tx)))), path)
    table = spark.read.schema(schemas.FRAUD_ALERT).parquet(path)
    return comparable(table.withColumn("stamped", F.col("created_at").isNotNull()).drop("created_at", "confidence"))


@query("detect_card_testing", f"""WITH {TX}, s AS (SELECT transaction_id, user_id, ts, amount, COUNT(*) OVER (
    PARTITION BY user_id ORDER BY {C._SEC} RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS small_amounts
    FROM tx WHERE amount <= 20) SELECT transaction_id, user_id, ts, {r('amount')} AS amount, small_amounts
    FROM s WHERE small_amounts >= 2""")
def _card_testing(spark, sf):
    tx = views.transactions(spark, sf)
    return comparable(detect.detect_card_testing(tx))


@query("detect_new_device", f"""WITH {TX}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id, device_id
    ORDER BY ts, transaction_id) AS rd, row_number() OVER (PARTITION BY user_id ORDER BY ts, transaction_id) AS ru FROM tx)
    SELECT user_id, device_id, ts, transaction_id FROM o WHERE rd = 1 AND ru > 1""")
def _new_device(spark, sf):
    return comparable(detect.detect_new_device(views.transactions(spark, sf)))


_HAVERSINE = """2 * 6371.0088 * ASIN(SQRT(LEAST(CAST(1 AS DOUBLE), POW(SIN(RADIANS(h.lat - t.location_lat) / 2), 2)
    + COS(RADIANS(t.location_lat)) * COS(RADIANS(h.lat)) * POW(SIN(RADIANS(h.lng - t.location_lng) / 2), 2))))"""


@query("detect_geo_outlier", f"""WITH {TX}, h AS (SELECT user_id, AVG(location_lat) AS lat, AVG(location_lng) AS lng
    FROM tx GROUP BY user_id), d AS (SELECT t.transaction_id, t.user_id, {_HAVERSINE} AS km FROM tx t JOIN h
    ON t.user_id = h.user_id) SELECT transaction_id, user_id, {r('km', 4)} AS distance_km FROM d WHERE km > 500""")
def _geo(spark, sf):
    return comparable(detect.detect_geo_outlier(views.transactions(spark, sf)), digits=4)


@query("detect_merchant_burst", f"""WITH {TX} SELECT merchant_category, date_trunc('hour', ts) AS window_start,
    COUNT(DISTINCT user_id) AS users, COUNT(*) AS n FROM tx GROUP BY 1, 2 HAVING COUNT(DISTINCT user_id) >= 3""")
def _burst(spark, sf):
    return comparable(detect.detect_merchant_burst(views.transactions(spark, sf)))


@query("detect_new_account_spend", f"""WITH {TX}, f AS (SELECT *, MIN(ts) OVER (PARTITION BY user_id) AS first_ts FROM tx)
    SELECT transaction_id, user_id, ts, {r('amount')} AS amount, merchant_category, first_ts FROM f
    WHERE merchant_category IN ('jewelry', 'electronics', 'travel') AND amount >= 500
    AND {C._SEC} - {C._SEC.replace('(ts)', '(first_ts)')} <= 7 * 86400""")
def _new_account(spark, sf):
    return comparable(
        detect.detect_new_account_spend(
            views.transactions(spark, sf), merchants=("jewelry", "electronics", "travel")
        )
    )


@query("json_roundtrip", f"""WITH {TX} SELECT transaction_id, user_id, {r('amount')} AS amount, merchant_category,
    CASE WHEN is_fraud THEN 'Label: fraud' ELSE 'Label: ok' END AS status FROM tx""")
def _json(spark, sf):
    """Struct to JSON text and back through path lookups."""
    doc = F.to_json(F.struct("transaction_id", "user_id", "amount", "merchant_category"))
    rows = views.transactions(spark, sf).select(doc.alias("doc"), "is_fraud")
    get = lambda name: F.get_json_object("doc", f"$.{name}")
    return comparable(
        rows.select(
            get("transaction_id").alias("transaction_id"),
            get("user_id").alias("user_id"),
            get("amount").cast("double").alias("amount"),
            get("merchant_category").alias("merchant_category"),
            F.concat(F.lit("Label: "), F.when(F.col("is_fraud"), "fraud").otherwise("ok")).alias("status"),
        )
    )
