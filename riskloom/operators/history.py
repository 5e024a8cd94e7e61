"""Per-user history: statistics, enrichment, scoring, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import expressions as X
from riskloom.functions import fixed
from riskloom.operators import behaviour, features
from riskloom.operators.skew import join_null_safe


def fraud_rows() -> Column:
    return F.count_if(X.flag(F.col("is_fraud")))


def user_stats(tx: DataFrame) -> DataFrame:
    """One row per user. A plain aggregate: map-side combined, so heavy users cost nothing extra.

    Amounts that are NaN or infinite count as transactions but not in the amount statistics.
    """
    amount = X.finite(F.col("amount"))
    return (
        tx.groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.avg(amount).alias("user_avg_amount"),
            F.stddev(amount).alias("user_std_amount"),
            F.percentile_approx(amount, 0.5).alias("median_amount"),
            fraud_rows().alias("fraud_count"),
        )
        .withColumn("fraud_rate_pct", X.ratio(F.col("fraud_count"), F.col("total_transactions")) * 100)
    )


# Values a user's median sketch keeps: up to about so many the median is exact, beyond it its rank is off by about 0.2 %.
SKETCH_VALUES = 2048


def user_partials(tx: DataFrame) -> DataFrame:
    """Statistics per user that can be merged with those of other rows: counts, mean, squared deviations, a quantile sketch."""
    amount = X.finite(F.col("amount").cast("double"))
    return tx.groupBy("user_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        fraud_rows().alias("fraud_count"),
        F.count(amount).alias("amounts"),
        F.avg(amount).alias("mean"),
        (F.var_pop(amount) * F.count(amount)).alias("deviations"),
        F.kll_sketch_agg_double(amount, F.lit(SKETCH_VALUES)).alias("sketch"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per user from the rows of ``user_partials`` of any number of batches; merging is associative.

    Deviations are taken about the merged mean rather than as a difference of large sums.
    """
    n, mean = F.col("amounts"), F.col("mean")
    merged = partials.groupBy("user_id").agg(
        F.sum("total_transactions").alias("total_transactions"), F.sum("fraud_count").alias("fraud_count"),
        F.sum(n).alias("amounts"), F.try_divide(F.sum(mean * n), F.sum(F.when(mean.isNotNull(), n))).alias("mean"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_VALUES)).alias("sketch"),
    )
    centre = merged.select("user_id", F.col("mean").alias("centre"))
    gap = mean - F.col("centre")
    spread = join_null_safe(partials, centre, ["user_id"]).groupBy("user_id").agg(
        F.sum(F.col("deviations") + n * gap * gap).alias("deviations")
    )
    return join_null_safe(merged, spread, ["user_id"]).select(*[c for c in partials.columns if c not in ("run", "batch_id")])


def stats_of_partials(partials: DataFrame) -> DataFrame:
    """What ``user_stats`` gives for all rows behind the partials."""
    n = F.col("amounts")
    return merge_partials(partials).select(
        "user_id", "total_transactions", F.col("mean").alias("user_avg_amount"),
        F.when(n > 1, F.sqrt(F.col("deviations") / (n - 1))).alias("user_std_amount"),
        F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))).alias("median_amount"), "fraud_count",
        (X.ratio(F.col("fraud_count"), F.col("total_transactions")) * 100).alias("fraud_rate_pct"),
    )


def user_stats_asof(tx: DataFrame) -> DataFrame:
    """Count, mean and deviation of the user's earlier transactions, on every row."""
    return behaviour.user_windows(
        tx, horizons=(), amounts=False, recency=False, frequency=False, as_of=True
    )


def with_user_totals(tx: DataFrame) -> DataFrame:
    """Whole-user aggregates on every row: aggregate, then join back (AQE splits a heavy user)."""
    return join_null_safe(tx, user_stats(tx), ["user_id"])


def enrich(tx: DataFrame, stats: DataFrame) -> DataFrame:
    """Left join with user statistics; unknown users keep NULLs."""
    return tx.join(stats, "user_id", "left")


def _row_risk(tx: DataFrame) -> DataFrame:
    return features.scorer_merchant_features(
        features.temporal_features(tx).withColumn("amount_round", X.round_amount(F.col("amount")))
    )


def risk_columns(enriched: DataFrame) -> DataFrame:
    """Row features, history position and heuristic probability of enriched transactions."""
    amount = F.col("amount").cast("double")
    mean, std = F.col("user_avg_amount"), F.col("user_std_amount")
    scored = _row_risk(enriched).withColumns(
        {
            "amount_zscore": X.zscore(amount, mean, std),
            "amount_percentile": X.amount_percentile(amount, mean),
            **{name: F.lit(value) for name, value in fixed.CONSTANT_RISKS.items()},
        }
    )
    return scored.withColumn(
        "fraud_probability",
        X.fraud_probability(F.col("is_night"), F.col("amount_round"), F.col("amount_zscore")),
    )


def _typed(column: Column, field) -> Column:
    """Cast to the table's type; a value that the type can't hold (too large, NaN, infinite) is NULL."""
    kind = field.dataType
    return column.try_cast(kind) if kind.typeName() == "decimal" else column.cast(kind)


def typed_scored(risk: DataFrame) -> DataFrame:
    """The typed 31-column table."""
    given = set(risk.columns)
    source = {
        "timestamp": F.col("ts"),
        "days_since_last": F.lit(1.0),
        **{f"transactions_last_{h}": F.lit(0) for h in fixed.HORIZONS},
        "model_version": F.lit(fixed.MODEL_VERSION),
        "processed_at": F.current_timestamp(),
    }
    return risk.select(
        *[
            _typed(F.col(f.name) if f.name in given else source[f.name], f).alias(f.name)
            for f in schemas.SCORED.fields
        ]
    )


def score(tx: DataFrame, stats: DataFrame) -> DataFrame:
    """Score transactions against a static user history (batch or stream × static)."""
    return typed_scored(risk_columns(enrich(tx, stats)))


def as_of_history(windows: DataFrame) -> DataFrame:
    """History columns that end before each row, under the names the score reads."""
    minutes = F.col("minutes_since_last")
    return windows.withColumns(
        {
            "user_avg_amount": F.col("history_avg_amount"),
            "user_std_amount": F.col("history_std_amount"),
            "days_since_last": F.when(minutes < fixed.FIRST_TRANSACTION_MINUTES, minutes / 1440),
        }
    )


def score_full(tx: DataFrame) -> DataFrame:
    """Score with computed velocity and recency, and a history that ends before each row."""
    windows = behaviour.user_windows(tx, frequency=False, as_of=True)
    return typed_scored(risk_columns(as_of_history(windows)))


def user_profiles(tx: DataFrame) -> DataFrame:
    """Profile roll-up: counts, totals, first and last event time, fraud rate as a fraction."""
    n = F.col("total_transactions")
    return (
        tx.groupBy("user_id")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("amount").alias("total_amount"),
            F.avg("amount").alias("avg_amount"),
            F.min("ts").alias("first_transaction"),
            F.max("ts").alias("last_transaction"),
            fraud_rows().alias("fraud_count"),
        )
        .withColumn("fraud_rate", X.ratio(F.col("fraud_count"), n))
    )


def _ranked(tx: DataFrame, value: str, top: int, out: str) -> DataFrame:
    """The ``top`` most frequent values per user, as an array in rank order."""
    rank = Window.partitionBy("user_id").orderBy(F.desc("n"), value)
    return (
        tx.groupBy("user_id", value)
        .agg(F.count("*").alias("n"))
        .withColumn("r", F.row_number().over(rank))
        .filter(F.col("r") <= top)
        .groupBy("user_id")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("r", value))), lambda x: x[value]).alias(out))
    )


def profile_preferences(tx: DataFrame, *, top: int = 3) -> DataFrame:
    """Preferred merchants, payment methods and hours, home position, spread and mean gap.

    The mean gap needs no ordering: consecutive gaps add up to last minus first.
    """
    n = F.col("n_rows")
    span = F.unix_timestamp("last_ts") - F.unix_timestamp("first_ts")
    base = (
        tx.groupBy("user_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.stddev("amount").alias("std_amount"),
            F.percentile_approx("amount", 0.5).alias("median_amount"),
            F.avg("location_lat").alias("home_location_lat"),
            F.avg("location_lng").alias("home_location_lng"),
        )
        .withColumn("avg_days_between_transactions", X.ratio(span, (n - 1) * 86400))
        .drop("n_rows", "first_ts", "last_ts")
    )
    hours = tx.withColumn("hour_of_day", F.hour("ts"))
    for rows, value, out in (
        (tx, "merchant_category", "preferred_merchants"), (tx, "payment_method", "preferred_payment_methods"),
        (hours, "hour_of_day", "typical_transaction_hours"),
    ):
        base = join_null_safe(base, _ranked(rows, value, top, out), ["user_id"])
    return base


def profile_table(tx: DataFrame) -> DataFrame:
    """The typed profile table: roll-up, preferences, and the mean heuristic probability as risk score."""
    risk = risk_columns(enrich(tx, user_stats(tx))).groupBy("user_id").agg(F.avg("fraud_probability").alias("risk_score"))
    whole = join_null_safe(join_null_safe(user_profiles(tx), profile_preferences(tx), ["user_id"]), risk, ["user_id"])
    given = set(whole.columns)
    return whole.select(
        *[_typed(F.col(f.name) if f.name in given else F.lit(None), f).alias(f.name) for f in schemas.USER_PROFILE.fields]
    )
