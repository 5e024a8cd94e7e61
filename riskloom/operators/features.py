"""Row-level features: narrow projections, valid on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import expressions as X
from riskloom.functions import fixed
from riskloom.operators.skew import exact_quantile


def parse_timestamp(df: DataFrame, col: str = "timestamp", out: str = "ts") -> DataFrame:
    return df.withColumn(out, X.parsed_timestamp(F.col(col)))


def temporal_features(
    df: DataFrame, ts: str = "ts", holidays: Iterable[tuple[int, int]] = fixed.HOLIDAYS
) -> DataFrame:
    """Calendar parts and flags; ``is_night`` is the scorer's rule, ``is_night_b`` the feature job's."""
    t = F.col(ts)
    hour, dow = F.hour(t), F.dayofweek(t)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": dow,
            "is_weekend": X.flag(dow.isin(1, 7)),
            "is_night": X.flag((hour >= 22) | (hour <= 6)),
            "is_night_b": X.flag((hour < 6) | (hour > 22)),
            "is_holiday": X.is_holiday(t, holidays),
            "month": F.month(t),
            "day_of_month": F.dayofmonth(t),
        }
    )


def amount_features(df: DataFrame, *, large: float = 1000, small: float = 10) -> DataFrame:
    """``amount_round`` is the scorer's rule, ``amount_round_b`` the feature job's."""
    a = F.col("amount")
    return df.withColumns(
        {
            "amount_log": F.log1p(a),
            "amount_round": X.round_amount(a),
            "amount_round_b": a % 1 == 0,
            "amount_large": a > large,
            "amount_small": a < small,
        }
    )


def merchant_features(
    df: DataFrame,
    *,
    scores: Mapping[str, float] = fixed.RISK_BEHAVIOUR,
    high_risk: Iterable[str] = tuple(fixed.RISK_BEHAVIOUR),
    default: float = fixed.RISK_DEFAULT,
) -> DataFrame:
    m = F.col("merchant_category")
    return df.withColumns(
        {
            "high_risk_merchant": m.isin(*high_risk),
            "merchant_risk_score": X.lookup(m, scores, default),
        }
    )


def scorer_merchant_features(df: DataFrame) -> DataFrame:
    """Merchant features with the scorer's set and scores."""
    out = merchant_features(df, scores=fixed.RISK_SCORER, high_risk=fixed.HIGH_RISK_SCORER)
    return out.withColumn("high_risk_merchant", X.flag(F.col("high_risk_merchant")))


def anomaly_features(df: DataFrame, *, z: float = 2.0, velocity: int = 10) -> DataFrame:
    """Four flags and their mean."""
    flags = {
        "amount_unusual": F.abs("amount_zscore") > z,
        "time_unusual": F.col("hour_of_day") < 6,
        "velocity_unusual": F.col("transactions_last_24h") > velocity,
        "merchant_unusual": F.col("user_merchant_frequency") == 1,
    }
    total = sum((condition.cast("int") for condition in flags.values()), start=F.lit(0))
    return df.withColumns({**flags, "anomaly_score": total.cast("double") / len(flags)})


def fill_constants(df: DataFrame, fills: Mapping[str, float] = fixed.NULL_FILLS) -> DataFrame:
    """Constant null fills, for the columns that exist."""
    return df.fillna({k: v for k, v in fills.items() if k in df.columns})


def fill_statistics(df: DataFrame, means: Mapping[str, str], medians: Iterable[str] = ()) -> DataFrame:
    """Fill NULLs from whole-table statistics: ``means`` maps a column to the column averaged.

    The statistics come in as scalar subqueries, not as joins; medians are exact.
    """
    stats = df.agg(
        F.struct(*[F.avg(source).alias(f"mean_{c}") for c, source in means.items()]).alias("s")
    ).scalar()
    filled = {c: F.coalesce(F.col(c), stats[f"mean_{c}"]) for c in means}
    filled |= {c: F.coalesce(F.col(c), exact_quantile(df, c).cast("double")) for c in medians}
    return df.withColumns(filled)


def scrub_infinite(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: X.scrubbed(F.col(c)) for c in columns})
