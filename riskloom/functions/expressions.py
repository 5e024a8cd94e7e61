"""Scalar expressions shared by batch and streaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions import fixed


def flag(condition: Column) -> Column:
    """Two-valued boolean: an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False))


def parsed_timestamp(text: Column) -> Column:
    """ISO text to timestamp; NULL (not an ANSI error) when it does not parse."""
    return F.try_to_timestamp(text, F.lit(fixed.TIMESTAMP_FORMAT))


def epoch_second(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def is_holiday(ts: Column, holidays: Iterable[tuple[int, int]] = fixed.HOLIDAYS) -> Column:
    days = [month * 100 + day for month, day in holidays]
    return flag((F.month(ts) * 100 + F.dayofmonth(ts)).isin(days))


def lookup(key: Column, scores: Mapping[str, float], default: float) -> Column:
    """Constant map lookup with a default; the map folds into the plan."""
    entries = [F.lit(x) for pair in scores.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(float(default)))


def round_amount(amount: Column) -> Column:
    """A multiple of ten, at least one hundred."""
    return flag((amount % 10 == 0) & (amount >= 100))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Standard score; 0 when the spread is zero or unknown."""
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def amount_percentile(amount: Column, mean: Column) -> Column:
    """Position of an amount around the user's mean: 25..75 below, 75..100 above."""
    above = F.lit(75.0) + F.least(F.lit(25.0), (amount - mean) / mean * 25.0)
    below = F.lit(25.0) + amount / mean * 50.0
    return F.when(mean > 0, F.when(amount > mean, above).otherwise(below)).otherwise(F.lit(50.0))


def fraud_probability(night: Column, rounded: Column, z: Column) -> Column:
    """Weighted risk columns plus night, round-amount and capped z-score terms."""
    total = sum(
        (F.col(name) * weight for name, weight in fixed.SCORE_WEIGHTS.items()),
        start=F.lit(0.0),
    )
    extremity = F.least(F.abs(z) / fixed.SCORE_ZSCORE_CAP, F.lit(1.0))
    return (
        total
        + F.when(night, fixed.SCORE_NIGHT).otherwise(0.0)
        + F.when(rounded, fixed.SCORE_ROUND).otherwise(0.0)
        + extremity * fixed.SCORE_ZSCORE
    )


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lng), 2
    )
    return F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a))) * (2 * 6371.0088)


def scrubbed(value: Column) -> Column:
    """Infinite values become 0; NULL stays NULL."""
    return F.when(F.abs(value) == float("inf"), F.lit(0.0)).otherwise(value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def hash32(key: Column, seed: int | str = 42) -> Column:
    """Reproducible 32-bit hash of a key that other engines can recompute."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def finite(column: Column) -> Column:
    """The value, or NULL when it is NaN or infinite."""
    value = column.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), column)
