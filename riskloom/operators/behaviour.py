"""Rolling behaviour per user: one exact way for every user, whatever their number of rows.

Rows are dealt once, by user and week, and all windows are Spark's own within such a chunk. None of them slides: a
sliding frame costs as many steps per row as it has rows, which is the square of a heavy user's. Instead every row also
appears as slim copies at the times when it leaves each horizon, and only running frames are used:

* A count is what has come minus what has left.
* Averages, deviations and largest values of the last day or seven days are put together from two running parts: the rows of the current
  day (or week, counted from the epoch) up to now, and the copies that leave it from now on, which are the rest of the window.
  Parts are merged by their moments, nothing is subtracted.
* What lies before a chunk (counts, the last time, the history) arrives as one carried row per user and chunk, and one per
  category and hour for the running counts; these come from one small aggregate.

A task's group is a user's chunk at most, so a user with most rows of the table is as many groups as there are weeks (Spark
sorts and buffers a group with spilling); no probe, threshold or cap decides. Rows are counted first, and the number of partitions
grows with them, so what a task sorts doesn't. NULL users, categories and times fall into groups of their own.

A row without time has no window but its like, and precedes all rows of its user that have one. Amounts that
are NaN or infinite make the averages and deviations of just the windows they lie in NaN or infinite.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from riskloom.functions import expressions as X
from riskloom.functions import fixed
from riskloom.operators import features

DAY = 86400
WEEK = 7 * DAY
# Rows are dealt by user and so many seconds; whole weeks.
CHUNK = WEEK
# Dealt rows (own ones and copies) that a task sorts, on average at most.
TASK_ROWS = 400_000
# The second of rows without time: before all others, further away than any horizon.
NO_TIME = -(1 << 40)
# Kinds of dealt rows: own rows, carried rows, and the copies that leave a horizon (from 1 on).
OWN, CARRIED = 0, -1

_FREQUENCY = {"merchant_category": "user_merchant_frequency", "hour_of_day": "user_hour_frequency"}
# Columns that windows read.
_READ = ("user_id", "ts", "transaction_id")
_AMOUNT_COLUMNS = ("user_avg_amount_24h", "user_avg_amount_7d", "user_std_amount_7d", "user_max_amount_7d")
_HISTORY = ("history_transactions", "history_avg_amount", "history_std_amount")


def user_windows(
    tx: DataFrame,
    *,
    horizons: Iterable[str] = tuple(fixed.HORIZONS),
    amounts: bool = True,
    recency: bool = True,
    frequency: bool = True,
    as_of: bool = False,
) -> DataFrame:
    """Add velocity, amount, recency, frequency and as-of history columns per user."""
    horizons = tuple(horizons)
    if frequency and "hour_of_day" not in tx.columns:
        tx = tx.withColumn("hour_of_day", F.hour("ts"))
    wanted = [*tx.columns, *_added(horizons, amounts, recency, frequency, as_of)]
    rows = tx.withColumn("__sec", F.coalesce(X.epoch_second(F.col("ts")), F.lit(NO_TIME)))
    spans = {h: fixed.HORIZONS[h] for h in (*horizons, *(("24h", "7d") if amounts else ()))}
    kinds = {h: kind for kind, h in enumerate(spans, 1)}
    # Columns that no window reads travel as one; wide rows make Spark's generated code too long to be compiled.
    read = [c for c in (*_READ, *(_FREQUENCY if frequency else ())) if c in tx.columns]
    packed = [c for c in tx.columns if c not in read]
    dealt = _copies(rows, spans, read, packed)
    parts = -(-tx.count() * (1 + len(spans)) // TASK_ROWS)
    if horizons or recency or frequency or as_of:
        dealt = dealt.unionByName(_carried(rows, {h: spans[h] for h in horizons}, recency, frequency, as_of, parts), allowMissingColumns=True)
    out = _dealt(dealt, parts, "user_id", "__chunk")
    own = F.when(F.col("__kind") == OWN, 1)
    # Three groups of windows, each with one sort; rows and columns that no later window needs leave in between.
    chunk = Window.partitionBy("user_id", "__chunk")
    week = Window.partitionBy("user_id", "__chunk", "__week")
    day = Window.partitionBy("user_id", "__chunk", "__week", "__day")
    done = []
    if recency:
        # By row, not by second: of rows with one second the earlier one precedes.
        earlier = chunk.orderBy("__week", "__day", "__order", "ts", "transaction_id").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("__prev", F.last(F.coalesce(own * F.col("__sec"), "__c.last"), ignorenulls=True).over(earlier))
        done.append("__prev")
    if horizons:
        now = _upto(chunk, "__week", "__day", "__order")
        found = {}
        for h in horizons:
            come = F.coalesce(own, f"__c.in_{h}", F.when(F.col("__kind") == kinds[h], -1), F.lit(0))
            found[f"transactions_last_{h}"] = F.sum(come).over(now) - 1
            done.append(f"transactions_last_{h}")
        out = out.withColumns(found)
    if amounts:
        out = out.withColumns(_named("__7d", _parts(_amount(OWN), _upto(week, "__day", "__order"), _SPREAD)))
        out = out.withColumns(_named("__24h", _parts(_amount(OWN), _upto(day, "__order"), _MEAN)))
    if as_of:
        out = out.withColumns(_named("__h", _history(chunk)))
        out = out.withColumns(_history_columns()).drop(*[c for c in out.columns if c.startswith("__h_")])
        done += _HISTORY
    needed = [OWN, CARRIED] if frequency else [OWN]
    if amounts:
        out = out.filter(F.col("__kind").isin([*needed, kinds["24h"], kinds["7d"]]))
        out = out.withColumns({"__order": -F.col("__order"), "__day": -F.col("__day")})
        out = out.withColumns(_named("__24h_rest", _parts(_amount(kinds["24h"]), _upto(day, "__order"), _MEAN)))
        out = out.withColumns(_named("__7d_rest", _parts(_amount(kinds["7d"]), _upto(week, "__day", "__order"), _SPREAD)))
        out = out.withColumns(_amount_columns())
        done += _AMOUNT_COLUMNS
    base = ["user_id", "__chunk", "__kind", "__sec", "__amount", *(["__row"] if packed else []), *[c for c in read if c != "user_id"]]
    if frequency:
        out = out.filter(F.col("__kind").isin(needed)).select(*base, *done, F.when(F.col("__kind") == OWN, F.col("__sec")).alias("__second"), "__c")
        for column, name in _FREQUENCY.items():
            # Carried rows have no second and come first.
            visits = F.sum(F.coalesce(own, f"__c.{name}", F.lit(0))).over(_upto(Window.partitionBy("user_id", "__chunk", column), "__second"))
            out = out.withColumn(name, visits)
        done += _FREQUENCY.values()
    out = out.filter(F.col("__kind") == OWN).select(*read, *[F.col(f"__row.`{c}`").alias(c) for c in packed], "__sec", "__amount", *done)
    return _finish(out, amounts, recency).select(*wanted)


def _dealt(df: DataFrame, parts: int, *columns: str) -> DataFrame:
    """Rows dealt by columns to at least so many partitions; where one would do, Spark decides."""
    if parts <= 1:
        return df.repartition(*columns)
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *columns)


def _added(horizons, amounts, recency, frequency, as_of) -> list[str]:
    names = [f"transactions_last_{h}" for h in horizons]
    if amounts:
        names += [*_AMOUNT_COLUMNS, "amount_zscore"]
    if recency:
        names.append("minutes_since_last")
    if frequency:
        names += _FREQUENCY.values()
    if as_of:
        names += _HISTORY
    return names


def _upto(block: WindowSpec, *order: str) -> WindowSpec:
    """Up to and with the row's second."""
    return block.orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def _times(spans: Mapping[str, int]) -> Column:
    """The row itself, and its copies at the seconds when it is as old as a horizon."""
    late = [(OWN, 0), *enumerate(spans.values(), 1)]
    return F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), (F.col("__sec") + span).alias("at")) for kind, span in late]))


def _copies(rows: DataFrame, spans: Mapping[str, int], read: list[str], packed: list[str]) -> DataFrame:
    """Own rows, and copies that carry the amount alone."""
    timed = rows.select("*", _times(spans).alias("__time"))
    own = F.col("__time.kind") == OWN
    kept = [F.col(c) if c == "user_id" else F.when(own, F.col(c)).alias(c) for c in (*read, "__sec")]
    if packed:
        kept.append(F.when(own, F.struct(*packed)).alias("__row"))
    at = F.col("__time.at")
    return timed.select(
        *kept, F.col("__time.kind").alias("__kind"), F.floor(at / CHUNK).alias("__chunk"), F.floor(at / WEEK).alias("__week"), F.floor(at / DAY).alias("__day"),
        # A copy stands just after its second: rows of that second are still with it.
        F.when(own, 2 * at).otherwise(2 * at + 1).alias("__order"), F.col("amount").cast("double").alias("__amount"),
    )


def _amount(kind: int) -> Column:
    return F.when(F.col("__kind") == kind, F.col("__amount"))


_MEAN, _SPREAD = ("n", "mean"), ("n", "mean", "var", "low", "high")


def _named(prefix: str, columns: Mapping[str, Column]) -> dict[str, Column]:
    return {f"{prefix}_{k}": v for k, v in columns.items()}


def _parts(amount: Column, window: WindowSpec, names: Iterable[str]) -> dict[str, Column]:
    made = {"n": F.count, "mean": F.avg, "var": F.var_pop, "low": F.min, "high": F.max}
    return {k: made[k](amount).over(window) for k in names}


def _merged(n: Column, mean: Column, m2: Column, k: Column, other: Column, m2_other: Column) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviations of two parts together; an empty part has a NULL mean."""
    count = n + k
    average = (F.coalesce(n * mean, F.lit(0.0)) + F.coalesce(k * other, F.lit(0.0))) / F.when(count > 0, count)
    between = F.coalesce((mean - other) * (mean - other) * n * k / F.when(count > 0, count), F.lit(0.0))
    return count, average, F.coalesce(m2, F.lit(0.0)) + F.coalesce(m2_other, F.lit(0.0)) + between


def _deviation(n: Column, m2: Column, low: Column, high: Column) -> Column:
    """Sample deviation; exactly 0 for equal values."""
    same = (low == high) & ~F.isnan(high) & (F.abs(high) != F.lit(float("inf")))
    return F.when(n > 1, F.when(same, F.lit(0.0)).otherwise(F.sqrt(F.greatest(m2, F.lit(0.0)) / F.when(n > 1, n - 1))))


def _history(chunk: WindowSpec) -> dict[str, Column]:
    """Running parts of the chunk before the row's second, and what the chunk's carried row says."""
    past = chunk.orderBy("__order").rangeBetween(Window.unboundedPreceding, -1)
    out = _parts(_amount(OWN), past, _SPREAD)
    out["rows"] = F.coalesce(F.sum(F.when(F.col("__kind") == OWN, 1)).over(past), F.lit(0))
    return out | {f"c_{c}": F.max(f"__c.{c}").over(past) for c in ("rows", "n", "s1", "s2", "low", "high")}


def _history_columns() -> dict[str, Column]:
    def h(name: str) -> Column:
        return F.col(f"__h_{name}")

    carried = F.coalesce(h("c_n"), F.lit(0))
    before = h("c_s1") / F.when(carried > 0, carried)
    m2 = F.greatest(h("c_s2") - h("c_s1") * before, F.lit(0.0))
    n, mean, m2 = _merged(h("n"), h("mean"), h("n") * h("var"), carried, before, m2)
    std = _deviation(n, m2, F.least(h("low"), h("c_low")), F.greatest(h("high"), h("c_high")))
    return dict(zip(_HISTORY, (h("rows") + F.coalesce(h("c_rows"), F.lit(0)), mean, std), strict=True))


def _amount_columns() -> dict[str, Column]:
    def c(name: str) -> Column:
        return F.col(f"__{name}")

    day = _merged(c("24h_n"), c("24h_mean"), F.lit(0.0), c("24h_rest_n"), c("24h_rest_mean"), F.lit(0.0))
    n, mean, m2 = _merged(c("7d_n"), c("7d_mean"), c("7d_n") * c("7d_var"), c("7d_rest_n"), c("7d_rest_mean"), c("7d_rest_n") * c("7d_rest_var"))
    largest = F.greatest("__7d_high", "__7d_rest_high")
    std = _deviation(n, m2, F.least("__7d_low", "__7d_rest_low"), largest)
    return dict(zip(_AMOUNT_COLUMNS, (day[1], mean, std, largest), strict=True))


def _finish(df: DataFrame, amounts: bool, recency: bool) -> DataFrame:
    """Columns that are plain expressions over the window results."""
    out = {}
    if amounts:
        out["amount_zscore"] = X.zscore(F.col("__amount"), F.col("user_avg_amount_7d"), F.col("user_std_amount_7d"))
    if recency:
        gap = (F.col("__sec") - F.when(F.col("__prev") != NO_TIME, F.col("__prev"))).cast("double") / 60
        out["minutes_since_last"] = F.coalesce(F.when(F.col("ts").isNotNull(), gap), F.lit(fixed.FIRST_TRANSACTION_MINUTES))
    return df.withColumns(out) if out else df


def _carried(rows: DataFrame, spans: Mapping[str, int], recency: bool, frequency: bool, as_of: bool, parts: int) -> DataFrame:
    """What precedes each chunk of a user, as rows that stand before the chunk's first second."""
    at = F.col("__time.at")
    groups = list(_FREQUENCY) if frequency else []
    own = F.col("__time.kind") == OWN
    amount = F.when(own, F.col("amount").cast("double"))
    sums = {"n": F.count("*"), "last": F.max(F.when(own, F.col("__sec")))}
    if as_of:
        mean, count = F.avg(amount), F.count(amount)
        sums |= {"na": count, "s1": F.sum(amount), "s2": count * (F.var_pop(amount) + mean * mean), "low": F.min(amount), "high": F.max(amount)}
    timed = rows.select("user_id", "amount", "__sec", *groups, _times(spans).alias("__time"))
    keys = [F.when(own, F.col(c)).alias(c) for c in groups]
    small = timed.groupBy("user_id", F.floor(at / CHUNK).alias("__chunk"), F.col("__time.kind").alias("kind"), *keys)
    # One row per user, chunk, category and hour from here on.
    small = _dealt(small.agg(*[v.alias(k) for k, v in sums.items()]), parts, "user_id")
    by_chunk = Window.partitionBy("user_id").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    fields: list[str] = [*(f"in_{h}" for h in spans), *(["last"] if recency else []), *(("rows", "n", "s1", "s2", "low", "high") if as_of else ())]
    parts = []
    if fields:
        came = F.coalesce(F.sum(F.when(F.col("kind") == OWN, F.col("n"))), F.lit(0))
        left = {h: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)) for kind, h in enumerate(spans, 1)}
        sums_of = {"rows": came, "last": F.max("last"), **{f"in_{h}": came - v for h, v in left.items()}}
        if as_of:
            sums_of |= {"n": F.sum("na"), "s1": F.sum("s1"), "s2": F.sum("s2"), "low": F.min("low"), "high": F.max("high")}
        totals = small.groupBy("user_id", "__chunk").agg(*[v.alias(k) for k, v in sums_of.items()])
        how = {"last": F.max, "low": F.min, "high": F.max}
        before = {c: how.get(c, F.sum)(c).over(by_chunk) for c in fields}
        parts.append(totals.select("user_id", "__chunk", F.col("rows").alias("came"), *[v.alias(k) for k, v in before.items()]).filter("came > 0"))
    for column in groups:
        name = _FREQUENCY[column]
        visits = small.filter(F.col("kind") == OWN).groupBy("user_id", column, "__chunk").agg(F.sum("n").alias("n"))
        by_key = Window.partitionBy("user_id", column).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        # The first chunk of a key has nothing to carry.
        parts.append(visits.select("user_id", "__chunk", column, F.sum("n").over(by_key).alias(name)).filter(F.col(name).isNotNull()))
        fields.append(name)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    first = F.col("__chunk") * CHUNK
    added = {"__kind": F.lit(CARRIED), "__week": F.floor(first / WEEK) - 1, "__day": F.floor(first / DAY) - 1, "__order": 2 * first - 1}
    return out.select("user_id", "__chunk", *groups, F.struct(*fields).alias("__c")).withColumns(added)


def behaviour_features(
    df: DataFrame, *, horizons: Iterable[str] = ("24h", "7d", "30d")
) -> DataFrame:
    """Velocity, rolling amount statistics, z-score and recency."""
    return user_windows(df, horizons=horizons, frequency=False)


def frequency_features(df: DataFrame) -> DataFrame:
    """Running counts per user and merchant category, and per user and hour."""
    return user_windows(df, horizons=(), amounts=False, recency=False)


def ml_feature_table(df: DataFrame) -> DataFrame:
    """The 24-column behavioural feature table."""
    renamed = df.withColumns({"is_night": F.col("is_night_b"), "amount_round": F.col("amount_round_b")})
    return features.fill_constants(renamed).select(*fixed.ML_TABLE_COLUMNS)


def build_ml_features(df: DataFrame, *, velocity: int = 10) -> DataFrame:
    """Every behavioural feature."""
    rows = features.merchant_features(features.amount_features(features.temporal_features(df)))
    windows = user_windows(rows, horizons=("24h", "7d", "30d"))
    return ml_feature_table(features.anomaly_features(windows, velocity=velocity))
