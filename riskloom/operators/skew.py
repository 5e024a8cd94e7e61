"""Keeping heavy keys out of single tasks.

``groupBy`` aggregates are safe as they are: Spark combines them map-side. Window
functions are not, because a window pulls a whole key into one task. The helpers
here compute running values in blocks, exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialise


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which NULL equals NULL; the left side's key columns stay."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return left.join(renamed, same, "left").drop(*[f"__r_{c}" for c in on])


def by_range(df: DataFrame, *columns: str, out: str = "__block") -> DataFrame:
    """The rows, written, with the number of their range: it grows with the columns.

    Spark's range partitioner draws the bounds from a sample of the rows, so values crowded into a narrow interval are split like
    any others. Only rows that are equal in all columns can't be split: fold them first. NULL comes first.
    """
    return materialise(df.repartitionByRange(*columns).withColumn(out, F.spark_partition_id()), "ranges")


def running(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: str,
    values: Mapping[str, tuple[str, str]],
    inclusive: bool = True,
) -> DataFrame:
    """Exact running aggregates without pulling a key into one task.

    ``values`` maps an output name to ``(sum|min|max, column)``. Rows are dealt by sampled ranges of keys and
    ``order`` and each range is scanned in its task; only one row per key and range is carried over.
    """
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    in_block = Window.partitionBy(*keys, "__block").orderBy(order)
    over_blocks = Window.partitionBy(*keys).orderBy("__block") if keys else Window.orderBy("__block")
    frame = in_block.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)

    blocked = by_range(df, *keys, order)
    totals = blocked.groupBy(*keys, "__block").agg(
        *[fold[how](column).alias(f"__t_{name}") for name, (how, column) in values.items()]
    )
    carry = totals.select(
        *keys,
        "__block",
        *[fold[how](f"__t_{name}").over(earlier).alias(f"__c_{name}") for name, (how, _) in values.items()],
    )
    own = blocked.withColumns(
        {f"__o_{name}": fold[how](column).over(frame) for name, (how, column) in values.items()}
    )

    def merged(name: str, how: str) -> Column:
        own_part, carried = F.col(f"__o_{name}"), F.col(f"__c_{name}")
        if how == "sum":
            return F.coalesce(carried + own_part, carried, own_part)
        return F.least(carried, own_part) if how == "min" else F.greatest(carried, own_part)

    return join_null_safe(own, carry, [*keys, "__block"]).select(
        *df.columns, *[merged(name, how).alias(name) for name, (how, _) in values.items()]
    )


def exact_quantile(df: DataFrame, column: str, q: float = 0.5) -> Column:
    """The smallest value that at least a share ``q`` of the rows does not exceed, as a scalar subquery.

    Equal values are counted map-side; ranks come from running counts over sampled ranges.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ranked = running(counts, keys=[], order=column, values={"upto": ("sum", "n")})
    total = ranked.agg(F.max("upto").alias("n")).scalar()
    return ranked.filter(F.col("upto") >= total * F.lit(q)).agg(F.min(column).alias("m")).scalar()


def dense_codes(values: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values numbered from 0 in their order: ranges are numbered in parallel, then shifted.

    The driver sees one count per range, whatever the number of values.
    """
    dealt = by_range(values.select(column).distinct(), column)
    own = F.row_number().over(Window.partitionBy("__block").orderBy(column)) - 1
    shifts, total = [], 0
    for block, n in sorted(dealt.groupBy("__block").count().collect()):
        shifts.append((block, total))
        total += n
    before = values.sparkSession.createDataFrame(shifts, "__block int, __before bigint")
    return dealt.withColumn(out, own).join(before, "__block").select(column, (F.col(out) + F.col("__before")).alias(out))
