"""Training matrices: category codes, null rules, scaling, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import fixed
from riskloom.functions.expressions import hash32, scrubbed
from riskloom.operators.skew import dense_codes


@dataclass(frozen=True)
class MatrixSpec:
    """Which columns form the matrix, in order: numeric, boolean, then coded categories."""

    numeric: Sequence[str]
    boolean: Sequence[str]
    category: Sequence[str]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.boolean, *(f"{c}_code" for c in self.category)]


SCORED_SPEC = MatrixSpec(fixed.MATRIX_NUMERIC, fixed.MATRIX_BOOLEAN, fixed.MATRIX_CATEGORY)
BEHAVIOUR_SPEC = MatrixSpec(fixed.MATRIX2_NUMERIC, fixed.MATRIX2_BOOLEAN, fixed.MATRIX2_CATEGORY)


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical codes of a category: one row per distinct value, NULL read as 'unknown'.

    Ordering runs over the distinct values only, never over the rows, and in no task over all of them.
    """
    value = F.coalesce(F.col(column), F.lit("unknown"))
    return dense_codes(df.select(value.alias(column)), column, f"{column}_code")


# Codes that are sent to every task; more than these spread over the partitions of a join.
_SENT_CODES = 10000


def encode_category(df: DataFrame, column: str, codes: DataFrame | None = None) -> DataFrame:
    """Add the code of a category; values missing from ``codes`` get one code past the last.

    A few codes are broadcast. Spark doesn't do so by itself: rows dealt by a few values leave most partitions empty, for which AQE
    keeps the shuffled join, and one task reads all rows of a value.
    """
    codes = category_codes(df, column) if codes is None else codes
    few = codes.limit(_SENT_CODES + 1).count() <= _SENT_CODES
    top = codes.agg((F.max(f"{column}_code") + 1).alias("m")).scalar()
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("unknown")))
    joined = filled.join(F.broadcast(codes) if few else codes, column, "left")
    return joined.withColumn(f"{column}_code", F.coalesce(F.col(f"{column}_code"), top).cast("int"))


def numeric_columns(df: DataFrame, spec: MatrixSpec) -> DataFrame:
    """Matrix null rules: numbers 0, flags false (as 0/1), categories 'unknown'; infinities 0."""
    out = {
        c: F.coalesce(scrubbed(F.col(c).cast("double")), F.lit(0.0)) for c in spec.numeric
    }
    out |= {c: F.coalesce(F.col(c), F.lit(False)).cast("int") for c in spec.boolean}
    out |= {c: F.coalesce(F.col(c), F.lit("unknown")) for c in spec.category}
    return df.withColumns(out)


def matrix(
    df: DataFrame,
    spec: MatrixSpec,
    *,
    id_col: str = "transaction_id",
    label: str = "is_fraud",
    codes: Mapping[str, DataFrame] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Numeric matrix as plain columns: id, features in order, label.

    Pass the ``codes`` of the training data to prepare later rows the same way.
    """
    rows = numeric_columns(df.filter(F.col(label).isNotNull()), spec)
    for c in spec.category:
        rows = encode_category(rows, c, (codes or {}).get(c))
    return rows.select(
        id_col, *keep, *[F.col(c).cast("double").alias(c) for c in spec.names], F.col(label).cast("int").alias("label")
    )


def scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean, unit population deviation; constant columns are 0.

    All statistics come from one aggregate, used as a scalar subquery. A column is constant when its least and
    largest value are equal: its deviation may be rounding noise that depends on the partitioning.
    """
    made = {"m": F.avg, "s": F.stddev_pop, "lo": F.min, "hi": F.max}
    stats = df.agg(F.struct(*[f(c).alias(f"{k}_{c}") for k, f in made.items() for c in columns]).alias("s")).scalar()

    def scaled(c: str) -> Column:
        m, s, lo, hi = (F.col("__stats")[f"{k}_{c}"] for k in made)
        return F.when(hi > lo, (F.col(c) - m) / s).otherwise((F.col(c) - lo).cast("double"))

    # One reference to the subquery: Spark plans it anew for each.
    return df.withColumn("__stats", stats).withColumns({c: scaled(c) for c in columns}).drop("__stats")


# Ranks by hash are found through this many hash ranges; only the range that contains
# a cut is ever ordered.
_RANGES = 65536
_WIDTH = 2**32 // _RANGES


def hash_parts(
    df: DataFrame,
    shares: Sequence[float],
    *,
    stratum: Column,
    id_col: str = "transaction_id",
    seed: int = 42,
    out: str = "part",
) -> DataFrame:
    """Exact stratified parts by hash order: part i holds ``shares[i]`` of every stratum.

    Per stratum, part sizes follow ``floor(n * cumulative share + 1/2)``. Rows are counted per
    hash range, the range containing a cut is ranked, and the cut key is applied as a
    threshold. The rows themselves are never shuffled. ``stratum`` is a class (a handful of
    values), so the cut tables have one row per class and cut and can be broadcast.
    """
    bounds, total = [], 0.0
    for share in shares[:-1]:
        total += share
        bounds.append(round(total, 12))
    keyed = df.select(stratum.alias("stratum"), F.col(id_col).alias("__id")).withColumn(
        "__h", hash32(F.col("__id"), seed)
    ).withColumn("__range", F.floor(F.col("__h") / _WIDTH))

    ranges = keyed.groupBy("stratum", "__range").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("__range"))
    size = F.sum("n").over(Window.partitionBy("stratum"))
    targets = F.array(*[
        F.struct(F.lit(i).alias("cut"), F.floor(size * b + 0.5).alias("target")) for i, b in enumerate(bounds)
    ])
    inside = F.filter(
        F.col("targets"),
        lambda t: (t["target"] > F.col("upto") - F.col("n")) & (t["target"] <= F.col("upto")),
    )
    cuts = (
        ranges.withColumns({"upto": upto, "targets": targets})
        .select("stratum", "__range", (F.col("upto") - F.col("n")).alias("before"), F.explode(inside).alias("c"))
        .select("stratum", "__range", F.col("c.cut").alias("cut"), (F.col("c.target") - F.col("before")).alias("nth"))
    )
    touched = cuts.select("stratum", "__range").distinct()
    ranked = keyed.join(touched, ["stratum", "__range"]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("stratum", "__range").orderBy("__h", "__id"))
    )
    # One threshold row per stratum and cut: strata are class labels, cuts are parts.
    thresholds = (
        ranked.join(cuts, ["stratum", "__range", "nth"])
        .groupBy("stratum")
        .agg(F.collect_list(F.struct(F.col("__h").alias("h"), F.col("__id").alias("id"))).alias("__cuts"))
        .withColumnRenamed("stratum", "__stratum")
    )
    own = F.struct(hash32(F.col(id_col), seed).alias("h"), F.col(id_col).alias("id"))
    # A share that rounds to nothing has no cut key: all its rows lie after the cut.
    missing = F.lit(len(bounds)) - F.size(F.col("__cuts"))
    part = F.coalesce(
        missing + F.size(F.filter(F.col("__cuts"), lambda c: own > c)), F.lit(len(bounds))
    )
    # The hint is needed: rows dealt by a few strata leave most partitions empty, and AQE then keeps them in one task each.
    return df.withColumn("__stratum", stratum).join(F.broadcast(thresholds), "__stratum", "left").withColumn(
        out, part.cast("int")
    ).drop("__stratum", "__cuts")


def _class(label: str) -> Column:
    return (F.col(label) == 1).cast("int")


def _stratum(df: DataFrame, label: str, minimum: int) -> Column:
    """The label, or one common stratum when there are too few positives to stratify."""
    positives = df.agg(F.count_if(F.col(label) == 1).alias("n")).scalar()
    return F.when(positives > minimum, _class(label)).otherwise(F.lit(0))


def stratified_split(
    df: DataFrame, *, label: str = "label", id_col: str = "transaction_id", test: float = 0.2,
    seed: int = 42, min_positives: int = 10,
) -> DataFrame:
    """Add ``split``: 'test' for the given share of each class, else 'train'."""
    parts = hash_parts(
        df, [test, 1 - test], stratum=_stratum(df, label, min_positives), id_col=id_col, seed=seed
    )
    return parts.withColumn("split", F.when(F.col("part") == 0, "test").otherwise("train")).drop("part")


def stratified_folds(
    df: DataFrame, k: int, *, label: str = "label", id_col: str = "transaction_id", seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Add a fold number with equal class shares per fold."""
    return hash_parts(df, [1 / k] * k, stratum=_class(label), id_col=id_col, seed=seed, out=out)
