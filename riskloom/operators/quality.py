"""Contract checks: not-null, uniqueness, references, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Violations per required column, all columns in one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations")


def contract_rules(
    df: DataFrame,
    schema: T.StructType | str,
    *,
    lengths: Mapping[str, int] | None = None,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
    allowed: Mapping[str, Sequence] | None = None,
) -> dict[tuple[str, str], Column]:
    """(column, rule) -> whether a row breaks it.

    From the schema: ``present`` (a column that the frame lacks; every row breaks it), ``required``, ``type`` (a value that the
    declared type can't hold) and ``scale`` (more decimal places than declared). ``length``, ``range`` (ends included, None is
    open) and ``allowed`` are given. But for ``required``, NULL breaks no rule; NaN lies above every number.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rules = {}
    for field in schema.fields:
        if field.name not in df.columns:
            rules[field.name, "present"] = F.lit(True)
            continue
        value, held = F.col(field.name), F.col(field.name).try_cast(field.dataType)
        if not field.nullable:
            rules[field.name, "required"] = value.isNull()
        if df.schema[field.name].dataType == field.dataType:
            continue
        rules[field.name, "type"] = value.isNotNull() & held.isNull()
        if isinstance(field.dataType, T.DecimalType):
            rules[field.name, "scale"] = held.cast("double") != value.cast("double")
    for name, most in (lengths or {}).items():
        rules[name, "length"] = F.length(F.col(name)) > most
    for name, (low, high) in (bounds or {}).items():
        below = F.lit(False) if low is None else F.col(name) < low
        rules[name, "range"] = below if high is None else below | (F.col(name) > high)
    for name, values in (allowed or {}).items():
        rules[name, "allowed"] = ~F.col(name).isin(*values)
    return rules


def check_contract(df: DataFrame, schema: T.StructType | str, **limits) -> DataFrame:
    """Violations per column and rule (see ``contract_rules``): one aggregate, one pass."""
    rules = contract_rules(df, schema, **limits)
    counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    named = [
        F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (column, rule) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*named)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """How many child rows lack a parent. Children are counted per key before the join."""
    per_key = child.groupBy(key).agg(F.count("*").alias("n"))
    orphans = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill column defaults on write."""
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in defaults.items()})
