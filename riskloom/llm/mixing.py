"""Mixing sources to target weights with Efraimidis-Spirakis sampling. DataFrame operations only.

Sources are numbered by name (code point order, null last) and weighted 1, 2, 3, 1, 2, 3, ... The words of
all documents are shared out by weight; a target stops at three times its source's words, and the
excess is shared among the others by weight until no target is above (water filling).

A source's target is met by whole epochs first. For the rest, every document draws the exponential key
-ln(u) / quality, u being a hash of its id; documents are taken by rising key until their words reach
the rest, the last one only if that comes nearer.

No source is sorted as a whole: a key is mapped to one of B equal slices of (0, 1), words are summed
by source and slice, and only the slice in which the rest runs out is ranked. B grows with the
square root of the number of documents, so that slice and the list of slices are both small.

Cases: a null text has size 0; a null source is a source of its own; a null quality is 1 and one that is
not positive counts as the smallest positive weight; rows repeated with one id have equal keys and are
taken in order of size; a null id hashes as an empty one; sources without words have target 0; an
empty table gives no rows; extra columns are carried by ``mix``, not by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

MAX_EPOCHS = 3
SEED = "mix-1"
SPACE = " \\t\\n\\x0B\\f\\r"
_LEAST_WEIGHT = 1e-6


def n_words(text: Column) -> Column:
    """Words between spaces, tabs and line ends."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{SPACE}]+", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(F.regexp_replace(trimmed, f"[{SPACE}]+$", ""), f"[{SPACE}]+"))
    ).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of a digest."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1).cast("double") / F.lit(2.0**52 + 2)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from one row per source: the list of sources is taken to fit one task."""
    name = Window.orderBy(F.asc_nulls_last("source"))
    weighted = sizes.withColumn("weight", (F.row_number().over(name) - 1) % 3 + 1)
    everything = Window.partitionBy(F.lit(0))
    # By rising limit per weight: everyone before a source is at the limit, the level is shared by the others.
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighted.withColumn("limit", (F.col("source_size") * MAX_EPOCHS).cast("double")).withColumns({
        "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        "place": F.row_number().over(fill),
    })
    fits = F.col("level") <= F.col("limit") / F.col("weight")
    return levels.withColumn(
        "final", F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    ).select("source", "source_size", F.least("limit", F.col("final") * F.col("weight")).alias("target"))


def plan_mix(sized: DataFrame) -> DataFrame:
    """From doc_id, source, size, quality: doc_id, size, source_size, target, copies, taken."""
    spark = sized.sparkSession
    quality = F.greatest(F.coalesce(F.col("quality").cast("double"), F.lit(1.0)), F.lit(_LEAST_WEIGHT))
    # u ** (1 / quality) falls as the exponential key rises.
    rows = materialise(
        sized.select("doc_id", "source", "size", (-F.ln(uniform(F.col("doc_id"))) / quality).alias("key")), "mix"
    )
    slices = max(16, int(rows.count() ** 0.5))
    rows = rows.withColumn("slice", F.floor((1 - F.exp(-F.col("key"))) * slices))
    by_slice = materialise(rows.groupBy("source", "slice").agg(F.sum("size").alias("words")), "slices")
    goals = targets(by_slice.groupBy("source").agg(F.sum("words").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    passed = by_slice.withColumn("upto", upto).alias("s").join(goals.alias("g"), same).filter(F.col("upto") > F.col("rest"))
    # The first slice that goes beyond the rest, and the words before it.
    edge = passed.groupBy("s.source").agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("edge"))
    plan = materialise(
        goals.alias("g").join(edge.alias("e"), F.col("e.source").eqNullSafe(F.col("g.source")), "left").select(
            F.col("g.source").alias("goal_source"), "source_size", "target", "epochs", "rest", "edge.slice", "edge.before"
        ).withColumnRenamed("slice", "edge_slice"),
        "plan",
    )
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    on_edge = F.col("slice") == F.col("edge_slice")
    ranked = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("size").over(ranked), F.lit(0))
    inside = joined.filter(on_edge).withColumn("chosen", earlier + F.col("size") / 2 <= F.col("rest"))
    outside = joined.filter(~F.coalesce(on_edge, F.lit(False))).withColumn(
        "chosen", (F.col("rest") > 0) & (F.col("edge_slice").isNull() | (F.col("slice") < F.col("edge_slice")))
    )
    copies = F.col("epochs") + F.col("chosen").cast("long")
    return outside.unionByName(inside).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality weights from labels: 2 for good, 1/2 for bad, 1 without a label."""
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    weight = F.when(F.col("label") == 1, 2.0).when(F.col("label") == 0, 0.5).otherwise(1.0)
    return docs.join(known, "doc_id", "left").withColumn("quality", weight).drop("label")


def size_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"))
    return with_quality(sized, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = plan_mix(size_documents(spark, store.documents(spark, sf_dir), sf_dir))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


OP6_SQL = """
WITH w AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS size FROM documents
), k AS (
  SELECT w.doc_id, source, size, -ln(CAST(CAST('0x' || substr(md5(coalesce(CAST(w.doc_id AS VARCHAR), '') || ':mix-1'), 1, 13) AS BIGINT) + 1 AS DOUBLE)
    / (4503599627370496 + 2)) / CASE l.quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM w LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON w.doc_id = l.doc_id
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM k GROUP BY source
), f AS (
  SELECT *, CAST(3 * n AS DOUBLE) AS cap, row_number() OVER o AS place,
    (CAST(sum(n) OVER () AS DOUBLE) - coalesce(sum(CAST(3 * n AS DOUBLE)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM s WINDOW o AS (ORDER BY CAST(3 * n AS DOUBLE) / CAST(weight AS DOUBLE), source NULLS LAST)
), g AS (
  SELECT source, n, least(cap, weight * (SELECT level FROM f WHERE level <= cap / weight ORDER BY place LIMIT 1)) AS target FROM f
), e AS (
  SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS epochs FROM g
), t AS (
  SELECT k.doc_id, size, n, target, epochs, target - epochs * n AS rest,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, round(target, 6) AS target,
  CAST(size * (epochs + CASE WHEN rest > 0 AND earlier + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM t
"""
