"""Model evaluation as aggregates: exact metrics, no driver-side arrays.

Predictions carry ``label`` and ``prediction`` (0/1) and, for ranking metrics, ``score`` in [0, 1].
``by`` evaluates several models or slices at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import fixed
from riskloom.functions.expressions import ratio
from riskloom.operators.skew import running


def _guarded(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def _tally(predictions: DataFrame, by: Sequence[str], *also: str) -> DataFrame:
    """Positives and negatives per prediction (and score): what every metric is made of."""
    positive = F.col("label") == 1
    return predictions.groupBy(*by, *also, "prediction").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def _confusion(tally: DataFrame, by: Sequence[str]) -> DataFrame:
    predicted = F.col("prediction") == 1

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    counts = tally.groupBy(*by).agg(
        total("neg", ~predicted).alias("true_negatives"),
        total("neg", predicted).alias("false_positives"),
        total("pos", ~predicted).alias("false_negatives"),
        total("pos", predicted).alias("true_positives"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    return counts.withColumns(
        {
            "specificity": _guarded(tn, tn + fp),
            "false_positive_rate": _guarded(fp, fp + tn),
            "false_negative_rate": _guarded(fn, fn + tp),
        }
    )


def confusion(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, and rates with zero guards."""
    return _confusion(_tally(predictions, by), by)


def threshold_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1, with the confusion counts they come from."""
    return _threshold_metrics(_tally(predictions, by), by)


def _threshold_metrics(tally: DataFrame, by: Sequence[str]) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    return _confusion(tally, by).withColumns(
        {
            "accuracy": _guarded(tp + tn, tp + tn + fp + fn),
            "precision": _guarded(tp, tp + fp),
            "recall": _guarded(tp, tp + fn),
            "f1_score": _guarded(tp * 2, tp * 2 + fp + fn),
        }
    )


def class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    sides = F.explode(
        F.array(
            F.struct(F.col("label").cast("int").alias("label"), F.lit(1).alias("actual"),
                     (F.col("label") == F.col("prediction")).cast("int").alias("hit"), F.lit(0).alias("predicted")),
            F.struct(F.col("prediction").cast("int").alias("label"), F.lit(0).alias("actual"),
                     F.lit(0).alias("hit"), F.lit(1).alias("predicted")),
        )
    )
    counts = (
        predictions.select(sides.alias("s"))
        .groupBy("s.label")
        .agg(F.sum("s.actual").alias("support"), F.sum("s.hit").alias("hit"), F.sum("s.predicted").alias("predicted"))
    )
    hit, support, predicted = F.col("hit"), F.col("support"), F.col("predicted")
    return counts.select(
        "label",
        _guarded(hit, predicted).alias("precision"),
        _guarded(hit, support).alias("recall"),
        _guarded(hit * 2, predicted + support).alias("f1_score"),
        "support",
    )


def _ranking(tally: DataFrame, by: Sequence[str]) -> DataFrame:
    """ROC-AUC and average precision from one pass of running counts over ascending scores."""
    keys = list(by)
    if not keys:
        tally, keys = tally.withColumn("__all", F.lit(1)), ["__all"]
    per_score = tally.groupBy(*keys, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranked = running(
        per_score, keys=keys, order="score",
        values={"pos_below": ("sum", "pos"), "neg_below": ("sum", "neg")}, inclusive=False,
    )
    totals = tally.groupBy(*keys).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    neg_below = F.coalesce("neg_below", F.lit(0))
    # Rows scored at least as high as this score: what a threshold here would flag.
    tp = F.col("all_pos") - F.coalesce("pos_below", F.lit(0))
    fp = F.col("all_neg") - neg_below
    out = (
        # One row per evaluated model.
        ranked.join(totals, keys)
        .groupBy(*keys)
        .agg(
            F.try_divide(F.sum(pos * (neg_below + neg / 2)), F.sum(pos) * F.sum(neg)).alias("roc_auc"),
            F.try_divide(F.sum(pos * tp / (tp + fp)), F.sum(pos)).alias("pr_auc"),
        )
    )
    return out if by else out.drop("__all")


def roc_auc(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under ROC as the rank statistic, ties counting half."""
    return _ranking(_tally(predictions, by, "score"), by).drop("pr_auc")


def average_precision(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average precision: the step sum over descending scores, without interpolation."""
    return _ranking(_tally(predictions, by, "score"), by).drop("roc_auc")


def evaluate(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All metrics, one row per evaluated model, from one tally by score."""
    keys = list(by)
    if not keys:
        predictions, keys = predictions.withColumn("__all", F.lit(1)), ["__all"]
    tally = _tally(predictions, keys, "score")
    out = _threshold_metrics(tally, keys).join(_ranking(tally, keys), keys, "left")
    return out if by else out.drop("__all")


def business_impact(
    metrics: DataFrame,
    avg_fraud_amount: Column,
    *,
    loss_rate: float = fixed.FRAUD_LOSS_RATE,
    cost: float = fixed.INVESTIGATION_COST,
) -> DataFrame:
    """Money view of a confusion matrix."""
    saved = F.col("true_positives") * avg_fraud_amount * loss_rate
    checks = (F.col("true_positives") + F.col("false_positives")) * F.lit(cost)
    missed = F.col("false_negatives") * avg_fraud_amount * loss_rate
    return metrics.withColumns(
        {"prevented_fraud": saved, "investigation_costs": checks, "missed_fraud_cost": missed}
    ).withColumns(
        {
            "net_savings": F.col("prevented_fraud") - F.col("investigation_costs") - F.col("missed_fraud_cost"),
        }
    ).withColumn("roi", _guarded(F.col("net_savings"), F.col("investigation_costs")))
