"""Training, persistence, registry and comparison jobs."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.expressions import ratio
from riskloom.ml import evaluate, tune
from riskloom.ml.prep import BEHAVIOUR_SPEC, SCORED_SPEC, MatrixSpec, category_codes, matrix, stratified_split
from riskloom.operators.limits import guard_min_rows, recent_models
from riskloom.operators.summaries import amount_by_label, filter_recent
from riskloom.session import materialise


def feature_importance(spark, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Feature scores, ranked. One row per feature."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(names, map(float, scores)), key=lambda p: (-p[1], p[0]))
    ranked = [(i, name, score) for i, (name, score) in enumerate(rows, 1)]
    return spark.createDataFrame(ranked, "rank int, feature string, importance double")


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def save_model(
    model: PipelineModel, meta: Mapping, path: str, codes: Mapping[str, DataFrame] | None = None
) -> str:
    """Model, metadata and the category codes it was trained with, side by side."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(dict(meta), default=str, sort_keys=True),)], "value string").write.mode(
        "overwrite"
    ).text(f"{path}/metadata")
    for name, table in (codes or {}).items():
        table.write.mode("overwrite").parquet(f"{path}/codes/{name}")
    return path


def load_codes(spark, path: str, spec: MatrixSpec) -> dict[str, DataFrame]:
    return {c: spark.read.parquet(f"{path}/codes/{c}") for c in spec.category}


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    meta = spark.read.text(f"{path}/metadata").first().value
    return PipelineModel.load(f"{path}/model"), json.loads(meta)


def register_run(spark, registry: str, row: Mapping) -> DataFrame:
    """Append one run; JSON payloads are kept as text."""
    values = {name: row.get(name) for name in schemas.TRAINING_RUN.names}
    values["created_at"] = values["created_at"] or datetime.now(timezone.utc)
    loose = ", ".join(
        f"{f.name} {'double' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}"
        for f in schemas.TRAINING_RUN.fields
    )
    return append_runs(spark.createDataFrame([tuple(values.values())], loose), registry)


def append_runs(runs: DataFrame, registry: str) -> DataFrame:
    """Append runs in the registry's types; columns they lack are NULL."""
    given = set(runs.columns)
    typed = runs.select(
        *[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.TRAINING_RUN.fields]
    )
    typed.write.mode("append").parquet(registry)
    return typed


def read_runs(spark, registry: str) -> DataFrame:
    return spark.read.schema(schemas.TRAINING_RUN).parquet(registry)


def score_batch(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    """Prediction and probability for every row: a narrow, distributed transform."""
    return tune.as_predictions(model.transform(rows), *keep)


def evaluate_recent(
    model: PipelineModel, feats: DataFrame, names: Sequence[str], *, days: int = 7, min_rows: int = 100,
    ts: str = "timestamp",
) -> DataFrame:
    """Metrics of a stored model on recent labelled rows, or a status row when there are too few."""
    recent = filter_recent(feats.filter(F.col("label").isNotNull()), days * 86400, ts=ts)
    status = guard_min_rows(recent, min_rows)
    if status.first().status != "ok":
        return status
    return evaluate.evaluate(score_batch(model, tune.with_vector(recent, names)))


def evaluate_stored(
    spark, path: str, feats: DataFrame, spec: MatrixSpec = SCORED_SPEC, *, ts: str = "timestamp", **limits
) -> DataFrame:
    """Load a model and re-evaluate it on recent rows, coded as in training."""
    model, _ = load_model(spark, path)
    rows = matrix(feats, spec, codes=load_codes(spark, path, spec), keep=[ts])
    return evaluate_recent(model, rows, spec.names, ts=ts, **limits)


def split_matrix(
    feats: DataFrame, spec: MatrixSpec = SCORED_SPEC, *, seed: int = 42, codes: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The training matrix with its split, materialised: every fold, fit and metric reads it."""
    rows = materialise(matrix(feats, spec, codes=codes), "matrix")
    return materialise(stratified_split(rows, seed=seed), "split")


@dataclass(frozen=True)
class TrainingResult:
    run_id: str
    status: str
    metrics: dict
    params: dict
    path: str
    rows: int


def train_job(
    feats: DataFrame,
    *,
    model_dir: str,
    registry: str,
    spec: MatrixSpec = SCORED_SPEC,
    grid: Mapping[str, Sequence] = tune.GRID,
    draws: int = 50,
    folds: int = 5,
    seed: int = 42,
    min_rows: int = 1000,
    estimator: tune.ResampledTrees | None = None,
) -> TrainingResult:
    """Matrix, split, search, evaluation, persistence, registry. Data stays in DataFrames;
    the driver only sees metrics."""
    spark = feats.sparkSession
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = f"run-{uuid.uuid4().hex}"
    if guard_min_rows(feats, min_rows).first().status != "ok":
        return TrainingResult(run_id, "insufficient_data", {}, {}, "", 0)
    codes = {c: materialise(category_codes(feats, c), "codes") for c in spec.category}
    rows = split_matrix(feats, spec, seed=seed, codes=codes)
    train = tune.with_vector(rows.filter("split = 'train'"), spec.names)
    test = tune.with_vector(rows.filter("split = 'test'"), spec.names)
    search = tune.random_search(train, grid=grid, draws=draws, folds=folds, seed=seed, estimator=estimator)
    model = search.bestModel
    metrics = evaluate.evaluate(score_batch(model, test)).first().asDict()
    importance = feature_importance(spark, model, spec.names)
    weights = {row.feature: row.importance for row in importance.collect()}
    params = {**tune.best_params(search), "cv_auc": max(search.avgMetrics)}
    path = save_model(
        model, {"run_id": run_id, "features": spec.names, "metrics": metrics, "params": params},
        f"{model_dir}/{run_id}", codes,
    )
    size = rows.agg(F.count("*").alias("n"), F.sum("label").alias("fraud")).first()
    ended = datetime.now(timezone.utc).replace(tzinfo=None)
    register_run(
        spark, registry,
        {
            "run_id": run_id, "model_name": "boosted_trees", "model_version": "v1.0",
            "algorithm": "boosted trees with oversampling",
            "training_data_count": size.n, "training_fraud_count": size.fraud,
            "training_fraud_rate": size.fraud / size.n,
            "accuracy": metrics["accuracy"], "precision_score": metrics["precision"],
            "recall_score": metrics["recall"], "f1_score": metrics["f1_score"],
            "auc_roc": metrics["roc_auc"], "auc_pr": metrics["pr_auc"],
            "hyperparameters": json.dumps(params), "feature_importance": json.dumps(weights),
            "training_start": started, "training_end": ended,
            "training_seconds": (ended - started).total_seconds(), "model_path": path, "status": "completed",
        },
    )
    return TrainingResult(run_id, "completed", metrics, params, path, size.n)


def train_behaviour_job(feats: DataFrame, *, model_dir: str, registry: str, **settings) -> TrainingResult:
    """The variant on the behavioural table: smaller search, oversampling to 10% only where fraud is rarer."""
    defaults = {
        "spec": BEHAVIOUR_SPEC, "grid": tune.GRID_BEHAVIOUR, "draws": 20, "folds": 3, "min_rows": 100,
        "estimator": tune.ResampledTrees(ratio=0.1, onlyBelow=0.1),
    }
    return train_job(feats, model_dir=model_dir, registry=registry, **{**defaults, **settings})


def compare(predictions: DataFrame, tx: DataFrame, model: str = "model_id") -> DataFrame:
    """One row per model on the same test rows: metrics, confusion, money. One grouped pass."""
    metrics = evaluate.evaluate(predictions, by=[model])
    fraud_mean = amount_by_label(tx).select("avg_fraud_amount").scalar()
    return evaluate.business_impact(metrics, F.coalesce(fraud_mean, F.lit(0.0)))


def score_stored(spark, run, feats: DataFrame, spec: MatrixSpec = SCORED_SPEC) -> DataFrame:
    """Rows scored by a registered run's model, coded as in its training, written; with the milliseconds a row took."""
    model, meta = load_model(spark, run.model_path)
    rows = matrix(feats, spec, codes=load_codes(spark, run.model_path, spec))
    began = time.monotonic()
    scored = materialise(score_batch(model, tune.with_vector(rows, meta["features"]), "transaction_id"), "scored")
    spent = (time.monotonic() - began) * 1000
    per_row = F.lit(spent) / scored.agg(F.count("*").alias("n")).scalar()
    return scored.withColumns({"model_id": F.lit(run.run_id), "ms_per_row": per_row})


def compare_stored(
    spark, registry: str, feats: DataFrame, tx: DataFrame, spec: MatrixSpec = SCORED_SPEC, *, k: int = 3
) -> DataFrame:
    """The k newest completed runs of a registry, loaded and compared on the same rows.

    The driver loops over k models and sees their registry rows; all scores stay in written tables. No run, no row.
    """
    scored = [score_stored(spark, run, feats, spec) for run in recent_models(read_runs(spark, registry), k).collect()]
    if not scored:
        nothing = spark.createDataFrame([], "label int, score double, prediction int, model_id string, ms_per_row double")
        scored = [nothing]
    together = reduce(DataFrame.unionByName, scored)
    speed = together.groupBy("model_id").agg(F.max("ms_per_row").alias("ms_per_row"))
    return compare(together, tx).join(speed, "model_id")


def significance(pairs: DataFrame, first: Column, second: Column, label: Column) -> DataFrame:
    """Paired test of two models (McNemar with continuity correction) and a two-proportion z."""
    hit_a, hit_b = first == label, second == label
    counts = pairs.agg(
        F.count("*").alias("n"),
        F.count_if(hit_a & ~hit_b).alias("only_first"),
        F.count_if(~hit_a & hit_b).alias("only_second"),
        F.count_if(hit_a).alias("first_right"),
        F.count_if(hit_b).alias("second_right"),
    )
    b, c, n = F.col("only_first"), F.col("only_second"), F.col("n")
    gap = F.greatest(F.abs(b - c) - 1, F.lit(0)).cast("double")
    pooled = ratio(F.col("first_right") + F.col("second_right"), n * 2)
    spread = F.sqrt(pooled * (1 - pooled) * 2 / n)
    return counts.withColumns(
        {
            "mcnemar_chi2": F.coalesce(ratio(gap * gap, b + c), F.lit(0.0)),
            "z": F.coalesce(
                F.try_divide(ratio(F.col("first_right") - F.col("second_right"), n), F.nullif(spread, F.lit(0.0))), F.lit(0.0)
            ),
        }
    )
