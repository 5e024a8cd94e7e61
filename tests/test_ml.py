"""Neighbours against brute force, resampling, splits, ranking metrics, training."""

import os
import random

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from riskloom.ml import evaluate, jobs, neighbours, prep, tune
from riskloom.ml.neighbours import nearest_neighbours
from riskloom.ml.resample import smote
from riskloom.plans import ml_queries
from riskloom.session import scratch_dir


def brute(points, k):
    out = {}
    for i, x in points:
        near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(x, y)))), j) for j, y in points if j != i)
        out[i] = [(j, round(d, 9)) for d, j in near[:k]]
    return out


def points_of(kind):
    pick = random.Random(7)
    if kind == "spread":
        return [(f"p{i:03d}", [pick.gauss(0, 1) for _ in range(3)]) for i in range(150)]
    if kind == "copies":  # a third of all points are one vector
        return [(f"p{i:03d}", [1.0, 2.0]) for i in range(50)] + [
            (f"q{i:03d}", [pick.random(), pick.random()]) for i in range(100)
        ]
    if kind == "grid":  # many equal distances
        return [(f"g{i}{j}", [float(i), float(j)]) for i in range(8) for j in range(8)]
    return [("only", [0.0]), ("other", [3.0])]


@pytest.mark.parametrize("kind", ["spread", "copies", "grid", "pair"])
@pytest.mark.parametrize("block_rows", [8, 2048])
def test_neighbours_equal_brute_force(spark, kind, block_rows):
    points = points_of(kind)
    df = spark.createDataFrame(points, "id string, x array<double>")
    got = {}
    for row in nearest_neighbours(df, 3, block_rows=block_rows).orderBy("id", "rank").collect():
        got.setdefault(row.id, []).append((row.nid, round(row.d, 9)))
    assert got == brute(points, 3)


def test_neighbours_in_many_dimensions_meet_in_few_tiles(spark, monkeypatch):
    """Small cells don't meet one by one: 600 spread points in cells of 4 are 32 tiles at most, and results are exact."""
    seen = []
    tiles = neighbours._tiles
    monkeypatch.setattr(neighbours, "_tiles", lambda *a: seen.append(tiles(*a)) or seen[0])
    pick = random.Random(5)
    points = [(f"p{i:03d}", [pick.gauss(0, 1) for _ in range(12)]) for i in range(600)]
    df = spark.createDataFrame(points, "id string, x array<double>")
    got = {}
    for row in nearest_neighbours(df, 3, block_rows=8).orderBy("id", "rank").collect():
        got.setdefault(row.id, []).append((row.nid, round(row.d, 9)))
    assert got == brute(points, 3)
    first, parts = seen[0]
    assert 1 < (first + parts).max() <= 2 * neighbours.TILES


def test_few_values_are_not_joined_by_value(spark):
    """Rows stay where they are when strata and codes are joined: no task reads all rows of a class or category."""
    rows = spark.range(0, 2000, 1, 4).select(
        F.col("id").cast("string").alias("transaction_id"), (F.col("id") % 20 == 0).cast("int").alias("label"), (F.col("id") % 3).cast("string").alias("c")
    )
    for out in (prep.stratified_split(rows), prep.encode_category(rows, "c")):
        held = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(held) == 4 and max(r["count"] for r in held) == 500


def test_neighbours_of_nothing(spark):
    assert nearest_neighbours(spark.createDataFrame([], "id string, x array<double>"), 3).count() == 0


def test_smote_invariants(spark):
    pick = random.Random(3)
    rows = [(f"n{i}", [pick.gauss(0, 1), pick.gauss(0, 1)], 0) for i in range(200)]
    rows += [(f"p{i}", [pick.gauss(4, 1), pick.gauss(4, 1)], 1) for i in range(12)]
    df = spark.createDataFrame(rows, "id string, x array<double>, label int")
    out = smote(df, ratio=0.3, k=5)
    made = out.filter("synthetic").collect()
    assert out.filter("not synthetic").count() == 212
    assert len(made) == int(0.3 * 200 - 12)
    assert all(r.label == 1 for r in made)
    minority = {i: np.array(x) for i, x, y in rows if y == 1}
    near = brute([(i, list(x)) for i, x in minority.items()], 5)
    for r in made:
        base = r.id.split("/")[1]
        on_segment = False
        for j, _ in near[base]:
            a, b, p = minority[base], minority[j], np.array(r.x)
            on_segment |= abs(np.linalg.norm(a - p) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) < 1e-9
        assert on_segment
    assert sorted(r.id for r in made) == sorted(r.id for r in smote(df, ratio=0.3, k=5).filter("synthetic").collect())


def test_smote_guards(spark):
    one = spark.createDataFrame([("a", [1.0], 1), ("b", [2.0], 0), ("c", [3.0], 0)], "id string, x array<double>, label int")
    assert smote(one, ratio=1.0).count() == 3  # a single positive has no neighbour
    none = one.withColumn("label", F.lit(0))
    assert smote(none).count() == 3
    balanced = spark.createDataFrame([(str(i), [float(i)], i % 2) for i in range(10)], "id string, x array<double>, label int")
    assert smote(balanced, ratio=3.0, only_below=0.1).count() == 10


def test_exact_parts(spark):
    rows = [(f"id{i}", int(i % 17 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "transaction_id string, label int")
    split = prep.stratified_split(df)
    got = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    positives = sum(y for _, y in rows)
    assert got[(1, "test")] == int(positives * 0.2 + 0.5) and got[(0, "test")] == int((1000 - positives) * 0.2 + 0.5)
    folds = prep.stratified_folds(df, 3).groupBy("label", "fold").count().collect()
    for label, n in ((1, positives), (0, 1000 - positives)):
        sizes = [r["count"] for r in folds if r.label == label]
        assert len(sizes) == 3 and sum(sizes) == n and max(sizes) - min(sizes) <= 1
    again = values(prep.stratified_split(df.repartition(5)), "split")
    assert again == values(split, "split")


def test_few_positives_are_not_stratified(spark):
    df = spark.createDataFrame([(str(i), int(i < 3)) for i in range(100)], "transaction_id string, label int")
    assert prep.stratified_split(df).filter("split = 'test'").count() == 20


def test_unseen_category(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    codes = prep.category_codes(train, "c")
    new = spark.createDataFrame([("1", "a"), ("2", "zz"), ("3", None)], "transaction_id string, c string")
    assert values(prep.encode_category(new, "c", codes), "c_code") == {"1": (0,), "2": (3,), "3": (2,)}


def scores(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_ranking_extremes(spark):
    good = scores(spark, [(1, 1, 0.9 + i / 1000) for i in range(10)] + [(0, 0, i / 100) for i in range(30)])
    assert evaluate.roc_auc(good).first().roc_auc == 1.0
    assert evaluate.average_precision(good).first().pr_auc == 1.0
    bad = good.withColumn("score", 1 - F.col("score"))
    assert evaluate.roc_auc(bad).first().roc_auc == 0.0
    ties = good.withColumn("score", F.lit(0.5))
    assert evaluate.roc_auc(ties).first().roc_auc == 0.5


def test_no_positives(spark):
    row = evaluate.evaluate(scores(spark, [(0, 0, 0.1), (0, 1, 0.7)])).first()
    assert row.roc_auc is None and row.precision == 0.0 and row.recall == 0.0 and row.accuracy == 0.5


def test_ranking_equals_pairs(spark):
    pick = random.Random(5)
    rows = [(int(pick.random() < 0.3), 0, round(pick.random() ** 4, 3)) for _ in range(300)]
    pos, neg = [s for y, _, s in rows if y], [s for y, _, s in rows if not y]
    pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(scores(spark, rows)).first().roc_auc == pytest.approx(pairs, abs=1e-12)


def test_training_job(spark, sf):
    path = scratch_dir(spark, "test")
    feats = ml_queries.scored(spark, sf)
    assert jobs.train_job(feats.limit(10), model_dir=path, registry=path).status == "insufficient_data"
    done = jobs.train_job(
        feats, model_dir=f"{path}/models", registry=f"{path}/runs", grid={"maxIter": [2], "maxDepth": [2, 3]}, draws=1, folds=2
    )
    assert done.status == "completed" and done.rows == 1000
    model, meta = jobs.load_model(spark, done.path)
    assert len(model.stages) == 2  # scaler and trees: the resampler is not part of the model
    assert meta["features"] == prep.SCORED_SPEC.names and len(meta["features"]) == 24
    assert spark.read.parquet(f"{path}/runs").first().status == "completed"
    # Re-evaluation codes categories as in training, even when the recent rows lack some of them.
    recent = feats.filter("merchant_category <> 'adult_entertainment'")
    again = jobs.evaluate_stored(spark, done.path, recent, days=60).first()
    whole = jobs.score_batch(model, tune.with_vector(prep.matrix(feats, prep.SCORED_SPEC), prep.SCORED_SPEC.names), "transaction_id")
    kept = evaluate.evaluate(whole.join(recent.select("transaction_id"), "transaction_id")).first()
    assert again.roc_auc == pytest.approx(kept.roc_auc, abs=1e-12) and again.true_positives == kept.true_positives
    assert jobs.evaluate_stored(spark, done.path, feats.limit(5), days=60).first().status == "insufficient_data"


def test_search_draws_are_reproducible():
    one = [{p.name: v for p, v in d.items()} for d in tune.draw_params(tune.ResampledTrees(), tune.GRID, 5, 42)]
    two = [{p.name: v for p, v in d.items()} for d in tune.draw_params(tune.ResampledTrees(), tune.GRID, 5, 42)]
    assert one == two and len({str(d) for d in one}) > 1


def test_constant_columns_scale_to_zero(spark):
    from riskloom.ml import prep

    rows = spark.range(100_000, numPartitions=8).selectExpr("0.1D AS a", "0.2D AS b", "CAST(id AS double) AS c", "CAST(NULL AS double) AS d")
    got = prep.scale(rows, ["a", "b", "c", "d"]).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b"), F.avg("c"), F.stddev_pop("c"), F.count("d")).first()
    assert tuple(got)[:4] == (0.0, 0.0, 0.0, 0.0) and got[6] == 0
    assert abs(got[4]) < 1e-9 and abs(got[5] - 1) < 1e-9


def test_nothing_registered_to_compare(spark, sf):
    registry = scratch_dir(spark, "no-runs")
    jobs.append_runs(spark.createDataFrame([("a", "failed")], "run_id string, status string"), registry)
    feats = ml_queries.scored(spark, sf)
    assert jobs.compare_stored(spark, registry, feats, ml_queries.views.transactions(spark, sf)).count() == 0


def test_a_fold_searches_its_neighbours_once(spark, sf, monkeypatch):
    """Three draws with different k on two folds: one neighbour search per fold, and one for the final fit."""
    from riskloom.ml import resample

    searched, real = [], resample.nearest_neighbours
    monkeypatch.setattr(resample, "nearest_neighbours", lambda points, k, **kw: searched.append(k) or real(points, k, **kw))
    rows = jobs.split_matrix(ml_queries.scored(spark, sf))
    grid = {"maxIter": [1], "maxDepth": [2], "ratio": [0.2, 0.4], "neighbours": [3, 5]}
    search = tune.random_search(tune.with_vector(rows, ml_queries._NAMES), grid=grid, draws=3, folds=2)
    assert len(search.avgMetrics) == 3 and len(searched) == 3


def test_a_longer_neighbour_list_gives_the_same_rows(spark):
    from riskloom.ml import resample

    random.seed(5)
    data = [(f"p{i}", [random.random(), random.random()], int(i % 6 == 0)) for i in range(240)]
    df = spark.createDataFrame(data, "id string, x array<double>, label int")
    near = resample.minority_neighbours(df.filter("label = 1"), 7)
    assert sorted(map(str, smote(df, k=3, near=near).collect())) == sorted(map(str, smote(df, k=3).collect()))


def test_rows_of_a_fit_are_dealt_in_bounded_parts(spark, monkeypatch):
    """Many rows in one partition are spread by id, a few stay; nothing is lost, and how they lay before doesn't matter."""
    from riskloom.ml import tune

    monkeypatch.setattr(tune, "TASK_ROWS", 100)
    few, many = (spark.range(n).coalesce(1).selectExpr("cast(id as string) AS id", "id AS x") for n in (100, 2000))
    assert tune.dealt(few).rdd.getNumPartitions() == 1
    parts = tune.dealt(many).rdd.glom().collect()
    sizes = list(map(len, parts))
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) < 200
    assert tune.dealt(many.repartition(7)).rdd.glom().collect() == parts


class Asked(Exception):
    """The search that a query asks for, instead of its fits."""


def asked(spark, monkeypatch, query, folder):
    """The search of a query over 1,200 own events, as (draws by name, folds); nothing is fitted."""

    def stop(search, dataset):
        raise Asked([{p.name: v for p, v in draw.items()} for draw in search.getEstimatorParamMaps()], search.getNumFolds())

    events = spark.range(1200).selectExpr(
        "id AS event_id", "id % 40 AS user_id", "timestamp_seconds(1704067200 + id * 600) AS ts",
        "element_at(array('click', 'view', 'signup', 'purchase', 'error'), cast(id % 5 AS int) + 1) AS event_type",
        "20.0D + id * 37 % 400 AS value", "concat('{\"k\": ', id * 7 % 90, '}') AS props",
    )
    events.write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(tune.CrossValidator, "fit", stop)
    with pytest.raises(Asked) as found:
        query(spark, str(folder))
    return found.value.args


@pytest.mark.parametrize("query", [ml_queries._job, ml_queries._tune])
def test_training_query_searches_the_whole_grid(spark, monkeypatch, tmp_path, query):
    draws, folds = asked(spark, monkeypatch, query, tmp_path)
    whole = tune.draw_params(tune.ResampledTrees(), tune.GRID, 50, 42)
    assert folds == 5 and draws == [{p.name: v for p, v in d.items()} for d in whole]
    assert {name: {d[name] for d in draws} for name in tune.GRID} == {name: set(values) for name, values in tune.GRID.items()}


def test_behaviour_query_searches_its_whole_grid(spark, monkeypatch, tmp_path):
    draws, folds = asked(spark, monkeypatch, ml_queries._job_behaviour, tmp_path)
    whole = tune.draw_params(tune.ResampledTrees(), tune.GRID_BEHAVIOUR, 20, 42)
    assert folds == 3 and len(draws) == 20 and draws == [{p.name: v for p, v in d.items()} for d in whole]


def test_draws_with_one_resampling_share_its_rows(spark, monkeypatch):
    """Four draws, two resamplings: on each of two folds two frames, and one for the final fit; the shared ones are gone in the end."""
    random.seed(4)
    data = [(f"t{i:03d}", random.random(), random.random(), int(i % 6 == 0)) for i in range(180)]
    rows = tune.with_vector(spark.createDataFrame(data, "transaction_id string, a double, b double, label int"), ["a", "b"])
    made, gone, real, discard = [], [], tune.smote, tune.discard
    monkeypatch.setattr(tune, "smote", lambda df, **kw: made.append(kw["ratio"]) or real(df, **kw))
    monkeypatch.setattr(tune, "discard", lambda frame: gone.append(frame.inputFiles()[0]) or discard(frame))
    draws = [(0.3, 1), (0.5, 1), (0.3, 2), (0.5, 2)]
    monkeypatch.setattr(tune, "draw_params", lambda estimator, *_: [
        {estimator.ratio: ratio, estimator.maxDepth: depth, estimator.maxIter: 1} for ratio, depth in draws
    ])
    search = tune.random_search(rows, draws=4, folds=2)
    assert len(search.avgMetrics) == 4 and min(search.avgMetrics) > 0
    assert sorted(made[:-1]) == [0.3, 0.3, 0.5, 0.5] and len(gone) == 4
    assert not any(os.path.exists(os.path.dirname(file.removeprefix("file://"))) for file in gone)


def test_shared_rows_are_those_of_the_resampling(spark):
    random.seed(6)
    data = [(f"p{i:03d}", [random.random(), random.random()], int(i % 9 == 0)) for i in range(270)]
    df = spark.createDataFrame(data, "id string, x array<double>, label int").repartition(5)
    whole = smote(df, ratio=0.4, k=3).select("id", "x", "label")
    shared = tune.SharedRows(lambda i: smote(df, ratio=0.4, k=3), [(0.4, 3)] * 2)
    with shared.of(0) as rows, shared.of(1) as again:
        assert again is rows and rows.rdd.getNumPartitions() == 1
        assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect())) and rows.count() > 270


def test_long_fits_begin_early_and_a_resampling_stays_together():
    grid = [(100, 3, 0.0, 0.1), (500, 8, 0.2, 0.2), (300, 8, 0.0, 0.3), (200, 4, 0.0, 0.1), (100, 3, 0.1, 0.3)]
    draws = [tune.ResampledTrees(maxIter=n, maxDepth=d, minInfoGain=g, ratio=r) for n, d, g, r in grid]
    assert tune.longest_first(draws, [(r,) for *_, r in grid]) == [2, 4, 3, 0, 1]
