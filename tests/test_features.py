"""Golden sample, edge rows, and rolling windows against plain ones."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import fixed
from riskloom.operators import behaviour, features, history, skew
from riskloom.plans import views

# The three-row sample whose results are known.
SAMPLE = [
    ("txn_001", "user_001", 50.0, "2024-01-15T10:30:00", "grocery", False),
    ("txn_002", "user_001", 1500.0, "2024-01-15T22:45:00", "electronics", True),
    ("txn_003", "user_002", 25.0, "2024-01-15T12:15:00", "restaurant", False),
]
COLUMNS = "transaction_id string, user_id string, amount double, timestamp string, merchant_category string, is_fraud boolean"


def parsed(spark, rows):
    return features.parse_timestamp(spark.createDataFrame(rows, COLUMNS)).drop("timestamp")


def test_three_row_sample(spark):
    tx = parsed(spark, SAMPLE)
    out = behaviour.build_ml_features(tx)
    assert out.columns == list(fixed.ML_TABLE_COLUMNS) and len(out.columns) == 24
    got = values(out, "day_of_week", "is_weekend", "is_night", "amount_round", "merchant_risk_score",
                 "transactions_last_24h", "minutes_since_last", "user_merchant_frequency", "anomaly_score", digits=4)
    assert got == {
        "txn_001": (2, False, False, True, 0.2, 0, 999999.0, 1, 0.25),
        "txn_002": (2, False, False, True, 0.5, 1, 735.0, 1, 0.25),
        "txn_003": (2, False, False, True, 0.2, 0, 999999.0, 1, 0.25),
    }
    z = values(out, "amount_zscore", digits=4)
    assert z == {"txn_001": (0.0,), "txn_002": (0.7071,), "txn_003": (0.0,)}
    std = values(behaviour.behaviour_features(tx), "user_std_amount_7d", digits=3)
    assert std == {"txn_001": (None,), "txn_002": (1025.305,), "txn_003": (None,)}
    assert values(features.temporal_features(tx), "is_night")["txn_002"] == (True,)


def test_calendar_edges(spark):
    days = ["2024-07-04T06:00:00", "2024-11-04T22:00:00", "2024-12-25T23:00:00", "2024-12-31T07:00:00", "2024-03-01T05:59:59.5", "bad"]
    tx = parsed(spark, [(str(i), "u", 1.0, d, "x", False) for i, d in enumerate(days)])
    got = values(features.temporal_features(tx), "is_holiday", "is_night", "is_night_b")
    assert got["0"] == (True, True, False)
    assert got["1"] == (True, True, False)
    assert got["2"] == (True, True, True)
    assert got["3"] == (True, False, False)
    assert got["4"][0] is False or got["4"] == (False, True, True)
    assert got["5"] == (False, False, False)  # unparsable: NULL timestamp, flags false


def edge_rows():
    start = dt.datetime(2024, 1, 1, 12)
    rows = [(f"same{i}", "same", 10.0, start + dt.timedelta(hours=i)) for i in range(4)]
    rows += [("null1", "nulls", None, start), ("null2", "nulls", 5.0, start + dt.timedelta(minutes=5)),
             ("null3", "nulls", None, start + dt.timedelta(days=8))]
    rows += [("one", "single", 99.5, start)]
    rows += [("peer1", "peer", 1.0, start), ("peer2", "peer", 2.5, start + dt.timedelta(milliseconds=400)),
             ("peer3", "peer", 3.0, start + dt.timedelta(seconds=1))]
    rows += [(f"fast{i:02d}", "fast", 20.0 + i, start + dt.timedelta(minutes=i)) for i in range(13)]
    rows += [(f"gap{i}", "gap", 7.25 * (i + 1), start + dt.timedelta(days=d)) for i, d in enumerate((0, 1, 6, 7, 7.5, 31, 44, 75, 200))]
    return [(i, u, a, t, ("grocery", "travel")[n % 2], False) for n, (i, u, a, t) in enumerate(rows)]


def edges(spark):
    return spark.createDataFrame(
        edge_rows(), "transaction_id string, user_id string, amount double, ts timestamp, merchant_category string, is_fraud boolean"
    )


def test_edge_rows(spark):
    out = behaviour.build_ml_features(edges(spark))
    got = values(out, "amount_zscore", "transactions_last_24h", "minutes_since_last", "velocity_unusual")
    assert got["same3"][0] == 0.0  # zero deviation
    assert got["one"] == (0.0, 0, 999999.0, False)
    assert got["peer2"][2] == 0.0 and got["peer1"][1] == 1  # same second counts as a peer
    assert got["fast12"][1] == 12 and got["fast12"][3] is True
    assert got["fast10"][3] is False


def assert_same(one, two, columns):
    left, right = values(one, *columns), values(two, *columns)
    assert left.keys() == right.keys()
    for key, row in left.items():
        assert row == pytest.approx(right[key], abs=1e-6), (key, columns)


def plain_windows(tx, horizons=("24h", "7d", "30d"), amounts=True, recency=True, frequency=True, as_of=False):
    """The same values by window functions over whole users."""
    df = tx.withColumn("sec", F.unix_timestamp("ts"))
    user = Window.partitionBy("user_id").orderBy("sec")
    last = {h: user.rangeBetween(-fixed.HORIZONS[h], 0) for h in ("1h", "24h", "7d", "30d") if h in fixed.HORIZONS}
    out = {f"transactions_last_{h}": F.count("*").over(last[h]) - 1 for h in horizons}
    if amounts:
        out |= {"user_avg_amount_24h": F.avg("amount").over(last["24h"]), "user_avg_amount_7d": F.avg("amount").over(last["7d"]),
                "user_std_amount_7d": F.stddev("amount").over(last["7d"]), "user_max_amount_7d": F.max("amount").over(last["7d"])}
    if as_of:
        before = user.rangeBetween(Window.unboundedPreceding, -1)
        out |= {"history_transactions": F.count("*").over(before), "history_avg_amount": F.avg("amount").over(before),
                "history_std_amount": F.stddev("amount").over(before)}
    if frequency:
        out["user_merchant_frequency"] = F.count("*").over(Window.partitionBy("user_id", "merchant_category").orderBy("sec"))
        out["user_hour_frequency"] = F.count("*").over(Window.partitionBy("user_id", F.hour("ts")).orderBy("sec"))
    if recency:
        previous = F.lag("sec").over(Window.partitionBy("user_id").orderBy("ts", "transaction_id"))
        out["minutes_since_last"] = F.coalesce((F.col("sec") - previous) / 60.0, F.lit(fixed.FIRST_TRANSACTION_MINUTES))
    return df.withColumns(out), list(out)


@pytest.mark.parametrize("source", ["edges", "events"])
def test_windows_equal_plain_ones(spark, sf, source):
    tx = edges(spark) if source == "edges" else views.transactions(spark, sf)
    plain, added = plain_windows(tx, as_of=True)
    assert_same(plain, behaviour.user_windows(tx, as_of=True), added)


def test_one_user_with_most_rows(spark, sf):
    tx = views.transactions(spark, sf).withColumn("user_id", (F.col("user_id").cast("long") % 2).cast("string"))
    plain, added = plain_windows(tx, as_of=True)
    assert_same(plain, behaviour.user_windows(tx, as_of=True), added)


def test_windows_of_feature_subsets(spark, sf):
    tx = views.transactions(spark, sf)
    for part in (
        {"horizons": (), "amounts": False, "recency": False},
        {"horizons": ("1h",), "amounts": False, "recency": False, "frequency": False},
        {"horizons": (), "amounts": False, "frequency": False},
        {"horizons": (), "recency": False, "frequency": False},
        {"horizons": (), "amounts": False, "recency": False, "frequency": False, "as_of": True},
    ):
        plain, added = plain_windows(tx, **part)
        assert_same(plain, behaviour.user_windows(tx, **part), added)


def test_windows_keep_rows_with_nulls_and_odd_amounts(spark):
    start = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(60):
        amount = [5.0 + i, None, float("nan"), 7.5, float("inf")][0 if i < 30 else i % 5]
        rows.append((f"t{i:02d}", None if i % 4 == 1 else "u", amount, start + dt.timedelta(hours=7 * i), None if i % 5 == 3 else "grocery", False))
    tx = spark.createDataFrame(rows, edges(spark).schema)
    plain, added = plain_windows(tx, as_of=True)
    left, right = values(plain, *added), values(behaviour.user_windows(tx, as_of=True), *added)
    assert left.keys() == right.keys() and len(right) == 60
    for key, row in left.items():
        assert row == pytest.approx(right[key], abs=1e-6, nan_ok=True), (key, added)
    untimed = tx.unionByName(tx.limit(1).withColumns({"transaction_id": F.lit("late"), "ts": F.lit(None).cast("timestamp")}))
    got = values(behaviour.user_windows(untimed, as_of=True), "transactions_last_24h", "minutes_since_last", "history_transactions", "user_merchant_frequency")
    assert len(got) == 61 and got["late"] == (0, 999999.0, 0, 1)
    assert got["t00"][2:] == (1, 2) and got["t00"][1] == 999999.0


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_no_window_over_a_whole_user(spark, sf):
    """Windows are over blocks of time, or over one carried row per block."""
    plan = plan_of(behaviour.build_ml_features(views.transactions(spark, sf), velocity=10))
    for line in plan.splitlines():
        if "windowspecdefinition(user_id" in line:
            assert "__chunk" in line


def test_filter_and_columns_reach_the_scan(spark, sf):
    tx = views.transactions(spark, sf).filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp")).select("transaction_id")
    plan = plan_of(tx)
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_results_do_not_depend_on_partitioning(spark, sf):
    tx = views.transactions(spark, sf)
    shuffled = tx.repartition(13, "merchant_category")
    assert_same(behaviour.build_ml_features(tx), behaviour.build_ml_features(shuffled), ["amount_zscore", "minutes_since_last", "user_hour_frequency"])


def test_scored_types_and_unknown_user(spark):
    tx = spark.createDataFrame(
        [("a", "known", 100.0, dt.datetime(2024, 5, 1, 3), "gambling", "card", True),
         ("b", "new", 30.0, dt.datetime(2024, 5, 1, 9), "grocery", "card", None),
         ("c", "steady", 1e13, dt.datetime(2024, 5, 1, 9), "grocery", "card", False)],
        "transaction_id string, user_id string, amount double, ts timestamp, merchant_category string, payment_method string, is_fraud boolean",
    )
    past = spark.createDataFrame(
        [("p1", "known", 10.0, False), ("p2", "known", 30.0, True), ("p3", "steady", 5.0, False), ("p4", "steady", 5.0, False)],
        "transaction_id string, user_id string, amount double, is_fraud boolean",
    )
    out = history.score(tx, history.user_stats(past))
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in schemas.SCORED.fields]
    rows = {r.transaction_id: r for r in out.collect()}
    assert float(rows["b"].amount_zscore) == 0.0 and float(rows["b"].amount_percentile) == 50.0
    assert rows["b"].user_avg_amount is None
    assert float(rows["a"].amount_percentile) == 100.0 and rows["a"].amount_round is True
    assert rows["c"].amount is None  # too large for the column: NULL, never an invented amount


def test_unknown_position_is_not_far(spark):
    from riskloom.operators.detect import detect_geo_outlier

    tx = spark.createDataFrame(
        [("a", "u", 10.0, 10.0), ("b", "u", None, None), ("c", "u", 10.1, 10.0)],
        "transaction_id string, user_id string, location_lat double, location_lng double",
    )
    assert detect_geo_outlier(tx, km=1000).count() == 0


def test_user_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "transaction_id string, user_id string, amount double, is_fraud boolean, ts timestamp")
    from riskloom.operators import summaries

    assert history.user_stats(empty).count() == 0
    row = summaries.tx_statistics(empty).first()
    assert row.total_transactions == 0 and row.fraud_percentage is None
    assert behaviour.user_windows(empty.withColumn("merchant_category", F.lit("a")), as_of=True).count() == 0


def test_running_ranges(spark, many_ranges):
    rows = spark.createDataFrame([("k", i, (i * 7) % 5 + 1) for i in range(100)], "key string, pos int, v int")
    out = skew.running(
        rows, keys=["key"], order="pos",
        values={"total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}, inclusive=True,
    ).orderBy("pos").collect()
    seen = []
    for r in out:
        seen.append(r.v)
        assert (r.total, r.low, r.high) == (sum(seen), min(seen), max(seen))


@pytest.fixture
def many_ranges(spark):
    """Small test frames stay in as many ranges as large ones would have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_crowded_values_are_split(spark, many_ranges):
    """All values in [0.9999, 1) and a third of the rows on one of them: several ranges, none with most values, exact ranks."""
    from riskloom.ml import evaluate

    scores = [0.9999 + (i * 7919 % 3000) * 3e-8 for i in range(3000)]
    data = [(s, int(i % 3 == 0)) for i, s in enumerate(scores)] + [(scores[5], i % 2) for i in range(1500)]
    df = spark.createDataFrame(data, "score double, label int").withColumn("prediction", F.lit(1))
    sizes = [r["count"] for r in skew.by_range(df.select("score").distinct(), "score").groupBy("__block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1000
    assert df.limit(1).select(skew.exact_quantile(df, "score").alias("q")).first().q == sorted(s for s, _ in data)[len(data) // 2 - 1]
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    ordered, below, better, i, j = sorted(neg), 0, 0.0, 0, 0
    for s in sorted(pos):
        while i < len(ordered) and ordered[i] < s:
            i += 1
        j = max(i, j)
        while j < len(ordered) and ordered[j] == s:
            j += 1
        better += i + (j - i) / 2
    assert abs(evaluate.roc_auc(df).first().roc_auc - better / (len(pos) * len(neg))) < 1e-12


def test_dense_codes(spark, many_ranges):
    from riskloom.ml import prep

    names = [f"n{i * 7919 % 2000:05d}" for i in range(2000)] * 2 + ["Z", "\u00e9", ""]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "c string")
    codes = prep.category_codes(df, "c")
    known = sorted({*names, "unknown"}, key=lambda n: n.encode())
    assert {r.c: r.c_code for r in codes.collect()} == {n: i for i, n in enumerate(known)}
    assert "SinglePartition" not in codes._jdf.queryExecution().toString()
    assert prep.category_codes(df.limit(0), "c").count() == 0


def test_contract_rules(spark):
    from riskloom import schemas
    from riskloom.operators import quality

    df = spark.createDataFrame(
        [("a", 1.25, "2024-01-01", 5, "x"), (None, 1.255, "no day", 300, "y"), ("abc", 1e12, None, None, None), ("b", float("nan"), "2024-01-01", 7, "x")],
        "id string, amount double, day string, n int, kind string",
    )
    schema = "id string not null, amount decimal(12,2), day date, n tinyint, kind string not null, extra int"
    out = quality.check_contract(df, schema, lengths={"id": 2}, bounds={"amount": (0, 100), "n": (6, None)}, allowed={"kind": ["x"]})
    assert {(r.column_name, r.rule): r.violations for r in out.collect()} == {
        ("id", "required"): 1, ("kind", "required"): 1, ("extra", "present"): 4, ("amount", "type"): 2, ("amount", "scale"): 1, ("day", "type"): 1,
        ("n", "type"): 1, ("id", "length"): 1, ("amount", "range"): 2, ("n", "range"): 1, ("kind", "allowed"): 1,
    }
    empty = quality.check_contract(df.limit(0), schemas.TRANSACTION_TABLE)
    assert {r.violations for r in empty.collect()} == {0}


def test_exact_quantile(spark):
    numbers = [-5.5, -0.25, 0.0, 0.0, 1e-9, 3.0, 3.0, 3.0, 700.0, 1e12, None]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    known = sorted(v for v in numbers if v is not None)
    for q in (0.1, 0.5, 0.75, 1.0):
        want = next(v for i, v in enumerate(known, 1) if i >= q * len(known) - 1e-12)
        assert df.limit(1).select(skew.exact_quantile(df, "v", q).alias("q")).first().q == want
