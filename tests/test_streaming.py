"""Replay safety, late rows, deduplication, quarantine, settings."""

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.config import StreamConfig
from riskloom.plans import views
from riskloom.plans.stream_queries import replay
from riskloom.plans.table_queries import messages_of
from riskloom.session import scratch_dir
from riskloom.sources import messages, sinks, tables
from riskloom.streaming import jobs

SCHEMA = "transaction_id string, user_id string, amount double, ts timestamp, merchant_category string, payment_method string, location_lat double, location_lng double, device_id string, is_fraud boolean"


def rows(spark, *specs):
    start = dt.datetime(2024, 1, 1)
    data = [(i, u, a, start + dt.timedelta(minutes=m), "grocery", "card", None, None, None, False) for i, u, a, m in specs]
    return spark.createDataFrame(data, SCHEMA)


def put(spark, path, df):
    messages_of(df).select("value").coalesce(1).write.mode("append").text(path)


def test_batch_is_idempotent(spark):
    path = scratch_dir(spark, "idem")
    df = rows(spark, ("a", "u", 1.0, 0), ("b", "u", 2.0, 1))
    for _ in range(2):
        sinks.write_batch(df, 0, path)
    sinks.write_batch(df, 1, path)
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 2), (1, 2)]


def test_late_rows_do_not_reopen_windows(spark):
    """Lateness is judged by the watermark of the batch before, hence the extra batch."""
    source, target, check = (scratch_dir(spark, n) for n in ("late", "late-out", "late-check"))
    for part in ([("a", "u", 1.0, 0), ("b", "u", 1.0, 30)], [("c", "u", 1.0, 300)], [("c2", "u", 1.0, 302)], [("late", "u", 1.0, 1), ("d", "u", 1.0, 301)]):
        put(spark, source, rows(spark, *part))
    stream = jobs.transaction_stream(spark, source, max_files=1)
    jobs.drain(jobs.start(jobs.windowed_volume(stream), jobs.to_table(target), check, mode="update"))
    final = jobs.latest_by_key(tables.read_table(spark, target), "window_start", "payment_method")
    assert {r.window_start.hour: r.n for r in final.collect()} == {0: 2, 5: 3}


def test_duplicates_within_and_across_batches(spark):
    source, target, check = (scratch_dir(spark, n) for n in ("dup", "dup-out", "dup-check"))
    put(spark, source, rows(spark, ("a", "u", 1.0, 0), ("a", "u", 1.0, 0), ("b", "u", 1.0, 1)))
    put(spark, source, rows(spark, ("b", "u", 1.0, 1), ("c", "u", 1.0, 2)))
    stream = jobs.transaction_stream(spark, source, max_files=1)
    jobs.drain(jobs.start(jobs.deduplicated(stream), jobs.to_table(target), check))
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_orphans_and_duplicates_in_scoring(spark):
    source, target, check, bad = (scratch_dir(spark, n) for n in ("sc", "sc-out", "sc-check", "sc-bad"))
    given = rows(spark, ("a", "u", 1.0, 0), ("a", "u", 1.0, 0), ("orphan", "u", 2.0, 1), ("done", "u", 3.0, 2))
    put(spark, source, given)
    from riskloom.operators.history import user_stats

    jobs.drain(
        jobs.run_scoring_stream(
            spark, source, stats=user_stats(given), processed=given.filter("transaction_id = 'done'"),
            parent=given.filter("transaction_id <> 'orphan'"), target=target, quarantine=bad, checkpoint=check,
        )
    )
    assert [r.transaction_id for r in spark.read.parquet(target).collect()] == ["a"]
    assert [r.transaction_id for r in spark.read.parquet(f"{bad}/orphans").collect()] == ["orphan"]


def test_partials_merge_to_the_statistics_of_all_rows(spark):
    from riskloom.operators.history import merge_partials, stats_of_partials, user_partials, user_stats

    data = [(str(i), None if i % 50 == 0 else f"u{i % 7}", 1e6 + (i * 7919 % 1000) / 64, i) for i in range(700)]
    data += [("n", "nan", float("nan"), 1), ("one", "single", 5.0, 2), ("i", "u1", float("inf"), 3)]
    df = rows(spark, *data)
    parts = [user_partials(df.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == k)) for k in range(3)]
    merged = merge_partials(parts[0].unionByName(parts[1])).unionByName(parts[2])
    assert values(stats_of_partials(merged), key="user_id", digits=6) == values(user_stats(df), key="user_id", digits=6)
    assert stats_of_partials(parts[0].limit(0)).count() == 0


def test_scoring_with_its_own_statistics(spark):
    """Each batch is scored by what earlier batches left; a replayed batch leaves the same."""
    source, target, check, bad, kept = (scratch_dir(spark, n) for n in ("ps", "ps-out", "ps-check", "ps-bad", "ps-kept"))
    nothing = rows(spark, ("a", "u", 1.0, 0)).limit(0)
    for part in ([("a", "u", 10.0, 0), ("b", "u", 30.0, 1)], [("c", "u", 50.0, 2), ("d", "v", 1.0, 3)], [("e", "u", 1.0, 4)]):
        put(spark, source, rows(spark, *part))
        jobs.drain(jobs.run_scoring_stream(
            spark, source, processed=nothing, target=target, quarantine=bad, checkpoint=check, partials=kept,
        ))
    seen = {r.transaction_id: r.user_avg_amount for r in spark.read.parquet(target).collect()}
    assert {k: float(v) if v is not None else None for k, v in seen.items() if k in "ce"} == {"c": 20.0, "e": 30.0}
    assert spark.read.parquet(kept).count() == 4
    with pytest.raises(ValueError):
        jobs.run_scoring_stream(spark, source, processed=nothing, target=target, quarantine=bad, checkpoint=check)


def test_malformed_messages(spark):
    texts = [
        '{"transaction_id":"1","user_id":"u","amount":2.5,"timestamp":"2024-01-01T00:00:00.000001","merchant_category":"m","payment_method":"p","is_fraud":false}',
        '{"transaction_id":"2","user_id":"u","amo', '{"transaction_id":"3","amount":1}', "", "null",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = messages.decode_json(df)
    assert [r.transaction_id for r in good.collect()] == ["1"]
    assert good.first().timestamp.microsecond == 1
    assert bad.count() == 4


def test_landed_table_keeps_every_message(spark):
    """Broken messages reach no stream and are not lost: profile, window, session and behaviour read one decoded table."""
    source, table = scratch_dir(spark, "land"), scratch_dir(spark, "land-table")
    broken = ['{"transaction_id":"x","user_id":"u","amo', "", "null", '{"transaction_id":"y","amount":1}']
    for i, part in enumerate([[("a", "u", 1.0, 0), ("b", "v", 2.0, 30)], [("c", "u", 4.0, 900)], [("d", "u", 8.0, 2000)]]):
        put(spark, source, rows(spark, *part))
        spark.createDataFrame([(broken[i],)], "value string").coalesce(1).write.mode("append").text(source)
        jobs.drain(jobs.land(spark, source, table))
    assert sorted(r.value for r in jobs.landed_quarantine(spark, table).collect()) == sorted(broken[:3])
    assert spark.read.parquet(table).filter("accepted and value is null").count() == 4

    def run(name, work):
        target, check = scratch_dir(spark, name), scratch_dir(spark, f"{name}-check")
        jobs.drain(work(jobs.landed_stream(spark, table, max_files=2), target, check))
        return tables.read_table(spark, target)

    profiles = run("land-profile", lambda s, t, c: jobs.run_profile_stream(s, target=t, checkpoint=c))
    assert {r.user_id: r.total_transactions for r in jobs.latest_by_key(profiles, "user_id").collect()} == {"u": 3, "v": 1}
    windows = run("land-window", lambda s, t, c: jobs.start(jobs.windowed_volume(s), jobs.to_table(t), c, mode="update"))
    assert jobs.latest_by_key(windows, "window_start", "payment_method").agg(F.sum("n")).first()[0] == 4
    sessions = run("land-session", lambda s, t, c: jobs.start(jobs.user_sessions(s), jobs.to_table(t), c))
    assert sessions.count() == 3  # the last one is still open
    store = scratch_dir(spark, "land-store")
    behaviour = run("land-behaviour", lambda s, t, c: jobs.run_behaviour_stream(s, store=store, target=t, checkpoint=c))
    assert sorted(r.transaction_id for r in behaviour.collect()) == ["a", "b", "c", "d"]


def test_failing_batch_raises(spark):
    source, check = scratch_dir(spark, "fail"), scratch_dir(spark, "fail-check")
    put(spark, source, rows(spark, ("a", "u", 1.0, 0)))

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        jobs.drain(jobs.start(jobs.transaction_stream(spark, source), broken, check))


def test_behaviour_looks_past_the_lead_in(spark):
    """Counts and gaps reach back further than the 30-day slice."""
    day = 1440
    past = rows(spark, ("a", "u", 1.0, 0), ("b", "u", 2.0, 5 * day)).withColumn("batch_id", F.lit(0))
    batch = rows(spark, ("c", "u", 3.0, 60 * day), ("d", "u", 4.0, 61 * day))
    streamed = jobs.behaviour_of_batch(batch, past)
    from riskloom.operators.behaviour import build_ml_features

    whole = build_ml_features(past.drop("batch_id").unionByName(batch)).filter("transaction_id in ('c', 'd')")
    assert values(streamed) == values(whole)


def test_replay_is_in_time_order(spark, sf):
    source, per_trigger = replay(spark, messages_of(views.transactions(spark, sf)))
    assert per_trigger == 4 and spark.read.text(source).count() == 1000


def test_kafka_options():
    plain = messages.kafka_options(StreamConfig())
    assert not any("sasl" in k for k in plain) and plain["startingOffsets"] == "earliest"
    secure = messages.kafka_options(
        StreamConfig(security_protocol="SASL_SSL", sasl_user="u", sasl_password="p", max_offsets_per_trigger=7), bounded=True
    )
    assert secure["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in secure
    assert 'username="u"' in secure["kafka.sasl.jaas.config"]
    assert "p" not in repr(StreamConfig(sasl_password="p")).split("sasl")[-1].replace("sasl_mechanism", "")


def test_config_from_environment(monkeypatch):
    monkeypatch.setenv("RISKLOOM_TOPIC", "cards")
    monkeypatch.setenv("RISKLOOM_MAX_OFFSETS_PER_TRIGGER", "500")
    config = StreamConfig.from_env()
    assert config.topic == "cards" and config.max_offsets_per_trigger == 500


def test_missing_table_only(spark):
    path = scratch_dir(spark, "none")
    assert tables.read_or_empty(spark, path, schemas.USER_STATS).count() == 0
    with pytest.raises(Exception):
        tables.read_or_empty(spark, path, schemas.USER_STATS, fmt="no-such-format")


def test_unknown_file_format(spark):
    with pytest.raises(ValueError):
        sinks.write_files(spark.range(1), "/nowhere/x.xml")


def test_shared_root_follows_the_session(spark, monkeypatch):
    from riskloom import session

    class Conf:
        value = "/shared/folder/"

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    assert session.shared_root(Fake()) == "/shared/folder"
    assert session.scratch_dir(Fake(), "x").startswith("/shared/folder/riskloom/x-")
    Fake.conf.value = None
    with pytest.raises(ValueError):
        session.shared_root(Fake())  # a cluster never falls back to a machine-local folder
    Fake.sparkContext.master = "local[2]"
    monkeypatch.setattr(session, "_local_root", None)
    assert session.shared_root(Fake()) == session.shared_root(Fake())


def test_sink_skips_empty_batches_and_persists_once(spark):
    path = scratch_dir(spark, "sink")
    sink = jobs.to_table(path)
    sink(rows(spark, ("a", "u", 1.0, 0)).filter("false"), 0)
    sink(rows(spark, ("a", "u", 1.0, 0)), 1)
    sink(rows(spark, ("a", "u", 1.0, 0)), 1)
    assert spark.read.parquet(path).groupBy("batch_id").count().collect() == [(1, 1)]


def test_known_ids_go_before_rows_are_sorted(spark, monkeypatch):
    """A message delivered again in a later batch is left out before the ranking by id, which sorts."""
    source, target, bad, check = (scratch_dir(spark, n) for n in ("known", "known-out", "known-bad", "known-check"))
    seen, first = [], jobs.first_by_key

    def ranked(df, *columns):
        seen.append(sorted(r.transaction_id for r in df.select("transaction_id").collect()))
        return first(df, *columns)

    monkeypatch.setattr(jobs, "first_by_key", ranked)
    nothing = rows(spark, ("z", "u", 1.0, 0)).limit(0)
    from riskloom.operators.history import user_stats

    for part in ([("a", "u", 1.0, 0), ("a", "u", 2.0, 0)], [("a", "u", 1.0, 0), ("b", "u", 1.0, 1), ("done", "u", 1.0, 2)]):
        put(spark, source, rows(spark, *part))
        jobs.drain(jobs.run_scoring_stream(
            spark, source, stats=user_stats(nothing), processed=rows(spark, ("done", "u", 1.0, 0)), target=target, quarantine=bad, checkpoint=check,
        ))
    assert seen == [["a", "a"], ["b"]]
    assert sorted((r.transaction_id, float(r.amount)) for r in spark.read.parquet(target).collect()) == [("a", 1.0), ("b", 1.0)]


def test_partitions_of_the_behaviour_stream_follow_the_batch(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    source, target, store, check = (scratch_dir(spark, n) for n in ("wide", "wide-out", "wide-store", "wide-check"))
    seen, work = [], jobs.behaviour_of_batch

    def told(batch, past):
        seen.append(int(batch.sparkSession.conf.get(key)))
        return work(batch, past)

    monkeypatch.setattr(jobs, "behaviour_of_batch", told)
    monkeypatch.setattr(jobs, "BATCH_ROWS", 2)
    for size in (40, 2):
        put(spark, source, rows(spark, *((f"{size}-{i}", f"u{i % 3}", 1.0, 100 - size + i) for i in range(size))))
    jobs.drain(jobs.run_behaviour_stream(jobs.transaction_stream(spark, source, max_files=1), store=store, target=target, checkpoint=check))
    configured = int(spark.conf.get(key))
    assert seen == [max(20, configured), configured]
    assert spark.read.parquet(target).count() == 42
