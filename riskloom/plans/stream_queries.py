"""Streaming queries: the transactions replayed as messages, then drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import history
from riskloom.plans import catalog as C
from riskloom.plans import views
from riskloom.plans.catalog import comparable, query, r
from riskloom.plans.feature_queries import CONSTANT_VELOCITY, SCORED_SQL
from riskloom.plans.table_queries import DECODED, DECODED_SQL, messages_of
from riskloom.session import scratch_dir
from riskloom.sources import messages
from riskloom.sources.sinks import write_batch
from riskloom.sources.tables import read_table
from riskloom.streaming import jobs

TX, RISK, WINDOWS = C.TX, C.RISK, C.WINDOWS
BATCHES = 2


def replay(spark, rows, *, path: str | None = None) -> tuple[str, int]:
    """Append messages in BATCHES time slices; (folder, files per trigger: one slice).

    Files are picked up by modification time, so each slice is written after the one before.
    The number of files follows the session's shuffle parallelism and keeps their size bounded.
    """
    path = path or scratch_dir(spark, "messages")
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // BATCHES)
    second = F.unix_timestamp("ts")
    low, high = rows.agg(F.min(second), F.max(second)).first()
    step = (high - low) // BATCHES + 1
    for i in range(BATCHES):
        part = rows.filter((second >= low + i * step) & (second < low + (i + 1) * step))
        part.select("value").repartition(files).write.mode("append").text(path)
    return path, files


def stream_of(spark, sf):
    source, per_trigger = replay(spark, messages_of(views.transactions(spark, sf)))
    return jobs.transaction_stream(spark, source, max_files=per_trigger)


def folders(spark, name):
    root = scratch_dir(spark, name)
    return f"{root}/table", f"{root}/checkpoint", f"{root}/quarantine"


@query("src_stream_ingest", f"WITH {TX} SELECT {DECODED_SQL} FROM tx")
def _ingest(spark, sf):
    target, checkpoint, _ = folders(spark, "ingest")
    jobs.drain(jobs.start(stream_of(spark, sf), jobs.to_table(target), checkpoint))
    return comparable(read_table(spark, target).select(*DECODED))


@query("src_bounded_ingest", f"WITH {TX} SELECT {DECODED_SQL} FROM tx")
def _bounded(spark, sf):
    source, _ = replay(spark, messages_of(views.transactions(spark, sf)))
    good, _ = messages.decode_json(messages.read_messages(spark, source, streaming=False))
    return comparable(messages.as_transactions(good).select(*DECODED))


@query("stream_features", f"WITH {RISK} {SCORED_SQL.format(velocity=CONSTANT_VELOCITY)} WHERE ts >= TIMESTAMP '2024-01-03'")
def _features(spark, sf):
    """The scorer as a stream; the first two days count as processed already."""
    tx = views.transactions(spark, sf)
    source, per_trigger = replay(spark, messages_of(tx))
    target, checkpoint, quarantine = folders(spark, "scored")
    done = tx.filter(F.col("ts") < F.lit("2024-01-03").cast("timestamp"))
    jobs.drain(
        jobs.run_scoring_stream(
            spark, source, stats=history.user_stats(tx), processed=done, parent=tx, target=target,
            quarantine=quarantine, checkpoint=checkpoint, max_files=per_trigger,
        )
    )
    return comparable(read_table(spark, target).drop("processed_at", "run", "batch_id"))


@query("stream_foreach_batch", f"WITH {TX} SELECT COUNT(*) AS n_rows, COUNT(DISTINCT transaction_id) AS ids, TRUE AS in_batches FROM tx")
def _foreach(spark, sf):
    """One table partition per micro-batch, several micro-batches, every row once."""
    target, checkpoint, _ = folders(spark, "batches")
    jobs.drain(jobs.start(stream_of(spark, sf), jobs.to_table(target), checkpoint))
    return read_table(spark, target).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("transaction_id").alias("ids"),
        (F.count_distinct("batch_id") >= BATCHES).alias("in_batches"),
    )


@query("stream_restart", f"WITH {TX} SELECT transaction_id, user_id, {r('amount')} AS amount FROM tx")
def _restart(spark, sf):
    """Stop after half the messages, restart from the checkpoint, restart once more with nothing new."""
    rows = messages_of(views.transactions(spark, sf))
    middle = F.lit("2024-01-15").cast("timestamp")
    target, checkpoint, _ = folders(spark, "restart")
    source, per_trigger = replay(spark, rows.filter(F.col("ts") < middle))
    for later in (None, rows.filter(F.col("ts") >= middle), None):
        if later is not None:
            replay(spark, later, path=source)
        stream = jobs.transaction_stream(spark, source, max_files=per_trigger)
        jobs.drain(jobs.start(stream, jobs.to_table(target), checkpoint))
    return comparable(read_table(spark, target).select("transaction_id", "user_id", "amount"))


@query("stream_user_profiles", f"""WITH {TX} SELECT user_id, COUNT(*) AS total_transactions, {r('SUM(amount)', 4)} AS total_amount,
    {r('AVG(amount)', 4)} AS avg_amount, MIN(ts) AS first_transaction, MAX(ts) AS last_transaction,
    COUNT(*) FILTER (WHERE is_fraud) AS fraud_count,
    {r('COUNT(*) FILTER (WHERE is_fraud) / CAST(COUNT(*) AS DOUBLE)', 4)} AS fraud_rate FROM tx GROUP BY user_id""")
def _profiles(spark, sf):
    target, checkpoint, _ = folders(spark, "profiles")
    jobs.drain(jobs.run_profile_stream(stream_of(spark, sf), target=target, checkpoint=checkpoint))
    return comparable(jobs.latest_by_key(read_table(spark, target), "user_id"), digits=4)


@query("stream_user_stats", f"""WITH {TX}, {C.STATS} SELECT user_id, total_transactions,
    {r('user_avg_amount')} AS user_avg_amount, {r('user_std_amount')} AS user_std_amount,
    {r('median_amount')} AS median_amount, fraud_count, {r('fraud_rate_pct')} AS fraud_rate_pct FROM st""")
def _stats_stream(spark, sf):
    """User statistics kept as partials of several batches, folded, and merged once more."""
    source, per_trigger = replay(spark, messages_of(views.transactions(spark, sf)))
    stream = jobs.transaction_stream(spark, source, max_files=max(1, per_trigger // 2))
    target, checkpoint, folded = folders(spark, "partials")
    jobs.drain(jobs.start(stream, jobs.to_partials(target), checkpoint))
    return comparable(history.stats_of_partials(read_table(spark, jobs.compact_partials(spark, target, folded))))


@query("stream_dedup", f"WITH {TX} SELECT transaction_id, user_id, {r('amount')} AS amount, ts FROM tx")
def _dedup(spark, sf):
    """Every message delivered twice within the watermark."""
    rows = messages_of(views.transactions(spark, sf))
    source, per_trigger = replay(spark, rows.unionByName(rows))
    stream = jobs.transaction_stream(spark, source, max_files=per_trigger)
    target, checkpoint, _ = folders(spark, "dedup")
    jobs.drain(jobs.start(jobs.deduplicated(stream), jobs.to_table(target), checkpoint))
    return comparable(read_table(spark, target).select("transaction_id", "user_id", "amount", "ts"))


_WINDOW_SQL = f"""SELECT {{start}} AS window_start, {{start}} + INTERVAL 1 DAY AS window_end, payment_method, COUNT(*) AS n,
    {r('SUM(amount)', 4)} AS amount, COUNT(*) FILTER (WHERE is_fraud) AS fraud_count, '{{kind}}' AS kind FROM {{source}} GROUP BY 1, 2, 3"""


@query("stream_windowed", f"""WITH {TX}, slid AS (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, ts),
      time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS s FROM tx)
    {_WINDOW_SQL.format(start="date_trunc('day', ts)", kind='tumbling', source='tx')}
    UNION ALL {_WINDOW_SQL.format(start='s', kind='sliding', source='slid')}""")
def _windowed(spark, sf):
    """Tumbling and sliding day windows, updated per batch; the newest state of each window."""
    source, per_trigger = replay(spark, messages_of(views.transactions(spark, sf)))
    out = None
    for kind, slide in (("tumbling", None), ("sliding", "12 hours")):
        stream = jobs.transaction_stream(spark, source, max_files=per_trigger)
        target, checkpoint, _ = folders(spark, kind)
        volume = jobs.windowed_volume(stream, width="1 day", slide=slide)
        jobs.drain(jobs.start(volume, jobs.to_table(target), checkpoint, mode="update"))
        final = jobs.latest_by_key(read_table(spark, target), "window_start", "window_end", "payment_method")
        final = final.withColumn("kind", F.lit(kind))
        out = final if out is None else out.unionByName(final)
    return comparable(out, digits=4)


@query("stream_sessions", f"""WITH {TX}, g AS (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR
      THEN 0 ELSE 1 END AS opened FROM tx), s AS (SELECT *, SUM(opened) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g)
    SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS n FROM s GROUP BY user_id, sid
    HAVING MAX(ts) + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', MAX(ts)) FROM tx) - INTERVAL 1 MINUTE""")
def _sessions(spark, sf):
    """Closed sessions: the watermark has passed their end."""
    target, checkpoint, _ = folders(spark, "sessions")
    jobs.drain(jobs.start(jobs.user_sessions(stream_of(spark, sf)), jobs.to_table(target), checkpoint))
    return comparable(read_table(spark, target).drop("run", "batch_id"))


@query("stream_behavioural", f"""WITH {TX}, {WINDOWS} SELECT transaction_id, {r('amount_zscore')} AS amount_zscore,
    transactions_last_24h, transactions_last_7d, {r('user_avg_amount_7d')} AS user_avg_amount_7d,
    {r('minutes_since_last')} AS minutes_since_last, user_merchant_frequency, user_hour_frequency, anomaly_score FROM ml""")
def _behavioural(spark, sf):
    target, checkpoint, store = folders(spark, "behaviour")
    jobs.drain(jobs.run_behaviour_stream(stream_of(spark, sf), store=store, target=target, checkpoint=checkpoint))
    return comparable(
        read_table(spark, target).select(
            "transaction_id", "amount_zscore", "transactions_last_24h", "transactions_last_7d", "user_avg_amount_7d",
            "minutes_since_last", "user_merchant_frequency", "user_hour_frequency", "anomaly_score",
        )
    )


@query("stream_quarantine", f"""WITH {TX} SELECT CASE WHEN payment_method IN ('paypal', 'bank_transfer') THEN 'quarantine' ELSE 'good' END AS side,
    CASE WHEN payment_method NOT IN ('paypal', 'bank_transfer') THEN transaction_id END AS transaction_id FROM tx""")
def _quarantine(spark, sf):
    """Truncated bank transfers and paypal messages with a text amount must end in quarantine."""
    rows = messages_of(views.transactions(spark, sf))
    broken = (
        F.when(F.col("payment_method") == "bank_transfer", F.substring("value", 1, 40))
        .when(F.col("payment_method") == "paypal", F.regexp_replace("value", r'"amount":[0-9.E]+', '"amount":"many"'))
        .otherwise(F.col("value"))
    )
    source, per_trigger = replay(spark, rows.withColumn("value", broken))
    target, checkpoint, quarantine = folders(spark, "split")
    jobs.drain(
        jobs.run_quarantine_stream(
            spark, source, target=target, quarantine=quarantine, checkpoint=checkpoint, max_files=per_trigger
        )
    )
    good = read_table(spark, target).select(F.lit("good").alias("side"), "transaction_id")
    bad = read_table(spark, quarantine).select(F.lit("quarantine").alias("side"), F.lit(None).cast("string").alias("transaction_id"))
    return good.unionByName(bad)


@query("stream_landed", f"""WITH {TX}, good AS (SELECT * FROM tx WHERE payment_method <> 'paypal')
    SELECT 'profile' AS side, user_id AS name, COUNT(*) AS n, {r('SUM(amount)', 4)} AS amount FROM good GROUP BY user_id
    UNION ALL SELECT 'window', CAST(date_trunc('day', ts) AS VARCHAR) || ' ' || payment_method, COUNT(*), {r('SUM(amount)', 4)} FROM good GROUP BY 2
    UNION ALL SELECT 'behaviour', NULL, COUNT(*), {r('SUM(amount)', 4)} FROM good
    UNION ALL SELECT 'quarantine', NULL, COUNT(*), NULL FROM tx WHERE payment_method = 'paypal'""")
def _landed(spark, sf):
    """One decoded table behind three streams; truncated messages lie in its quarantine, once."""
    rows = messages_of(views.transactions(spark, sf))
    broken = F.when(F.col("payment_method") == "paypal", F.substring("value", 1, 40)).otherwise(F.col("value"))
    source, per_trigger = replay(spark, rows.withColumn("value", broken))
    table = scratch_dir(spark, "landed")
    for _ in range(2):  # the second run finds nothing new
        jobs.drain(jobs.land(spark, source, table, max_files=per_trigger))
    profiles, windows, (target, checkpoint, store) = folders(spark, "profiles"), folders(spark, "windows"), folders(spark, "behaviour")
    jobs.drain(jobs.run_profile_stream(jobs.landed_stream(spark, table), target=profiles[0], checkpoint=profiles[1]))
    volume = jobs.windowed_volume(jobs.landed_stream(spark, table), width="1 day")
    jobs.drain(jobs.start(volume, jobs.to_table(windows[0]), windows[1], mode="update"))
    jobs.drain(jobs.run_behaviour_stream(jobs.landed_stream(spark, table), store=store, target=target, checkpoint=checkpoint))
    users = jobs.latest_by_key(read_table(spark, profiles[0]), "user_id")
    days = jobs.latest_by_key(read_table(spark, windows[0]), "window_start", "window_end", "payment_method")
    name = F.concat_ws(" ", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), "payment_method")
    amount = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")
    parts = [
        users.select(F.lit("profile").alias("side"), F.col("user_id").alias("name"), F.col("total_transactions").alias("n"), F.col("total_amount").cast("double").alias("amount")),
        days.select(F.lit("window").alias("side"), name.alias("name"), "n", F.col("amount").cast("double").alias("amount")),
        read_table(spark, target).agg(F.count("*").alias("n"), amount).select(F.lit("behaviour").alias("side"), F.lit(None).cast("string").alias("name"), "n", "amount"),
        jobs.landed_quarantine(spark, table).agg(F.count("*").alias("n")).select(
            F.lit("quarantine").alias("side"), F.lit(None).cast("string").alias("name"), "n", F.lit(None).cast("double").alias("amount")
        ),
    ]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), digits=4)


@query("stream_exactly_once", f"""WITH {TX} SELECT 'scored' AS side, transaction_id, 1 AS n FROM tx
    UNION ALL SELECT 'quarantine', transaction_id, 2 FROM tx WHERE payment_method = 'paypal'""")
def _exactly_once(spark, sf):
    """Every message twice, the second time in a later batch; broken copies of some between them; then all of it
    again through a second checkpoint on the same target. Each id is stored once, each broken message each time."""
    rows = messages_of(views.transactions(spark, sf))
    source, _ = replay(spark, rows)
    broken = rows.filter("payment_method = 'paypal'").withColumn("value", F.concat(F.col("transaction_id"), F.lit(":"), F.substring("value", 1, 40)))
    broken.select("value").write.mode("append").text(source)
    source, per_trigger = replay(spark, rows, path=source)
    target, checkpoint, quarantine = folders(spark, "once")
    nothing = views.transactions(spark, sf).limit(0)
    for number in (1, 2):
        jobs.drain(
            jobs.run_scoring_stream(
                spark, source, stats=history.user_stats(nothing), processed=nothing, target=target,
                quarantine=quarantine, checkpoint=f"{checkpoint}-{number}", max_files=per_trigger,
            )
        )
    bad = read_table(spark, f"{quarantine}/messages").select(F.lit("quarantine").alias("side"), F.split("value", ":")[0].alias("transaction_id"))
    both = read_table(spark, target).select(F.lit("scored").alias("side"), "transaction_id").unionByName(bad)
    return both.groupBy("side", "transaction_id").agg(F.count("*").cast("int").alias("n"))


@query("stream_bad_amounts", f"""WITH {TX}, odd AS (SELECT *, CAST(transaction_id AS BIGINT) % 97 < 3 AS bad FROM tx),
    good AS (SELECT * FROM odd WHERE NOT bad)
    SELECT o.user_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT bad) AS stored, COUNT(*) FILTER (WHERE bad) AS rejected,
    {r('MAX(g.m)', 4)} AS user_avg_amount FROM odd o LEFT JOIN (SELECT user_id, AVG(amount) AS m FROM good GROUP BY user_id) g USING (user_id)
    GROUP BY o.user_id""")
def _bad_amounts(spark, sf):
    """NaN, infinite and too large amounts are rejected; they touch no other row of their user."""
    rows = messages_of(views.transactions(spark, sf))
    odd = F.element_at(F.array(F.lit('"amount":"NaN"'), F.lit('"amount":"Infinity"'), F.lit('"amount":5e12')), (F.col("transaction_id").cast("long") % 97 + 1).cast("int"))
    value = F.when(F.col("transaction_id").cast("long") % 97 < 3, F.regexp_replace("value", F.lit(r'"amount":[0-9.E]+'), odd)).otherwise(F.col("value"))
    source, per_trigger = replay(spark, rows.withColumn("value", value))
    target, checkpoint, quarantine = folders(spark, "amounts")
    good, _ = messages.decode_json(messages.read_messages(spark, source, streaming=False))
    stats = history.user_stats(messages.as_transactions(good))
    jobs.drain(
        jobs.run_scoring_stream(
            spark, source, stats=stats, processed=views.transactions(spark, sf).limit(0), target=target,
            quarantine=quarantine, checkpoint=checkpoint, max_files=per_trigger,
        )
    )
    stored = read_table(spark, target).select("user_id", F.lit(1).alias("stored"), F.lit(0).alias("rejected"))
    user = F.regexp_extract("value", '"user_id":"([^"]*)"', 1)
    bad = read_table(spark, f"{quarantine}/messages").select(user.alias("user_id"), F.lit(0).alias("stored"), F.lit(1).alias("rejected"))
    counts = stored.unionByName(bad).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("stored").alias("stored"), F.sum("rejected").alias("rejected"))
    return comparable(counts.join(stats.select("user_id", "user_avg_amount"), "user_id", "left"), digits=4)


@query("stream_metrics", f"""WITH {TX} SELECT TRUE AS in_batches, COUNT(*) AS processed, COUNT(*) FILTER (WHERE payment_method = 'paypal') AS errors,
    {r("100.0 * COUNT(*) FILTER (WHERE payment_method <> 'paypal') / COUNT(*)")} AS success_pct, TRUE AS rated FROM tx""")
def _metrics(spark, sf):
    """Counters of a stream with broken messages, from the table its batches write."""
    rows = messages_of(views.transactions(spark, sf))
    broken = F.when(F.col("payment_method") == "paypal", F.substring("value", 1, 40)).otherwise(F.col("value"))
    source, per_trigger = replay(spark, rows.withColumn("value", broken))
    target, checkpoint, metrics = folders(spark, "metrics")
    raw = messages.read_messages(spark, source, streaming=True, max_files=per_trigger)

    def store(batch, batch_id):
        good, _ = messages.decode_json(batch)
        write_batch(good, batch_id, target, jobs.run_of(batch))

    jobs.drain(jobs.start(raw, jobs.counted(store, metrics), checkpoint))
    totals = jobs.stream_totals(read_table(spark, metrics))
    return comparable(totals.select(
        (F.col("batches") >= BATCHES).alias("in_batches"), "processed", "errors", "success_pct", (F.col("rows_per_second") > 0).alias("rated")
    ))
