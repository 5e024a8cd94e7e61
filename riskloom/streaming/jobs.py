"""Structured Streaming jobs.

Every sink writes one partition per run and micro-batch and overwrites only that, so a batch that
is replayed after a failure leaves the same rows, and a new checkpoint on an old target leaves the
rows of earlier runs. Errors propagate. ``trigger=None`` drains what is available and stops.

Bad messages: the scoring stream has its own quarantine. All others read ``landed_stream``: ``land`` decodes a source
once into a table that keeps each message, accepted or not. ``transaction_stream``, which reads a source directly,
leaves out what it can't decode.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas
from riskloom.functions import expressions as X
from riskloom.functions import fixed
from riskloom.operators import behaviour, features, history
from riskloom.operators.joins import drop_processed, split_by_parent
from riskloom.sources import messages
from riskloom.sources.sinks import first_by_key, write_batch
from riskloom.sources.tables import read_or_empty, read_table

# Rows of a batch to a shuffle partition where windows with 30 days of history follow.
BATCH_ROWS = 20_000


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run a stream through a batch function, with its own checkpoint."""
    writer = stream.writeStream.foreachBatch(each_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; a failed batch raises here."""
    query.awaitTermination()
    return query


def per_batch(work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Sink function that persists a batch, so its plan runs once, and skips empty ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                work(batch, batch_id)
        finally:
            batch.unpersist()

    return write


@contextmanager
def partitions_by_rows(batch: DataFrame) -> Iterator[None]:
    """Shuffles of what runs inside get a partition for every BATCH_ROWS of the batch, and no fewer than configured.

    Windows are dealt to a fixed number of partitions, which AQE does not split: without this a task's memory grows with the batch.
    """
    conf, key = batch.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(max(int(before), -(-batch.count() // BATCH_ROWS))))
    try:
        yield
    finally:
        conf.set(key, before)


def run_of(batch: DataFrame) -> str:
    """The query's id, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def to_table(path: str) -> Callable[[DataFrame, int], None]:
    """Sink function: the batch as one partition of a table."""
    return per_batch(lambda batch, batch_id: write_batch(batch, batch_id, path, run_of(batch)))


def transaction_stream(spark: SparkSession, source, *, max_files: int | None = None) -> DataFrame:
    """Decoded, contract-checked transactions from a message stream."""
    good, _ = messages.decode_json(messages.read_messages(spark, source, streaming=True, max_files=max_files))
    return messages.as_transactions(good)


_LAND_CHECKPOINT = "_checkpoint"


def land(
    spark: SparkSession, source, table: str, *, trigger: str | None = None, max_files: int | None = None
) -> StreamingQuery:
    """Decode a source once for every stream behind it: good rows and raw bad messages side by side, by ``accepted``.

    The sink's log makes a batch visible as a whole or not at all, and each message once. That log belongs to one
    checkpoint, which therefore lies inside the table.
    """
    raw = messages.read_messages(spark, source, streaming=True, max_files=max_files)
    writer = (
        messages.judged(raw).writeStream.format("parquet").partitionBy("accepted")
        .option("path", table).option("checkpointLocation", f"{table}/{_LAND_CHECKPOINT}")
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def _landed_schema() -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schemas.TRANSACTION.fields]
    return T.StructType([T.StructField("value", T.StringType()), *fields, T.StructField("accepted", T.BooleanType())])


def landed_stream(spark: SparkSession, table: str, *, max_files: int | None = None) -> DataFrame:
    """The good rows of a landed table, as they come in."""
    reader = spark.readStream.schema(_landed_schema())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return messages.as_transactions(reader.parquet(table).filter("accepted").drop("value", "accepted"))


def landed_quarantine(spark: SparkSession, table: str) -> DataFrame:
    """The raw text of every message that could not be decoded."""
    return spark.read.schema(_landed_schema()).parquet(table).filter("not accepted").select("value")


def deduplicated(stream: DataFrame, *, watermark: str = "1 minute") -> DataFrame:
    """Drop repeated ids; the watermark bounds how long ids are remembered."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["transaction_id"])


def stored_ids(spark: SparkSession, target: str, run: str, batch_id: int, key: str = "transaction_id") -> DataFrame:
    """Ids in a target, without those of this batch and later ones of its run: a replay sees what it saw first."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("run", T.StringType()), T.StructField("batch_id", T.IntegerType())])
    own = (F.col("run") == run) & (F.col("batch_id") >= batch_id)
    return read_or_empty(spark, target, schema).filter(~own).select(key)


def partials_before(spark: SparkSession, table: str, run: str, batch_id: int) -> DataFrame:
    """Mergeable user statistics of earlier batches: a replay sees what it saw first."""
    schema = T.StructType.fromDDL(
        "user_id string, total_transactions bigint, fraud_count bigint, amounts bigint, mean double, deviations double, sketch binary, run string, batch_id int"
    )
    return read_or_empty(spark, table, schema).filter((F.col("run") != run) | (F.col("batch_id") < batch_id))


def to_partials(table: str) -> Callable[[DataFrame, int], None]:
    """Sink function over transactions: the batch's mergeable statistics, one row per user of the batch."""
    return per_batch(lambda batch, batch_id: write_batch(history.user_partials(batch), batch_id, table, run_of(batch)))


def compact_partials(spark: SparkSession, table: str, into: str) -> str:
    """Fold a table of partials to one row per user, in a new folder that streams with other checkpoints go on from."""
    write_batch(history.merge_partials(read_table(spark, table)), 0, into, "compacted")
    return into


def score_batch(
    stats: DataFrame | None, processed: DataFrame, parent: DataFrame | None, target: str, quarantine: str, partials: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Sink function over raw messages: each good id is scored and stored once, the rest goes to quarantine.

    Undecodable messages go to ``quarantine/messages``, rows without parent to ``quarantine/orphans``. With ``partials``
    the users' history is what earlier batches have left there, and this batch adds its own; otherwise it is ``stats``.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        good, bad = messages.decode_json(batch)
        write_batch(bad, batch_id, f"{quarantine}/messages", run)
        # Known ids go before anything is sorted: a message delivered again costs no more than the join.
        unknown = drop_processed(drop_processed(messages.as_transactions(good), processed), stored_ids(batch.sparkSession, target, run, batch_id))
        fresh = first_by_key(unknown, "transaction_id", "ts", "amount")
        known = stats if partials is None else history.stats_of_partials(partials_before(batch.sparkSession, partials, run, batch_id))
        scored, once = history.score(fresh, known), parent is None and partials is None
        # What is written once needs no copy in memory.
        scored = scored if once else scored.persist()
        try:
            accepted, orphans = (scored, None) if parent is None else split_by_parent(scored, parent)
            write_batch(accepted, batch_id, target, run)
            if partials is not None:
                write_batch(history.user_partials(accepted), batch_id, partials, run)
            if orphans is not None:
                write_batch(orphans, batch_id, f"{quarantine}/orphans", run)
        finally:
            if not once:
                scored.unpersist()

    return per_batch(work)


def run_scoring_stream(
    spark: SparkSession,
    source,
    *,
    stats: DataFrame | None = None,
    processed: DataFrame,
    target: str,
    quarantine: str,
    checkpoint: str,
    parent: DataFrame | None = None,
    partials: str | None = None,
    trigger: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Messages -> not yet processed, here or in an earlier batch -> enriched and scored -> typed table."""
    raw = messages.read_messages(spark, source, streaming=True, max_files=max_files)
    if (stats is None) == (partials is None):
        raise ValueError("give either stats or a table of partials")
    return start(raw, score_batch(stats, processed, parent, target, quarantine, partials), checkpoint, trigger=trigger)


def run_quarantine_stream(
    spark: SparkSession, source, *, target: str, quarantine: str, checkpoint: str,
    trigger: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """Split messages: decodable rows to the target, raw text of the others to quarantine."""
    raw = messages.read_messages(spark, source, streaming=True, max_files=max_files)

    def work(batch: DataFrame, batch_id: int) -> None:
        good, bad = messages.decode_json(batch)
        write_batch(messages.as_transactions(good), batch_id, target, run_of(batch))
        write_batch(bad, batch_id, quarantine, run_of(batch))

    return start(raw, per_batch(work), checkpoint, trigger=trigger)


def run_profile_stream(
    stream: DataFrame, *, target: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Incremental user profiles: state is one small row per user; each batch writes changed users.

    Amounts are added as decimals, so the order of arrival does not matter.
    """
    exact = stream.withColumn("amount", F.col("amount").cast(T.DecimalType(18, 2)))
    return start(history.user_profiles(exact), to_table(target), checkpoint, trigger=trigger, mode="update")


def latest_by_key(table: DataFrame, *keys: str) -> DataFrame:
    """Current rows of a table written in update mode: per key, the row of the newest batch."""
    rest = [c for c in table.columns if c not in (*keys, "run", "batch_id")]
    newest = F.max_by(F.struct(*rest), F.col("batch_id"))
    return table.groupBy(*keys).agg(newest.alias("r")).select(*keys, "r.*")


def windowed_volume(
    stream: DataFrame, *, width: str = "1 hour", slide: str | None = None, watermark: str = "1 minute"
) -> DataFrame:
    """Volume, amount and fraud per event-time window and payment method."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return (
        stream.withWatermark("ts", watermark)
        .groupBy(window.alias("w"), "payment_method")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("amount").cast(T.DecimalType(18, 2))).alias("amount"),
            F.count_if(X.flag(F.col("is_fraud"))).alias("fraud_count"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "payment_method", "n", "amount", "fraud_count")
    )


def user_sessions(stream: DataFrame, *, gap: str = "6 hours", watermark: str = "1 minute") -> DataFrame:
    """Sessions per user, emitted once they are closed by the watermark."""
    return (
        stream.withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap).alias("w"), "user_id")
        .agg(F.count("*").alias("n"))
        .select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


_LEAD_IN = fixed.HORIZONS["30d"]


def behaviour_of_batch(batch: DataFrame, past: DataFrame) -> DataFrame:
    """Behavioural features of a batch, given everything stored before it.

    Rolling windows see the batch plus 30 days of history of the batch's users. What reaches
    further back (running counts, the previous transaction) comes in as aggregates.
    """
    columns = ["transaction_id", "user_id", "ts", "amount", "merchant_category", "is_fraud"]
    users = batch.select("user_id").distinct()
    since = batch.agg((F.min("ts") - F.make_dt_interval(secs=F.lit(_LEAD_IN).cast("decimal(18,6)"))).alias("s")).scalar()
    related = past.select(*columns).join(users, "user_id", "left_semi")
    recent, older = related.filter(F.col("ts") >= since), related.filter(F.col("ts") < since)
    both = batch.select(*columns).withColumn("__new", F.lit(True)).unionByName(
        recent.withColumn("__new", F.lit(False))
    )
    rows = features.merchant_features(features.amount_features(features.temporal_features(both)))
    windows = behaviour.user_windows(
        rows, horizons=("24h", "7d", "30d")
    ).filter("__new")
    before = older.groupBy("user_id", "merchant_category").agg(F.count("*").alias("older_visits"))
    hours = older.groupBy("user_id", F.hour("ts").alias("hour_of_day")).agg(F.count("*").alias("older_hours"))
    last = older.groupBy("user_id").agg(F.max("ts").alias("older_ts"))
    since_older = (X.epoch_second(F.col("ts")) - X.epoch_second(F.col("older_ts"))).cast("double") / 60
    first = F.col("minutes_since_last") == fixed.FIRST_TRANSACTION_MINUTES
    whole = (
        windows.join(before, ["user_id", "merchant_category"], "left")
        .join(hours, ["user_id", "hour_of_day"], "left")
        .join(last, "user_id", "left")
        .withColumns(
            {
                "user_merchant_frequency": F.col("user_merchant_frequency") + F.coalesce("older_visits", F.lit(0)),
                "user_hour_frequency": F.col("user_hour_frequency") + F.coalesce("older_hours", F.lit(0)),
                "minutes_since_last": F.when(first, F.coalesce(since_older, F.col("minutes_since_last"))).otherwise(
                    F.col("minutes_since_last")
                ),
            }
        )
    )
    return behaviour.ml_feature_table(features.anomaly_features(whole))


def run_behaviour_stream(
    stream: DataFrame, *, store: str, target: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Behavioural features per micro-batch. ``store`` keeps the raw rows of earlier batches."""
    added = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.IntegerType())]
    schema = T.StructType([*stream.schema.fields, *added])

    def work(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        # Own batches from this one on don't count, so a replayed batch sees what it saw the first time.
        past = read_or_empty(batch.sparkSession, store, schema).filter((F.col("run") != run) | (F.col("batch_id") < batch_id))
        with partitions_by_rows(batch):
            write_batch(behaviour_of_batch(batch, past), batch_id, target, run)
        write_batch(batch, batch_id, store, run)

    return start(stream, per_batch(work), checkpoint, trigger=trigger)


def counted(work: Callable[[DataFrame, int], None], metrics: str) -> Callable[[DataFrame, int], None]:
    """Sink function over raw messages that also writes each batch's rows, errors and seconds to a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        work(batch, batch_id)
        seconds = time.monotonic() - began
        counts = batch.agg(
            F.count("*").alias("input_rows"), F.count_if(~messages.is_decodable(F.col("value"))).alias("errors"), F.lit(seconds).alias("seconds")
        )
        write_batch(counts, batch_id, metrics, run_of(batch))

    return per_batch(write)


def stream_totals(metrics: DataFrame) -> DataFrame:
    """Totals over every batch ever written: rows, errors, success in percent, average rate."""
    totals = metrics.agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("processed"), F.sum("errors").alias("errors"), F.sum("seconds").alias("seconds")
    )
    return totals.withColumns({
        "success_pct": X.ratio(F.col("processed") - F.col("errors"), F.col("processed")) * 100,
        "rows_per_second": X.ratio(F.col("processed"), F.col("seconds")),
    })
