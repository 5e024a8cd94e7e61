"""Message streams: Kafka options, JSON decoding, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.config import StreamConfig
from riskloom.functions import fixed

ENVELOPE = ("kafka_key", "kafka_timestamp", "topic", "partition", "offset")


def kafka_options(config: StreamConfig, *, bounded: bool = False) -> dict[str, str]:
    """Source options; security settings only when a protocol is configured."""
    options = {
        "kafka.bootstrap.servers": config.servers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
    }
    if bounded:
        options["endingOffsets"] = config.ending_offsets
    else:
        options["failOnDataLoss"] = "false"
        if config.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if config.security_protocol:
        options["kafka.security.protocol"] = config.security_protocol
        options["kafka.sasl.mechanism"] = config.sasl_mechanism
        options["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{config.sasl_user}" password="{config.sasl_password}";'
        )
    return options


def read_messages(
    spark: SparkSession,
    source: StreamConfig | str,
    *,
    streaming: bool,
    max_files: int | None = None,
) -> DataFrame:
    """Messages with a ``value`` column: a Kafka topic, or a folder of JSON lines as stand-in."""
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, StreamConfig):
        # Bounded reads must start at an offset that exists now.
        return reader.format("kafka").options(**kafka_options(source, bounded=not streaming)).load()
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format("text").load(source)


def _accepted(text: Column, schema: T.StructType) -> Column:
    """The parsed message as a one-element array, empty unless every required field is filled.

    Parsing sits inside one array expression, so each message is parsed once, however many
    fields are checked and selected.
    """

    def filled(data: Column) -> Column:
        condition = data.isNotNull()
        for name in schemas.required(schema):
            condition = condition & data[name].isNotNull()
        if "amount" in schema.names:
            # NaN, infinity and what the tables can't hold are no amounts.
            amount = data["amount"].cast("double")
            condition = condition & (data["amount"].isNull() | (~F.isnan(amount) & (F.abs(amount) < fixed.AMOUNT_LIMIT)))
        return condition

    return F.filter(F.array(F.from_json(text, schema)), filled)


def is_decodable(value: Column, schema: T.StructType = schemas.TRANSACTION) -> Column:
    """Whether a raw message decodes to a row with every required field."""
    return F.size(_accepted(value.cast("string"), schema)) > 0


def decode_json(
    df: DataFrame, schema: T.StructType = schemas.TRANSACTION, *, keep_envelope: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw values). Both are narrow: the frame is split, not shuffled."""
    envelope = []
    if keep_envelope:
        envelope = [
            F.col("key").cast("string").alias("kafka_key"),
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("topic"),
            F.col("partition"),
            F.col("offset"),
        ]
    text = F.col("value").cast("string")
    good = df.select(*envelope, F.inline(_accepted(text, schema)))
    bad = df.filter(F.size(_accepted(text, schema)) == 0).select(*envelope, text.alias("value"))
    return good, bad


def judged(df: DataFrame, schema: T.StructType = schemas.TRANSACTION) -> DataFrame:
    """Every message once: its columns and ``accepted``, or NULLs and the raw text as ``value``. One parse, no shuffle."""
    text = F.col("value").cast("string")
    rows = df.select(text.alias("value"), F.inline_outer(_accepted(text, schema)))
    accepted = F.col(schemas.required(schema)[0]).isNotNull()
    return rows.withColumn("accepted", accepted).withColumn("value", F.when(~accepted, F.col("value")))


def as_transactions(decoded: DataFrame) -> DataFrame:
    """Decoded messages under the operator column names (``ts`` as timestamp)."""
    if isinstance(decoded.schema["timestamp"].dataType, T.StringType):
        from riskloom.operators.features import parse_timestamp

        return parse_timestamp(decoded).drop("timestamp")
    return decoded.withColumnRenamed("timestamp", "ts")
