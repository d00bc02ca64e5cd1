"""Tick messages: topic sources, JSON decoding and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import text_to_double
from tickloom.schemas import ISO_MICROS, TICK_MESSAGE

# Topic names.
RAW_TOPIC = "raw-stock-data"
METRICS_TOPIC = "processed-stock-metrics"
ALERTS_TOPIC = "market-alerts"

TICK_COLUMNS = TICK_MESSAGE.fieldNames()


def topic_messages(spark: SparkSession, servers: str, topic: str = RAW_TOPIC,
                   starting_offsets: str = "latest", **options: str) -> DataFrame:
    """A Kafka topic as a stream. The live aggregates start at `latest`, raw ingestion at
    `earliest`. Needs the Spark Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def publish(messages: DataFrame, servers: str, topic: str = METRICS_TOPIC,
            checkpoint: str | None = None) -> StreamingQuery | None:
    """Send messages of `encode_rows` to a topic; a stream needs a checkpoint folder."""
    if messages.isStreaming:
        return (
            messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
    return None


def file_messages(spark: SparkSession, folder: str, glob: str = "*",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files with one message per line as a stream, in the topic's shape."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def decode_ticks(messages: DataFrame) -> DataFrame:
    """Message bytes or text to tick columns; `message` keeps the text.

    Broken messages become rows of nulls, which the sinks reject. change_percent may be a number
    or text with or without a percent sign.
    """
    text = messages.select(F.col("value").cast("string").alias("message"))
    parsed = text.select("message", F.from_json("message", TICK_MESSAGE).alias("data"))
    return parsed.select("data.*", "message").withColumn(
        "change_percent", text_to_double("change_percent")
    )


def encode_rows(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Rows to JSON messages in `value`, with an optional message `key`."""
    value = F.to_json(
        F.struct(*rows.columns), {"timestampFormat": ISO_MICROS, "ignoreNullFields": "false"}
    )
    keyed = [F.col(key).cast("string").alias("key")] if key else []
    return rows.select(*keyed, value.alias("value"))


def encode_ticks(ticks: DataFrame) -> DataFrame:
    return encode_rows(ticks.select(*TICK_COLUMNS), key="symbol")
