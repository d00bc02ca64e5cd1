"""What a stopped window query leaves behind, so that another with other state partitions can take over.

The number of state partitions is fixed for the life of a checkpoint. A query that is to have another starts a checkpoint
of its own, with `after=last_watermark(spark, old)`: the windows that the old query has released are not formed again, all others are
formed from their ticks, which the new query reads again in their order of arrival. `replay_from` tells from what time on.
Both may write to one table, where each window then is once.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def last_watermark(spark: SparkSession, checkpoint: str) -> datetime.datetime | None:
    """Up to what time the query of a checkpoint has released its windows, in UTC; None if it has released none.

    Raises where the last batch has begun and not ended: it may have been written, so its query has to be run once more.
    """
    offsets, commits = _log(spark, checkpoint, "offsets"), _log(spark, checkpoint, "commits")
    begun = offsets.where(F.col("value").contains("batchWatermarkMs")).select(
        "batch_id", F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("reached"))
    last = begun.join(commits.select("batch_id", F.lit(True).alias("done")).distinct(), "batch_id", "left").agg(
        F.max_by("done", "batch_id").alias("done"), F.max_by("reached", "batch_id").alias("reached"),
        F.max("batch_id").alias("batch_id")).first()
    if last.batch_id is not None and not last.done:
        raise ValueError(f"batch {last.batch_id} of {checkpoint} has not ended; run its query once more")
    if not last.reached:
        return None
    return datetime.datetime.fromtimestamp(last.reached / 1000, datetime.UTC)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that the query of a checkpoint holds and has not released: their keys, and the state partition."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "partition_id")


def state_load(spark: SparkSession, checkpoint: str) -> DataFrame:
    """partition_id, n_windows for every state partition, also the empty ones: what to choose another number by."""
    stores = spark.read.format("state-metadata").load(checkpoint).agg(F.max("numPartitions").alias("count"))
    every = stores.select(F.explode(F.sequence(F.lit(0), (F.col("count") - 1).cast("int"))).alias("partition_id"))
    held = open_windows(spark, checkpoint).groupBy("partition_id").agg(F.count("*").alias("n_windows"))
    return every.join(held, "partition_id", "left").select("partition_id", F.coalesce("n_windows", F.lit(0)).alias("n_windows"))


def replay_from(spark: SparkSession, checkpoint: str, longest_minutes: int) -> datetime.datetime | None:
    """Event time of the earliest tick that a window not yet released can hold, in UTC; None for all ticks.

    That is the watermark less the longest window: symbols without an open window may still get ticks in one that began there.
    A source that starts by time (`startingTimestamp` of a topic, `trade_date` of the raw table) can skip what is before.
    """
    reached = last_watermark(spark, checkpoint)
    return reached and reached - datetime.timedelta(minutes=longest_minutes)


def _log(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    rows = spark.read.schema("value string").text(f"{checkpoint.rstrip('/')}/{name}")
    return rows.select(F.col("_metadata.file_name").try_cast("long").alias("batch_id"), "value")
