"""The streaming queries: raw ingestion, moving averages and sector performance."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators.windows import moving_averages, sector_windows, split_windows, symbol_and_sector_windows
from tickloom.plans.alerts import threshold_alerts
from tickloom.schemas import MARKET_ALERTS, MOVING_AVERAGES, RAW_TICKS, SECTOR_PERFORMANCE
from tickloom.sources.messages import TICK_COLUMNS
from tickloom.streaming.sinks import BatchWriter, batch_writer

WATERMARK = "1 minute"
PARTITIONS = "spark.sql.shuffle.partitions"


def with_watermark(ticks: DataFrame) -> DataFrame:
    return ticks.withWatermark("timestamp", WATERMARK)


def register_stream(ticks: DataFrame, name: str = "stock_stream") -> DataFrame:
    """The watermarked stream as a view, for SQL over it."""
    marked = with_watermark(ticks)
    marked.createOrReplaceTempView(name)
    return marked


def start_raw_ingest(ticks: DataFrame, path: str, checkpoint: str,
                     available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Every tick to the raw table, by date. Rows that break the contract are kept as rejects."""
    message = ["message"] if "message" in ticks.columns else []
    writer = batch_writer(path, RAW_TICKS, date_from="timestamp")
    rows = ticks.select(*TICK_COLUMNS, *message)
    return _start(rows.writeStream.foreachBatch(writer), checkpoint, available_now, every)


def start_moving_averages(ticks: DataFrame, path: str, checkpoint: str,
                          available_now: bool = False, every: str | None = None,
                          state_partitions: int | None = None, after: datetime.datetime | None = None) -> StreamingQuery:
    """Closed windows of all lengths, appended once each. `after` is the `handover.last_watermark` of a query that
    this one takes over from; give it again at restarts."""
    writer = batch_writer(path, MOVING_AVERAGES, small=True)
    rows = moving_averages(with_watermark(ticks), after=after)
    return _start(_appended(rows, writer), checkpoint, available_now, every, state_partitions)


def start_sector_performance(ticks: DataFrame, path: str, checkpoint: str,
                             available_now: bool = False,
                             every: str | None = None,
                             state_partitions: int | None = None, after: datetime.datetime | None = None) -> StreamingQuery:
    """Closed sector windows, appended once each; `after` as in `start_moving_averages`."""
    writer = batch_writer(path, SECTOR_PERFORMANCE, small=True)
    rows = sector_windows(with_watermark(ticks), after=after)
    return _start(_appended(rows, writer), checkpoint, available_now, every, state_partitions)


def start_aggregates(ticks: DataFrame, averages_path: str, sectors_path: str, checkpoint: str,
                     available_now: bool = False,
                     every: str | None = None,
                     state_partitions: int | None = None, after: datetime.datetime | None = None) -> list[StreamingQuery]:
    """Both aggregates, as one query: their source is read and decoded once. `after` as in `start_moving_averages`."""
    averages = batch_writer(averages_path, MOVING_AVERAGES, small=True, keep=False)
    sectors = batch_writer(sectors_path, SECTOR_PERFORMANCE, small=True, keep=False)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the windows are taken from the state once
        try:
            for writer, rows in zip((averages, sectors), split_windows(batch), strict=True):
                writer(rows, batch_id)
        finally:
            batch.unpersist()

    rows = symbol_and_sector_windows(with_watermark(ticks), after)
    return [_start(_appended(rows, write), checkpoint, available_now, every, state_partitions)]


def start_alerts(ticks: DataFrame, rules: DataFrame, path: str, checkpoint: str,
                 available_now: bool = False, every: str | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Threshold crossings to the alerts table; a restart goes on from each symbol's last tick. The table of
    rules is read again for each micro-batch, so a rule that is added applies from the next one on."""
    writer = batch_writer(path, MARKET_ALERTS, small=True)
    return _start(_appended(threshold_alerts(ticks, rules), writer), checkpoint, available_now, every, state_partitions)


def wait_for_any(spark: SparkSession) -> None:
    """Block until one of the session's queries ends; raises if it failed."""
    spark.streams.awaitAnyTermination()


def _appended(rows: DataFrame, writer: BatchWriter) -> DataStreamWriter:
    return rows.writeStream.outputMode("append").foreachBatch(writer)


def _start(stream: DataStreamWriter, checkpoint: str, available_now: bool,
           every: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """By default the next batch starts when the last one ends. `every` sets an interval and
    `available_now` stops after the data that is there. `state_partitions` is fixed for the life of
    a checkpoint; without it the session's `spark.sql.shuffle.partitions` counts."""
    stream = stream.option("checkpointLocation", checkpoint)
    if available_now:
        stream = stream.trigger(availableNow=True)
    elif every:
        stream = stream.trigger(processingTime=every)
    if state_partitions is None:
        return stream.start()
    conf = SparkSession.active().conf
    before = conf.get(PARTITIONS)
    conf.set(PARTITIONS, str(state_partitions))
    try:  # a query takes a copy of the settings when it starts
        return stream.start()
    finally:
        conf.set(PARTITIONS, before)
