"""Tumbling event-time windows over ticks, for batch and streaming DataFrames."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import micros

# Window label and length in minutes.
AVERAGE_WINDOWS = {"5min": 5, "15min": 15, "30min": 30}
SECTOR_WINDOW_MINUTES = 15
SECTOR_COLUMNS = ["sector", "avg_price", "total_volume", "avg_change_percent", "window_end_time"]


def window_averages(ticks: DataFrame, label: str, with_close: bool = False) -> DataFrame:
    """Average price per symbol and window. `window_end_time` is the last tick in the window;
    `with_close` adds the end of the window itself."""
    slot = F.window("timestamp", f"{AVERAGE_WINDOWS[label]} minutes")
    rows = (
        ticks.groupBy("symbol", slot)
        .agg(_average("price").alias("avg_price"), F.max("timestamp").alias("window_end_time"))
        .withColumn("window_size", F.lit(label))
        .withColumn("window_close", F.col("window.end"))
    )
    return rows.select(*_average_columns(with_close))


def moving_averages(ticks: DataFrame, with_close: bool = False, after: datetime.datetime | None = None) -> DataFrame:
    """The window averages of all lengths in one result, from one scan, one shuffle and, in a stream, one state.
    With `after` only of windows that end later."""
    rows = _expanded(ticks, [("symbol", label, minutes) for label, minutes in AVERAGE_WINDOWS.items()], after)
    return (
        rows.groupBy(F.col("name").alias("symbol"), "window_size", "window_close")
        .agg(_average("price").alias("avg_price"), F.max("timestamp").alias("window_end_time"))
        .select(*_average_columns(with_close))
    )


def symbol_and_sector_windows(ticks: DataFrame, after: datetime.datetime | None = None) -> DataFrame:
    """What `moving_averages` and `sector_windows` give, as one result whose `kind` is symbol or sector: a stream is
    read and decoded once for both, and keeps one state. `split_windows` parts the rows again. With `after` only of windows
    that end later."""
    kinds = [("symbol", label, minutes) for label, minutes in AVERAGE_WINDOWS.items()]
    rows = _expanded(ticks, [*kinds, ("sector", f"{SECTOR_WINDOW_MINUTES}min", SECTOR_WINDOW_MINUTES)], after)
    return rows.groupBy("kind", "name", "window_size", "window_close").agg(
        _average("price").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
        _average("change_percent").alias("avg_change_percent"),
        F.max("timestamp").alias("window_end_time"),
    )


def split_windows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The moving averages and the sector windows among the rows of `symbol_and_sector_windows`."""
    symbols, sectors = [rows.where(F.col("kind") == kind).withColumnRenamed("name", kind) for kind in ("symbol", "sector")]
    return symbols.select(*_average_columns(False)), sectors.select(*SECTOR_COLUMNS)


def every_window(ticks: DataFrame, *kept: str) -> DataFrame:
    """Each tick once for every length of the moving averages: window_size, the window's end, and the columns `kept`."""
    slots = [F.struct(F.lit(label).alias("window_size"), _slot_end(minutes).alias("window_close")) for label, minutes in AVERAGE_WINDOWS.items()]
    return ticks.where(F.col("timestamp").isNotNull()).select(*kept, F.inline(F.array(*slots)))


def _expanded(ticks: DataFrame, windows: list[tuple[str, str, int]], after: datetime.datetime | None = None) -> DataFrame:
    """Each tick once for every window (kind of key, label, minutes) that it falls in and that ends later than `after`.

    `window_close` is an event time as the tick's own time is: it takes over the watermark, as `F.window` does for its
    windows. So one aggregate holds windows of all lengths, and each decides by its own end whether a tick
    is late and when it is closed.
    """
    slots = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("name"), F.lit(label).alias("window_size"), _slot_end(minutes).alias("window_close"))
        for kind, label, minutes in windows
    ])
    marked = F.col("window_close").alias("window_close", metadata=ticks.schema["timestamp"].metadata)
    columns = [c for c in ("price", "volume", "change_percent", "timestamp") if c in ticks.columns]
    rows = ticks.where(F.col("timestamp").isNotNull()).select(*columns, F.inline(slots))
    rows = rows.select(*columns, "kind", "name", "window_size", marked)
    return rows if after is None else rows.where(F.col("window_close") > F.lit(after))


def sector_windows(ticks: DataFrame, with_close: bool = False, after: datetime.datetime | None = None) -> DataFrame:
    """Average price, volume, average change and last tick time per sector and window, with `after` only of windows
    that end later."""
    if after is not None:
        ticks = ticks.where(_slot_end(SECTOR_WINDOW_MINUTES) > F.lit(after))
    slot = F.window("timestamp", f"{SECTOR_WINDOW_MINUTES} minutes")
    rows = (
        ticks.groupBy("sector", slot)
        .agg(
            _average("price").alias("avg_price"),
            F.sum("volume").alias("total_volume"),
            _average("change_percent").alias("avg_change_percent"),
            F.max("timestamp").alias("window_end_time"),
        )
        .withColumn("window_close", F.col("window.end"))
    )
    return rows.select(*SECTOR_COLUMNS, *(["window_close"] if with_close else []))


def _average(column: str) -> Column:
    """Summed as decimals of eight places and divided once, so that neither order, partitions nor
    retries change it. A plain average where a value is too large for that, or no number."""
    value = F.col(column)
    units = value.try_cast("decimal(24,8)")
    exact = F.sum(units) / F.count(units).cast("decimal(10,0)")
    whole = F.count(units) == F.count(value)
    return F.when(F.count(value) > 0, F.when(whole, exact.cast("double")).otherwise(F.avg(value.cast("double"))))


def _average_columns(with_close: bool) -> list[str]:
    columns = ["symbol", "window_size", "avg_price", "window_end_time"]
    return columns + (["window_close"] if with_close else [])


def _slot_end(minutes: int) -> Column:
    """End of the epoch-aligned window that holds the tick."""
    width = minutes * 60_000_000
    at = micros("timestamp")
    return F.timestamp_micros(at - F.pmod(at, F.lit(width)) + F.lit(width))
