"""Daily metrics per symbol.

Each function takes ticks or their daily rollup. One row per symbol and day, computed in one
aggregate: open and close are the prices at the first and last tick, ordered by time and then id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import percent_change, range_percent
from tickloom.operators.repeat import repeat_rows
from tickloom.operators.rollup import as_partials, mean, merge

KEYS = ["symbol", "trade_date"]
METRICS = [
    *KEYS, "avg_price", "high_price", "low_price", "open_price", "close_price",
    "daily_volume", "daily_volatility", "daily_return",
]


def symbol_days(source: DataFrame) -> DataFrame:
    """All daily metrics plus the tick count per symbol and day."""
    return (
        merge(as_partials(source), *KEYS)
        .withColumn("avg_price", mean("price_sum", "price_count"))
        .withColumnRenamed("volume_sum", "daily_volume")
        .withColumn("daily_volatility", range_percent("high_price", "low_price"))
        .withColumn("daily_return", percent_change("close_price", "open_price"))
        .select(*METRICS, "tick_count")
    )


def daily_metrics(source: DataFrame) -> DataFrame:
    return symbol_days(source).select(*KEYS, "avg_price", "high_price", "low_price", "daily_volume")


def open_close(source: DataFrame) -> DataFrame:
    return symbol_days(source).select(*KEYS, "open_price", "close_price")


def daily_volatility(source: DataFrame) -> DataFrame:
    return symbol_days(source).select(*KEYS, "daily_volatility")


def daily_return(source: DataFrame) -> DataFrame:
    return symbol_days(source).select(*KEYS, "daily_return")


def stock_metrics(source: DataFrame, per_tick: bool = False) -> DataFrame:
    """The daily metrics table. Rows without symbol or date are left out.

    `per_tick` gives each row once per tick of its day, as an inner join of the daily rows to
    their ticks does. The joined rows are all alike, so the row is repeated by its tick count
    instead of shuffling the ticks a second time.
    """
    days = counted_metrics(source)
    if per_tick:
        # The ticks themselves are the rows to make: counting them reads no columns.
        total = None if "tick_count" in source.columns else source.count()
        days = repeat_rows(days, "tick_count", total=total)
    return days.select(*METRICS)


def volatility_days(source: DataFrame) -> DataFrame:
    """Volatility and tick count per symbol and day; a rollup without open and close will do."""
    return (
        merge(as_partials(source), *KEYS)
        .where(F.col("symbol").isNotNull() & F.col("trade_date").isNotNull())
        .withColumn("daily_volatility", range_percent("high_price", "low_price"))
        .select(*KEYS, "daily_volatility", "tick_count")
    )


def counted_metrics(source: DataFrame) -> DataFrame:
    """`stock_metrics` with `tick_count`, the number of times each row counts per tick."""
    return symbol_days(source).where(
        F.col("symbol").isNotNull() & F.col("trade_date").isNotNull()
    )
