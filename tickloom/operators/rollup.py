"""Mergeable daily partials.

Every daily figure is a merge of per-tick partials, so ticks can be rolled up once to one row per
symbol, sector and day, and all daily models built from that much smaller table. The same merge
serves raw ticks (each tick is a partial of itself) and the rolled-up table.

Sums of prices and percentages are kept in hundredths, the scale they are stored at. Whole numbers
add without error in a double up to 2**53, so an average does not depend on how the rows were
partitioned or on a retried task, at the cost of a plain double sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import order_key, trade_date


def as_partials(source: DataFrame) -> DataFrame:
    """Ticks as partials; a table that already holds partials is returned unchanged."""
    if "tick_count" in source.columns:
        return source
    one = F.lit(1).cast("long")
    none = F.lit(0).cast("long")
    key = order_key("timestamp", "id")
    price = F.col("price").cast("double")
    return source.select(
        "symbol",
        "sector",
        trade_date("timestamp").alias("trade_date"),
        one.alias("tick_count"),
        _hundredths(source, "price").alias("price_sum"),
        F.when(F.col("price").isNull(), none).otherwise(one).alias("price_count"),
        price.alias("high_price"),
        price.alias("low_price"),
        key.alias("open_key"),
        price.alias("open_price"),
        key.alias("close_key"),
        price.alias("close_price"),
        F.col("volume").alias("volume_sum"),
        _hundredths(source, "change_percent").alias("change_sum"),
        F.when(F.col("change_percent").isNull(), none).otherwise(one).alias("change_count"),
    )


def merge(partials: DataFrame, *keys: str) -> DataFrame:
    """Merge partials per key. Combined before the shuffle, so a hot key costs one row per task."""
    rules = {
        "tick_count": F.sum("tick_count"),
        "price_sum": F.sum("price_sum"),
        "price_count": F.sum("price_count"),
        "high_price": F.max("high_price"),
        "low_price": F.min("low_price"),
        "volume_sum": F.sum("volume_sum"),
        "change_sum": F.sum("change_sum"),
        "change_count": F.sum("change_count"),
    }
    if "open_key" in partials.columns:
        rules |= {
            "open_key": F.min("open_key"),
            "open_price": F.min_by("open_price", "open_key"),
            "close_key": F.max("close_key"),
            "close_price": F.max_by("close_price", "close_key"),
        }
    return partials.groupBy(*keys).agg(*[rule.alias(name) for name, rule in rules.items()])


def daily_rollup(ticks: DataFrame, open_close: bool = True) -> DataFrame:
    """One row of partials per symbol, sector and day: the only pass over the ticks.

    The sector model does without `open_close`, which needs the most work per tick.
    """
    partials = as_partials(ticks)
    if not open_close:
        partials = partials.drop("open_key", "open_price", "close_key", "close_price")
    return merge(partials, "symbol", "sector", "trade_date")


def mean(hundredths: str, count: str) -> Column:
    """Average from a sum in hundredths and a count; null over no values."""
    return F.try_divide(F.col(hundredths), F.col(count) * 100)


def _hundredths(source: DataFrame, column: str) -> Column:
    """Exact for stored decimals; values of other types may have more places and keep them."""
    value = F.col(column).cast("double") * 100
    stored = source.schema[column].dataType
    exact = isinstance(stored, T.DecimalType) and stored.scale <= 2
    return F.rint(value) if exact else value
