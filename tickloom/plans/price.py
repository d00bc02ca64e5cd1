"""Price analytics: moving averages, momentum and trend over a symbol's daily rows.

All window columns share one specification, so they cost one shuffle by symbol and one sort of
daily rows. A symbol holds one row per day it traded, so no partition grows with its ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import percent_change, trend

# Frame lengths and lag, in rows.
AVERAGES = {"ma_5_day": 5, "ma_10_day": 10, "ma_20_day": 20}
LAG = 5

COLUMNS = [
    "symbol", "trade_date", "avg_price", "open_price", "close_price", "high_price", "low_price",
    "daily_volume", "daily_volatility", "daily_return",
    "ma_5_day", "ma_10_day", "ma_20_day", "momentum_5_day", "trend_signal",
]


def moving_averages(metrics: DataFrame) -> DataFrame:
    return metrics.select("symbol", "trade_date", *_averages())


def momentum(metrics: DataFrame) -> DataFrame:
    return metrics.select("symbol", "trade_date", _momentum())


def trend_signal(metrics: DataFrame) -> DataFrame:
    return moving_averages(metrics).select(
        "symbol", "trade_date", trend("ma_5_day", "ma_20_day").alias("trend_signal")
    )


def price_analytics(metrics: DataFrame) -> DataFrame:
    """The price table, one row per symbol and day."""
    return (
        metrics.select("*", *_averages(), _momentum())
        .withColumn("trend_signal", trend("ma_5_day", "ma_20_day"))
        .select(*COLUMNS)
    )


def price_analytics_per_tick(metrics: DataFrame) -> DataFrame:
    """The price table as computed over metrics repeated once per tick, with `copies` per row.

    With n ticks in a day the repeated tables join to n * n * n rows. These hold few different
    ones: from the 20th repeat on a frame of 20 rows lies within the day, and from the 6th repeat
    on the lag does. So at most 20 averages and 6 momenta per day are computed from the last days'
    values and counts, and `copies` says how often each row occurs. Input needs `tick_count`.
    """
    longest = max(AVERAGES.values())
    prior = {
        "__prices": _recent("avg_price", longest - 1),
        "__closes": _recent("close_price", LAG),
    }
    days = metrics.withColumns(prior)
    repeats = (
        days.withColumn("__i", F.explode(_positions(longest)))
        .withColumn("__i_rows", _position_rows("__i", longest))
        .withColumn("__seen", F.concat("__prices", F.array_repeat("avg_price", F.col("__i"))))
        .withColumns({name: _tail_mean("__seen", n) for name, n in AVERAGES.items()})
        .withColumn("__j", F.explode(_positions(LAG + 1)))
        .withColumn("__j_rows", _position_rows("__j", LAG + 1))
        .withColumn("__old", _lagged_close())
        .withColumn("momentum_5_day", percent_change("close_price", "__old"))
        .withColumn("trend_signal", trend("ma_5_day", "ma_20_day"))
    )
    wide = "decimal(38,0)"
    copies = F.col("tick_count").cast(wide) * F.col("__i_rows") * F.col("__j_rows")
    return repeats.select(*COLUMNS, copies.cast(wide).alias("copies"))


def _by_day() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("trade_date")


def _averages() -> list[Column]:
    return [
        F.avg("avg_price").over(_by_day().rowsBetween(1 - n, 0)).alias(name)
        for name, n in AVERAGES.items()
    ]


def _momentum() -> Column:
    earlier = F.lag("close_price", LAG).over(_by_day())
    return percent_change(F.col("close_price"), earlier).alias("momentum_5_day")


def _recent(column: str, rows: int) -> Column:
    """The last `rows` values before the day when each value is repeated once per tick."""
    kept = F.least(F.col("tick_count"), F.lit(rows)).cast("int")
    runs = F.collect_list(F.struct(F.col(column).alias("value"), kept.alias("n"))).over(
        _by_day().rowsBetween(-rows, -1)
    )
    values = F.flatten(F.transform(runs, lambda run: F.array_repeat(run["value"], run["n"])))
    return _last(values, rows)


def _last(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))


def _positions(limit: int) -> Column:
    """Places 1, 2, ... of a repeated row within its day; the last stands for all later ones."""
    return F.sequence(F.lit(1), F.least(F.col("tick_count"), F.lit(limit)).cast("int"))


def _position_rows(position: str, limit: int) -> Column:
    later = F.col("tick_count") - limit + 1
    return F.when(F.col(position) == limit, later).otherwise(F.lit(1)).cast("decimal(19,0)")


def _tail_mean(values: str, n: int) -> Column:
    tail = F.filter(_last(F.col(values), n), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(tail, F.lit(0.0), lambda total, v: total + v), F.size(tail))


def _lagged_close() -> Column:
    """Close five repeated rows back: in an earlier day for the first five places of a day."""
    place = F.size("__closes") - LAG + F.col("__j")
    earlier = F.when(place >= 1, F.try_element_at("__closes", F.greatest(place, F.lit(1))))
    return F.when(F.col("__j") > LAG, F.col("close_price")).otherwise(earlier)
