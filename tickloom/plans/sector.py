"""Sector model: daily sector figures, volatility across symbols, and rank.

Functions take ticks or their daily rollup. Pass the stored rollup when more than one is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.lookup import BROADCAST_BYTES, SALTS, measured_bytes
from tickloom.operators.rollup import as_partials, mean, merge
from tickloom.plans.daily import volatility_days
from tickloom.session import stored

KEYS = ["sector", "trade_date"]


def sector_daily(source: DataFrame) -> DataFrame:
    """Average price, volume and average change per sector and day. A null sector is a group."""
    return merge(as_partials(source), *KEYS).select(
        *KEYS,
        mean("price_sum", "price_count").alias("sector_avg_price"),
        F.col("volume_sum").alias("sector_volume"),
        mean("change_sum", "change_count").alias("sector_avg_change"),
    )


def symbol_sectors(source: DataFrame) -> DataFrame:
    """Each sector a symbol was ever seen in, with its number of ticks there."""
    return (
        as_partials(source).groupBy("symbol", "sector")
        .agg(F.sum("tick_count").alias("sector_ticks"))
    )


def sector_volatility(source: DataFrame, per_tick: bool = False,
                      days: DataFrame | None = None) -> DataFrame:
    """Sample standard deviation of daily volatility over the symbols of a sector.

    By default each symbol counts once. `per_tick` weighs a symbol's day by its ticks that day
    times its ticks in the sector, which is what joining repeated daily rows to all ticks on the
    symbol alone amounts to, without forming the pairs. `days` is the stored daily table with
    tick counts, if there is one.
    """
    days = volatility_days(source) if days is None else days
    members = days.select("symbol", "trade_date", "daily_volatility", "tick_count").join(
        symbol_sectors(source), "symbol"
    )
    if per_tick:
        return _weighted(members)
    return members.groupBy(*KEYS).agg(
        F.stddev_samp("daily_volatility").alias("sector_volatility")
    )


def sector_analysis(source: DataFrame, per_tick: bool = False,
                    days: DataFrame | None = None) -> DataFrame:
    """Daily sector figures with volatility and the rank by average change, nulls first."""
    by_change = Window.partitionBy("trade_date").orderBy(F.desc_nulls_first("sector_avg_change"))
    return (
        sector_daily(source)
        .join(sector_volatility(source, per_tick, days), KEYS, "left")
        .withColumn("performance_rank", F.rank().over(by_change).cast("long"))
    )


def _weighted(members: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Weighted sample deviation in two passes; weights are doubles as their product may not fit
    a long. Both passes combine before the shuffle: the centres, a row per sector and day, are
    measured and broadcast, or repeated by a salt that splits each sector and day."""
    weight = F.col("tick_count").cast("double") * F.col("sector_ticks").cast("double")
    salt = F.pmod(F.xxhash64("symbol"), F.lit(SALTS)).cast("int").alias("salt")
    rows = stored(
        members.select(*KEYS, F.col("daily_volatility").alias("x"), weight.alias("w"), salt), "sector-members")
    counted = F.when(F.col("x").isNotNull(), F.col("w"))
    centres = rows.groupBy(*KEYS).agg(
        F.sum(counted).alias("total"),
        F.try_divide(F.sum(F.col("w") * F.col("x")), F.sum(counted)).alias("centre"),
    )
    centres = stored(centres, "sector-centres")
    same_group = (
        F.col("r.sector").eqNullSafe(F.col("c.sector"))
        & (F.col("r.trade_date") == F.col("c.trade_date"))
    )
    if measured_bytes(centres) <= broadcast_bytes:
        centres = F.broadcast(centres)
    else:
        centres = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same_group = same_group & (F.col("r.salt") == F.col("c.salt"))
    off = F.col("x") - F.col("centre")
    return (
        rows.alias("r").join(centres.alias("c"), same_group)
        .select("r.sector", "r.trade_date", "total", (F.col("w") * off * off).alias("square"))
        .groupBy(*KEYS)
        .agg(F.sum("square").alias("squares"), F.max("total").alias("total"))
        .select(
            *KEYS,
            F.sqrt(
                F.when(F.col("total") > 1, F.col("squares") / (F.col("total") - 1))
            ).alias("sector_volatility"),
        )
    )
