"""Alerts where a symbol's value crosses a threshold: the writer of the table that `MARKET_ALERTS` describes.

A rule names a symbol or `*` for all, an alert type, the value it watches (price, volume or change_percent), whether it fires
above or below, and a threshold. It fires at a tick that is strictly beyond the threshold when the tick before of the same
symbol was not, or was null; a symbol's first tick counts as a crossing. So it fires once for each time that
the value stays beyond, however many ticks that lasts. Null values fire nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.previous import VALUES, with_previous

RULES = "symbol string, alert_type string, watched string, above boolean, threshold double"
EVERY = "*"


def threshold_alerts(ticks: DataFrame, rules: DataFrame) -> DataFrame:
    """symbol, alert_type, value, threshold, triggered_at for ticks in a batch or a stream and a table of rules.

    Ticks meet their symbol's rules by an equality join, whose size Spark checks before it broadcasts. The rules for all
    symbols go to every task instead: as a key of that join they would bring all ticks to one. A rule that stands twice
    fires twice.
    """
    rule = F.struct("alert_type", "watched", "above", F.col("threshold").cast("double").alias("threshold"))
    own = rules.where(F.col("symbol") != EVERY).groupBy("symbol").agg(F.collect_list(rule).alias("own"))
    common = rules.where(F.col("symbol") == EVERY).agg(F.collect_list(rule).alias("common"))  # one row, also of no rules
    met = with_previous(ticks).join(own, "symbol", "left").crossJoin(F.broadcast(common))
    every = F.when(F.col("own").isNull(), F.col("common")).otherwise(F.concat("own", "common"))
    ruled = met.select("*", F.inline(every))
    value, before = _watched(""), _watched("previous_")
    fires = _beyond(value) & ~F.coalesce(_beyond(before), F.lit(False))
    return ruled.where(fires).select("symbol", "alert_type", value.alias("value"), "threshold", F.col("timestamp").alias("triggered_at"))


def _watched(prefix: str) -> Column:
    return F.coalesce(*[F.when(F.col("watched") == c, F.col(f"{prefix}{c}")) for c in VALUES])


def _beyond(value: Column) -> Column:
    return F.when(F.col("above"), value > F.col("threshold")).otherwise(value < F.col("threshold"))
