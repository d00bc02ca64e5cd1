"""The tick before each tick of its symbol, for batch and streaming DataFrames.

Ticks are in the order of their time, and at one moment of their values, so the order never hangs on how rows lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from tickloom.functions import trade_date

#: What a symbol's ticks are ordered by, and what is known of the tick before.
ORDER = ["timestamp", "price", "volume", "change_percent"]
VALUES = ORDER[1:]
_TYPES = {"timestamp": "timestamp", "price": "double", "volume": "double", "change_percent": "double"}


def with_previous(ticks: DataFrame) -> DataFrame:
    """symbol, timestamp, the values of each tick, and those of the tick before as `previous_*`, null for a first one.

    Ticks without a symbol or a time have no place in the order and are left out. In a stream, so are ticks older
    than one of their symbol that an earlier micro-batch held.
    """
    rows = ticks.select("symbol", *[F.col(c).cast(t).alias(c) for c, t in _TYPES.items()]).where("symbol IS NOT NULL AND timestamp IS NOT NULL")
    return _in_stream(rows) if ticks.isStreaming else _in_batch(rows)


def _in_batch(rows: DataFrame) -> DataFrame:
    """Windows run over a symbol's days, so a symbol with a third of all ticks is many groups; only the
    last tick of each day is looked up by the first one of the symbol's next day."""
    days = rows.withColumn("day", trade_date("timestamp"))
    in_day = Window.partitionBy("symbol", "day").orderBy(*ORDER)
    value = F.struct(*VALUES)
    found = days.select(
        "*", F.lag(value).over(in_day).alias("before"), (F.row_number().over(in_day) == 1).alias("first"),
        F.lead(F.lit(1)).over(in_day).isNull().alias("last"))
    ends = found.where("last").select("symbol", "day", value.alias("end"))
    ends = ends.select("symbol", "day", F.lag("end").over(Window.partitionBy("symbol").orderBy("day")).alias("end"))
    linked = found.join(ends, ["symbol", "day"], "left")
    before = F.when(F.col("first"), F.col("end")).otherwise(F.col("before"))
    return linked.select("symbol", *ORDER, *[before[c].alias(f"previous_{c}") for c in VALUES])


def _in_stream(rows: DataFrame) -> DataFrame:
    """A symbol's last tick is its state, so state grows with symbols, and a group holds one micro-batch of a symbol."""
    schema = ", ".join(["symbol string", *[f"{c} {_TYPES[c]}" for c in ORDER], *[f"previous_{c} double" for c in VALUES]])
    followed = rows.groupBy("symbol").applyInPandasWithState(
        _follow, schema, ", ".join(f"{c} {_TYPES[c]}" for c in ORDER), "append", "NoTimeout")
    # Rows as they come from Python can't be shuffled ("ColumnarBatchRow cannot be cast"); a computed column makes others of them.
    return followed.withColumn("symbol", F.concat("symbol", F.lit("")))


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    new = pd.concat(list(frames)).sort_values(ORDER, na_position="first")
    columns = ["symbol", *ORDER, *[f"previous_{c}" for c in VALUES]]
    if state.exists:
        last = pd.DataFrame([state.get], columns=ORDER)
        last["timestamp"] = pd.to_datetime(last["timestamp"])
        new = new[new["timestamp"] >= last["timestamp"].iloc[0]]
    if new.empty:
        return
    new = new.reset_index(drop=True)
    for c in VALUES:
        new[f"previous_{c}"] = new[c].shift(1)
        if state.exists:
            new.loc[0, f"previous_{c}"] = last[c].iloc[0]
    end = new.iloc[-1]
    state.update((end["timestamp"].to_pydatetime(), *[None if pd.isna(end[c]) else float(end[c]) for c in VALUES]))
    yield new[columns]
