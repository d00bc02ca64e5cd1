"""Column contracts of the stored tables.

A contract is both the Spark schema of a table and the rules a row must meet to enter it.
Prices and percentages are stored as decimal(10,2); models work on doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = True
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    """`natural_key` names the columns whose hash is the row id. Where equal rows are rows of their own, a table is
    `numbered` as it is written instead."""

    fields: tuple[Field, ...]
    natural_key: tuple[str, ...]
    numbered: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        """Schema of the stored table: generated id, the fields, load time."""
        return T.StructType(
            [T.StructField("id", T.LongType(), True)]
            + [T.StructField(f.name, f.type, True) for f in self.fields]
            + [T.StructField("processed_timestamp", T.TimestampType(), True)]
        )


# Columns, types and lengths of the stored tables.
RAW_TICKS = Contract(
    (
        Field("symbol", T.StringType(), max_length=10),
        Field("price", MONEY),
        Field("volume", T.LongType()),
        Field("change_percent", MONEY, required=False),
        Field("timestamp", T.TimestampType()),
        Field("sector", T.StringType(), required=False, max_length=50),
    ),
    natural_key=("symbol", "timestamp", "price", "volume", "change_percent", "sector"),
    numbered=True,
)

MOVING_AVERAGES = Contract(
    (
        Field("symbol", T.StringType(), max_length=10),
        Field("window_size", T.StringType(), max_length=20),
        Field("avg_price", MONEY),
        Field("window_end_time", T.TimestampType()),
    ),
    natural_key=("symbol", "window_size", "window_end_time"),
)

SECTOR_PERFORMANCE = Contract(
    (
        Field("sector", T.StringType(), max_length=50),
        Field("avg_price", MONEY),
        Field("total_volume", T.LongType()),
        Field("avg_change_percent", MONEY, required=False),
        Field("window_end_time", T.TimestampType()),
    ),
    natural_key=("sector", "window_end_time"),
)

MARKET_ALERTS = Contract(
    (
        Field("symbol", T.StringType(), max_length=10),
        Field("alert_type", T.StringType(), max_length=50),
        Field("value", MONEY),
        Field("threshold", MONEY),
        Field("triggered_at", T.TimestampType()),
    ),
    natural_key=("symbol", "alert_type", "triggered_at"),
)

# Wire form of a tick. change_percent arrives as a number or as text, so it is read as text.
TICK_MESSAGE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("change_percent", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("sector", T.StringType()),
])

# One row per model run in the run log.
RUN_LOG = T.StructType([
    T.StructField("created_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("model_name", T.StringType()),
])
