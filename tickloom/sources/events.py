"""The event table of the test data, read as the inputs of the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.windows import moving_averages, window_averages
from tickloom.schemas import MONEY
from tickloom.sources.messages import ISO_MICROS, TICK_COLUMNS
from tickloom.sources.quotes import BLOCK, CHANGE_KEY, PRICE_KEY, VOLUME_KEY

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files: a stream takes a plain path for
    a folder, a pattern for either."""
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/events[.]parquet")


def raw_ticks(source: DataFrame) -> DataFrame:
    """Events as rows of the raw tick table."""
    return _ticks(source, F.col("value").cast(MONEY)).withColumn(
        "change_percent", F.col("change_percent").cast(MONEY)
    )


def wire_ticks(source: DataFrame, *carried: str) -> DataFrame:
    """Events as ticks in the types of the stream, then any event columns to carry along."""
    return _ticks(source, F.round("value", 2), *carried)


def _ticks(source: DataFrame, price: Column, *carried: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    at = utc_time(source, "ts")
    return source.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        price.alias("price"),
        (k + 1).alias("volume"),
        ((k - 50) / F.lit(10.0)).alias("change_percent"),
        at.alias("timestamp"),
        F.concat(F.lit("SEC"), F.pmod("user_id", F.lit(5)).cast("string")).alias("sector"),
        (at + F.expr("interval 60 seconds")).alias("processed_timestamp"),
        *carried,
    )


def tick_messages(source: DataFrame) -> DataFrame:
    """One JSON message per event. `view` events carry the change as text, `error` events are not
    valid JSON."""
    rows = wire_ticks(source, "event_type")
    as_text = _json(*[
        F.col(c).cast("string").alias(c) if c == "change_percent" else F.col(c)
        for c in TICK_COLUMNS
    ])
    value = (
        F.when(F.col("event_type") == "view", as_text)
        .when(F.col("event_type") == "error", F.concat(F.lit("<"), _json(*TICK_COLUMNS)))
        .otherwise(_json(*TICK_COLUMNS))
    )
    return rows.select(value.alias("value"))


def quote_responses(source: DataFrame) -> DataFrame:
    """One quote response per event. `error` events lack the quote, `signup` ones are not JSON."""
    quote = F.struct(
        F.col("price").cast("string").alias(PRICE_KEY),
        F.col("volume").cast("string").alias(VOLUME_KEY),
        F.concat(F.col("change_percent").cast("string"), F.lit("%")).alias(CHANGE_KEY),
    )
    response = (
        F.when(F.col("event_type") == "error", F.lit('{"Note": {"text": "rate limit"}}'))
        .when(F.col("event_type") == "signup", F.lit("<html>"))
        .otherwise(F.to_json(F.struct(quote.alias(BLOCK))))
    )
    return wire_ticks(source, "event_type").select(
        "id", "symbol", response.alias("response"), F.col("timestamp").alias("fetched_at")
    )


def dirty_ticks(source: DataFrame) -> DataFrame:
    """Ticks of which some break the raw table's contract, by event type."""
    kind = F.col("event_type")
    return wire_ticks(source, "event_type").select(
        F.when(kind == "signup", F.concat(F.lit("NEWSYMBOL-"), F.col("symbol")))
        .otherwise(F.col("symbol")).alias("symbol"),
        F.when(kind == "purchase", F.col("price") * 1e7).otherwise(F.col("price")).alias("price"),
        F.when(kind != "error", F.col("volume")).alias("volume"),
        "change_percent",
        "timestamp",
        F.when(kind != "click", F.col("sector")).alias("sector"),
    )


def stored_averages(ticks: DataFrame, label: str | None = None) -> DataFrame:
    """The stream's table of averages as a batch, of all windows or one length: prices at two
    places, loaded 60 s after the window closes, the earliest a one-minute watermark allows."""
    averages = (
        window_averages(ticks, label, with_close=True) if label
        else moving_averages(ticks, with_close=True)
    )
    return averages.select(
        "symbol",
        "window_size",
        F.col("avg_price").cast(MONEY).alias("avg_price"),
        "window_end_time",
        (F.col("window_close") + F.expr("interval 60 seconds")).alias("processed_timestamp"),
    )


def run_log(source: DataFrame) -> DataFrame:
    """Events as model runs lasting `value` seconds."""
    start = utc_time(source, "ts")
    length = F.round(F.col("value") * 1e6).cast("bigint")
    return source.select(
        start.alias("created_at"),
        start.alias("started_at"),
        F.timestamp_micros(F.unix_micros(start) + length).alias("completed_at"),
        F.col("event_type").alias("model_name"),
    )


def supplier_regions(spark: SparkSession, folder: str) -> DataFrame:
    """A symbol to sector table: suppliers by region. Not every tick's symbol is a supplier."""
    supplier = spark.read.parquet(f"{folder}/supplier.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("symbol"),
            F.col("r_name").alias("sector"),
        )
    )


def utc_time(source: DataFrame, column: str) -> Column:
    """A timestamp without zone as the moment it names in UTC, whatever the session's time zone."""
    if source.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC":
        return F.col(column).cast("timestamp")
    return F.concat(F.col(column).cast("string"), F.lit("Z")).cast("timestamp")


def _json(*columns: Column | str) -> Column:
    return F.to_json(
        F.struct(*columns), {"timestampFormat": ISO_MICROS, "ignoreNullFields": "false"}
    )
