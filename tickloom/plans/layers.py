"""Build the model layers in order and store them: staging as a view, the models as tables.

Ticks are read once, into the rollup. The daily table is bucketed by symbol, so the price model
reads it without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.operators.rollup import daily_rollup
from tickloom.plans.daily import METRICS, counted_metrics
from tickloom.plans.price import price_analytics
from tickloom.plans.sector import sector_analysis
from tickloom.plans.staging import staging

ROWS_PER_BUCKET = 2_000_000


def store_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def store_table(df: DataFrame, name: str, location: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """Replace a table. With `buckets` it is bucketed by symbol; rows that are already hashed by
    symbol into that many partitions make one file per bucket."""
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "symbol").sortBy("symbol", "trade_date")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def build_layers(raw: DataFrame, location: str | None = None, prefix: str = "",
                 buckets: int | None = None) -> dict[str, DataFrame]:
    """Build every model from the raw tick table; returns them by name.

    `location` is the folder for the tables (default: the warehouse), `prefix` goes before table
    names, `buckets` defaults to one for every ROWS_PER_BUCKET rows of the rollup.
    """
    models = {"staging": store_view(staging(raw), f"{prefix}staging")}

    def table(name: str, df: DataFrame, **options) -> None:
        models[name] = store_table(df, f"{prefix}{name}", location, **options)

    table("daily_rollup", daily_rollup(models["staging"]))
    buckets = buckets or 1 + models["daily_rollup"].count() // ROWS_PER_BUCKET
    # Hashed by symbol alone, the rows serve the daily aggregate and the buckets in one shuffle.
    by_symbol = models["daily_rollup"].repartition(buckets, "symbol")
    table("stock_metrics", counted_metrics(by_symbol), buckets=buckets)
    days = models["stock_metrics"]
    table("sector_analysis", sector_analysis(models["daily_rollup"], days=days))
    table("price_analytics", price_analytics(days.select(*METRICS)))
    return models
