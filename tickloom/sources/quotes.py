"""Quote responses of a market-data service to ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import text_to_double, text_to_long
from tickloom.operators.lookup import lookup

# Block and keys of a quote response.
BLOCK = "Global Quote"
PRICE_KEY = "05. price"
VOLUME_KEY = "06. volume"
CHANGE_KEY = "10. change percent"


def normalise_quotes(quotes: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Columns symbol, response (JSON text) and fetched_at to tick columns.

    A missing block, a missing key or text that is not a number gives null, so the row fails the
    tick contract. `sectors` (symbol, sector) adds the sector.
    """
    block = F.try_element_at(
        F.from_json("response", "map<string,map<string,string>>"), F.lit(BLOCK)
    )
    ticks = quotes.withColumn("__quote", block).select(
        "symbol",
        text_to_double(_entry(PRICE_KEY)).alias("price"),
        text_to_long(_entry(VOLUME_KEY)).alias("volume"),
        text_to_double(_entry(CHANGE_KEY)).alias("change_percent"),
        F.col("fetched_at").alias("timestamp"),
    )
    if sectors is None:
        return ticks.withColumn("sector", F.lit(None).cast("string"))
    return attach_sector(ticks, sectors)


def attach_sector(ticks: DataFrame, sectors: DataFrame, default: str | None = None) -> DataFrame:
    """Sector by symbol; an unknown symbol gets `default`."""
    plain = ticks.drop("sector") if "sector" in ticks.columns else ticks
    found = lookup(plain, sectors.select("symbol", "sector"), "symbol")
    return found.withColumn("sector", F.coalesce("sector", F.lit(default).cast("string")))


def _entry(key: str) -> Column:
    return F.try_element_at(F.col("__quote"), F.lit(key))
