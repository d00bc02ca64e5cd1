"""Stored tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables the models and analyses read.
SOURCE_TABLES = ("raw_stock_data", "stock_moving_averages", "sector_performance", "market_alerts")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_known(name))


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{_known(name)}")


def jdbc_table(spark: SparkSession, url: str, name: str, partitions: int,
               lower_id: int, upper_id: int, **options: str) -> DataFrame:
    """A database table, read in parallel by ranges of its id."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", _known(name))
        .option("partitionColumn", "id")
        .option("lowerBound", lower_id)
        .option("upperBound", upper_id)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )


def _known(name: str) -> str:
    if name not in SOURCE_TABLES:
        raise ValueError(f"unknown source table {name!r}; known: {', '.join(SOURCE_TABLES)}")
    return name
