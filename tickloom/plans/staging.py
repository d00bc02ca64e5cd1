"""Staging: the raw tick columns the models read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def staging(raw: DataFrame) -> DataFrame:
    """The eight tick columns as they are stored."""
    return raw.select(
        "id", "symbol", "price", "volume", "change_percent", "timestamp", "sector",
        "processed_timestamp",
    )


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs by column name; duplicates stay."""
    result = first
    for other in others:
        result = result.unionByName(other)
    return result


def literal_rows(spark: SparkSession, ids: Iterable[int | None]) -> DataFrame:
    """One row per given id; None makes a null."""
    return spark.createDataFrame([(i,) for i in ids], "id int")


def rows_with_id(df: DataFrame, value: int) -> DataFrame:
    """Rows whose id equals the value; null ids drop out."""
    return df.where(F.col("id") == value)
