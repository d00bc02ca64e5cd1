"""Repeat rows by a count column without holding one row's copies in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 100_000
ROWS_PER_PARTITION = 1_000_000
MOST_PARTITIONS = 100_000


def repeat_rows(df: DataFrame, count: str, block: int = BLOCK, total: int | None = None) -> DataFrame:
    """Each row `count` times (none for null, zero or negative counts).

    Large counts are first cut into blocks that are hashed over the cluster, then each block is
    expanded, so the copies of one row are made by many tasks and never sit in one array. The
    number of partitions comes from the number of rows to make: `total`, or else the sum of the counts,
    as AQE would merge partitions by their size before expansion.
    """
    blocks = F.ceil(F.col(count) / F.lit(block)).cast("long")
    rest = F.col(count) - F.col("__block") * block
    cut = (
        df.where(F.col(count) > 0)
        .withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("__size", F.least(rest, F.lit(block)).cast("int"))
    )
    spread = cut.repartition(_partitions(df, count, total), *cut.columns)
    return (
        spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__size"))))
        .select(*df.columns)
    )


def _partitions(df: DataFrame, count: str, total: int | None) -> int:
    if total is None:
        total = df.where(F.col(count) > 0).agg(F.sum(F.col(count).cast("decimal(38,0)"))).first()[0] or 0
    return min(MOST_PARTITIONS, 1 + int(total) // ROWS_PER_PARTITION)
