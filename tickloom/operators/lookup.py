"""Attach attributes of a dimension to a large table whose keys may be skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import stored

BROADCAST_BYTES = 32 << 20
SALTS = 32


def lookup(facts: DataFrame, dimension: DataFrame, key: str,
           broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """Left join; attributes are null for unknown and null keys. Raises on a key with two rows.

    The dimension is stored once, and one aggregation over it measures its bytes and checks its
    keys. Within `broadcast_bytes` it is broadcast. Beyond, the join is salted: facts of one key
    spread over `salts` partitions by their place in their partition, which also splits alike facts
    and is the same when a task over files runs again; the dimension is repeated to match.
    """
    dimension = stored(dimension.where(F.col(key).isNotNull()), "lookup")
    size, most = _measured(dimension, key)
    if most > 1:
        raise ValueError(f"the dimension has {most} rows for one {key}")
    if size <= broadcast_bytes:
        return facts.join(F.broadcast(dimension), key, "left")
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    salted_facts = facts.withColumn("__salt", salt)
    salted_dimension = dimension.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted_facts.join(salted_dimension, [key, "__salt"], "left").drop("__salt")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows as a broadcast holds them, about."""
    return df.agg(F.sum(_width(df))).first()[0] or 0


def _measured(dimension: DataFrame, key: str) -> tuple[int, int]:
    by_key = dimension.groupBy(key).agg(F.sum(_width(dimension)).alias("size"), F.count("*").alias("n"))
    size, most = by_key.agg(F.sum("size"), F.max("n")).first()
    return size or 0, most or 0


def _width(df: DataFrame):
    fixed = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            fixed = fixed + F.coalesce(F.octet_length(column), F.lit(0))
        fixed = fixed + F.lit(8 if isinstance(field.dataType, T.AtomicType) else 256)
    return fixed.cast("long")
