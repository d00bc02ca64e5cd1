"""Data checks, and the split of rows into those a table contract accepts and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import ISO_MICROS, Contract, Field


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that break a not-null rule."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that break a unique rule, with their number of rows. Nulls do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows in the contract's column types, with `reject_reason` and `rejected_row`.

    `reject_reason` is null for rows the table accepts and otherwise lists the broken rules.
    `rejected_row` keeps the whole row as it came, as JSON, for rejected rows only.
    """
    original = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "timestampFormat": ISO_MICROS})
    reasons = F.concat_ws("; ", *[_violation(field) for field in contract.fields])
    judged = df.withColumn("reject_reason", F.when(reasons != "", reasons))
    rejected = F.col("reject_reason").isNotNull()
    return judged.select(
        *[_typed(field).alias(field.name) for field in contract.fields],
        "reject_reason",
        F.when(rejected, original).alias("rejected_row"),
    )


def rules(contract: Contract) -> list[str]:
    """The reasons for which a row can be rejected."""
    names = []
    for field in contract.fields:
        names += [f"{field.name} is null"] if field.required else []
        names += [f"{field.name} longer than {field.max_length}"] if field.max_length is not None else []
        names += [f"{field.name} out of range"] if not isinstance(field.type, T.StringType) else []
    return names


def broken_rules(contract: Contract) -> dict[str, Column]:
    """Each rule of a contract, and whether a row of `apply_contract` breaks it. Only rejected rows have their reasons split."""
    reason = F.col("reject_reason")
    return {rule: reason.isNotNull() & F.array_contains(F.split(reason, "; "), rule) for rule in rules(contract)}


def accepted(judged: DataFrame, contract: Contract) -> DataFrame:
    return judged.where(F.col("reject_reason").isNull()).select(*contract.columns)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNotNull()).select("reject_reason", "rejected_row")


def with_row_id(df: DataFrame, contract: Contract) -> DataFrame:
    """Row id from the natural key: the same row gets the same id on every rerun."""
    return df.withColumn("id", F.xxhash64(*contract.natural_key))


def _typed(field: Field) -> Column:
    """Decimals are rounded half up to their scale; what does not fit becomes null, not an error."""
    return F.col(field.name).try_cast(field.type)


def _violation(field: Field) -> Column:
    column = F.col(field.name)
    broken = F.lit(None).cast("string")
    if field.max_length is not None:
        broken = F.when(
            F.char_length(column) > field.max_length, f"{field.name} longer than {field.max_length}"
        )
    if not isinstance(field.type, T.StringType):
        broken = F.when(
            column.isNotNull() & _typed(field).isNull(), f"{field.name} out of range"
        )
    if field.required:
        broken = F.when(column.isNull(), f"{field.name} is null").otherwise(broken)
    return broken
