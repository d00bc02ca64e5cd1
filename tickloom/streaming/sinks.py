"""Micro-batch sinks that end up with every row once, however often a batch is retried.

Every attempt at a batch writes a folder of its own, and `manifest` says which folders count. The query is known by the id
that its checkpoint keeps: a restart has the same, however the path is spelled, and a new checkpoint another, also at an
old path. Tables by date have a log for each day, so that a day is listed and read alone.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import trade_date
from tickloom.operators.quality import apply_contract, broken_rules, with_row_id
from tickloom.schemas import Contract
from tickloom.streaming.manifest import ALL, MERGED, Manifest, attempt_folder


BatchWriter = Callable[[DataFrame, int], None]
ROWS_PER_FILE = 1_000_000
CHECKS = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("rule", T.StringType()), T.StructField("n_rows", T.LongType()),
])


def batch_writer(path: str, contract: Contract, date_from: str | None = None, small: bool = False,
                 rows_per_file: int = ROWS_PER_FILE, run: str | None = None, keep: bool = True) -> BatchWriter:
    """A `foreachBatch` function that writes accepted and rejected rows in one pass.

    Of a retried batch one attempt counts. Errors are raised, so a failed batch is never taken as done. `date_from` adds
    a date partition from that timestamp, in UTC. `run` names the query where the function is called outside one.

    The rows that break each rule, and the keys that were given, are counted by the write itself.

    `small` is for aggregates, whose batches are small but spread over every state partition. The
    batch is kept while it is counted and written, as each use would compute it again; an empty one
    is left out and others go to one file per `rows_per_file` rows instead of one per task. With `keep` off the
    caller keeps it, with other rows beside: each task reads one part of that, and a shuffle brings the rows to their files,
    as merging the parts would have one task read all that is kept for a few rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name, attempt, log = run or _query_id(batch), uuid.uuid4().hex, Manifest(batch.sparkSession, path)
        first = log.first_key(name, batch_id)
        judged = apply_contract(batch, contract)
        judged = judged.withColumn("id", _row_key(judged, first)) if contract.numbered else with_row_id(judged, contract)
        judged = judged.withColumn("processed_timestamp", F.current_timestamp()).withColumn("accepted", F.col("reject_reason").isNull())
        partitions = ["accepted"]
        if date_from:
            judged, partitions = judged.withColumn("trade_date", trade_date(date_from)), ["trade_date", "accepted"]
        counts = Observation()
        rules = broken_rules(contract)
        judged = judged.observe(counts, F.max("id").alias("last"), *[F.count_if(c).alias(rule) for rule, c in rules.items()])
        folder = f"{log.data}/{attempt_folder(name, batch_id, attempt)}"
        found = {"last": None, **dict.fromkeys(rules, 0)}
        if not small:
            judged.write.partitionBy(*partitions).parquet(folder)
            found = counts.get
        else:
            if keep:
                judged.persist()
            try:
                # One parallel job; probing an empty batch for a first row takes several small ones.
                rows = (judged if keep else batch).count()
                if rows > 0:
                    files = math.ceil(rows / rows_per_file)
                    judged = judged.coalesce(files) if keep else judged.repartition(files, "id")
                    judged.write.partitionBy(*partitions).parquet(folder)
                    found = counts.get
            finally:
                if keep:
                    judged.unpersist()
        used = contract.numbered and found["last"] is not None
        log.commit(name, batch_id, attempt, found["last"] + 1 if used else first, {rule: found[rule] or 0 for rule in rules})

    return write


def _row_key(rows: DataFrame, first: int) -> Column:
    """Keys from `first` on that no two rows share, without a pass to count rows: partitions take turns. A source that
    hands out the same partitions again gives the same keys to a retried batch."""
    place = F.monotonically_increasing_id()
    within = place.bitwiseAND(F.lit((1 << 33) - 1))
    return F.lit(first) + within * F.lit(rows.rdd.getNumPartitions()) + F.shiftright(place, 33)


def stored_rows(spark: SparkSession, path: str, contract: Contract, day: str | None = None) -> DataFrame:
    """Accepted rows of a table filled by `batch_writer`, in the table's schema.

    `day` (ISO date) is for tables by date: only that day's folders are listed and read. Such
    tables also have the column `trade_date`, whose filters prune.
    """
    rows = _read(spark, path, contract, day).where("accepted")
    dated = ["trade_date"] if "trade_date" in rows.columns else []
    return rows.select(*contract.schema().fieldNames(), *dated)


def rejected_rows(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    return _read(spark, path, contract).where("not accepted").select(
        "reject_reason", "rejected_row", "processed_timestamp"
    )


def broken_rows(spark: SparkSession, path: str) -> DataFrame:
    """run, batch_id, rule, n_rows: how many rows of each batch broke each rule, as counted when it was written. A row that
    breaks several rules counts for each."""
    return spark.read.schema(CHECKS).json(f"{path.rstrip('/')}/checks")


def compact_day(spark: SparkSession, path: str, contract: Contract, day: str) -> int:
    """`compact_days` for one day."""
    return compact_days(spark, path, contract, [day])


def compact_days(spark: SparkSession, path: str, contract: Contract, days: list[str] | None = None) -> int:
    """Merge the closed batches of days, by default of all, into few files; returns how many folders went.

    Only those days' folders are listed and read. The last batch of a query may still be retried and stays as it is. All days
    are written by one job, whose tasks Spark sizes by bytes, beside what counts; then one file a day lets the
    merged rows count instead. A reader sees one or the other. `vacuum` deletes what went.
    """
    log, attempt = Manifest(spark, path), uuid.uuid4().hex
    merges = [m for m in map(log.mergeable, days or log.days()) if m]
    if not merges:
        return 0
    entries = [e for m in merges for e in m.entries]
    rows = _read_entries(spark, log, contract, entries)
    folders = len({file.rsplit("/", 1)[0] for file in rows.inputFiles()})
    partitions = ["accepted"] if merges[0].day == ALL else ["trade_date", "accepted"]
    rows = rows.drop("run", "batch_id", "attempt").hint("rebalance", *[F.col(p) for p in partitions])
    rows.write.partitionBy(*partitions).parquet(f"{log.data}/{attempt_folder(MERGED, 0, attempt)}")
    won = [log.merged(m, attempt) for m in merges]
    if not any(won):
        log.discard(MERGED, 0, attempt)
    return folders if all(won) else 0


def vacuum(spark: SparkSession, path: str, older_than: float = 86_400) -> int:
    """Delete the folders of a table that have not counted for `older_than` seconds; returns how many went."""
    return Manifest(spark, path).vacuum(older_than)


def _query_id(batch: DataFrame) -> str:
    """The id in the checkpoint of the query that runs this batch."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("outside a streaming query, batch_writer needs `run`")
    return found


def _read(spark: SparkSession, path: str, contract: Contract, day: str | None = None) -> DataFrame:
    log = Manifest(spark, path)
    return _read_entries(spark, log, contract, log.live(day))


def _read_entries(spark: SparkSession, log: Manifest, contract: Contract, entries: list) -> DataFrame:
    dated = any(e.day != ALL for e in entries)
    schema = T.StructType(
        contract.schema().fields
        + [
            T.StructField("reject_reason", T.StringType()),
            T.StructField("rejected_row", T.StringType()),
            T.StructField("accepted", T.BooleanType()),
            T.StructField("run", T.StringType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("attempt", T.StringType()),
        ]
        + ([T.StructField("trade_date", T.DateType())] if dated else [])
    )
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", log.data).parquet(*[log.folder(e) for e in entries])
