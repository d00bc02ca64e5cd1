from __future__ import annotations

import datetime
import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import SMALL, as_dicts
from tickloom.operators import windows
from tickloom.schemas import MOVING_AVERAGES, RAW_TICKS, SECTOR_PERFORMANCE
from tickloom.sources import events as ev
from tickloom.sources.messages import decode_ticks, encode_ticks, file_messages
from tickloom.streaming import runner, sinks


def put(folder, name, *ticks):
    """A file of messages from (symbol, 'HH:MM:SS', price)."""
    lines = [
        json.dumps({"symbol": s, "price": p, "volume": 1, "change_percent": "1.0",
                    "timestamp": f"2024-01-01T{at}.000000", "sector": "S"})
        for s, at, p in ticks
    ]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


class Feed:
    """Run the averages query over the files put so far, as a restart from its checkpoint."""

    def __init__(self, spark, tmp_path):
        self.spark, self.inbox = spark, tmp_path / "in"
        self.out, self.progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run(self, start=runner.start_moving_averages):
        ticks = decode_ticks(file_messages(self.spark, str(self.inbox), "*.json"))
        query = start(ticks, self.out, self.progress, available_now=True)
        query.awaitTermination()
        return query

    def rows(self):
        rows = sinks.stored_rows(self.spark, self.out, MOVING_AVERAGES)
        return sorted((r["window_size"], r["symbol"], float(r["avg_price"]),
                       r["window_end_time"].strftime("%H:%M:%S")) for r in rows.collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_windows_appear_once_when_the_watermark_passes(feed):
    put(feed.inbox, "1.json", ("A", "09:01:00", 1.0), ("A", "09:04:00", 2.0))
    feed.run()
    put(feed.inbox, "2.json", ("A", "09:06:00", 5.0))
    feed.run()
    assert feed.rows() == [("5min", "A", 1.5, "09:04:00")]
    put(feed.inbox, "3.json", ("A", "09:50:00", 7.0))
    feed.run()
    assert feed.rows() == [
        ("15min", "A", 2.67, "09:06:00"),
        ("30min", "A", 2.67, "09:06:00"),
        ("5min", "A", 1.5, "09:04:00"),
        ("5min", "A", 5.0, "09:06:00"),
    ]


def test_late_tick_counts_only_in_windows_still_open(feed):
    put(feed.inbox, "1.json", ("A", "09:01:00", 1.0), ("A", "09:20:00", 3.0))
    feed.run()
    put(feed.inbox, "2.json", ("A", "09:02:00", 9.0))
    feed.run()
    put(feed.inbox, "3.json", ("A", "10:30:00", 1.0))
    feed.run()
    closed = feed.rows()
    assert ("5min", "A", 1.0, "09:01:00") in closed
    assert ("15min", "A", 1.0, "09:01:00") in closed
    assert ("30min", "A", 4.33, "09:20:00") in closed


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    stream = ev.wire_ticks(ev.event_stream(spark, SMALL))
    runner.start_moving_averages(stream, out, progress, available_now=True).awaitTermination()
    ticks = ev.wire_ticks(ev.events(spark, SMALL))
    until = ticks.agg(F.max("timestamp")).first()[0] - datetime.timedelta(minutes=1)
    batch = (
        windows.moving_averages(ticks, with_close=True).where(F.col("window_close") <= until)
        .withColumn("avg_price", F.col("avg_price").cast("decimal(10,2)"))
        .select(*MOVING_AVERAGES.columns)
    )
    stored = sinks.stored_rows(spark, out, MOVING_AVERAGES).select(*MOVING_AVERAGES.columns)
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0


@pytest.mark.parametrize("provider", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_many_batches_equal_one_batch_job(spark, tmp_path, provider):
    """Ticks in time order over several batches and restarts, state evicted on the way."""
    ticks = ev.wire_ticks(ev.events(spark, SMALL))
    lines = [r["value"] for r in encode_ticks(ticks.orderBy("timestamp")).collect()]
    inbox, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    inbox.mkdir()
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, f"org.apache.spark.sql.execution.streaming.state.{provider}")
    try:
        left = 0
        for part in range(4):
            for piece in range(2):
                n = part * 2 + piece
                (inbox / f"{n}.json").write_text("\n".join(lines[n * 125:(n + 1) * 125]) + "\n")
                time.sleep(0.05)
            stream = decode_ticks(file_messages(spark, str(inbox), "*.json", 1))
            query = runner.start_moving_averages(stream, out, progress, available_now=True)
            query.awaitTermination()
            left = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
    finally:
        spark.conf.set(setting, before)
    assert left == 3
    until = ticks.agg(F.max("timestamp")).first()[0] - datetime.timedelta(minutes=1)
    batch = (
        windows.moving_averages(ticks, with_close=True).where(F.col("window_close") <= until)
        .withColumn("avg_price", F.col("avg_price").cast("decimal(10,2)"))
        .select(*MOVING_AVERAGES.columns)
    )
    stored = sinks.stored_rows(spark, out, MOVING_AVERAGES).select(*MOVING_AVERAGES.columns)
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0


def test_source_may_be_a_folder_of_files(spark, tmp_path):
    ev.events(spark, SMALL).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    counts = []
    for folder in (SMALL, str(tmp_path)):
        out, progress = str(tmp_path / f"o{len(counts)}"), str(tmp_path / f"p{len(counts)}")
        stream = ev.wire_ticks(ev.event_stream(spark, folder))
        runner.start_sector_performance(stream, out, progress, available_now=True).awaitTermination()
        counts.append(sinks.stored_rows(spark, out, SECTOR_PERFORMANCE).count())
    assert counts[0] == counts[1] > 0


def test_both_aggregates_run_over_one_source(spark, tmp_path):
    stream = ev.wire_ticks(ev.event_stream(spark, SMALL))
    paths = [str(tmp_path / name) for name in ("averages", "sectors")]
    queries = runner.start_aggregates(stream, *paths, str(tmp_path / "c"), available_now=True)
    for query in queries:
        query.awaitTermination()
    assert sinks.stored_rows(spark, paths[0], MOVING_AVERAGES).count() > 0
    sectors = sinks.stored_rows(spark, paths[1], SECTOR_PERFORMANCE)
    assert len(sectors.inputFiles()) == 1
    assert sectors.count() > 0
    assert sectors.columns == SECTOR_PERFORMANCE.schema().fieldNames()


def test_small_batches_make_few_files(spark, tmp_path):
    out = str(tmp_path / "out")
    write = sinks.batch_writer(out, MOVING_AVERAGES, small=True, rows_per_file=40, run="c")
    rows = spark.range(100, numPartitions=16).selectExpr(
        "concat('S', id) as symbol", "'5min' as window_size", "1D as avg_price",
        "timestamp'2024-01-01 09:00:00' as window_end_time")
    write(rows, 0)
    stored = sinks.stored_rows(spark, out, MOVING_AVERAGES)
    assert stored.count() == 100
    assert len(stored.inputFiles()) == 3


def test_retried_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    write = sinks.batch_writer(out, MOVING_AVERAGES, small=True, run="a")
    other = sinks.batch_writer(out, MOVING_AVERAGES, small=True, run="b")
    rows = spark.sql("select 'A' as symbol, '5min' as window_size, 1.005D as avg_price, "
                     "timestamp'2024-01-01 09:00:00' as window_end_time")
    write(rows, 0)
    first = sinks.stored_rows(spark, out, MOVING_AVERAGES).collect()
    write(rows, 0)
    again = sinks.stored_rows(spark, out, MOVING_AVERAGES).collect()
    assert len(first) == len(again) == 1
    assert first[0]["id"] == again[0]["id"]
    write(rows, 1)
    write(rows.limit(0), 2)
    assert sinks.stored_rows(spark, out, MOVING_AVERAGES).count() == 2
    other(rows, 0)
    assert sinks.stored_rows(spark, out, MOVING_AVERAGES).count() == 3


def test_rows_that_break_the_contract_are_kept_apart(spark, tmp_path):
    out = str(tmp_path / "out")
    write = sinks.batch_writer(out, SECTOR_PERFORMANCE, run="c")
    write(spark.sql(
        "select s as sector, p as avg_price, 1L as total_volume, cast(null as double) as "
        "avg_change_percent, timestamp'2024-01-01 09:00:00' as window_end_time "
        "from values ('X', 1D), (null, 1D), ('Y', 1e12D) as t(s, p)"), 0)
    assert [r["sector"] for r in sinks.stored_rows(spark, out, SECTOR_PERFORMANCE).collect()] == ["X"]
    reasons = {r["reject_reason"] for r in sinks.rejected_rows(spark, out, SECTOR_PERFORMANCE).collect()}
    assert reasons == {"sector is null", "avg_price out of range"}


def test_failed_batch_fails_the_query_and_is_done_again(feed):
    put(feed.inbox, "1.json", ("A", "09:01:00", 1.0), ("A", "10:01:00", 1.0))
    ticks = decode_ticks(file_messages(feed.spark, str(feed.inbox), "*.json"))

    def broken(batch, batch_id):
        raise RuntimeError("disk full")

    rows = windows.moving_averages(runner.with_watermark(ticks))
    query = runner._start(
        rows.writeStream.outputMode("append").foreachBatch(broken), feed.progress, True)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    feed.run()
    assert [r[0] for r in feed.rows()] == ["15min", "30min", "5min"]


def test_raw_ingest_resumes_without_duplicates(feed):
    put(feed.inbox, "1.json", ("A", "09:01:00", 1.0), ("B", "09:02:00", 2.345))
    feed.run(runner.start_raw_ingest)
    feed.run(runner.start_raw_ingest)
    put(feed.inbox, "2.json", ("C", "09:03:00", 3.0), ("LONGER-THAN-TEN", "09:03:00", 3.0))
    (feed.inbox / "3.json").write_text("{broken\n")
    feed.run(runner.start_raw_ingest)
    stored = sinks.stored_rows(feed.spark, feed.out, RAW_TICKS)
    rows = as_dicts(stored, "symbol")
    assert [(r["symbol"], str(r["price"])) for r in rows] == [
        ("A", "1.00"), ("B", "2.35"), ("C", "3.00")]
    assert all(r["processed_timestamp"] is not None and r["id"] is not None for r in rows)
    rejects = sinks.rejected_rows(feed.spark, feed.out, RAW_TICKS).collect()
    assert len(rejects) == 2
    assert any("{broken" in r["rejected_row"] for r in rejects)


def test_sql_over_the_stream_view(spark, feed):
    put(feed.inbox, "1.json", ("A", "09:01:00", 1.0), ("A", "09:30:00", 1.0))
    ticks = decode_ticks(file_messages(spark, str(feed.inbox), "*.json"))
    marked = runner.register_stream(ticks, "tick_stream")
    counts = spark.sql(
        "select symbol, window(timestamp, '5 minutes') as slot, count(*) as n from tick_stream "
        "group by symbol, window(timestamp, '5 minutes')")
    query = (counts.writeStream.outputMode("append").format("memory").queryName("slots")
             .option("checkpointLocation", feed.progress).trigger(availableNow=True).start())
    query.awaitTermination()
    assert marked.isStreaming
    assert [r["n"] for r in spark.table("slots").collect()] == [1]


@pytest.mark.parametrize("one_day", [False, True])
def test_late_ticks_are_written_by_many_tasks(spark, tmp_path, monkeypatch, one_day):
    from tickloom.catalog import registry

    folder, made, scratch = str(tmp_path / "in"), {}, registry.scratch_dir
    monkeypatch.setattr(registry, "scratch_dir", lambda s, name: made.setdefault(name, scratch(s, name)))
    events = ev.events(spark, SMALL)
    if one_day:
        day = ev.wire_ticks(events).select(F.to_date("timestamp").alias("d")).agg(F.min("d")).first()[0]
        events = events.filter(F.to_date("ts") == day)
    events.repartition(8).write.parquet(f"{folder}/events.parquet")
    late = registry.queries()["stream_late_ticks"](spark, folder)
    plain = registry.queries()["stream_moving_averages"](spark, folder)
    assert as_dicts(late, *late.columns) == as_dicts(plain, *plain.columns)
    assert one_day or late.count()
    files = spark.read.text(made["late-messages"]).select(F.input_file_name()).distinct().count()
    assert files > 3


def test_no_task_reads_all_that_is_kept_for_a_few_rows(spark, tmp_path):
    from pyspark import TaskContext

    seen = tmp_path / "seen"
    seen.mkdir()

    @F.udf("boolean")
    def read(name):
        task = TaskContext.get()
        with open(f"{seen}/{task.stageId()}-{task.partitionId()}", "a") as file:
            file.write("x")
        return name == "S0"

    at = F.timestamp_seconds(F.lit(1704099600) + F.col("id") * 900)
    rows = spark.range(0, 400, 1, 8).select(
        F.concat(F.lit("S"), (F.col("id") % 40).cast("string")).alias("sector"), F.lit(1.0).alias("avg_price"), F.lit(2).alias("total_volume"),
        F.lit(None).cast("double").alias("avg_change_percent"), at.alias("window_end_time")).persist()
    rows.count()
    try:
        few = rows.where(read.asNondeterministic()("sector"))
        sinks.batch_writer(str(tmp_path / "out"), SECTOR_PERFORMANCE, small=True, keep=False, run="q")(few, 0)
    finally:
        rows.unpersist()
    stored = sinks.stored_rows(spark, str(tmp_path / "out"), SECTOR_PERFORMANCE)
    assert stored.count() == 10 and len(stored.inputFiles()) == 1
    assert max(file.stat().st_size for file in seen.iterdir()) == 50


def test_messages_are_encoded_only_where_they_are_sent(spark, tmp_path, monkeypatch):
    from tickloom.catalog import registry

    sent, encode = [], registry.encode_ticks
    monkeypatch.setattr(registry, "encode_ticks", lambda ticks: (sent.append(ticks.count()), encode(ticks))[1])
    streams = list(registry._late_streams(spark, SMALL))
    ticks = ev.wire_ticks(ev.events(spark, SMALL)).groupBy(F.to_date("timestamp").alias("d")).count().orderBy("d").collect()
    middle, counts = len(ticks) // 2, [r["count"] for r in ticks]
    assert len(streams) == 3 and sent == [sum(counts[:middle]), sum(counts[middle:]), counts[0]]


def test_the_rules_that_a_row_breaks_are_counted(spark):
    from tickloom.operators.quality import apply_contract, broken_rules

    rows = spark.createDataFrame([("S", 1.0, 1, None, 0), (None, 1e12, 1, None, 0), ("S" * 60, None, 1, None, 0)], (
        "sector string, avg_price double, total_volume long, avg_change_percent double, at long")).withColumn("window_end_time", F.timestamp_seconds("at")).drop("at")
    found = broken_rules(SECTOR_PERFORMANCE)
    got = apply_contract(rows, SECTOR_PERFORMANCE).agg(*[F.count_if(c).alias(rule) for rule, c in found.items()]).first().asDict()
    assert {rule: n for rule, n in got.items() if n} == {
        "sector is null": 1, "sector longer than 50": 1, "avg_price is null": 1, "avg_price out of range": 1}
