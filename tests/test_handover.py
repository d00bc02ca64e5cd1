"""A window query with other state partitions takes over from one that was stopped."""

from __future__ import annotations

import datetime
import json

import pytest

from tests.test_streaming import put
from tickloom.schemas import MOVING_AVERAGES, SECTOR_PERFORMANCE
from tickloom.sources.messages import decode_ticks, file_messages
from tickloom.streaming import handover, runner, sinks


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.inbox, self.folder = spark, folder / "in", folder

    def path(self, name):
        return str(self.folder / name)

    def run(self, start, *paths, **settings):
        ticks = decode_ticks(file_messages(self.spark, str(self.inbox), "*.json"))
        queries = start(ticks, *map(self.path, paths), available_now=True, **settings)
        for query in queries if isinstance(queries, list) else [queries]:
            query.awaitTermination()
            sizes = {s["numShufflePartitions"] for s in query.lastProgress["stateOperators"]}
            assert sizes <= {settings["state_partitions"]}  # none where there was nothing new

    def averages(self, name):
        rows = sinks.stored_rows(self.spark, self.path(name), MOVING_AVERAGES)
        return sorted((r.window_size, r.symbol, float(r.avg_price), str(r.window_end_time)) for r in rows.collect())

    def sectors(self, name):
        rows = sinks.stored_rows(self.spark, self.path(name), SECTOR_PERFORMANCE)
        return sorted((r.sector, float(r.avg_price), r.total_volume, str(r.window_end_time)) for r in rows.collect())


FIRST = [("A", "09:01:00", 1.0), ("A", "09:04:00", 2.0), ("B", "09:12:00", 7.0), ("A", "09:17:00", 3.0), ("A", None, 5.0)]
# Late for the 5 and 15 minutes that have ended, in time for the 30 minutes.
SECOND = [("A", "09:03:00", 9.0), ("B", "09:18:00", 4.0), ("C", "09:20:00", 8.0), ("A", "11:00:00", 1.0)]


@pytest.fixture
def feed(spark, tmp_path):
    out = Feed(spark, tmp_path)
    put(out.inbox, "1.json", *FIRST)
    return out


def test_moved_averages_are_those_of_a_query_that_never_moved(spark, feed):
    feed.run(runner.start_moving_averages, "moved", "old", state_partitions=3)
    feed.run(runner.start_moving_averages, "stayed", "other", state_partitions=3)
    after = handover.last_watermark(spark, feed.path("old"))
    assert after == datetime.datetime(2024, 1, 1, 9, 16, tzinfo=datetime.UTC)
    before = feed.averages("moved")
    assert before and before == feed.averages("stayed")
    put(feed.inbox, "2.json", *SECOND)
    for _ in range(2):  # a restart changes nothing
        feed.run(runner.start_moving_averages, "moved", "new", state_partitions=7, after=after)
    feed.run(runner.start_moving_averages, "stayed", "other", state_partitions=3)
    got = feed.averages("moved")
    assert got == feed.averages("stayed") and len(got) == len(set(got)) > len(before)
    assert ("30min", "A", 3.75, "2024-01-01 09:17:00") in got  # with ticks from before and after the move


def test_moved_aggregates_are_those_of_queries_that_never_moved(spark, feed):
    feed.run(runner.start_aggregates, "a", "s", "old", state_partitions=3)
    feed.run(runner.start_sector_performance, "only", "old-sectors", state_partitions=3)
    feed.run(runner.start_aggregates, "a0", "s0", "other", state_partitions=3)
    after, sectors_after = (handover.last_watermark(spark, feed.path(p)) for p in ("old", "old-sectors"))
    put(feed.inbox, "2.json", *SECOND)
    feed.run(runner.start_aggregates, "a", "s", "new", state_partitions=7, after=after)
    feed.run(runner.start_sector_performance, "only", "new-sectors", state_partitions=7, after=sectors_after)
    feed.run(runner.start_aggregates, "a0", "s0", "other", state_partitions=3)
    assert feed.averages("a") == feed.averages("a0")
    assert feed.sectors("s") == feed.sectors("s0") == feed.sectors("only")
    assert len(feed.sectors("s")) == 2


def test_state_tells_the_open_windows_and_where_to_read_from(spark, feed):
    feed.run(runner.start_moving_averages, "out", "old", state_partitions=3)
    held = handover.open_windows(spark, feed.path("old")).collect()
    assert sorted((r["name"], r["window_size"]) for r in held) == [
        ("A", "15min"), ("A", "30min"), ("A", "5min"), ("B", "30min")]
    load = {r.partition_id: r.n_windows for r in handover.state_load(spark, feed.path("old")).collect()}
    assert sorted(load) == [0, 1, 2] and sum(load.values()) == len(held)
    for partition, n in load.items():
        assert sum(r["partition_id"] == partition for r in held) == n
    since = handover.replay_from(spark, feed.path("old"), 30)
    assert since == datetime.datetime(2024, 1, 1, 8, 46, tzinfo=datetime.UTC)


def logged(folder, name, batch, **values):
    (folder / name).mkdir(parents=True, exist_ok=True)
    (folder / name / str(batch)).write_text("v1\n" + json.dumps(values) + ('\n{"logOffset":0}' if name == "offsets" else ""))


def test_a_batch_that_has_not_ended_must_be_ended_first(spark, tmp_path):
    logged(tmp_path, "offsets", 9, batchWatermarkMs=1_000)
    logged(tmp_path, "offsets", 10, batchWatermarkMs=61_000)
    logged(tmp_path, "commits", 9, nextBatchWatermarkMs=61_000)
    with pytest.raises(ValueError, match="batch 10"):
        handover.last_watermark(spark, str(tmp_path))
    logged(tmp_path, "commits", 10, nextBatchWatermarkMs=61_000)
    assert handover.last_watermark(spark, str(tmp_path)) == datetime.datetime(1970, 1, 1, 0, 1, 1, tzinfo=datetime.UTC)


def test_a_query_without_a_watermark_has_released_nothing(spark, tmp_path):
    logged(tmp_path, "offsets", 0, batchWatermarkMs=0)
    logged(tmp_path, "commits", 0, nextBatchWatermarkMs=0)
    assert handover.last_watermark(spark, str(tmp_path)) is None
    assert handover.replay_from(spark, str(tmp_path), 30) is None


def test_the_moved_query_takes_its_messages_load_by_load(spark, tmp_path, monkeypatch):
    from tests.conftest import SMALL
    from tickloom.catalog import registry

    made, scratch, sent, send = {}, registry.scratch_dir, [], registry._sent
    monkeypatch.setattr(registry, "scratch_dir", lambda s, name: made.setdefault(name, scratch(s, name)))
    monkeypatch.setattr(registry, "_sent", lambda ticks, messages: (sent.append(ticks.count()), send(ticks, messages))[1])
    monkeypatch.setattr(registry, "ROWS_PER_STATE", 60)
    moved = registry.queries()["stream_moved_state"](spark, SMALL)
    plain = registry.queries()["stream_moving_averages"](spark, SMALL)
    assert sorted(moved.collect()) == sorted(plain.collect()) and moved.count()
    ticks = registry.ev.wire_ticks(registry.ev.events(spark, SMALL)).count()
    assert len(sent) >= 5 and sum(sent) == ticks and max(sent[:3]) <= 3 * 60 and max(sent) <= 7 * 60
    batches = spark.read.text(f"{made['moved-old']}/commits").selectExpr("_metadata.file_name").distinct().count()
    assert batches > 2  # each load is a micro-batch
