"""Threshold crossings in a batch and a stream."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tickloom.operators.previous import with_previous
from tickloom.operators.windows import symbol_and_sector_windows
from tickloom.plans import alerts
from tickloom.schemas import MARKET_ALERTS
from tickloom.sources.messages import decode_ticks, file_messages
from tickloom.streaming import runner, sinks

TICKS = "symbol string, price double, volume long, change_percent double, timestamp timestamp"
START = datetime.datetime(2024, 1, 1, 9)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def rules(spark, *rows):
    return spark.createDataFrame(rows or [("A", "price_above", "price", True, 10.0)], alerts.RULES)


def fired(spark, ticks, *rows):
    found = alerts.threshold_alerts(spark.createDataFrame(ticks, TICKS), rules(spark, *rows))
    return sorted((r.symbol, r.alert_type, r.value, r.triggered_at) for r in found.collect())


def brute(ticks, rows):
    key = lambda t: tuple((v is not None, v) for v in (t[4], *t[1:4]))
    out, last = [], {}
    for t in sorted((t for t in ticks if t[0] is not None and t[4] is not None), key=key):
        named = dict(zip(("price", "volume", "change_percent"), t[1:4]))
        for symbol, kind, watched, above, limit in rows:
            if symbol in (t[0], "*"):
                beyond = lambda v: v is not None and (v > limit if above else v < limit)  # noqa: E731,B023
                if beyond(named.get(watched)) and not beyond(last.get(t[0], {}).get(watched)):
                    out.append((t[0], kind, float(named[watched]), t[4]))
        last[t[0]] = named
    return sorted(out)


def test_one_alert_for_each_crossing(spark):
    prices = [9.0, 11.0, 12.0, 10.0, 10.0, 10.5, None, 11.0]
    got = fired(spark, [("A", p, 1, 0.0, at(i)) for i, p in enumerate(prices)])
    assert [(v, t) for _, _, v, t in got] == [(10.5, at(5)), (11.0, at(1)), (11.0, at(7))]


def test_a_first_tick_and_days_apart(spark):
    assert fired(spark, [("A", 11.0, 1, 0.0, at(0)), ("A", 12.0, 1, 0.0, at(3 * 1440)), ("B", 99.0, 1, 0.0, at(1))]) == [
        ("A", "price_above", 11.0, at(0))]


def test_rules_of_all_kinds_equal_brute_force(spark):
    rng = random.Random(4)
    ticks = [(rng.choice(["A", "A", "A", "B", "*", None]), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 1, 2, 3]),
              rng.choice([None, -1.0, 0.0, 1.0]), rng.choice([None, *[at(60 * rng.randint(0, 150)) for _ in range(20)]])) for _ in range(800)]
    rows = [("A", "p", "price", True, 1.5), ("B", "v", "volume", False, 2.0), ("*", "c", "change_percent", True, 0.0), ("A", "p", "price", True, 1.5),
            ("*", "none", "sector", True, 0.0), ("C", "p", "price", True, 0.0)]
    assert fired(spark, ticks, *rows) == brute(ticks, rows)
    assert fired(spark, [], *rows) == []


def test_a_rule_for_all_symbols_does_not_bring_all_ticks_to_one_task(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ticks = spark.createDataFrame([(f"S{i}", 11.0, 1, 0.0, at(i)) for i in range(400)], TICKS)
        found = alerts.threshold_alerts(ticks, rules(spark, ("*", "any", "price", True, 10.0), ("S1", "own", "price", True, 10.0)))
        by_task = {r.task: r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(by_task.values()) == 401 and max(by_task.values()) < 200


def test_the_tick_before_runs_over_days(spark):
    frame = with_previous(spark.createDataFrame([("A", 1.0, 1, 0.0, at(0))], TICKS))
    assert "hashpartitioning(symbol#" in plan_of(frame) and "day#" in plan_of(frame)


class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.inbox, self.n = spark, tmp_path / "in", 0
        self.out, self.progress, self.sent = str(tmp_path / "out"), str(tmp_path / "p"), []
        self.inbox.mkdir()

    def put(self, *ticks):
        self.n += 1
        (self.inbox / f"{self.n}.json").write_text("".join(json.dumps({
            "symbol": s, "price": p, "volume": 1, "change_percent": 0.0, "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.000000")}) + "\n" for s, p, t in ticks))
        self.sent += [(s, p, 1, 0.0, t) for s, p, t in ticks]

    def run(self, *rows):
        stream = decode_ticks(file_messages(self.spark, str(self.inbox), "*.json"))
        runner.start_alerts(stream, rules(self.spark, *rows), self.out, self.progress, available_now=True, state_partitions=2).awaitTermination()
        found = sinks.stored_rows(self.spark, self.out, MARKET_ALERTS)
        return sorted((r.symbol, r.alert_type, float(r.value), r.triggered_at) for r in found.collect())


def test_a_stream_goes_on_from_the_last_tick_after_a_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put(("A", 9.0, at(0)), ("B", 50.0, at(0)))
    assert feed.run() == []
    feed.put(("A", 11.0, at(2)), ("A", 10.5, at(1)), ("A", 9.5, at(3)), ("A", 12.0, at(4)))
    crossed = [("A", "price_above", 10.5, at(1)), ("A", "price_above", 12.0, at(4))]
    assert feed.run() == crossed
    feed.put(("A", 13.0, at(5)))
    assert feed.run() == crossed  # still beyond
    feed.put(("A", 1.0, at(2)))
    feed.put(("A", None, at(6)), ("A", 14.0, at(7)))
    assert feed.run() == sorted([*crossed, ("A", "price_above", 14.0, at(7))])  # the late tick changes nothing
    assert feed.run() == sorted([*crossed, ("A", "price_above", 14.0, at(7))])


def test_a_stream_equals_the_batch(spark, tmp_path):
    rng, feed = random.Random(9), Feed(spark, tmp_path)
    rows = [("A", "a", "price", True, 5.0), ("*", "b", "price", False, 3.0)]
    for n in range(3):
        feed.put(*[(rng.choice("AAB"), float(rng.randint(0, 9)), at(100 * n + rng.randint(0, 99))) for _ in range(60)])
        got = feed.run(*rows)
    assert got == brute(feed.sent, rows)


def test_both_aggregates_read_their_source_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ticks = decode_ticks(file_messages(spark, str(tmp_path / "in"), "*.json"))
    plan = symbol_and_sector_windows(runner.with_watermark(ticks))._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and plan.count("from_json") == 1 and plan.count("Aggregate [") == 1
    with pytest.raises(AssertionError):
        assert plan.count("Union") > 0
