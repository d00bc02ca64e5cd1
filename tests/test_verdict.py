"""Order, size, time zone and restart must not change a result."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of
from tickloom.catalog.registry import present
from tickloom.operators import windows
from tickloom.plans import daily, sector
from tickloom.schemas import MOVING_AVERAGES, RAW_TICKS
from tickloom.sources import events as ev
from tickloom.sources.messages import decode_ticks, file_messages
from tickloom.streaming import runner, sinks


def put(folder, name, *symbols, day="2024-01-01"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({
        "symbol": s, "price": 1.5, "volume": 1, "change_percent": "1.0",
        "timestamp": f"{day}T09:00:00.000000", "sector": "S"}) + "\n" for s in symbols))
    time.sleep(0.05)


def ingest(spark, inbox, out, progress):
    ticks = decode_ticks(file_messages(spark, str(inbox), "*.json", 1))
    runner.start_raw_ingest(ticks, out, progress, available_now=True).awaitTermination()


def symbols(spark, out, **more):
    return sorted(r["symbol"] for r in sinks.stored_rows(spark, out, RAW_TICKS, **more).collect())


def test_fresh_checkpoint_at_an_old_path_keeps_older_rows(spark, tmp_path):
    inbox, out, progress = tmp_path / "in", str(tmp_path / "out"), tmp_path / "progress"
    put(inbox, "1.json", "A1", "A2", "A3")
    ingest(spark, inbox, out, str(progress))
    progress.rename(tmp_path / "lost")
    (inbox / "1.json").rename(tmp_path / "1.json")
    put(inbox, "2.json", "B1")
    ingest(spark, inbox, out, str(progress))
    assert symbols(spark, out) == ["A1", "A2", "A3", "B1"]


def test_two_spellings_of_a_checkpoint_and_a_real_restart(spark, tmp_path):
    inbox, out, progress = tmp_path / "in", str(tmp_path / "out"), tmp_path / "progress"
    put(inbox, "1.json", "A")
    ingest(spark, inbox, out, str(progress))
    newest = max((progress / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.rename(tmp_path / "commit")  # as if the driver died before the commit
    for crc in (progress / "commits").glob(f".{newest.name}.crc"):
        crc.rename(tmp_path / "crc")
    ingest(spark, inbox, out, f"file:{progress}")
    assert symbols(spark, out) == ["A"]


def test_a_day_is_read_and_compacted_alone(spark, tmp_path):
    inbox, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    for n in range(4):
        put(inbox, f"{n}.json", f"D1-{n}", "LONGER-THAN-TEN")
    put(inbox, "4.json", "D2", day="2024-01-02")
    put(inbox, "5.json", "D1-last")
    ingest(spark, inbox, out, progress)
    rows = sinks.stored_rows(spark, out, RAW_TICKS)
    filters = plan_of(rows.where("trade_date = '2024-01-01'")).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "trade_date" in filters and "2024-01-01" in filters
    first = ["D1-0", "D1-1", "D1-2", "D1-3", "D1-last"]
    assert symbols(spark, out, day="2024-01-01") == first
    before = len(sinks.stored_rows(spark, out, RAW_TICKS, day="2024-01-01").inputFiles())
    assert sinks.compact_day(spark, out, RAW_TICKS, "2024-01-01") == 8  # accepted and rejected of four batches
    assert symbols(spark, out, day="2024-01-01") == first
    assert len(sinks.stored_rows(spark, out, RAW_TICKS, day="2024-01-01").inputFiles()) < before
    assert sinks.rejected_rows(spark, out, RAW_TICKS).count() == 4
    assert sinks.compact_day(spark, out, RAW_TICKS, "2024-01-01") == 0
    put(inbox, "6.json", "D1-more")
    ingest(spark, inbox, out, progress)
    assert symbols(spark, out) == [*first[:4], "D1-last", "D1-more", "D2"]


CENTS = [39600, 26778, 56456, 3262, 56921, 34114]


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
@pytest.mark.parametrize("parts", [1, 3, 16])
def test_window_averages_do_not_hang_on_order(spark, kind, parts):
    seen = set()
    for order in (CENTS, [39600, 34114, 56456, 3262, 56921, 26778]):
        rows = spark.createDataFrame([(i, c) for i, c in enumerate(order)], "i long, c long").repartitionByRange(parts, "i")
        ticks = rows.select(
            F.lit("A").alias("symbol"), (F.col("c") / 100).cast(kind).alias("price"),
            F.timestamp_micros(F.col("i") + 1).alias("timestamp"))
        for frame in (windows.window_averages(ticks, "5min"), windows.moving_averages(ticks)):
            seen |= {r["avg_price"] for r in frame.select(F.col("avg_price").cast("decimal(10,2)")).collect()}
    assert {str(x) for x in seen} == {"361.89"}


def test_window_averages_of_numbers_too_large_for_decimals(spark):
    ticks = spark.sql("select 'A' symbol, p price, timestamp'2024-01-01' timestamp from values (1e300D), (3e300D) t(p)")
    assert windows.window_averages(ticks, "5min").first()["avg_price"] == 2e300


def test_presented_numbers_do_not_saturate(spark):
    rows = spark.sql("select x, cast(1e30 as decimal(38,0)) as copies from values "
                     "(1e13D), (double('Infinity')), (double('NaN')), (1.2345675D), (-1e10D), (cast(null as double)) t(x)")
    got = present(rows).collect()
    assert [r["copies"] for r in got] == ["1" + "0" * 30] * 6
    assert [str(r["x"]) for r in got] == ["10000000000000.0", "inf", "nan", "1.234568", "-10000000000.0", "None"]


def test_days_are_utc_in_any_zone(spark):
    keys = ["symbol", "trade_date"]
    want = daily.stock_metrics(ev.raw_ticks(ev.events(spark, SMALL))).orderBy(keys).collect()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = daily.stock_metrics(ev.raw_ticks(ev.events(spark, SMALL))).orderBy(keys).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == want


def test_centres_are_broadcast_or_salted(spark):
    source = daily.as_partials(ev.raw_ticks(ev.events(spark, SMALL)))
    members = daily.volatility_days(source).join(sector.symbol_sectors(source), "symbol")
    small, large = sector._weighted(members), sector._weighted(members, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan_of(small) and "SortMergeJoin" not in plan_of(small)
    assert "salt" in plan_of(large)
    rows = lambda f: {(r[0], r[1]): round(r[2], 9) if r[2] else r[2] for r in f.collect()}
    assert rows(small) == rows(large)


def test_state_partitions_are_set_for_one_query(spark, tmp_path):
    before = spark.conf.get(runner.PARTITIONS)
    ticks = ev.wire_ticks(ev.event_stream(spark, SMALL))
    query = runner.start_moving_averages(
        ticks, str(tmp_path / "out"), str(tmp_path / "p"), available_now=True, state_partitions=3)
    query.awaitTermination()
    assert spark.conf.get(runner.PARTITIONS) == before
    assert {s["numShufflePartitions"] for s in query.lastProgress["stateOperators"]} == {3}
    assert sinks.stored_rows(spark, str(tmp_path / "out"), MOVING_AVERAGES).count() > 0
