from __future__ import annotations

import pytest

from tests.conftest import as_dicts, plan_of
from tickloom.operators.repeat import repeat_rows
from tickloom.operators.rollup import daily_rollup
from tickloom.plans import daily, monitor


def test_one_tick_day(ticks):
    row, = as_dicts(daily.stock_metrics(ticks([("A", "2024-01-01 10:00:00", 12.5, 7)])), "symbol")
    assert row["avg_price"] == row["open_price"] == row["close_price"] == 12.5
    assert row["daily_volume"] == 7
    assert row["daily_volatility"] == 0.0
    assert row["daily_return"] == 0.0


def test_figures_by_hand(ticks):
    rows = ticks([
        ("A", "2024-01-01 15:00:00", 12, 5),
        ("A", "2024-01-01 09:00:00", 10, 1),
        ("A", "2024-01-01 12:00:00", 8, 2),
        ("A", "2024-01-02 00:00:00", 20, 4),
    ])
    first, second = as_dicts(daily.stock_metrics(rows), "trade_date")
    assert (first["open_price"], first["close_price"]) == (10, 12)
    assert (first["high_price"], first["low_price"], first["avg_price"]) == (12, 8, 10)
    assert first["daily_volume"] == 8
    assert first["daily_volatility"] == pytest.approx(40)
    assert first["daily_return"] == pytest.approx(20)
    assert str(second["trade_date"]) == "2024-01-02"


def test_open_price_zero_gives_null_return(ticks):
    rows = ticks([("A", "2024-01-01 09:00:00", 0), ("A", "2024-01-01 10:00:00", 5)])
    row, = as_dicts(daily.stock_metrics(rows), "symbol")
    assert row["daily_return"] is None
    assert row["daily_volatility"] == pytest.approx(200)


def test_mid_price_zero_gives_null_volatility(ticks):
    rows = ticks([("A", "2024-01-01 09:00:00", 0), ("A", "2024-01-01 10:00:00", 0)])
    row, = as_dicts(daily.stock_metrics(rows), "symbol")
    assert row["daily_volatility"] is None


def test_ticks_at_one_time_are_ordered_by_id(ticks):
    at = "2024-01-01 09:00:00"
    rows = [("A", at, 3, 1, 0, "S", 30), ("A", at, 1, 1, 0, "S", 10), ("A", at, 2, 1, 0, "S", 20)]
    for order in (rows, rows[::-1]):
        row, = as_dicts(daily.open_close(ticks(order)), "symbol")
        assert (row["open_price"], row["close_price"]) == (1, 3)


def test_order_key_holds_largest_ids_and_early_times(ticks):
    top = 2**63 - 1
    rows = ticks([
        ("A", "1969-12-31 23:59:58", 1, 1, 0, "S", top),
        ("A", "1969-12-31 23:59:59", 2, 1, 0, "S", 0),
    ])
    row, = as_dicts(daily.open_close(rows), "symbol")
    assert (row["open_price"], row["close_price"]) == (1, 2)


def test_order_key_keeps_neighbouring_microseconds_apart(ticks):
    """Stored ids are hashes, so they take any sign."""
    rows = ticks([
        ("A", "2024-01-01 09:00:00.000001", 1, 1, 0, "S", 2**63 - 1),
        ("A", "2024-01-01 09:00:00.000002", 2, 1, 0, "S", -(2**63)),
    ])
    row, = as_dicts(daily.open_close(rows), "symbol")
    assert (row["open_price"], row["close_price"]) == (1, 2)


def test_volume_counted_per_tick_may_exceed_a_long(spark):
    import datetime

    days = spark.createDataFrame(
        [("A", datetime.date(2024, 1, 1), 3 * 10**14, 3 * 10**11)],
        "symbol string, trade_date date, daily_volume long, tick_count long")
    row, = monitor.data_volume(days, per_tick=True).collect()
    assert int(row["total_trade_volume"]) == 9 * 10**25


def test_symbol_filter_reaches_the_scan(spark, ticks, tmp_path):
    from tickloom.plans import price

    ticks([("A", "2024-01-01 09:00:00", 1), ("B", "2024-01-01 09:00:00", 1)]).write.parquet(
        f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    result = price.price_analytics(daily.stock_metrics(stored)).where("symbol = 'A'")
    plan = plan_of(result)
    assert "EqualTo(symbol,A)" in plan
    assert "sector" not in plan.split("ReadSchema")[1]
    assert result.count() == 1


def test_rollup_gives_the_same_days(ticks):
    rows = ticks([
        ("A", f"2024-01-0{1 + i % 3} {8 + i:02d}:00:00", 10 + i * 1.37, i, i / 7, f"S{i % 2}")
        for i in range(12)
    ] + [("B", "2024-01-01 10:00:00", None, 3, None, None)])
    direct = as_dicts(daily.symbol_days(rows), "symbol", "trade_date")
    rolled = as_dicts(daily.symbol_days(daily_rollup(rows)), "symbol", "trade_date")
    assert direct == rolled
    assert direct[-1]["avg_price"] is None


def test_average_does_not_depend_on_partitions(spark, ticks):
    rows = ticks([("A", f"2024-01-01 09:{i // 60:02d}:{i % 60:02d}", f"{i * 0.07 + 0.1:.2f}")
                  for i in range(600)])
    averages = {
        daily.daily_metrics(rows.repartition(n, "id")).first()["avg_price"] for n in (1, 3, 7, 16)
    }
    assert len(averages) == 1


def test_rows_without_symbol_leave_the_metrics_table(ticks):
    rows = ticks([(None, "2024-01-01 09:00:00", 1), ("A", "2024-01-01 09:00:00", 1)])
    assert daily.daily_metrics(rows).count() == 2
    assert daily.stock_metrics(rows).count() == 1
    assert daily.stock_metrics(rows, per_tick=True).count() == 1


def test_per_tick_repeats_each_day_by_its_ticks(ticks):
    rows = ticks([("A", f"2024-01-01 09:00:0{i}", i) for i in range(4)]
                 + [("A", "2024-01-02 09:00:00", 9)])
    counts = daily.stock_metrics(rows, per_tick=True).groupBy("trade_date").count()
    assert [r["count"] for r in as_dicts(counts, "trade_date")] == [4, 1]


@pytest.mark.parametrize("block", [1, 3, 10, 1000])
def test_repeat_rows_in_blocks(spark, block):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 0), ("d", None)], "k string, n long")
    counts = {r["k"]: r["count"] for r in repeat_rows(df, "n", block).groupBy("k").count().collect()}
    assert counts == {"a": 10, "b": 1}


def test_data_volume_both_ways(ticks):
    rows = ticks([("A", "2024-01-01 09:00:00", 1, 10), ("A", "2024-01-01 10:00:00", 1, 20),
                  ("B", "2024-01-01 09:00:00", 1, 5)])
    days = daily.counted_metrics(rows)
    per_day, = as_dicts(monitor.data_volume(days), "analysis_date")
    per_tick, = as_dicts(monitor.data_volume(days, per_tick=True), "analysis_date")
    assert (per_day["total_records"], per_day["total_symbols"]) == (2, 2)
    assert per_day["total_trade_volume"] == 35
    assert (per_tick["total_records"], per_tick["total_symbols"]) == (3, 2)
    assert per_tick["total_trade_volume"] == 65


def test_date_filter_reaches_the_scan(ticks, spark, tmp_path):
    ticks([("A", "2024-01-01 09:00:00", 1), ("A", "2024-01-02 09:00:00", 1)]).write.parquet(
        f"{tmp_path}/t")
    result = daily.stock_metrics(spark.read.parquet(f"{tmp_path}/t"))
    late = result.where("trade_date >= date'2024-01-02'")
    assert "GreaterThanOrEqual(timestamp,2024-01-02" in plan_of(late)
    assert late.count() == 1


def test_daily_plan_is_one_hash_aggregate_over_one_scan(spark):
    from tests.conftest import SMALL
    from tickloom.catalog import registry

    plan = plan_of(daily.stock_metrics(registry._ticks(spark, SMALL)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "SortAggregate" not in plan
    assert "event_type" not in plan
