"""Models on many random small cases, each a symbol of its own, against row-by-row Python."""

from __future__ import annotations

import datetime
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from tickloom.operators import windows
from tickloom.operators.rollup import daily_rollup
from tickloom.plans import daily, price, sector

START = datetime.datetime(2024, 1, 1)
SCHEMA = ("id long, symbol string, price decimal(10,2), volume long, change_percent decimal(10,2), "
          "timestamp timestamp, sector string")


def random_ticks(seed, symbols, days, most_per_day):
    """Few distinct times and prices, so that ties, zeros and flat days are common."""
    rng = random.Random(seed)
    rows = []
    for s in range(symbols):
        prices = [Decimal(rng.choice([0, 1, 5, 9, 10, 333, 9999])) / 100 * rng.choice([1, 7])
                  for _ in range(rng.randint(1, 4))]
        for d in range(days):
            for _ in range(rng.choice([0, 1, 1, 2, rng.randint(1, most_per_day)])):
                at = START + datetime.timedelta(days=d, seconds=rng.choice([0, 1, 60, 86399]),
                                                microseconds=rng.choice([0, 1, 999999]))
                rows.append((rng.getrandbits(63) - 2**62, f"S{s}", rng.choice(prices),
                             rng.randint(0, 1000), Decimal(rng.randint(-500, 500)) / 100, at,
                             f"X{rng.choice([s % 3, s % 3, s % 3, 2])}"))
    rng.shuffle(rows)
    return rows


def by_day(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1], r[5].date()].append(r)
    return groups


def percent(new, old):
    return None if old == 0 else (new - old) / old * 100


def brute_days(rows):
    result = {}
    for key, ticks in by_day(rows).items():
        ticks = sorted(ticks, key=lambda r: (r[5], r[0]))
        values = [float(r[2]) for r in ticks]
        high, low = max(values), min(values)
        middle = (high + low) / 2
        result[key] = {
            "avg_price": float(sum(r[2] for r in ticks) / len(ticks)),
            "high_price": high, "low_price": low,
            "open_price": values[0], "close_price": values[-1],
            "daily_volume": sum(r[3] for r in ticks),
            "daily_volatility": None if middle == 0 else (high - low) / middle * 100,
            "daily_return": percent(values[-1], values[0]),
            "tick_count": len(ticks),
        }
    return result


def close(value):
    return value if value is None else pytest.approx(value, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("from_rollup", [False, True])
def test_daily_metrics(spark, from_rollup):
    rows = random_ticks(1, symbols=60, days=6, most_per_day=9)
    ticks = spark.createDataFrame(rows, SCHEMA).repartition(5)
    source = daily_rollup(ticks) if from_rollup else ticks
    got = {(r["symbol"], r["trade_date"]): r.asDict() for r in daily.symbol_days(source).collect()}
    expected = brute_days(rows)
    assert got.keys() == expected.keys()
    for key, figures in expected.items():
        for column, value in figures.items():
            assert got[key][column] == close(value), (key, column)


def test_price_analytics(spark):
    rows = random_ticks(2, symbols=25, days=28, most_per_day=4)
    ticks = spark.createDataFrame(rows, SCHEMA)
    got = defaultdict(list)
    result = price.price_analytics(daily.stock_metrics(ticks))
    for r in result.orderBy("symbol", "trade_date").collect():
        got[r["symbol"]].append(r)
    history = defaultdict(list)
    for (symbol, day), figures in sorted(brute_days(rows).items()):
        history[symbol].append((day, figures))
    assert got.keys() == history.keys()
    for symbol, days in history.items():
        averages = [f["avg_price"] for _, f in days]
        closes = [f["close_price"] for _, f in days]
        for i, row in enumerate(got[symbol]):
            assert row["trade_date"] == days[i][0]
            means = {n: statistics.fmean(averages[max(0, i - n + 1):i + 1]) for n in (5, 10, 20)}
            for n, mean in means.items():
                assert row[f"ma_{n}_day"] == close(mean)
            momentum = percent(closes[i], closes[i - 5]) if i >= 5 else None
            assert row["momentum_5_day"] == close(momentum)
            gap = means[5] - means[20]
            signal = "Neutral" if abs(gap) < 1e-9 else "Bullish" if gap > 0 else "Bearish"
            assert row["trend_signal"] == signal


def test_price_analytics_per_tick(spark):
    """The literal join: every repeat of a day with every repeat of its averages and momenta."""
    rows = random_ticks(3, symbols=20, days=8, most_per_day=24)
    metrics = daily.counted_metrics(spark.createDataFrame(rows, SCHEMA))
    expected = Counter()
    repeated = defaultdict(list)
    for (symbol, day), figures in sorted(brute_days(rows).items()):
        repeated[symbol] += [(day, figures)] * figures["tick_count"]
    for symbol, sequence in repeated.items():
        moving, lagged, size = defaultdict(list), defaultdict(list), Counter()
        for i, (day, figures) in enumerate(sequence):
            size[day] += 1
            moving[day].append(tuple(
                round(statistics.fmean([f["avg_price"] for _, f in sequence[max(0, i - n + 1):i + 1]]), 5)
                for n in (5, 10, 20)))
            old = sequence[i - 5][1]["close_price"] if i >= 5 else 0
            change = percent(figures["close_price"], old)
            lagged[day].append(None if change is None else round(change, 5) + 0.0)
        for day, n in size.items():
            for means, many in Counter(moving[day]).items():
                for change, times in Counter(lagged[day]).items():
                    expected[symbol, day, *means, change] += n * many * times
    got = Counter()
    for r in price.price_analytics_per_tick(metrics).collect():
        change = r["momentum_5_day"]
        means = (round(r[f"ma_{n}_day"], 5) for n in (5, 10, 20))
        key = (r["symbol"], r["trade_date"], *means, None if change is None else round(change, 5) + 0.0)
        got[key] += int(r["copies"])
    # A value next to a rounding border may fall on either side, so compare neighbours as one.
    assert sum(got.values()) == sum(expected.values())
    off = sum((got - expected).values())
    assert off <= 0.001 * sum(expected.values())


@pytest.mark.parametrize("per_tick", [False, True])
def test_sector_volatility(spark, per_tick):
    rows = random_ticks(4, symbols=24, days=5, most_per_day=6)
    days = brute_days(rows)
    ticks_in_sector = Counter((r[1], r[6]) for r in rows)
    samples = defaultdict(list)
    for (symbol, day), figures in days.items():
        for (other, name), ticks in ticks_in_sector.items():
            if other == symbol:
                weight = figures["tick_count"] * ticks if per_tick else 1
                value = figures["daily_volatility"]
                samples[name, day] += [] if value is None else [value] * weight
    got = {(r["sector"], r["trade_date"]): r["sector_volatility"] for r in
           sector.sector_volatility(spark.createDataFrame(rows, SCHEMA), per_tick).collect()}
    assert got.keys() == samples.keys()
    for key, values in samples.items():
        expected = statistics.stdev(values) if len(values) > 1 else None
        assert got[key] == close(expected), key


def test_windows(spark):
    rows = random_ticks(5, symbols=30, days=3, most_per_day=8)
    expected = defaultdict(list)
    for r in rows:
        for label, minutes in windows.AVERAGE_WINDOWS.items():
            slot = (r[5] - START) // datetime.timedelta(minutes=minutes)
            expected[r[1], label, slot].append(r)
    expected = Counter(
        (symbol, label, max(r[5] for r in ticks), round(float(sum(r[2] for r in ticks) / len(ticks)), 5))
        for (symbol, label, _), ticks in expected.items())
    got = Counter(
        (r["symbol"], r["window_size"], r["window_end_time"], round(r["avg_price"], 5))
        for r in windows.moving_averages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == expected
