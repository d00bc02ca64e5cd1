"""The queries as plain SQL for an independent engine.

Written from the definitions, not from the Spark plans: per-tick results come from the literal
joins and frames over repeated rows, which the library replaces by counts.
"""

from __future__ import annotations

from tickloom.operators.quality import rules
from tickloom.schemas import RAW_TICKS

BASE = """
WITH ticks AS (
    SELECT event_id AS id,
           'U' || user_id AS symbol,
           round(value, 2) AS price,
           CAST(round(value * 100) AS BIGINT) AS cents,
           CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS volume,
           (CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 10.0 AS change_percent,
           CAST(json_extract_string(props, '$.k') AS BIGINT) - 50 AS change_tenths,
           ts AS tick_time,
           CAST(ts AS DATE) AS trade_date,
           'SEC' || (user_id % 5) AS sector,
           event_type AS kind
    FROM events
),
daily AS (
    SELECT symbol, trade_date, sum(cents) / (count(*) * 100.0) AS avg_price,
           max(price) AS high_price,
           min(price) AS low_price, CAST(sum(volume) AS BIGINT) AS daily_volume
    FROM ticks GROUP BY symbol, trade_date
),
edges AS (
    SELECT id, symbol, trade_date,
           first_value(price) OVER (PARTITION BY symbol, trade_date ORDER BY tick_time, id)
               AS open_price,
           last_value(price) OVER (PARTITION BY symbol, trade_date ORDER BY tick_time, id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS close_price
    FROM ticks
),
per_tick AS (
    SELECT e.id, symbol, trade_date, avg_price, high_price, low_price, open_price, close_price,
           daily_volume,
           (high_price - low_price) / NULLIF((high_price + low_price) / 2, 0) * 100
               AS daily_volatility,
           (close_price - open_price) / NULLIF(open_price, 0) * 100 AS daily_return
    FROM daily JOIN edges e USING (symbol, trade_date)
),
metrics AS (SELECT DISTINCT * EXCLUDE (id) FROM per_tick),
analytics AS (
    SELECT *,
           avg(avg_price) OVER (days ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5_day,
           avg(avg_price) OVER (days ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ma_10_day,
           avg(avg_price) OVER (days ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20_day,
           (close_price - lag(close_price, 5) OVER days)
               / NULLIF(lag(close_price, 5) OVER days, 0) * 100 AS momentum_5_day
    FROM metrics WINDOW days AS (PARTITION BY symbol ORDER BY trade_date)
),
sector_days AS (
    SELECT sector, trade_date, sum(cents) / (count(*) * 100.0) AS sector_avg_price,
           CAST(sum(volume) AS BIGINT) AS sector_volume,
           sum(change_tenths) / (count(*) * 10.0) AS sector_avg_change
    FROM ticks GROUP BY sector, trade_date
),
members AS (SELECT DISTINCT symbol, sector FROM ticks),
volatility AS (
    SELECT sector, trade_date, stddev_samp(daily_volatility) AS sector_volatility
    FROM metrics JOIN members USING (symbol) GROUP BY sector, trade_date
),
volatility_per_tick AS (
    SELECT t.sector, p.trade_date, stddev_samp(p.daily_volatility) AS sector_volatility
    FROM per_tick p JOIN ticks t ON p.symbol = t.symbol GROUP BY t.sector, p.trade_date
),
sizes(window_size, width) AS (
    VALUES ('5min', INTERVAL 5 MINUTE), ('15min', INTERVAL 15 MINUTE), ('30min', INTERVAL 30 MINUTE)
),
windows AS (
    SELECT symbol, window_size, time_bucket(width, tick_time) + width AS window_close,
           sum(cents) / (count(*) * 100.0) AS avg_price, max(tick_time) AS window_end_time
    FROM ticks, sizes GROUP BY symbol, window_size, width, time_bucket(width, tick_time)
),
sector_windows AS (
    SELECT sector, time_bucket(INTERVAL 15 MINUTE, tick_time) + INTERVAL 15 MINUTE AS window_close,
           sum(cents) / (count(*) * 100.0) AS avg_price, CAST(sum(volume) AS BIGINT) AS total_volume,
           sum(change_tenths) / (count(*) * 10.0) AS avg_change_percent, max(tick_time) AS window_end_time
    FROM ticks GROUP BY sector, time_bucket(INTERVAL 15 MINUTE, tick_time)
),
released AS (SELECT max(tick_time) - INTERVAL 1 MINUTE AS until FROM ticks),
averages AS (
    SELECT symbol, window_size, window_end_time,
           CAST(CAST(CAST(avg_price AS VARCHAR) AS DECIMAL(10, 2)) AS DOUBLE) AS avg_price,
           window_close + INTERVAL 60 SECOND AS processed_timestamp
    FROM windows
),
encoded AS (
    SELECT *, '{"symbol":"' || symbol || '","price":' || price || ',"volume":' || volume
        || ',"change_percent":' || CAST(change_percent AS DOUBLE)
        || ',"timestamp":"' || strftime(tick_time, '%Y-%m-%dT%H:%M:%S.%f')
        || '","sector":"' || sector || '"}' AS message
    FROM ticks
),
dirty AS (
    SELECT CASE WHEN kind = 'signup' THEN 'NEWSYMBOL-' || symbol ELSE symbol END AS symbol,
           CASE WHEN kind = 'purchase' THEN price * 1e7 ELSE price END AS price,
           CASE WHEN kind <> 'error' THEN volume END AS volume,
           change_percent, tick_time,
           CASE WHEN kind <> 'click' THEN sector END AS sector
    FROM ticks
),
highest AS (
    SELECT symbol, max(price) AS high FROM ticks GROUP BY symbol
),
judged AS (
    SELECT *, concat_ws('; ',
        CASE WHEN length(symbol) > 10 THEN 'symbol longer than 10' END,
        CASE WHEN round(price, 2) >= 1e8 THEN 'price out of range' END,
        CASE WHEN volume IS NULL THEN 'volume is null' END) AS reject_reason
    FROM dirty
)
"""

METRIC_COLUMNS = (
    "avg_price", "high_price", "low_price", "open_price", "close_price",
    "daily_volatility", "daily_return",
)


def _six(*columns: str) -> str:
    """Columns at six places, half up, by way of nine so that noise in the last bits of a double
    does not decide a tie."""
    return ", ".join(
        f"CAST(CAST(CAST(CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 9))"
        f" AS DECIMAL(38, 6)) AS DOUBLE) AS {c}"
        for c in columns
    )


def _iso(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


KEYS = "symbol, CAST(trade_date AS VARCHAR) AS trade_date"
SECTOR_KEYS = "sector, CAST(trade_date AS VARCHAR) AS trade_date"
TREND = """CASE WHEN ma_5_day > ma_20_day THEN 'Bullish'
    WHEN ma_5_day < ma_20_day THEN 'Bearish' ELSE 'Neutral' END AS trend_signal"""
# Averages of equal prices over repeated rows differ in the last bits, so the difference is rounded.
TREND_PER_TICK = """CASE WHEN round(ma_5_day - ma_20_day, 9) > 0 THEN 'Bullish'
    WHEN round(ma_5_day - ma_20_day, 9) < 0 THEN 'Bearish' ELSE 'Neutral' END AS trend_signal"""


def _metrics(table: str) -> str:
    return f"SELECT {KEYS}, {_six(*METRIC_COLUMNS)}, daily_volume FROM {table}"


def _windows(label: str) -> str:
    return (
        f"SELECT symbol, window_size, {_six('avg_price')}, "
        f"{_iso('window_end_time', 'window_end_time')} FROM windows WHERE window_size = '{label}'"
    )


def _sector_analysis(volatility: str) -> str:
    return f"""
SELECT {SECTOR_KEYS}, {_six('sector_avg_price', 'sector_avg_change', 'sector_volatility')},
       sector_volume, performance_rank
FROM (
    SELECT d.*, v.sector_volatility,
           rank() OVER (PARTITION BY d.trade_date ORDER BY d.sector_avg_change DESC NULLS FIRST)
               AS performance_rank
    FROM sector_days d LEFT JOIN {volatility} v
        ON d.sector = v.sector AND d.trade_date = v.trade_date
)"""


PRICE_ANALYTICS = f"""
SELECT {KEYS}, {_six(*METRIC_COLUMNS, 'ma_5_day', 'ma_10_day', 'ma_20_day', 'momentum_5_day')},
       daily_volume, {TREND}
FROM analytics"""

PRICE_ANALYTICS_PER_TICK = f"""
, moving AS (
    SELECT symbol, trade_date,
           avg(avg_price) OVER (days ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5_day,
           avg(avg_price) OVER (days ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ma_10_day,
           avg(avg_price) OVER (days ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20_day
    FROM per_tick WINDOW days AS (PARTITION BY symbol ORDER BY trade_date)
),
lagged AS (
    SELECT symbol, trade_date,
           (close_price - lag(close_price, 5) OVER days)
               / NULLIF(lag(close_price, 5) OVER days, 0) * 100 AS momentum_5_day
    FROM per_tick WINDOW days AS (PARTITION BY symbol ORDER BY trade_date)
),
joined AS (
    SELECT {KEYS}, {_six(*METRIC_COLUMNS, 'ma_5_day', 'ma_10_day', 'ma_20_day', 'momentum_5_day')},
           daily_volume, {TREND_PER_TICK}
    FROM per_tick JOIN moving USING (symbol, trade_date)
        LEFT JOIN lagged USING (symbol, trade_date)
)
SELECT *, CAST(count(*) AS VARCHAR) AS copies FROM joined GROUP BY ALL"""

STREAM_VS_BATCH = f"""
SELECT symbol, CAST(analysis_date AS VARCHAR) AS analysis_date,
       {_six('streaming_avg_price', 'batch_avg_price', 'price_difference', 'percentage_difference')}
FROM (
    SELECT a.symbol, m.trade_date AS analysis_date, a.avg_price AS streaming_avg_price,
           m.avg_price AS batch_avg_price, a.avg_price - m.avg_price AS price_difference,
           (a.avg_price - m.avg_price) / NULLIF(m.avg_price, 0) * 100 AS percentage_difference
    FROM averages a JOIN metrics m
        ON a.symbol = m.symbol AND CAST(a.window_end_time AS DATE) = m.trade_date
    WHERE a.window_size = '30min'
)
ORDER BY percentage_difference DESC"""

STREAM_STATS = f"""
SELECT CAST(analysis_date AS VARCHAR) AS analysis_date, total_records,
       {_six('avg_processing_delay_seconds')}
FROM (
    SELECT CAST(window_end_time AS DATE) AS analysis_date, count(*) AS total_records,
           avg(epoch_us(processed_timestamp) / 1e6 - epoch_us(window_end_time) / 1e6)
               AS avg_processing_delay_seconds
    FROM averages GROUP BY 1
)
ORDER BY 1"""

BATCH_RUN_STATS = f"""
SELECT CAST(run_date AS VARCHAR) AS run_date, model_name,
       {_six('avg_execution_time', 'max_execution_time', 'min_execution_time')}
FROM (
    SELECT CAST(ts AS DATE) AS run_date, event_type AS model_name,
           avg(round(value * 1e6) / 1e6) AS avg_execution_time,
           max(round(value * 1e6) / 1e6) AS max_execution_time,
           min(round(value * 1e6) / 1e6) AS min_execution_time
    FROM events GROUP BY ALL
)
ORDER BY run_date, avg_execution_time DESC"""


def _data_volume(table: str, volume: str = "BIGINT") -> str:
    return f"""
SELECT CAST(trade_date AS VARCHAR) AS analysis_date, count(*) AS total_records,
       count(DISTINCT symbol) AS total_symbols,
       CAST(sum(daily_volume) AS {volume}) AS total_trade_volume
FROM {table} GROUP BY trade_date ORDER BY 1"""


TICK_VALUES = (
    f"symbol, {_six('price', 'change_percent')}, volume, sector, "
    f"{_iso('tick_time', 'timestamp')}"
)


_ALERTS = f"""
SELECT symbol, alert_type, {_six('value', 'threshold')}, {_iso('tick_time', 'triggered_at')}
FROM (
    SELECT symbol, alert_type, tick_time, value, threshold, lag(value) OVER (
        PARTITION BY symbol, alert_type ORDER BY tick_time, price, volume, change_percent) AS before, above
    FROM (
        SELECT t.*, 'price_above' AS alert_type, true AS above, price AS value, floor(high / 2) AS threshold FROM ticks t JOIN highest USING (symbol)
        UNION ALL
        SELECT t.*, 'price_below', false, price, floor(high / 4) FROM ticks t JOIN highest USING (symbol)
        UNION ALL
        SELECT t.*, 'change_above', true, change_percent, 4.5 FROM ticks t
    )
)
WHERE CASE WHEN above THEN value > threshold ELSE value < threshold END
    AND NOT coalesce(CASE WHEN above THEN before > threshold ELSE before < threshold END, false)"""


def oracle_sql() -> dict[str, str]:
    bodies = {
        "staging": f"SELECT id, {TICK_VALUES}, "
                   f"{_iso('tick_time + INTERVAL 60 SECOND', 'processed_timestamp')} FROM ticks",
        "daily_metrics": f"SELECT {KEYS}, {_six('avg_price', 'high_price', 'low_price')}, "
                         "daily_volume FROM daily",
        "open_close": f"SELECT DISTINCT {KEYS}, {_six('open_price', 'close_price')} FROM edges",
        "daily_volatility": f"SELECT {KEYS}, {_six('daily_volatility')} FROM metrics",
        "daily_return": f"SELECT {KEYS}, {_six('daily_return')} FROM metrics",
        "stock_metrics": _metrics("metrics"),
        "stock_metrics_per_tick": _metrics("per_tick"),
        "sector_daily": f"SELECT {SECTOR_KEYS}, {_six('sector_avg_price', 'sector_avg_change')}, "
                        "sector_volume FROM sector_days",
        "sector_volatility": f"SELECT {SECTOR_KEYS}, {_six('sector_volatility')} FROM volatility",
        "sector_volatility_per_tick":
            f"SELECT {SECTOR_KEYS}, {_six('sector_volatility')} FROM volatility_per_tick",
        "sector_analysis": _sector_analysis("volatility"),
        "sector_analysis_per_tick": _sector_analysis("volatility_per_tick"),
        "moving_averages":
            f"SELECT {KEYS}, {_six('ma_5_day', 'ma_10_day', 'ma_20_day')} FROM analytics",
        "momentum": f"SELECT {KEYS}, {_six('momentum_5_day')} FROM analytics",
        "trend_signal": f"SELECT {KEYS}, {TREND} FROM analytics",
        "price_analytics": PRICE_ANALYTICS,
        "price_analytics_per_tick": PRICE_ANALYTICS_PER_TICK,
        "window_avg_5min": _windows("5min"),
        "window_avg_15min": _windows("15min"),
        "window_avg_30min": _windows("30min"),
        "window_avg_union": " UNION ALL ".join(
            f"({_windows(label)})" for label in ("5min", "15min", "30min")
        ),
        "sector_window_15min":
            f"SELECT sector, {_six('avg_price', 'avg_change_percent')}, total_volume, "
            f"{_iso('window_end_time', 'window_end_time')} FROM sector_windows",
        "stream_vs_batch": STREAM_VS_BATCH,
        "stream_stats": STREAM_STATS,
        "batch_run_stats": BATCH_RUN_STATS,
        "data_volume": _data_volume("metrics"),
        "data_volume_per_tick": _data_volume("per_tick", "VARCHAR"),
        "quote_normalise": f"""
SELECT symbol, CASE WHEN sent THEN price END AS price,
       CAST(CASE WHEN sent THEN volume END AS DOUBLE) AS volume,
       CASE WHEN sent THEN change_percent END AS change_percent,
       {_iso('tick_time', 'timestamp')}
FROM (SELECT *, kind NOT IN ('error', 'signup') AS sent FROM ticks)""",
        "sector_lookup": f"""
SELECT t.id, t.symbol, {_six('price')}, r.r_name AS sector
FROM ticks t LEFT JOIN supplier s ON t.symbol = 'U' || s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "sector_lookup_unknown": f"""
SELECT t.id, t.symbol, {_six('price')} FROM ticks t
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE t.symbol = 'U' || s.s_suppkey)""",
        "sector_lookup_default": f"""
SELECT t.id, t.symbol, {_six('price')}, coalesce(r.r_name, 'Unknown') AS sector
FROM ticks t LEFT JOIN supplier s ON t.symbol = 'U' || s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "tick_decode": f"""
SELECT * REPLACE (CAST(volume AS DOUBLE) AS volume)
FROM (SELECT {TICK_VALUES} FROM ticks WHERE kind <> 'error')
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM ticks WHERE kind = 'error'""",
        "tick_encode": "SELECT symbol AS key, message AS value FROM encoded",
        "literal_rows": "SELECT symbol, CAST(1 AS DOUBLE) AS id FROM ticks "
                        "UNION ALL SELECT symbol, CAST(NULL AS DOUBLE) AS id FROM ticks",
        "literal_filter": """
SELECT * FROM (
    SELECT symbol, CAST(1 AS DOUBLE) AS id FROM ticks
    UNION ALL SELECT symbol, CAST(NULL AS DOUBLE) AS id FROM ticks
) WHERE id = 1""",
        "check_not_null": f"SELECT {KEYS} FROM analytics WHERE momentum_5_day IS NULL",
        "check_unique": "SELECT symbol, count(*) AS n_records FROM ticks "
                        "WHERE symbol IS NOT NULL GROUP BY symbol HAVING count(*) > 1",
        "sink_accept": f"SELECT {TICK_VALUES} FROM judged WHERE reject_reason = ''",
        "sink_reject": f"SELECT reject_reason, {TICK_VALUES} FROM judged WHERE reject_reason <> ''",
        "raw_ingest": f"SELECT {TICK_VALUES} FROM ticks WHERE kind <> 'error'",
        "raw_ingest_resumed": f"SELECT {TICK_VALUES} FROM ticks WHERE kind <> 'error'",
        "raw_ingest_day": f"SELECT CAST(trade_date AS VARCHAR) AS trade_date, {TICK_VALUES} FROM ticks "
                          "WHERE kind <> 'error' AND trade_date = (SELECT min(trade_date) FROM ticks)",
        "raw_ingest_keys": "SELECT symbol, true AS has_id, true AS has_load_time, CAST(2 * count(*) AS BIGINT) AS n_rows, "
                           "CAST(2 * count(*) AS BIGINT) AS n_ids FROM ticks WHERE kind <> 'error' GROUP BY symbol",
        "raw_ingest_compacted": f"SELECT {TICK_VALUES} FROM ticks WHERE kind <> 'error'",
        "raw_ingest_checks": f"""
SELECT rule, count(reason) AS n_rows FROM (SELECT unnest([{", ".join(f"'{rule}'" for rule in rules(RAW_TICKS))}]) AS rule)
LEFT JOIN (SELECT unnest(string_split(reject_reason, '; ')) AS reason FROM judged) ON reason = rule GROUP BY rule""",
        "data_volume_monthly": """
SELECT CAST(CAST(date_trunc('month', trade_date) AS DATE) AS VARCHAR) AS span_start, count(*) AS total_records,
       CAST(sum(daily_volume) AS BIGINT) AS total_trade_volume, count(DISTINCT symbol) AS total_symbols, true AS within_bound
FROM metrics GROUP BY date_trunc('month', trade_date)""",
        "threshold_alerts": _ALERTS,
        "stream_alerts": _ALERTS,
        "table_by_name": f"SELECT id, {TICK_VALUES} FROM ticks",
        "stream_sql_view": f"""
SELECT symbol, {_iso('time_bucket(INTERVAL 5 MINUTE, tick_time)', 'window_start')}, count(*) AS n_ticks
FROM ticks, released GROUP BY symbol, time_bucket(INTERVAL 5 MINUTE, tick_time), until
HAVING time_bucket(INTERVAL 5 MINUTE, tick_time) + INTERVAL 5 MINUTE <= until""",
        "stream_both_aggregates": f"""
SELECT 'symbol' AS kind, symbol AS name, window_size, {_six('avg_price')}, {_iso('window_end_time', 'window_end_time')}
FROM averages, released WHERE processed_timestamp - INTERVAL 60 SECOND <= until
UNION ALL
SELECT 'sector', sector, '15min', CAST(CAST(CAST(avg_price AS VARCHAR) AS DECIMAL(10, 2)) AS DOUBLE),
       {_iso('window_end_time', 'window_end_time')}
FROM sector_windows, released WHERE window_close <= until""",
        "raw_ingest_rejects": """
SELECT 'symbol is null; price is null; volume is null; timestamp is null' AS reject_reason,
       '<' || message AS message
FROM encoded WHERE kind = 'error'""",
        "stream_moving_averages": f"""
SELECT symbol, window_size, {_six('avg_price')}, {_iso('window_end_time', 'window_end_time')}
FROM averages, released WHERE processed_timestamp - INTERVAL 60 SECOND <= until""",
        "stream_late_ticks": f"""
SELECT symbol, window_size, {_six('avg_price')}, {_iso('window_end_time', 'window_end_time')}
FROM averages, released WHERE processed_timestamp - INTERVAL 60 SECOND <= until""",
        "stream_moved_state": f"""
SELECT symbol, window_size, {_six('avg_price')}, {_iso('window_end_time', 'window_end_time')}
FROM averages, released WHERE processed_timestamp - INTERVAL 60 SECOND <= until""",
        "stream_sector_performance": f"""
SELECT sector, CAST(CAST(CAST(avg_price AS VARCHAR) AS DECIMAL(10, 2)) AS DOUBLE) AS avg_price,
       total_volume,
       CAST(CAST(CAST(avg_change_percent AS VARCHAR) AS DECIMAL(10, 2)) AS DOUBLE)
           AS avg_change_percent,
       {_iso('window_end_time', 'window_end_time')}
FROM sector_windows, released WHERE window_close <= until""",
        "late_ticks": """
SELECT window_size, count(*) AS n_ticks, count(*) FILTER (again AND time_bucket(minutes, tick_time) + minutes <= until) AS n_late
FROM (SELECT tick_time, false AS again FROM ticks UNION ALL
      SELECT tick_time, true FROM ticks WHERE trade_date = (SELECT min(trade_date) FROM ticks)), released,
    (VALUES ('5min', INTERVAL 5 MINUTE), ('15min', INTERVAL 15 MINUTE), ('30min', INTERVAL 30 MINUTE)) w(window_size, minutes)
GROUP BY window_size""",
        "stored_layers": f"""
SELECT a.symbol, a.sector, CAST(a.trade_date AS VARCHAR) AS trade_date, {_six('close_price')},
       trend_signal, performance_rank
FROM (SELECT *, {TREND} FROM analytics JOIN members USING (symbol)) a
JOIN (SELECT *, rank() OVER (PARTITION BY trade_date ORDER BY sector_avg_change DESC NULLS FIRST)
          AS performance_rank FROM sector_days) d USING (sector, trade_date)""",
    }
    return {name: BASE + body for name, body in bodies.items()}
