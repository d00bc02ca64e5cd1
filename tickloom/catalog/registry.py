"""Every analytic as a named query over a folder of test tables.

Results are put in a form that does not depend on an engine's number and time types: doubles at
six places, decimals as doubles, dates and times as ISO text.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import quality, windows
from tickloom.operators.rollup import daily_rollup
from tickloom.plans import alerts, daily, layers, monitor, price, sector
from tickloom.functions import micros, trade_date
from tickloom.plans.staging import literal_rows, rows_with_id, staging, union_all
from tickloom.schemas import MARKET_ALERTS, MOVING_AVERAGES, RAW_TICKS, SECTOR_PERFORMANCE, TICK_MESSAGE
from tickloom.session import scratch_dir, stored
from tickloom.sources import events as ev
from tickloom.sources import tables
from tickloom.sources.messages import TICK_COLUMNS, decode_ticks, encode_ticks, file_messages
from tickloom.sources.quotes import attach_sector, normalise_quotes
from tickloom.streaming import handover, runner, sinks

Query = Callable[[SparkSession, str], DataFrame]
#: Ticks of a load for each state partition: each has three windows, of about 130 bytes apiece while they are aggregated.
ROWS_PER_STATE = 400_000


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Price analytics per symbol and day, in its own types."""
    return price.price_analytics(_metrics(spark, folder))


def queries() -> dict[str, Query]:
    return {
        "staging": lambda s, d: present(_ticks(s, d)),
        "daily_metrics": lambda s, d: present(daily.daily_metrics(_ticks(s, d))),
        "open_close": lambda s, d: present(daily.open_close(_ticks(s, d))),
        "daily_volatility": lambda s, d: present(daily.daily_volatility(_ticks(s, d))),
        "daily_return": lambda s, d: present(daily.daily_return(_ticks(s, d))),
        "stock_metrics": lambda s, d: present(_metrics(s, d)),
        "stock_metrics_per_tick": lambda s, d: present(
            daily.stock_metrics(_ticks(s, d), per_tick=True)
        ),
        "sector_daily": lambda s, d: present(sector.sector_daily(_ticks(s, d))),
        "sector_volatility": lambda s, d: present(sector.sector_volatility(_rollup(s, d))),
        "sector_volatility_per_tick": lambda s, d: present(
            sector.sector_volatility(_rollup(s, d), per_tick=True)
        ),
        "sector_analysis": lambda s, d: present(sector.sector_analysis(_rollup(s, d))),
        "sector_analysis_per_tick": lambda s, d: present(
            sector.sector_analysis(_rollup(s, d), per_tick=True)
        ),
        "moving_averages": lambda s, d: present(price.moving_averages(_metrics(s, d))),
        "momentum": lambda s, d: present(price.momentum(_metrics(s, d))),
        "trend_signal": lambda s, d: present(price.trend_signal(_metrics(s, d))),
        "price_analytics": lambda s, d: present(flagship(s, d)),
        "price_analytics_per_tick": _price_analytics_per_tick,
        "window_avg_5min": lambda s, d: present(windows.window_averages(_ticks(s, d), "5min")),
        "window_avg_15min": lambda s, d: present(windows.window_averages(_ticks(s, d), "15min")),
        "window_avg_30min": lambda s, d: present(windows.window_averages(_ticks(s, d), "30min")),
        "window_avg_union": lambda s, d: present(windows.moving_averages(_ticks(s, d))),
        "sector_window_15min": lambda s, d: present(windows.sector_windows(_ticks(s, d))),
        "stream_vs_batch": _stream_vs_batch,
        "stream_stats": lambda s, d: present(
            monitor.stream_stats(ev.stored_averages(_ticks(s, d)))
        ),
        "batch_run_stats": lambda s, d: present(
            monitor.batch_run_stats(ev.run_log(ev.events(s, d)))
        ),
        "data_volume": lambda s, d: present(monitor.data_volume(_metrics(s, d))),
        "data_volume_per_tick": lambda s, d: present(
            monitor.data_volume(daily.counted_metrics(_ticks(s, d)), per_tick=True)
        ),
        "data_volume_monthly": _data_volume_monthly,
        "threshold_alerts": lambda s, d: present(alerts.threshold_alerts(_ticks(s, d), _alert_rules(s, d))),
        "stream_alerts": _stream_alerts,
        "quote_normalise": lambda s, d: present(_volume_as_double(
            normalise_quotes(ev.quote_responses(ev.events(s, d))).drop("sector")
        )),
        "sector_lookup": lambda s, d: present(_looked_up(s, d)),
        "sector_lookup_unknown": lambda s, d: present(
            quality.check_not_null(_looked_up(s, d), "sector").drop("sector")
        ),
        "sector_lookup_default": lambda s, d: present(_looked_up(s, d, "Unknown")),
        "table_by_name": _table_by_name,
        "tick_decode": lambda s, d: present(_volume_as_double(
            decode_ticks(ev.tick_messages(ev.events(s, d))).select(*TICK_COLUMNS)
        )),
        "tick_encode": lambda s, d: encode_ticks(ev.wire_ticks(ev.events(s, d))),
        "literal_rows": lambda s, d: present(_literal_rows(s, d)),
        "literal_filter": lambda s, d: present(rows_with_id(_literal_rows(s, d), 1)),
        "check_not_null": lambda s, d: present(
            quality.check_not_null(price.momentum(_metrics(s, d)), "momentum_5_day")
            .select("symbol", "trade_date")
        ),
        "check_unique": lambda s, d: present(quality.check_unique(_ticks(s, d), "symbol")),
        "sink_accept": lambda s, d: present(
            quality.accepted(_judged(s, d), RAW_TICKS)
        ),
        "sink_reject": _sink_reject,
        "raw_ingest": _raw_ingest,
        "raw_ingest_rejects": _raw_ingest_rejects,
        "raw_ingest_resumed": _raw_ingest_resumed,
        "raw_ingest_day": _raw_ingest_day,
        "raw_ingest_keys": _raw_ingest_keys,
        "raw_ingest_compacted": _raw_ingest_compacted,
        "raw_ingest_checks": _raw_ingest_checks,
        "stream_sql_view": _stream_sql_view,
        "stream_both_aggregates": _stream_both_aggregates,
        "stream_moving_averages": _stream_moving_averages,
        "stream_sector_performance": _stream_sector_performance,
        "stream_late_ticks": _stream_late_ticks,
        "stream_moved_state": _stream_moved_state,
        "late_ticks": _late_ticks,
        "stored_layers": _stored_layers,
    }


def present(df: DataFrame) -> DataFrame:
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("string") if field.dataType.scale == 0 else column.cast("double")
    if isinstance(field.dataType, T.DoubleType):
        return _six_places(column)
    if isinstance(field.dataType, T.DateType):
        return column.cast("string")
    if isinstance(field.dataType, T.TimestampType):
        utc = F.to_utc_timestamp(column, F.current_timezone())
        return F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return column


def _six_places(column: Column) -> Column:
    """Half up, by way of nine places so that noise in the last bits does not decide a tie.

    Plain arithmetic where nine places are whole numbers in a double; `round`, which goes through a
    decimal object per value, for larger numbers and those that are none.
    """
    ninth = F.rint(column * 1e9)
    near = F.signum(ninth) * F.floor((F.abs(ninth) + 500) / 1000) / 1e6 + F.lit(0.0)
    return F.when(F.abs(column) < 9e6, near).otherwise(F.round(column, 6))


def _ticks(spark: SparkSession, folder: str) -> DataFrame:
    return staging(ev.raw_ticks(ev.events(spark, folder)))


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return daily.stock_metrics(_ticks(spark, folder))


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The sector model uses the rollup several times, so it is stored: one pass over the ticks."""
    return stored(daily_rollup(_ticks(spark, folder), open_close=False), "sector-rollup")


def _price_analytics_per_tick(spark: SparkSession, folder: str) -> DataFrame:
    rows = price.price_analytics_per_tick(daily.counted_metrics(_ticks(spark, folder)))
    return present(
        present(rows).groupBy(*price.COLUMNS).agg(F.sum(F.col("copies").cast("decimal(38,0)")).alias("copies"))
    )


def _stream_vs_batch(spark: SparkSession, folder: str) -> DataFrame:
    ticks = _ticks(spark, folder)
    averages = ev.stored_averages(ticks, monitor.COMPARED_WINDOW)
    return present(monitor.stream_vs_batch(averages, daily.stock_metrics(ticks)))


def _looked_up(spark: SparkSession, folder: str, default: str | None = None) -> DataFrame:
    found = attach_sector(_ticks(spark, folder), ev.supplier_regions(spark, folder), default)
    return found.select("id", "symbol", "price", "sector")


def _literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A row with id 1 and a row with a null id for every tick."""
    symbols = _ticks(spark, folder).select("symbol")
    ids = literal_rows(spark, [1, None]).withColumn("on", F.lit(1))
    rows = symbols.withColumn("on", F.lit(1)).join(F.broadcast(ids), "on")
    one, none = (rows.where(c).select("symbol", F.col("id").cast("double")) for c in ("id = 1", "id IS NULL"))
    return union_all(one, none)


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return quality.apply_contract(ev.dirty_ticks(ev.events(spark, folder)), RAW_TICKS)


def _volume_as_double(ticks: DataFrame) -> DataFrame:
    """Whole numbers with nulls come back in different types from different engines."""
    return ticks.withColumn("volume", F.col("volume").cast("double"))


def _sink_reject(spark: SparkSession, folder: str) -> DataFrame:
    """The whole row as it came, read back from its JSON."""
    rows = quality.rejected(_judged(spark, folder))
    row = F.from_json("rejected_row", TICK_MESSAGE).alias("row")
    return present(rows.select("reject_reason", row).select("reject_reason", "row.*").withColumn(
        "change_percent", F.col("change_percent").cast("double")))


def _ingest(spark: SparkSession, folder: str, times: int = 1) -> str:
    """The raw table filled by a query that is started `times` times on one checkpoint."""
    path, progress = scratch_dir(spark, "raw-ticks"), scratch_dir(spark, "raw-ticks-progress")
    for _ in range(times):
        ticks = decode_ticks(ev.tick_messages(ev.event_stream(spark, folder)))
        runner.start_raw_ingest(ticks, path, progress, available_now=True).awaitTermination()
    return path


def _raw_ingest(spark: SparkSession, folder: str) -> DataFrame:
    rows = sinks.stored_rows(spark, _ingest(spark, folder), RAW_TICKS)
    return present(rows.select(*RAW_TICKS.columns))


def _raw_ingest_resumed(spark: SparkSession, folder: str) -> DataFrame:
    rows = sinks.stored_rows(spark, _ingest(spark, folder, times=2), RAW_TICKS)
    return present(rows.select(*RAW_TICKS.columns))


def _raw_ingest_day(spark: SparkSession, folder: str) -> DataFrame:
    """The first day of the raw table, read by its date."""
    path = _ingest(spark, folder)
    first = ev.raw_ticks(ev.events(spark, folder)).agg(F.min(trade_date("timestamp"))).first()[0]
    rows = sinks.stored_rows(spark, path, RAW_TICKS, day=str(first))
    return present(rows.select("trade_date", *RAW_TICKS.columns))


def _raw_ingest_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and load times of a table to which every message came twice: equal rows have ids of their own."""
    path = scratch_dir(spark, "raw-twice")
    messages = ev.tick_messages(ev.event_stream(spark, folder))
    runner.start_raw_ingest(
        decode_ticks(messages.union(messages)), path, scratch_dir(spark, "raw-twice-progress"), available_now=True).awaitTermination()
    rows = sinks.stored_rows(spark, path, RAW_TICKS)
    return rows.groupBy("symbol").agg(
        F.bool_and(F.col("id").isNotNull()).alias("has_id"),
        F.bool_and(F.col("processed_timestamp").isNotNull()).alias("has_load_time"),
        F.count("*").alias("n_rows"),
        F.count_distinct("id").alias("n_ids"))


def _raw_ingest_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table after four batches that all hold every day, with the closed ones merged and what they were deleted."""
    messages, path, progress = (scratch_dir(spark, f"compacted-{name}") for name in ("messages", "raw", "progress"))
    sent = ev.tick_messages(ev.events(spark, folder))
    for part in range(4):
        sent.where(F.pmod(F.xxhash64("value"), F.lit(4)) == part).write.mode("append").text(messages)
        ticks = decode_ticks(file_messages(spark, messages, "*.txt"))
        runner.start_raw_ingest(ticks, path, progress, available_now=True).awaitTermination()
    sinks.compact_days(spark, path, RAW_TICKS)
    sinks.vacuum(spark, path, older_than=0)
    return present(sinks.stored_rows(spark, path, RAW_TICKS).select(*RAW_TICKS.columns))


def _raw_ingest_checks(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows broke each rule, as the ingest itself counted."""
    path = scratch_dir(spark, "checked")
    ticks = ev.dirty_ticks(ev.event_stream(spark, folder))
    runner.start_raw_ingest(ticks, path, scratch_dir(spark, "checked-progress"), available_now=True).awaitTermination()
    return sinks.broken_rows(spark, path).groupBy("rule").agg(F.sum("n_rows").alias("n_rows"))


def _data_volume_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Months from the sketches of their days, and whether the estimate is within its bound of the exact number."""
    metrics = _metrics(spark, folder)
    months = monitor.volume_over(monitor.volume_sketches(metrics), "month")
    exact = metrics.groupBy(F.to_date(F.date_trunc("month", "trade_date")).alias("span_start")).agg(
        F.count_distinct("symbol").alias("total_symbols"))
    off = F.abs(F.col("symbol_estimate") - F.col("total_symbols"))
    return present(months.join(exact, "span_start").select(
        "span_start", "total_records", "total_trade_volume", "total_symbols",
        (off <= F.greatest(F.lit(1), F.col("total_symbols") * monitor.SKETCH_ERROR)).alias("within_bound")))


def _alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    """For every symbol its price beyond half and below a quarter of its highest one, and one rule for all symbols."""
    highest = _ticks(spark, folder).groupBy("symbol").agg(F.max("price").alias("high"))
    own = F.inline(F.array(*[
        F.struct(F.lit(name).alias("alert_type"), F.lit("price").alias("watched"), F.lit(above).alias("above"),
                 F.floor(F.col("high") / parts).cast("double").alias("threshold"))
        for name, above, parts in (("price_above", True, 2), ("price_below", False, 4))]))
    common = spark.createDataFrame([(alerts.EVERY, "change_above", "change_percent", True, 4.5)], alerts.RULES)
    return highest.select("symbol", own).unionByName(common)


def _stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a stream, from the stored alerts table."""
    path = scratch_dir(spark, "alerts")
    ticks = ev.wire_ticks(ev.event_stream(spark, folder))
    runner.start_alerts(
        ticks, stored(_alert_rules(spark, folder), "alert-rules"), path, scratch_dir(spark, "alerts-progress"), available_now=True,
    ).awaitTermination()
    return present(sinks.stored_rows(spark, path, MARKET_ALERTS).select(*MARKET_ALERTS.columns))


def _table_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The raw ticks as a table, read by the name that the models use."""
    path = scratch_dir(spark, "tables")
    _ticks(spark, folder).write.parquet(f"{path}/raw_stock_data")
    rows = tables.parquet_table(spark, path, "raw_stock_data")
    return present(rows.drop("processed_timestamp"))


def _stream_sql_view(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the registered stream, stored by a query of its own."""
    name, path = f"ticks_{uuid.uuid4().hex}", scratch_dir(spark, "sql-view")
    runner.register_stream(ev.wire_ticks(ev.event_stream(spark, folder)), name)
    try:
        counts = spark.sql(
            f"SELECT symbol, window.start AS window_start, count(*) AS n_ticks FROM {name} "
            "GROUP BY symbol, window(timestamp, '5 minutes')")
        query = counts.writeStream.outputMode("append").format("parquet").option(
            "checkpointLocation", scratch_dir(spark, "sql-view-progress")).trigger(availableNow=True).start(path)
        query.awaitTermination()
    finally:
        spark.catalog.dropTempView(name)
    return present(spark.read.schema(counts.schema).parquet(path))


def _stream_both_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """Both aggregates at once over one source."""
    averages, sectors = scratch_dir(spark, "both-averages"), scratch_dir(spark, "both-sectors")
    ticks = staging(ev.wire_ticks(ev.event_stream(spark, folder)))
    for query in runner.start_aggregates(
            ticks, averages, sectors, scratch_dir(spark, "both-progress"), available_now=True):
        query.awaitTermination()
    one = sinks.stored_rows(spark, averages, MOVING_AVERAGES).select(
        F.lit("symbol").alias("kind"), F.col("symbol").alias("name"), "window_size", "avg_price", "window_end_time")
    other = sinks.stored_rows(spark, sectors, SECTOR_PERFORMANCE).select(
        F.lit("sector").alias("kind"), F.col("sector").alias("name"), F.lit("15min").alias("window_size"),
        "avg_price", "window_end_time")
    return present(union_all(one, other))


def _raw_ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = sinks.rejected_rows(spark, _ingest(spark, folder), RAW_TICKS)
    message = F.get_json_object("rejected_row", "$.message")
    return rows.select("reject_reason", message.alias("message"))


def _stream_moving_averages(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "moving-averages")
    ticks = staging(ev.wire_ticks(ev.event_stream(spark, folder)))
    runner.start_moving_averages(
        ticks, path, scratch_dir(spark, "moving-averages-progress"), available_now=True
    ).awaitTermination()
    rows = sinks.stored_rows(spark, path, MOVING_AVERAGES)
    return present(rows.select(*MOVING_AVERAGES.columns))


def _stream_sector_performance(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "sector-performance")
    ticks = staging(ev.wire_ticks(ev.event_stream(spark, folder)))
    runner.start_sector_performance(
        ticks, path, scratch_dir(spark, "sector-performance-progress"), available_now=True
    ).awaitTermination()
    rows = sinks.stored_rows(spark, path, SECTOR_PERFORMANCE)
    return present(rows.select(*SECTOR_PERFORMANCE.columns))


def _stream_late_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """The averages over micro-batches, the last of which holds all ticks of the first day again.

    By then the windows of that day are closed, so its ticks are late and change nothing.
    """
    path, progress = scratch_dir(spark, "late-averages"), scratch_dir(spark, "late-progress")
    for stream in _late_streams(spark, folder):
        runner.start_moving_averages(stream, path, progress, available_now=True).awaitTermination()
    return present(sinks.stored_rows(spark, path, MOVING_AVERAGES).select(*MOVING_AVERAGES.columns))


def _stream_moved_state(spark: SparkSession, folder: str) -> DataFrame:
    """The averages by a query with 3 state partitions over the first days, and by one with 7 that takes over from it, in one table.

    Messages come in the order of time, a load for each micro-batch, so a state partition holds the windows of a load and
    not of all days.
    """
    path, old, new, messages = (scratch_dir(spark, f"moved-{name}") for name in ("averages", "old", "new", "messages"))
    ticks = ev.wire_ticks(ev.events(spark, folder))
    days = _days(ticks)
    middle = days[len(days) // 2]
    for load in _loads(_between(ticks, days[0], middle), 3 * ROWS_PER_STATE):
        runner.start_moving_averages(_sent(load, messages), path, old, available_now=True, state_partitions=3).awaitTermination()
    after = handover.last_watermark(spark, old)
    for load in _loads(_between(ticks, middle), 7 * ROWS_PER_STATE):
        runner.start_moving_averages(
            _sent(load, messages), path, new, available_now=True, state_partitions=7, after=after).awaitTermination()
    return present(sinks.stored_rows(spark, path, MOVING_AVERAGES).select(*MOVING_AVERAGES.columns))


def _late_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """How many ticks of those micro-batches came too late, from the raw table."""
    path, progress = scratch_dir(spark, "late-raw"), scratch_dir(spark, "late-raw-progress")
    for stream in _late_streams(spark, folder):
        runner.start_raw_ingest(stream, path, progress, available_now=True).awaitTermination()
    return monitor.late_ticks(sinks.stored_rows(spark, path, RAW_TICKS))


def _late_streams(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The same stream three times, each time with more messages: the first days, the others, the first day again."""
    messages = scratch_dir(spark, "late-messages")
    ticks = ev.wire_ticks(ev.events(spark, folder))
    days = _days(ticks)
    parts = [(days[0], days[len(days) // 2]), (days[len(days) // 2], None), (days[0], [*days, None][1])]
    for first, end in parts:
        yield _sent(_between(ticks, first, end), messages)


def _sent(ticks: DataFrame, messages: str) -> DataFrame:
    """The stream of all messages of a folder, with those of the ticks added to it."""
    rows = encode_ticks(ticks).select("value")
    rows.write.mode("append").text(messages)  # however many files, a run takes them as one micro-batch
    return decode_ticks(file_messages(ticks.sparkSession, messages, "*.txt"))


def _days(ticks: DataFrame) -> list[datetime.date]:
    return [r[0] for r in ticks.select(trade_date("timestamp").alias("d")).distinct().orderBy("d").collect()]


def _between(ticks: DataFrame, first: datetime.date, end: datetime.date | None = None) -> DataFrame:
    """The ticks from one day on, up to before another. Taken before they are encoded, so that each is encoded once."""
    day = trade_date("timestamp")
    return ticks.where((day >= F.lit(first)) & (day < F.lit(end)) if end else day >= F.lit(first))


def _loads(ticks: DataFrame, rows: int) -> list[DataFrame]:
    """The ticks in stretches of whole hours, one after the other, each of at most so many rows or one hour; at least one stretch."""
    hour = F.floor(micros("timestamp") / F.lit(3_600_000_000))
    starts, held = [], 0
    for at, n in ticks.groupBy(hour.alias("hour")).count().orderBy("hour").collect():
        if not starts or held + n > rows:
            starts.append(at)
            held = 0
        held += n
    if len(starts) < 2:
        return [ticks]
    return [ticks.where((hour >= at) & (hour < end) if end else hour >= at) for at, end in zip(starts, [*starts[1:], None], strict=True)]


def _stored_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Build and store all layers, then join the two end tables by symbol's sector and day."""
    models = layers.build_layers(
        ev.raw_ticks(ev.events(spark, folder)),
        location=scratch_dir(spark, "layers"),
        prefix=f"tickloom_{uuid.uuid4().hex}_",
    )
    prices = models["price_analytics"].select("symbol", "trade_date", "close_price", "trend_signal")
    members = sector.symbol_sectors(models["daily_rollup"]).select("symbol", "sector")
    ranks = models["sector_analysis"].select("sector", "trade_date", "performance_rank")
    return present(prices.join(members, "symbol").join(ranks, ["sector", "trade_date"]))
