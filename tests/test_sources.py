from __future__ import annotations

import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import as_dicts
from tickloom.operators.quality import accepted, apply_contract, rejected
from tickloom.schemas import RAW_TICKS
from tickloom.sources.messages import decode_ticks, encode_ticks, file_messages, publish, topic_messages
from tickloom.sources.quotes import attach_sector, normalise_quotes
from tickloom.sources.tables import catalog_table, parquet_table


def message(**changes):
    tick = {"symbol": "A", "price": 1.25, "volume": 3, "change_percent": -0.5,
            "timestamp": "2024-01-01T09:00:00.123456", "sector": "S"}
    return json.dumps({**tick, **changes})


def decode(spark, *values):
    raw = spark.createDataFrame([(i, bytearray(v.encode())) for i, v in enumerate(values)],
                                "n int, value binary").orderBy("n").select("value")
    return [r.asDict() for r in decode_ticks(raw).collect()]


def test_change_as_number_text_or_percent(spark):
    rows = decode(spark, message(), message(change_percent="-0.5"), message(change_percent="-0.5%"),
                  message(change_percent=None), message(change_percent="n/a"))
    assert [r["change_percent"] for r in rows] == [-0.5, -0.5, -0.5, None, None]
    assert {r["price"] for r in rows} == {1.25}
    assert rows[0]["timestamp"] == datetime.datetime(2024, 1, 1, 9, 0, 0, 123456)


def test_broken_messages_become_rejects(spark):
    raw = spark.createDataFrame([(message(),), ("{not json",), ("",), (message()[:40],), (None,)],
                                "value string")
    judged = apply_contract(decode_ticks(raw), RAW_TICKS)
    assert accepted(judged, RAW_TICKS).count() == 1
    rows = rejected(judged).collect()
    assert len(rows) == 4
    assert any("{not json" in r["rejected_row"] for r in rows)


def test_encode_then_decode_gives_the_ticks(spark, ticks):
    rows = ticks([("A", "2024-01-01 09:00:00.123456", "1.25", 3, "0.50", "S"),
                  ("B", "2024-01-01 09:00:00", 2, 4, None, None)])
    encoded = encode_ticks(rows)
    assert encoded.columns == ["key", "value"]
    wire = json.loads(as_dicts(encoded, "key")[0]["value"])
    assert wire["timestamp"] == "2024-01-01T09:00:00.123456"
    back = decode_ticks(encoded).drop("message")
    expected = rows.drop("id").withColumns(
        {c: F.col(c).cast("double") for c in ("price", "change_percent")})
    assert as_dicts(back, "symbol") == as_dicts(expected.select(back.columns), "symbol")


def quotes(spark, *responses):
    at = datetime.datetime(2024, 1, 1, 9)
    return spark.createDataFrame([(f"Q{i}", r, at) for i, r in enumerate(responses)],
                                 "symbol string, response string, fetched_at timestamp")


def block(price="150.25", volume="1000", change="1.5%"):
    return json.dumps({"Global Quote": {
        "01. symbol": "X", "05. price": price, "06. volume": volume, "10. change percent": change}})


def test_quotes(spark):
    raw = quotes(spark, block(), block(change="-0.75%"), '{"Note": {"a": "b"}}', "<html>",
                 block(price="abc"), block(volume="1.5"), '{"Global Quote": {}}', None)
    rows = as_dicts(normalise_quotes(raw), "symbol")
    assert (rows[0]["price"], rows[0]["volume"], rows[0]["change_percent"]) == (150.25, 1000, 1.5)
    assert rows[1]["change_percent"] == -0.75
    for r in rows[2:4] + rows[6:]:
        assert (r["price"], r["volume"], r["change_percent"]) == (None, None, None)
    assert rows[4]["price"] is None and rows[4]["volume"] == 1000
    assert rows[5]["volume"] is None
    judged = apply_contract(normalise_quotes(raw), RAW_TICKS)
    assert accepted(judged, RAW_TICKS).count() == 2


def test_quotes_with_sector(spark):
    sectors = spark.createDataFrame([("Q0", "Technology")], "symbol string, sector string")
    rows = as_dicts(normalise_quotes(quotes(spark, block(), block()), sectors), "symbol")
    assert [r["sector"] for r in rows] == ["Technology", None]
    defaulted = attach_sector(normalise_quotes(quotes(spark, block(), block())), sectors, "Other")
    assert [r["sector"] for r in as_dicts(defaulted, "symbol")] == ["Technology", "Other"]


def test_tables_by_name(spark, ticks, tmp_path):
    rows = ticks([("A", "2024-01-01 09:00:00", 1)])
    rows.write.parquet(f"{tmp_path}/raw_stock_data")
    assert parquet_table(spark, str(tmp_path), "raw_stock_data").count() == 1
    rows.createOrReplaceTempView("raw_stock_data")
    assert catalog_table(spark, "raw_stock_data").count() == 1
    with pytest.raises(ValueError, match="unknown source table"):
        catalog_table(spark, "other")


def test_file_messages_are_a_stream_in_topic_shape(spark, tmp_path):
    assert file_messages(spark, str(tmp_path), "*.json", 2).isStreaming
    assert file_messages(spark, str(tmp_path)).columns == ["value"]


def test_topic_needs_the_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        topic_messages(spark, "broker:9092")
    with pytest.raises(AnalysisException, match="kafka"):
        publish(spark.sql("select 'k' as key, 'v' as value"), "broker:9092")
