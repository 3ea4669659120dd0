"""Frames, envelopes, fan-out."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.sources import envelopes, frames

from helpers import at, notice, notices, rows, trade, trades

GOOD = {
    "stream": "btcusdt@aggTrade",
    "data": {
        "e": "aggTrade", "E": 1700000000123, "a": 5, "s": "BTCUSDT", "p": "1.5", "q": "2",
        "f": 1, "l": 3, "T": 1700000000100, "m": True,
    },
}


def text(**over):
    data = GOOD["data"] | over
    return json.dumps({"stream": GOOD["stream"], "data": {k: v for k, v in data.items() if v is not None}})


def frame_df(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode(spark):
    out = frames.decode_frames(frame_df(spark, text())).drop("trade_id")
    assert rows(out) == [
        ("btcusdt@aggTrade", "aggTrade", "2023-11-14 22:13:20.123000", 5, "BTCUSDT", 1.5, 2.0, 1, 3,
         "2023-11-14 22:13:20.100000", True)
    ]


@pytest.mark.parametrize(
    ("frame", "reason"),
    [
        ("not json", frames.UNDECODABLE),
        (text(a="x"), frames.UNDECODABLE),
        (text(a="5"), frames.UNDECODABLE),
        (text(m="true"), frames.UNDECODABLE),
        (text()[:40], frames.UNDECODABLE),
        (text() + " tail", frames.UNDECODABLE),
        ("", frames.UNDECODABLE),
        ('{"result":null,"id":1}', frames.NOT_A_TRADE),
        (text(e="kline"), frames.NOT_A_TRADE),
        (text(T=None), frames.MISSING_FIELD),
        (text(p="abc"), frames.BAD_PRICE),
        (text(q=""), frames.BAD_QUANTITY),
        (text(p="1e999"), frames.NOT_FINITE),
    ],
)
def test_quarantine(spark, frame, reason):
    df = frame_df(spark, frame, text())
    assert rows(frames.quarantine_frames(df)) == [(frame, reason)]
    assert frames.decode_frames(df).count() == 1


def test_zero_mode(spark):
    zero = frames.decode_frames(
        frame_df(spark, "not json", '{"result":null,"id":1}', text(p="abc"), text(p="1e999"), text(a="x")),
        on_bad_frame="zero",
    )
    got = rows(zero, "stream", "symbol", "price", "quantity", "aggregate_id", "trade_time")
    lost = ("", "", 0.0, 0.0, 0, "0001-01-01 00:00:00.000000")
    assert got == sorted(
        [
            lost,
            lost,
            ("", "", 0.0, 0.0, 0, "1970-01-01 00:00:00.000000"),
            ("btcusdt@aggTrade", "BTCUSDT", 0.0, 2.0, 5, "2023-11-14 22:13:20.100000"),
        ],
        key=repr,
    )
    assert zero.where(F.length("trade_id") == 64).count() == 4


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="on_bad_frame"):
        frames.decode_frames(frame_df(spark, text()), on_bad_frame="drop")


def test_frame_is_parsed_once(spark):
    plan = frames.decode_frames(frame_df(spark, text()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_subscribe(spark):
    df = trades(spark, [trade(1), trade(2, stream="bbbusdt@aggTrade"), trade(3, stream="cccusdt@aggTrade")])
    assert frames.stream_names(" AAAusdt, BBBUSDT") == ["aaausdt@aggTrade", "bbbusdt@aggTrade"]
    assert rows(frames.subscribe_symbols(df, "AAAUSDT, bbbusdt"), "aggregate_id") == [(1,), (2,)]
    listed = spark.createDataFrame([(" CCCUSDT ",), ("AAAUSDT",)], "symbol string")
    assert rows(frames.subscribe_symbols(df, listed), "aggregate_id") == [(1,), (3,)]


def test_envelope_text(spark):
    wrapped = envelopes.wrap_trades(trades(spark, [trade(1, event_time=at(0.12))]), F.lit("now"))
    wire = json.loads(envelopes.to_wire(wrapped).first()["value"])
    assert wire["subscribers"] == ["consumer.mongo", "consumer.telegrambot"]
    assert wire["type"] == "BinanceTradeEvent"
    assert wire["createdAt"] == "now"
    assert list(wire["eventData"]) == list(schemas.TRADE_WIRE.values())
    assert wire["eventData"]["EventTime"] == "2024-01-01T00:00:00.12Z"


def test_envelope_round_trip_keeps_braces_and_big_ids(spark):
    df = trades(spark, [trade(1, symbol='X}{Y"', aggregate_id=2**60 + 1)])
    wire = envelopes.to_wire(envelopes.wrap_trades(df, F.lit("}")))
    back = envelopes.unwrap(envelopes.parse_envelopes(wire), schemas.TRADE_EVENT)
    assert rows(back) == rows(df)


def test_unwrap_by_type_and_rejects(spark):
    both = envelopes.wrap_trades(trades(spark, [trade(1)])).unionByName(
        envelopes.wrap_notifications(notices(spark, [notice("2024-01-01T00:00:00Z")]))
    )
    broken = both.limit(1).withColumn("event_data", F.lit('{"ID":5,"Price":"x"}'))
    everything = both.unionByName(broken)
    assert envelopes.unwrap(everything, schemas.TRADE_EVENT).count() == 1
    assert envelopes.unwrap(everything, schemas.NOTIFICATION_EVENT).count() == 1
    assert envelopes.unwrap_rejects(everything, schemas.TRADE_EVENT).count() == 1


def test_malformed_envelope(spark):
    parsed = envelopes.parse_envelopes(frame_df(spark, "nope", '{"id":"a"}'))
    assert rows(parsed.where("malformed is not null"), "value") == [("nope",)]


def test_fan_out(spark):
    wrapped = envelopes.wrap_trades(trades(spark, [trade(1), trade(2)]))
    assert envelopes.fan_out(wrapped).count() == 4
    assert envelopes.for_subscriber(wrapped, "consumer.mongo").count() == 2


def test_dedup(spark):
    wrapped = envelopes.wrap_trades(trades(spark, [trade(1), trade(1), trade(2)]))
    assert envelopes.dedup_events(wrapped).count() == 2
