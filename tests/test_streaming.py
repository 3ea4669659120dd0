"""Streaming jobs: same results as batch, nothing twice after a restart."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import alerts, rollup
from tapeloom.sources import envelopes, frames, lake
from tapeloom.sources.hot import DOCUMENTS, REJECTS, HotStore
from tapeloom.streaming import ingest
from tapeloom.streaming import rollups as live

from helpers import at, rows, trade, trades


def write_frames(spark, folder, name, made, extra=()):
    """One frame file; files are named and dated in the order given."""
    lines = [r["value"] for r in frames.encode_frames(trades(spark, made)).collect()]
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([*lines, *extra]) + "\n")
    stamp = 1_700_000_000 + int(name)
    os.utime(path, (stamp, stamp))


def large(n, **over):
    return trade(n, price=3_000_000.0, event_time=at(n), **over)


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("in", "hot", "alerts", "bad", "cp", "cp2", "out")}


def test_ingest_batches_restart_and_quarantine(spark, places):
    hot = HotStore(spark, places["hot"])

    def run():
        source = frames.read_frames(spark, places["in"], streaming=True, maxFilesPerTrigger="1")
        sink = ingest.alert_table(places["alerts"])
        ingest.start_ingest(source, hot, places["cp"], sink, places["bad"]).awaitTermination()

    write_frames(spark, places["in"], "1", [trade(1), large(2)], extra=["junk"])
    write_frames(spark, places["in"], "2", [trade(3)])
    run()
    run()
    assert rows(hot.scan_trades(), "aggregate_id") == [(1,), (2,), (3,)]
    write_frames(spark, places["in"], "3", [large(4)])
    run()
    assert rows(hot.scan_trades(), "aggregate_id") == [(1,), (2,), (3,), (4,)]
    assert hot.live_parts(schemas.TRADE_EVENT).count() == 3
    # The same as the batch operators over all frames.
    decoded = frames.decode_frames(frames.read_frames(spark, places["in"]))
    assert rows(hot.scan_trades()) == rows(decoded)
    assert rows(hot.scan_notifications()) == rows(alerts.build_notifications(decoded))
    assert rows(spark.read.parquet(places["alerts"]).drop("batch")) == rows(alerts.alert_messages(decoded))
    assert rows(spark.read.json(places["bad"]), "value", "reason") == [("junk", "undecodable")]


def test_failing_sink_repeats_the_batch_without_copies(spark, places):
    hot = HotStore(spark, places["hot"])
    write_frames(spark, places["in"], "1", [large(1)])

    def fail(messages, batch):
        raise OSError("no connection")

    def run(sink):
        source = frames.read_frames(spark, places["in"], streaming=True)
        ingest.start_ingest(source, hot, places["cp"], sink).awaitTermination()

    with pytest.raises(Exception, match="no connection"):
        run(fail)
    run(ingest.alert_table(places["alerts"]))
    assert hot.scan_trades().count() == 1
    assert hot.scan_notifications().count() == 1
    assert spark.read.parquet(places["alerts"]).count() == 1


def test_ingest_drops_redelivered_frames(spark, places):
    hot = HotStore(spark, places["hot"])
    write_frames(spark, places["in"], "1", [trade(1), trade(1), trade(2)])
    write_frames(spark, places["in"], "2", [trade(2), trade(3)])
    source = frames.read_frames(spark, places["in"], streaming=True, maxFilesPerTrigger="1")
    ingest.start_ingest(
        source, hot, places["cp"], ingest.alert_table(places["alerts"]), dedup_within="1 hour"
    ).awaitTermination()
    assert rows(hot.scan_trades(), "aggregate_id") == [(1,), (2,), (3,)]


def test_ingest_zero_mode(spark, places):
    hot = HotStore(spark, places["hot"])
    write_frames(spark, places["in"], "1", [trade(1)], extra=["junk"])
    source = frames.read_frames(spark, places["in"], streaming=True)
    ingest.start_ingest(
        source, hot, places["cp"], ingest.alert_table(places["alerts"]), on_bad_frame="zero"
    ).awaitTermination()
    assert rows(hot.scan_trades(), "symbol") == [("",), ("AAAUSDT",)]


def test_fan_out_to_hot_and_rejects(spark, places):
    made = trades(spark, [trade(1), large(2)])
    wire = envelopes.to_wire(
        envelopes.wrap_trades(made, F.lit("-")).unionByName(
            envelopes.wrap_notifications(alerts.build_notifications(made), F.lit("-"))
        )
    )
    wire.union(spark.createDataFrame([("junk",)], "value string")).coalesce(1).write.text(places["in"])
    hot = HotStore(spark, places["hot"])
    seen, bad = [], []
    handlers = {
        schemas.STORE_SUBSCRIBER: ingest.hot_handler(hot),
        schemas.ALERT_SUBSCRIBER: lambda df, batch: seen.extend(rows(df, "type")),
    }
    ingest.start_fan_out(
        spark.readStream.text(places["in"]), handlers, places["cp"],
        rejects=lambda df, batch: bad.extend(rows(df)),
    ).awaitTermination()
    assert rows(hot.scan_trades()) == rows(made)
    assert rows(hot.scan_notifications()) == rows(alerts.build_notifications(made))
    assert seen == [("BinanceTradeEvent",)] * 2
    assert bad == [("junk",)]


def test_two_streams_into_one_store(spark, places):
    """Streams, and new checkpoints, do not take each other's batches for their own."""
    hot = HotStore(spark, places["hot"])
    for n, checkpoint in ((1, "cp"), (2, "cp2")):
        folder = f"{places['in']}{n}"
        write_frames(spark, folder, "1", [large(n), trade(n + 10)])
        source = frames.read_frames(spark, folder, streaming=True)
        sink = ingest.alert_table(places["alerts"])
        ingest.start_ingest(source, hot, places[checkpoint], sink, places["bad"]).awaitTermination()
    assert sorted(rows(hot.scan_trades(), "aggregate_id")) == [(1,), (2,), (11,), (12,)]
    assert spark.read.parquet(places["alerts"]).count() == 2


def test_hot_handler_drops_nothing(spark, places):
    good = envelopes.wrap_trades(trades(spark, [trade(1)]), F.lit("-"))
    damaged = good.withColumn("event_data", F.lit('{"Price":"x"}')).withColumn("id", F.lit("bad"))
    other = good.withColumn("type", F.lit("Other")).withColumn("id", F.lit("other"))
    envelopes.to_wire(good.unionByName(damaged).unionByName(other)).coalesce(1).write.text(places["in"])
    hot = HotStore(spark, places["hot"])
    handlers = {schemas.STORE_SUBSCRIBER: ingest.hot_handler(hot)}
    ingest.start_fan_out(spark.readStream.text(places["in"]), handlers, places["cp"]).awaitTermination()
    assert hot.scan_trades().count() == 1
    assert rows(hot.scan(DOCUMENTS), "id", "type") == [("other", "Other")]
    assert rows(hot.scan(REJECTS), "id") == [("bad",)]


def test_hot_append_by_type(spark, places):
    write_frames(spark, places["in"], "1", [trade(1), trade(2)])
    stream = frames.decode_frames(frames.read_frames(spark, places["in"], streaming=True))
    for _ in range(2):
        ingest.start_hot_append(
            envelopes.wrap_trades(stream, F.lit("-")), places["out"], places["cp"]
        ).awaitTermination()
    assert os.path.isdir(f"{places['out']}/type=BinanceTradeEvent")
    assert spark.read.parquet(places["out"]).count() == 2


@pytest.mark.parametrize("grain", ["minute", "hourly"])
def test_stream_rollup_equals_batch_on_closed_buckets(spark, places, grain):
    made = [trade(n, trade_time=at(n * 97), price=float(n % 7 + 1)) for n in range(120)]
    for part in range(4):
        write_frames(spark, places["in"], str(part + 1), made[part * 30 : part * 30 + 30])
    source = frames.read_frames(spark, places["in"], streaming=True, maxFilesPerTrigger="1")
    rolled = live.stream_rollup(frames.decode_frames(source), grain, "1 minute", dedup_key="trade_id")
    live.start_stream_rollup(rolled, places["out"], places["cp"]).awaitTermination()
    got = rows(spark.read.parquet(places["out"]))
    batch = rollup.rollup(
        trades(spark, made).withColumn("triggered_notification", F.lit(False)), grain
    )
    name = schemas.GRAINS[grain][1]
    unit = "interval 1 minute" if grain == "minute" else "interval 1 hour"
    closed = batch.where(F.col(name) + F.expr(unit) <= F.lit(at(119 * 97 - 60)).cast("timestamp"))
    assert got == rows(closed)
    assert got


def test_late_trade_is_dropped_by_the_stream(spark, places):
    # A batch filters late rows by the watermark the batch before it started with.
    for n, made in enumerate(
        [
            [trade(1, trade_time=at(0)), trade(2, trade_time=at(7200))],
            [trade(3, trade_time=at(7300))],
            [trade(4, trade_time=at(1)), trade(5, trade_time=at(14400))],
        ]
    ):
        write_frames(spark, places["in"], str(n + 1), made)
    source = frames.read_frames(spark, places["in"], streaming=True, maxFilesPerTrigger="1")
    rolled = live.stream_rollup(frames.decode_frames(source), "hourly", "10 minutes")
    live.start_stream_rollup(rolled, places["out"], places["cp"]).awaitTermination()
    assert rows(spark.read.parquet(places["out"]), "trade_count") == [(1,), (2,)]


def test_late_trades_make_further_partial_states(spark, places):
    """Batches far behind the latest trade: rollups of the live states equal the batch ones."""
    made = [trade(n, trade_time=at(n * 613), price=0.1 * (n % 7 + 1), quantity=1e15 if n == 3 else 0.1) for n in range(60)]
    for part in range(4):
        # The newest trades come first.
        write_frames(spark, places["in"], str(part + 1), made[3 - part :: 4])
    source = frames.read_frames(spark, places["in"], streaming=True, maxFilesPerTrigger="1")
    for _ in range(2):
        live.start_state_stream(frames.decode_frames(source), places["out"], places["cp"]).awaitTermination()
    batch = trades(spark, made).withColumn("triggered_notification", F.lit(False))
    for grain in rollup.GRAINS:
        assert rows(lake.read_merged_rollups(spark, places["out"], grain)) == rows(rollup.rollup(batch, grain))
    assert len(os.listdir(f"{places['out']}/state")) == 4


def test_only_the_failing_handler_is_repeated(spark, places):
    wire = envelopes.to_wire(envelopes.wrap_trades(trades(spark, [trade(1)]), F.lit("-")))
    many = wire.select(F.replace("value", F.lit("consumer.telegrambot"), F.lit('third","consumer.telegrambot')).alias("value"))
    many.coalesce(1).write.text(places["in"])
    seen, broken = [], [True]

    def handler(name):
        def handle(df, batch):
            seen.append((name, df.count()))
            if name == "consumer.telegrambot" and broken[0]:
                raise OSError("away")

        return handle

    names = [schemas.STORE_SUBSCRIBER, schemas.ALERT_SUBSCRIBER, "third"]

    def run():
        ingest.start_fan_out(
            spark.readStream.text(places["in"]), {n: handler(n) for n in names}, places["cp"],
            rejects=lambda df, batch: seen.append(("rejects", df.count())),
        ).awaitTermination()

    with pytest.raises(Exception, match="away"):
        run()
    assert sorted(seen) == [("consumer.mongo", 1), ("consumer.telegrambot", 1), ("rejects", 0), ("third", 1)]
    seen.clear()
    broken[0] = False
    run()
    assert seen == [("consumer.telegrambot", 1)]
    seen.clear()
    run()
    assert seen == []
