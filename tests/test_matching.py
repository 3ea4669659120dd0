"""Trade / notification matching against a plain greedy pass."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import matching, purge
from tapeloom.session import session_conf

from helpers import T0, at, notice, notices, rows, trade, trades


def nano(t):
    text = t.strftime("%Y-%m-%dT%H:%M:%S.%f").rstrip("0").rstrip(".")
    return text + "Z"


def seconds(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def legacy(t):
    return t.strftime("%Y-%m-%d %H:%M:%S.%f").rstrip("0").rstrip(".") + " +0000 UTC"


def greedy(tape, stored, texts):
    """Walk the trades in order; each takes its first key that is stored and unused."""
    free, flagged, met = set(stored), set(), set()
    for number, symbol, event_time, trade_time in sorted(tape, key=lambda r: (r[3], r[0])):
        keys = [(symbol, f(event_time)) for f in texts]
        met.update(k for k in keys if k in set(stored))
        for key in keys:
            if key in free:
                free.remove(key)
                flagged.add(number)
                break
    return flagged, met


def flagged_numbers(df):
    return {r[0] for r in df.where("triggered_notification").select("aggregate_id").collect()}


@pytest.mark.parametrize("mode", ["exact", "compat"])
@pytest.mark.parametrize("seed", range(6))
def test_same_as_greedy(spark, mode, seed):
    rng = random.Random(seed)
    texts = [nano] if mode == "exact" else [nano, seconds, legacy]
    tape, stored = [], []
    for number in range(400):
        symbol = rng.choice(["A", "A", "B"])
        event_time = T0 + dt.timedelta(milliseconds=rng.randrange(0, 40) * 250)
        # Few distinct trade times, so that ties are common.
        tape.append((number, symbol, event_time, at(rng.randrange(30))))
    for _ in range(60):
        event_time = T0 + dt.timedelta(milliseconds=rng.randrange(0, 44) * 250)
        stored.append((rng.choice(["A", "B", "C"]), rng.choice([nano, seconds, legacy])(event_time)))
    trade_df = trades(
        spark,
        [trade(n, symbol=s, event_time=e, trade_time=t) for n, s, e, t in tape],
    )
    notice_df = notices(spark, [notice(text, symbol=s) for s, text in stored])
    want, met = greedy(tape, stored, texts)
    assert flagged_numbers(matching.flag_trades(trade_df, notice_df, mode)) == want
    matches = matching.match_notifications(trade_df, notice_df, mode)
    assert {tuple(r) for r in matches.select("symbol", "key_text").collect()} == met


def test_same_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(matching, "BROADCAST_KEYS", 0)
    test_same_as_greedy(spark, "exact", 1)
    test_same_as_greedy(spark, "compat", 1)


def test_ids_and_lookup_beyond_the_broadcast_bound(spark, monkeypatch):
    tape = trades(spark, [trade(n, event_time=at(n % 3)) for n in range(9)])
    # One notification meets no trade.
    found = notices(spark, [notice("2024-01-01T00:00:01Z", trade_id="t0004"), notice("2024-01-01T00:09:00Z", trade_id="t0099")])

    def outcome():
        flagged = matching.flag_trades(tape, found, "by_trade_id")
        return flagged_numbers(flagged), rows(matching.lookup_first_notification(tape, found), "trade_id")

    few = outcome()
    monkeypatch.setattr(matching, "BROADCAST_KEYS", 0)
    assert outcome() == few == ({4}, [("t0004",)])


def test_flagging_does_not_shuffle_the_tape(spark):
    tape = trades(spark, [trade(n) for n in range(50)])
    found = notices(spark, [notice("2024-01-01T00:00:00Z")])
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "10000"}):
        for mode in matching.MODES:
            plan = matching.flag_trades(tape, found, mode)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, mode


def test_consume_once(spark):
    tape = trades(spark, [trade(2), trade(1)])
    found = notices(spark, [notice("2024-01-01T00:00:00Z")])
    for mode in ("exact", "compat"):
        assert flagged_numbers(matching.flag_trades(tape, found, mode)) == {1}


def test_seconds_fallback(spark):
    times = [0.123, 0.0, 0.5, 0.5]
    tape = trades(spark, [trade(n, event_time=at(t)) for n, t in enumerate(times)])
    found = notices(
        spark, [notice("2024-01-01T00:00:00Z"), notice("2024-01-01T00:00:00.5Z")]
    )
    assert flagged_numbers(matching.flag_trades(tape, found, "compat")) == {0, 2}
    assert flagged_numbers(matching.flag_trades(tape, found, "exact")) == {1, 2}


def test_by_trade_id(spark):
    tape = trades(spark, [trade(1), trade(2)])
    found = notices(spark, [notice("x", trade_id="t0002"), notice("y", trade_id="t0002")])
    flagged = matching.flag_trades(tape, found, "by_trade_id")
    assert flagged.count() == 2
    assert flagged_numbers(flagged) == {2}


def test_unknown_layout_never_matches(spark):
    tape = trades(spark, [trade(1, event_time=at(0.12))])
    found = notices(spark, [notice("2024-01-01T00:00:00.120Z"), notice("yesterday")])
    assert flagged_numbers(matching.flag_trades(tape, found, "compat")) == set()


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        matching.match_notifications(trades(spark, [trade(1)]), notices(spark, [notice("x")]), "any")


def test_candidate_keys(spark):
    tape = trades(spark, [trade(1, event_time=at(0.123)), trade(2, event_time=at(7))])
    got = rows(matching.notification_keys(tape), "trade_id", "priority", "event_time")
    assert got == [
        ("t0001", 0, "2024-01-01T00:00:00.123Z"),
        ("t0001", 1, "2024-01-01T00:00:00Z"),
        ("t0001", 2, "2024-01-01 00:00:00.123 +0000 UTC"),
        ("t0002", 0, "2024-01-01T00:00:07Z"),
        ("t0002", 1, "2024-01-01 00:00:07 +0000 UTC"),
    ]
    assert matching.distinct_keys(tape.union(tape)).count() == 5


def test_first_notification_per_key(spark):
    tape = trades(spark, [trade(1)])
    found = notices(
        spark,
        [
            notice("2024-01-01T00:00:00Z", trade_id="b"),
            notice("2024-01-01T00:00:00Z", trade_id="a"),
            notice("2024-01-01T00:00:01Z", trade_id="c"),
        ],
    )
    assert rows(matching.lookup_first_notification(tape, found), "trade_id") == [("a",)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    tape = spark.range(1000).select(
        F.concat(F.lit("A"), (F.col("id") % 1).cast("string")).alias("symbol"),
        F.timestamp_micros(F.col("id") % 1).alias("event_time"),
        F.timestamp_micros("id").alias("trade_time"),
        F.col("id").alias("aggregate_id"),
    )
    found = notices(spark, [notice("1970-01-01T00:00:00Z", symbol="A0")])

    def plan(mode):
        return matching.match_notifications(tape, found, mode)._jdf.queryExecution().executedPlan().toString()

    exact = plan("exact")
    assert "partial_min_by(aggregate_id" in exact and "SortAggregate" not in exact
    compat = plan("compat")
    assert "row_number(), 3, Partial" in compat
    assert compat.count("row_number(), 3, Partial") == 1, "the tape is read once"
    for text in (exact, compat):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_purge_by_key(spark):
    df = notices(
        spark,
        [
            notice("e1", symbol="A", trade_id="1"),
            notice("e2", symbol="B", trade_id="2"),
            notice("e3", symbol="C", trade_id="3"),
        ],
    )
    shape = "symbol string, event_time string, trade_id string"

    def left(*keys):
        kept = purge.purge_notifications_by_key(df, spark.createDataFrame(list(keys), shape))
        return [r[0] for r in rows(kept, "symbol")]

    assert left(("A", None, None), (None, "e2", "")) == ["C"]
    assert left(("A", "e2", None), ("B", "e2", "9"), ("C", None, "3")) == ["A", "B"]
    assert left(("A", "e1", "1")) == ["B", "C"]
    with pytest.raises(ValueError, match="at least one"):
        left(("A", None, None), ("", None, None))
    plan = purge.purge_notifications_by_key(
        df, spark.createDataFrame([("A", None, None), (None, "e2", None)], shape)
    )._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan


def test_purge_by_ids(spark):
    tape = trades(spark, [trade(1), trade(2)])
    gone = spark.createDataFrame([("t0001",), ("t0001",), ("zz",)], "trade_id string")
    assert rows(purge.purge_trades(tape, gone), "trade_id") == [("t0002",)]
    found = notices(spark, [notice("a", trade_id="t0001"), notice("b", trade_id="t0003")])
    assert rows(purge.purge_notifications_by_trade_id(found, gone), "trade_id") == [("t0003",)]
