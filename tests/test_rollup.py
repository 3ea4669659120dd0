"""Rollups, curated rows and the merge of partial runs."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import curate, rollup

from helpers import T0, at, rows, trade, trades


def flagged(spark, made, flags=()):
    df = trades(spark, made)
    return df.withColumn("triggered_notification", F.col("aggregate_id").isin(list(flags)))


def test_ties(spark):
    df = flagged(
        spark,
        [
            trade(2, price=11.0, trade_time=at(1)),
            trade(1, price=10.0, trade_time=at(1)),
            trade(4, price=13.0, trade_time=at(5)),
            trade(3, price=12.0, trade_time=at(5)),
        ],
        flags=[1, 4],
    )
    for grain in rollup.GRAINS:
        row = rollup.rollup(df, grain).first()
        assert (row.first_price, row.last_price) == (10.0, 12.0)
        assert (row.min_price, row.max_price, row.avg_price) == (10.0, 13.0, 11.5)
        assert (row.volume, row.trade_count, row.notifications_triggered) == (4.0, 4, 2)


def test_columns(spark):
    df = flagged(spark, [trade(1)])
    for grain in rollup.GRAINS:
        out = rollup.rollup(df, grain)
        assert out.columns == schemas.rollup(grain).names
        assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.rollup(grain)]


def test_empty_input_has_no_rows(spark):
    df = flagged(spark, [trade(1)]).where("false")
    assert all(out.count() == 0 for out in rollup.process(df).values())


def by_hand(made, grain):
    """Plain one-pass statistics per (symbol, bucket)."""
    groups = defaultdict(list)
    for t in made:
        r = dict(zip(schemas.TRADE.names, t))
        cut = {
            "minute": dict(second=0, microsecond=0),
            "hourly": dict(minute=0, second=0, microsecond=0),
            "daily": dict(hour=0, minute=0, second=0, microsecond=0),
        }[grain]
        groups[r["symbol"], r["trade_time"].replace(**cut)].append(r)
    out = []
    for (symbol, start), g in groups.items():
        prices = [r["price"] for r in g]
        first = min(g, key=lambda r: (r["trade_time"], r["aggregate_id"]))
        last = max(g, key=lambda r: (r["trade_time"], -r["aggregate_id"]))
        out.append(
            (symbol, start.strftime("%Y-%m-%d"), start.strftime("%Y-%m-%d %H:%M:%S.%f"),
             min(prices), max(prices), round(sum(prices) / len(prices), 6),
             sum(r["quantity"] for r in g), len(g),
             sum(r["aggregate_id"] % 10 == 0 for r in g), first["price"], last["price"])
        )
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def random_tape():
    rng = random.Random(7)
    return [
        trade(
            n,
            symbol=rng.choice(["A", "A", "A", "B"]),
            price=float(rng.randrange(1, 100)),
            quantity=float(rng.randrange(1, 5)),
            trade_time=T0 + dt.timedelta(seconds=rng.randrange(0, 3 * 86400, 17), microseconds=rng.choice([0, 1, 999_999])),
        )
        for n in range(1500)
    ]


def test_against_plain_pass(spark, random_tape):
    df = flagged(spark, random_tape, [n for n in range(0, 1500, 10)])
    for grain, out in rollup.process(df).items():
        got = rows(out.withColumn("avg_price", F.round("avg_price", 6)))
        assert got == by_hand(random_tape, grain)


def test_merged_states_equal_one_pass(spark, random_tape):
    df = flagged(spark, random_tape, [n for n in range(0, 1500, 10)])
    parts = [rollup.minute_state(df.where(F.col("aggregate_id") % 3 == k)) for k in range(3)]
    merged = rollup.merge_states(parts)
    assert rows(rollup.publish(merged, "daily")) == rows(rollup.rollup(df, "daily"))
    assert rows(merged) == rows(rollup.minute_state(df))


def test_merge_partials(spark):
    df = flagged(spark, [trade(1, price=1.0), trade(2, price=2.0), trade(3, price=9.0, trade_time=at(1))])
    a = rollup.rollup(df.where("aggregate_id < 3"), "hourly")
    b = rollup.rollup(df.where("aggregate_id = 3"), "hourly")
    merged = rollup.merge_partials(a.unionByName(b), "hourly")
    assert rows(merged, "min_price", "max_price", "avg_price", "volume", "trade_count") == [
        (1.0, 9.0, 4.0, 3.0, 3)
    ]


def test_hash_aggregates_only(spark, random_tape):
    df = flagged(spark, random_tape)
    for grain in rollup.GRAINS:
        plan = rollup.rollup(df, grain)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_ids_of_any_size(spark):
    """A later small id, an earlier large one, and ties between ids far apart."""
    made = [
        trade(1, aggregate_id=2**38, price=20.0, trade_time=at(30)),
        trade(2, aggregate_id=7, price=10.0, trade_time=at(10)),
        trade(3, aggregate_id=-(2**63), price=30.0, trade_time=at(30)),
        trade(4, aggregate_id=2**63 - 1, price=5.0, trade_time=at(10)),
    ]
    row = rollup.rollup(flagged(spark, made), "minute").first()
    assert (row.first_price, row.last_price) == (10.0, 30.0)
    states = [rollup.minute_state(flagged(spark, [t])) for t in made]
    row = rollup.publish(rollup.merge_states(states), "minute").first()
    assert (row.first_price, row.last_price) == (10.0, 30.0)


def test_curated(spark):
    df = flagged(
        spark,
        [
            trade(1, first_trade_id=5, last_trade_id=3, trade_time=at(0.123456)),
            trade(2, first_trade_id=5, last_trade_id=7, trade_time=at(86399.9999)),
        ],
        flags=[2],
    )
    out = curate.curated(curate.processed(df))
    assert out.columns == schemas.CURATED.names
    assert rows(out, "amount_of_trades", "trade_time", "date", "triggered_notification") == [
        (0, "2024-01-01 00:00:00.123000", "2024-01-01", False),
        (3, "2024-01-01 23:59:59.999000", "2024-01-01", True),
    ]
