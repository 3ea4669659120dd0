"""Minute / hourly / daily price and volume rollups.

One pass over the trades builds the minute state; hours and days come from that much
smaller table. The state of two runs merges exactly, first and last price and the sums of
prices and quantities included: none of them depends on the order of rows or runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.functions import exactsum, ordering, times

GRAINS = tuple(schemas.GRAINS)


def bucket(grain: str, time: str = "trade_time") -> Column:
    unit, name = schemas.GRAINS[grain]
    return F.date_trunc(unit, time).alias(name)


def _measures() -> list[Column]:
    return [
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        *exactsum.sums("price", "price"),
        *exactsum.sums("quantity", "volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.col("triggered_notification").cast("bigint")).alias("notifications_triggered"),
    ]


def _ends(first: Column, last: Column) -> list[Column]:
    return [
        F.min(first).alias("first_key"),
        F.min_by("price", first).alias("first_price"),
        F.max(last).alias("last_key"),
        F.max_by("price", last).alias("last_price"),
    ]


def minute_state(trades: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mergeable state per (symbol, minute) of trades with `triggered_notification`.

    First / last order by (trade_time, aggregate_id) to the microsecond, for any id. The
    tape itself is ordered by a long, per high part of the ids; those few rows a minute are
    then merged like the states of several runs. `by` adds grouping columns, e.g. a run id.
    """
    first = ordering.minute_first_key("trade_time", "aggregate_id")
    last = ordering.minute_last_key("trade_time", "aggregate_id")
    high = ordering.id_high("aggregate_id").alias("id_high")
    parts = trades.groupBy(*by, "symbol", bucket("minute"), high).agg(
        *_measures(), *_ends(first, last)
    )
    return merge_states(
        parts.select(
            *by,
            "symbol",
            "minute_start",
            "min_price",
            "max_price",
            *exactsum.carried("price"),
            *exactsum.carried("volume"),
            "trade_count",
            "notifications_triggered",
            ordering.key_time("first_key", "minute_start").alias("first_time"),
            ordering.key_id("first_key", "id_high").alias("first_id"),
            "first_price",
            ordering.key_time("last_key", "minute_start").alias("last_time"),
            ordering.key_id("last_key", "id_high", last=True).alias("last_id"),
            "last_price",
        ),
        by,
    )


def merge_states(states: DataFrame | Iterable[DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    """One state row per (symbol, minute) from the rows of any number of runs."""
    if not isinstance(states, DataFrame):
        states = reduce(DataFrame.unionByName, states)
    first = ordering.first_order("first_time", "first_id")
    last = ordering.last_order("last_time", "last_id")
    merged = states.groupBy(*by, "symbol", "minute_start").agg(
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *exactsum.merged("price"),
        *exactsum.merged("volume"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("notifications_triggered").alias("notifications_triggered"),
        F.min("first_time").alias("first_time"),
        F.min_by("first_id", first).alias("first_id"),
        F.min_by("first_price", first).alias("first_price"),
        F.max("last_time").alias("last_time"),
        F.max_by("last_id", last).alias("last_id"),
        F.max_by("last_price", last).alias("last_price"),
    )
    small = {c: exactsum.carried(c) for c in ("price", "volume")}
    columns = [c for c in merged.columns if c not in {n for name in small for n in exactsum.names(name)}]
    return merged.select(*columns, *small["price"], *small["volume"])


def publish(state: DataFrame, grain: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The eleven published columns of a grain from merged minute state.

    A symbol has one row a minute, so the minute itself orders first and last.
    """
    name = schemas.GRAINS[grain][1]
    if grain == "minute":
        rows = state
    else:
        at = F.unix_micros("minute_start")
        rows = state.groupBy(*by, "symbol", bucket(grain, "minute_start")).agg(
            F.min("min_price").alias("min_price"),
            F.max("max_price").alias("max_price"),
            *exactsum.merged("price"),
            *exactsum.merged("volume"),
            F.sum("trade_count").alias("trade_count"),
            F.sum("notifications_triggered").alias("notifications_triggered"),
            F.min_by("first_price", at).alias("first_price"),
            F.max_by("last_price", at).alias("last_price"),
        )
    return rows.select(
        *by,
        "symbol",
        times.utc_date(name).alias("date"),
        name,
        "min_price",
        "max_price",
        (exactsum.total("price") / F.col("trade_count")).alias("avg_price"),
        exactsum.total("volume").alias("volume"),
        "trade_count",
        "notifications_triggered",
        "first_price",
        "last_price",
    )


def rollup(trades: DataFrame, grain: str) -> DataFrame:
    """Rollup of one grain straight from flagged trades.

    An hour or a day comes from the minute state, but never needs it stored.
    """
    return publish(minute_state(trades), grain)


def process(trades: DataFrame) -> dict[str, DataFrame]:
    """All three grains."""
    state = minute_state(trades)
    return {grain: publish(state, grain) for grain in GRAINS}


def merge_partials(rows: DataFrame, grain: str) -> DataFrame:
    """Combine the rows several runs published for one bucket.

    First and last price are not recoverable from published rows and are left out; the
    lake's merged reader has them, from the minute state.
    """
    name = schemas.GRAINS[grain][1]
    merged = rows.groupBy("symbol", "date", name).agg(
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *exactsum.sums(F.col("avg_price") * F.col("trade_count"), "price"),
        *exactsum.sums("volume", "volume"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("notifications_triggered").alias("notifications_triggered"),
    )
    return merged.select(
        "symbol",
        "date",
        name,
        "min_price",
        "max_price",
        (exactsum.total("price") / F.col("trade_count")).alias("avg_price"),
        exactsum.total("volume").alias("volume"),
        "trade_count",
        "notifications_triggered",
    )
