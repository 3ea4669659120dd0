"""Matching trades with the notifications in the hot store.

A notification is found by (symbol, event time text). A trade offers up to three texts in
priority order: RFC 3339 with fraction, RFC 3339 in seconds, legacy layout. Per key there
is one notification, and the first trade in trade-time order to ask for it consumes it.

No step gathers a key's trades in one place: `exact` needs the least trade per key, which
is a partial aggregate; `compat` needs the three least, which is a group limit applied
before the shuffle. A trade is identified by (symbol, event_time, trade_time,
aggregate_id), so the join back to the tape spreads even a key that holds most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import ordering, times
from tapeloom.session import at_most

MODES = ("exact", "compat", "by_trade_id")

# Keys are broadcast up to this many rows (under 100 bytes each).
BROADCAST_KEYS = 500_000


# What identifies a trade in the output of the matching.
_TRADE_KEY = ["symbol", "event_time", "trade_time", "aggregate_id"]

# Texts exactly as a trade writes them: no trailing zeros, microseconds at most.
_NANO_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,5}[1-9])?Z$"
_LEGACY_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{0,5}[1-9])? \+0000 UTC$"


def notification_keys(trades: DataFrame) -> DataFrame:
    """(trade_id, symbol, priority, event_time) candidate keys; equal texts collapse."""
    texts = F.array_distinct(
        F.array(
            times.rfc3339_nano("event_time"),
            times.rfc3339_seconds("event_time"),
            times.legacy_text("event_time"),
        )
    )
    return trades.select("trade_id", "symbol", F.posexplode(texts).alias("priority", "event_time"))


def distinct_keys(trades: DataFrame) -> DataFrame:
    """Distinct (symbol, event_time text) candidate keys.

    Distinct on the timestamp first: three texts a key are made once, not once a trade.
    """
    seen = trades.select("symbol", "event_time").distinct()
    return notification_keys(seen.withColumn("trade_id", F.lit(None).cast("string"))).select(
        "symbol", "event_time"
    ).distinct()


def first_per_key(notifications: DataFrame) -> DataFrame:
    """One notification per (symbol, event_time): the one with the least trade id."""
    order = Window.partitionBy("symbol", "event_time").orderBy(
        "trade_id", "total_price", "price", "quantity"
    )
    return (
        notifications.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") == 1)
        .drop("rank")
    )


def _second(name: str) -> Column:
    return F.date_trunc("second", name)


def _stored_keys(notifications: DataFrame) -> DataFrame:
    """Distinct notification keys as (symbol, legacy, at).

    A text that is not in the exact layout a trade would write can never be met.
    """
    text = F.col("event_time")
    return (
        notifications.select(
            "symbol",
            F.when(text.rlike(_LEGACY_TEXT), True).when(text.rlike(_NANO_TEXT), False).alias("legacy"),
            F.replace(text, F.lit(times.LEGACY_SUFFIX), F.lit("Z")).try_cast("timestamp").alias("at"),
        )
        .where(F.col("legacy").isNotNull() & F.col("at").isNotNull())
        .distinct()
    )


def lookup_first_notification(trades: DataFrame, notifications: DataFrame) -> DataFrame:
    """At most one notification per candidate key of the trades."""
    seconds = _stored_keys(notifications).select("symbol", _second("at").alias("second")).distinct()
    tape = trades.select("symbol", "event_time", _second("event_time").alias("second"))
    if at_most(seconds, BROADCAST_KEYS):
        # All texts of a trade lie in its second.
        tape = tape.join(F.broadcast(seconds), ["symbol", "second"], "left_semi")
    return (
        first_per_key(notifications)
        .join(distinct_keys(tape), ["symbol", "event_time"], "left_semi")
        .select(*notifications.columns)
    )


def _match_exact(trades: DataFrame, notifications: DataFrame) -> tuple[DataFrame, bool]:
    """The matches, and whether their number was found small: one trade a key at most."""
    keys = (
        _stored_keys(notifications)
        .where(~F.col("legacy"))
        .select("symbol", F.col("at").alias("event_time"))
    )
    tape = trades.select(*_TRADE_KEY)
    few = at_most(keys, BROADCAST_KEYS)
    if few:
        # Drops the trades no key can meet before anything is shuffled.
        tape = tape.join(F.broadcast(keys), ["symbol", "event_time"], "left_semi")
    firsts = tape.groupBy("symbol", "event_time").agg(
        F.min("trade_time").alias("trade_time"),
        F.min_by("aggregate_id", ordering.first_key("trade_time", "aggregate_id")).alias(
            "aggregate_id"
        ),
    )
    if not few:
        # Reduced to a row per key first; the join then has the same partitioning.
        firsts = firsts.join(keys, ["symbol", "event_time"], "left_semi")
    found = firsts.select(
        "symbol",
        times.rfc3339_nano("event_time").alias("key_text"),
        "event_time",
        "trade_time",
        "aggregate_id",
    )
    return found, few


def _match_compat(trades: DataFrame, notifications: DataFrame) -> tuple[DataFrame, bool]:
    """Outcome of the greedy pass over all three keys, without the pass.

    Call the trades of one exact event time a group. The fraction key and the legacy key
    belong to one group; the seconds key is shared by the groups of that second (a
    whole-second group has it as its own first key). So in each group at most one trade
    takes the fraction key: its first. The next trade, if any, is the group's only
    possible taker of the shared key, which goes to the earliest such trade of the second.
    The legacy key goes to the next trade of the group that did not get the shared one.
    Three trades a group therefore decide everything.
    """
    stored = _stored_keys(notifications).withColumn("second", _second("at"))
    few = at_most(stored, BROADCAST_KEYS)
    # Times with a key, per second: at most two entries a distinct time.
    keys = stored.groupBy("symbol", "second").agg(
        F.collect_list(F.when(~F.col("legacy"), F.col("at"))).alias("standard_at"),
        F.collect_list(F.when(F.col("legacy"), F.col("at"))).alias("legacy_at"),
    )

    def with_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
        own = F.array_contains("standard_at", F.col("event_time"))
        return (
            df.join(keys, ["symbol", "second"])
            .withColumn("has_fraction_key", own & (F.col("event_time") != F.col("second")))
            .withColumn("has_shared", F.array_contains("standard_at", F.col("second")))
            .withColumn("has_legacy", F.array_contains("legacy_at", F.col("event_time")))
            .where("has_fraction_key or has_shared or has_legacy")
            .drop("standard_at", "legacy_at")
        )

    flags = ["has_fraction_key", "has_shared", "has_legacy"]
    tape = trades.select(*_TRADE_KEY, _second("event_time").alias("second"))
    if few:
        tape = with_keys(tape, F.broadcast(keys))
    order = Window.partitionBy("symbol", "event_time").orderBy("trade_time", "aggregate_id")
    top = tape.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 3)

    # Time and id of the first three apart: fixed-width values keep the hash aggregate.
    ranked = [
        F.max(F.when(F.col("rank") == n, F.col(part))).alias(f"{part}_{n}")
        for n in (1, 2, 3)
        for part in ("trade_time", "aggregate_id")
    ]
    carried = [F.bool_or(name).alias(name) for name in flags] if few else []
    groups = top.groupBy("symbol", "event_time").agg(
        F.max("second").alias("second"), *ranked, *carried
    )
    if not few:
        groups = with_keys(groups, keys)

    def at_rank(n: int) -> Column:
        pair = F.struct(
            F.col(f"trade_time_{n}").alias("trade_time"),
            F.col(f"aggregate_id_{n}").alias("aggregate_id"),
        )
        return F.when(F.col(f"trade_time_{n}").isNotNull(), pair)

    # Candidates for the shared key, and those behind them in the same group.
    fraction = F.col("has_fraction_key")
    front = F.when(fraction, at_rank(2)).otherwise(at_rank(1))
    behind = F.when(fraction, at_rank(3)).otherwise(at_rank(2))
    groups = groups.withColumn("front", front).withColumn("behind", behind)
    # At most one row per distinct event time of the second, however many trades there are.
    of_second = Window.partitionBy("symbol", "second")
    groups = groups.withColumn("shared_taker", F.min("front").over(of_second))
    got_shared = F.col("has_shared") & F.col("front").eqNullSafe(F.col("shared_taker"))

    def key(text: Column, taker: Column) -> Column:
        return F.struct(text.alias("key_text"), taker.alias("taker"))

    found = F.array(
        F.when(fraction, key(times.rfc3339_nano("event_time"), at_rank(1))),
        F.when(
            F.col("has_shared"),
            key(times.rfc3339_seconds("event_time"), F.when(got_shared, F.col("front"))),
        ),
        F.when(
            F.col("has_legacy"),
            key(
                times.legacy_text("event_time"),
                F.when(got_shared, F.col("behind")).otherwise(F.col("front")),
            ),
        ),
    )
    matches = (
        groups.select("symbol", "event_time", F.explode(found).alias("k"))
        .where(F.col("k").isNotNull())
        .select(
            "symbol", "k.key_text", "event_time", "k.taker.trade_time", "k.taker.aggregate_id"
        )
    )
    # A key is consumed by one trade at most, so few keys mean few takers.
    return matches, few


def _match_trade_id(trades: DataFrame, notifications: DataFrame) -> DataFrame:
    keys = notifications.select("trade_id", F.col("event_time").alias("key_text")).distinct()
    if at_most(keys, BROADCAST_KEYS):
        keys = F.broadcast(keys)
    return (
        trades.select("trade_id", *_TRADE_KEY)
        .join(keys, "trade_id")
        .select("symbol", "key_text", "event_time", "trade_time", "aggregate_id", "trade_id")
    )


def match_notifications(trades: DataFrame, notifications: DataFrame, mode: str = "exact") -> DataFrame:
    """(symbol, key_text, event_time, trade_time, aggregate_id): keys some trade can meet.

    Trade time and aggregate id name the trade that consumes the key; a key that could be
    met but was not consumed has nulls there (`compat` only).
    `exact` uses the first key text only, `compat` all three, `by_trade_id` the trade id,
    which it adds as a column.
    Trades must be free of redelivered copies (`dedup_events`).
    """
    if mode == "exact":
        return _match_exact(trades, notifications)[0]
    if mode == "compat":
        return _match_compat(trades, notifications)[0]
    if mode == "by_trade_id":
        return _match_trade_id(trades, notifications)
    raise ValueError(f"unknown mode: {mode}")


def flag_matched(trades: DataFrame, matches: DataFrame, stored: bool = False, few: bool = False) -> DataFrame:
    """Trades plus `triggered_notification`, from the output of `match_notifications`.

    Few enough matches are broadcast, which spares the shuffle of the whole tape: known to
    be `few`, or `stored` (read from files), and then counted here.
    """
    taken = (
        matches.where(F.col("aggregate_id").isNotNull())
        .select(*_TRADE_KEY)
        .distinct()
        .withColumn("taken", F.lit(True))
    )
    if few or (stored and at_most(taken, BROADCAST_KEYS)):
        taken = F.broadcast(taken)
    return trades.join(taken, _TRADE_KEY, "left").select(
        *trades.columns, F.coalesce("taken", F.lit(False)).alias("triggered_notification")
    )


def flag_trades(trades: DataFrame, notifications: DataFrame, mode: str = "exact") -> DataFrame:
    """Trades plus `triggered_notification`; every notification key is consumed once."""
    if mode == "by_trade_id":
        ids = notifications.select("trade_id").distinct().withColumn("taken", F.lit(True))
        if at_most(ids, BROADCAST_KEYS):
            ids = F.broadcast(ids)
        return trades.join(ids, "trade_id", "left").select(
            *trades.columns, F.coalesce("taken", F.lit(False)).alias("triggered_notification")
        )
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    match = _match_exact if mode == "exact" else _match_compat
    matches, few = match(trades, notifications)
    return flag_matched(trades, matches, few=few)
