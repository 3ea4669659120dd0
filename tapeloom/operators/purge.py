"""Key-based deletes, as anti joins that yield the remaining rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = ("symbol", "event_time", "trade_id")


def purge_trades(trades: DataFrame, ids: DataFrame) -> DataFrame:
    """Trades whose `trade_id` is not listed."""
    return trades.join(ids.select("trade_id"), "trade_id", "left_anti").select(*trades.columns)


def purge_notifications_by_trade_id(notifications: DataFrame, ids: DataFrame) -> DataFrame:
    return notifications.join(ids.select("trade_id"), "trade_id", "left_anti").select(
        *notifications.columns
    )


def purge_notifications_by_key(notifications: DataFrame, keys: DataFrame) -> DataFrame:
    """Notifications no key matches; a null or empty part of a key matches anything.

    Keys are split by which parts are set (at most seven kinds), and each kind is an equi
    anti join. An all-blank key would delete everything and is refused.
    """
    parts = [F.when(F.col(p) != "", F.col(p)).alias(p) for p in _PARTS]
    keys = keys.select(*parts).distinct()
    kinds = keys.select(*[F.col(p).isNotNull().alias(p) for p in _PARTS]).distinct().collect()
    if any(not any(kind) for kind in kinds):
        raise ValueError("a purge key needs at least one of symbol, event_time, trade_id")
    left = notifications
    for kind in sorted(kinds):
        used = [p for p in _PARTS if kind[p]]
        of_kind = keys
        for p in _PARTS:
            of_kind = of_kind.where(F.col(p).isNotNull() if kind[p] else F.col(p).isNull())
        left = left.join(of_kind.select(*used), used, "left_anti")
    return left.select(*notifications.columns)
