"""Large-trade alerts and the notifications they publish (batch or stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import numbers, times

# Alert threshold and message layout.
THRESHOLD = 2_000_000.0
MESSAGE = "🚨 *Trade Alert!*\nSymbol: %s\nPrice: %s\nQty: %s\nTotalPrice: %s"


def notional() -> Column:
    return F.col("price") * F.col("quantity")


def is_large(threshold: float = THRESHOLD) -> Column:
    """Strictly more than the threshold."""
    return notional() > F.lit(float(threshold))


def detect_alerts(trades: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return trades.where(is_large(threshold))


def alert_text() -> Column:
    return F.format_string(
        MESSAGE,
        F.col("symbol"),
        numbers.fixed6("price"),
        numbers.fixed6("quantity"),
        numbers.money_text(notional()),
    )


def alert_messages(trades: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(trade_id, message) of every alert."""
    return detect_alerts(trades, threshold).select("trade_id", alert_text().alias("message"))


def build_notifications(trades: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Notification records of the alerting trades."""
    return detect_alerts(trades, threshold).select(
        times.rfc3339_nano("event_time").alias("event_time"),
        "price",
        "quantity",
        "symbol",
        "is_buyer_maker",
        notional().alias("total_price"),
        "trade_id",
    )
