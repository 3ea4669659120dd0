"""Curated projections of flagged trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.functions import times
from tapeloom.operators.matching import flag_trades


def amount_of_trades() -> Column:
    """Size of the inclusive id range, never negative."""
    return F.greatest(
        F.col("last_trade_id") - F.col("first_trade_id") + F.lit(1), F.lit(0).cast("bigint")
    )


def processed(flagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The seven processed columns; `keep` carries further ones, e.g. the aggregate id."""
    return flagged.select(
        "trade_time",
        "symbol",
        "price",
        "quantity",
        amount_of_trades().alias("amount_of_trades"),
        "is_buyer_maker",
        "triggered_notification",
        *keep,
    )


def curated(done: DataFrame) -> DataFrame:
    """Curated columns of processed trades: time to the millisecond, UTC date."""
    return done.select(
        "symbol",
        F.timestamp_millis(F.unix_millis("trade_time")).alias("trade_time"),
        "price",
        "quantity",
        "amount_of_trades",
        "is_buyer_maker",
        "triggered_notification",
        times.utc_date("trade_time").alias("date"),
    ).select(*schemas.CURATED.names)


def curate_trades(trades: DataFrame, notifications: DataFrame, mode: str = "exact") -> DataFrame:
    """Flag, project and date the trades."""
    return curated(processed(flag_trades(trades, notifications, mode)))
