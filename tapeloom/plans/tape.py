"""A trade tape over the `events` table of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import alerts
from tapeloom.session import prepare


def trades_from(events: DataFrame, event_time: Column | None = None, trade_time: Column | None = None) -> DataFrame:
    """Events as trades; the event time is coarse, so that many trades share a key."""
    ts = F.col("ts").cast("timestamp")
    event_id = F.col("event_id")
    rows = events.select(
        event_id.cast("string").alias("trade_id"),
        F.concat(F.lower("event_type"), F.lit("usdt@aggTrade")).alias("stream"),
        F.lit("aggTrade").alias("event_type"),
        (F.date_trunc("hour", ts) if event_time is None else event_time).alias("event_time"),
        event_id.alias("aggregate_id"),
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
        (F.col("value") * 100.0).alias("price"),
        (1 + (event_id * 37) % 200).cast("double").alias("quantity"),
        event_id.alias("first_trade_id"),
        (event_id + (event_id % 7) - 3).alias("last_trade_id"),
        (ts if trade_time is None else trade_time).alias("trade_time"),
        ((event_id % 2) == 0).alias("is_buyer_maker"),
    )
    return rows.select(*schemas.TRADE.names)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from(events(spark, sf_dir))


def tied_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade times cut to the hour: many equal times, for first / last ties."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return trades_from(events(spark, sf_dir), trade_time=hour)


def split_second_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times at four fractions of one second an hour, for the fallback keys."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    at = F.timestamp_micros(F.unix_micros(hour) + (F.col("event_id") % 4) * 250_000)
    return trades_from(events(spark, sf_dir), event_time=at)


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.build_notifications(trades(spark, sf_dir))
