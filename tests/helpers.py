"""Hand-made trades and notifications."""

from __future__ import annotations

import datetime as dt

from tapeloom import schemas

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds: float = 0.0) -> dt.datetime:
    return T0 + dt.timedelta(microseconds=round(seconds * 1_000_000))


def trade(number: int, **over: object) -> tuple:
    row = {
        "trade_id": f"t{number:04d}",
        "stream": "aaausdt@aggTrade",
        "event_type": "aggTrade",
        "event_time": at(),
        "aggregate_id": number,
        "symbol": "AAAUSDT",
        "price": 10.0,
        "quantity": 1.0,
        "first_trade_id": number,
        "last_trade_id": number,
        "trade_time": at(number),
        "is_buyer_maker": False,
    } | over
    return tuple(row[name] for name in schemas.TRADE.names)


def notice(event_time: str, **over: object) -> tuple:
    row = {
        "event_time": event_time,
        "price": 10.0,
        "quantity": 1.0,
        "symbol": "AAAUSDT",
        "is_buyer_maker": False,
        "total_price": 10.0,
        "trade_id": "t0001",
    } | over
    return tuple(row[name] for name in schemas.NOTIFICATION.names)


def trades(spark, rows):
    return spark.createDataFrame(rows, schemas.TRADE)


def notices(spark, rows):
    return spark.createDataFrame(rows, schemas.NOTIFICATION)


def rows(df, *columns):
    """Sorted tuples, times as UTC text."""
    from pyspark.sql import functions as F

    picked = df.select(*(columns or df.columns))
    texts = [
        F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) if t == "timestamp" else F.col(n)
        for n, t in picked.dtypes
    ]
    return sorted((tuple(r) for r in picked.select(*texts).collect()), key=repr)
