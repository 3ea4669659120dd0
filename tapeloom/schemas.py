"""Record schemas of the tape: frames, trades, notifications, curated rows, rollups."""

from __future__ import annotations

from pyspark.sql import types as T

# One exchange frame. The single-letter keys differ only in case
# (`e`/`E`), so the parsed struct is renamed by position right after parsing.
FRAME_JSON = (
    "stream string, "
    "data struct<e:string, E:bigint, a:bigint, s:string, p:string, q:string, "
    "f:bigint, l:bigint, T:bigint, m:boolean>, "
    "malformed string"
)
FRAME_FIELDS = (
    "struct<stream:string, "
    "data:struct<event_type:string, event_ms:bigint, aggregate_id:bigint, symbol:string, "
    "price_text:string, quantity_text:string, first_trade_id:bigint, last_trade_id:bigint, "
    "trade_ms:bigint, is_buyer_maker:boolean>, "
    "malformed:string>"
)

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("aggregate_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("first_trade_id", T.LongType()),
        T.StructField("last_trade_id", T.LongType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)

NOTIFICATION = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("total_price", T.DoubleType()),
        T.StructField("trade_id", T.StringType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subscribers", T.ArrayType(T.StringType())),
        T.StructField("type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_data", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

# What an envelope says about its payload; the type is the table's name.
ABOUT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("subscribers", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

CURATED = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("amount_of_trades", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("triggered_notification", T.BooleanType()),
        T.StructField("date", T.StringType()),
    ]
)

# Wire names of the payload fields, in payload order.
TRADE_WIRE = {
    "trade_id": "ID",
    "stream": "Stream",
    "event_type": "EventType",
    "event_time": "EventTime",
    "aggregate_id": "AggregateID",
    "symbol": "Symbol",
    "price": "Price",
    "quantity": "Quantity",
    "first_trade_id": "FirstTradeID",
    "last_trade_id": "LastTradeID",
    "trade_time": "TradeTime",
    "is_buyer_maker": "IsBuyerMaker",
}
NOTIFICATION_WIRE = {
    "event_time": "EventTime",
    "price": "Price",
    "quantity": "Quantity",
    "symbol": "Symbol",
    "is_buyer_maker": "IsBuyerMaker",
    "total_price": "TotalPrice",
    "trade_id": "TradeID",
}

# Event types, sources and subscribers of the envelopes.
TRADE_EVENT = "BinanceTradeEvent"
NOTIFICATION_EVENT = "NotificationEvent"
TRADE_SOURCE = "WebSocketStreamServer"
NOTIFICATION_SOURCE = "TelegramBot"
STORE_SUBSCRIBER = "consumer.mongo"
ALERT_SUBSCRIBER = "consumer.telegrambot"

# Grain name -> (date_trunc unit, bucket column).
GRAINS = {
    "minute": ("minute", "minute_start"),
    "hourly": ("hour", "hour_start"),
    "daily": ("day", "day_start"),
}


def wire_schema(schema: T.StructType, names: dict[str, str]) -> T.StructType:
    """The JSON shape of a payload: wire names, times as text."""
    return T.StructType(
        [
            T.StructField(
                names[f.name],
                T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
            )
            for f in schema.fields
        ]
    )


def rollup(grain: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("date", T.StringType()),
            T.StructField(GRAINS[grain][1], T.TimestampType()),
            T.StructField("min_price", T.DoubleType()),
            T.StructField("max_price", T.DoubleType()),
            T.StructField("avg_price", T.DoubleType()),
            T.StructField("volume", T.DoubleType()),
            T.StructField("trade_count", T.LongType()),
            T.StructField("notifications_triggered", T.LongType()),
            T.StructField("first_price", T.DoubleType()),
            T.StructField("last_price", T.DoubleType()),
        ]
    )


def _sum(name: str) -> list[T.StructField]:
    """Columns of a sum that does not depend on the order of rows (see `exactsum`)."""
    limbs = [T.StructField(f"{name}_{limb}", T.LongType()) for limb in ("3", "2", "1", "0")]
    return [*limbs, T.StructField(f"{name}_far", T.DoubleType())]


def minute_state() -> T.StructType:
    """Mergeable per-minute state, the source of every published rollup.

    First and last trade carry their time (epoch micros) and id, so that states merge.
    """
    return T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("minute_start", T.TimestampType()),
            T.StructField("min_price", T.DoubleType()),
            T.StructField("max_price", T.DoubleType()),
            *_sum("price"),
            *_sum("volume"),
            T.StructField("trade_count", T.LongType()),
            T.StructField("notifications_triggered", T.LongType()),
            T.StructField("first_time", T.LongType()),
            T.StructField("first_id", T.LongType()),
            T.StructField("first_price", T.DoubleType()),
            T.StructField("last_time", T.LongType()),
            T.StructField("last_id", T.LongType()),
            T.StructField("last_price", T.DoubleType()),
        ]
    )
