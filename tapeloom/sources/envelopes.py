"""Event envelopes around trades and notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom import schemas
from tapeloom.functions import ids, times

_PAYLOADS = {
    schemas.TRADE_EVENT: (schemas.TRADE, schemas.TRADE_WIRE),
    schemas.NOTIFICATION_EVENT: (schemas.NOTIFICATION, schemas.NOTIFICATION_WIRE),
}


def payload_json(schema: T.StructType, names: dict[str, str]) -> Column:
    """Wire JSON of a record whose columns are in scope."""
    fields = [
        (times.rfc3339_nano(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(
            names[f.name]
        )
        for f in schema.fields
    ]
    return F.to_json(F.struct(*fields))


def typed_payload(
    df: DataFrame, parsed: str, schema: T.StructType, names: dict[str, str], keep: list[Column] | None = None
) -> DataFrame:
    """Columns of `schema` from a parsed wire struct column, and the columns to keep."""
    fields = []
    for f in schema.fields:
        column = F.col(f"{parsed}.{names[f.name]}")
        if isinstance(f.dataType, T.TimestampType):
            column = times.parse_rfc3339(column)
        fields.append(column.alias(f.name))
    return df.select(*fields, *(keep or []))


# Source of each type of event, and who gets it.
_SENT = {
    schemas.TRADE_EVENT: (schemas.TRADE_SOURCE, [schemas.STORE_SUBSCRIBER, schemas.ALERT_SUBSCRIBER]),
    schemas.NOTIFICATION_EVENT: (schemas.NOTIFICATION_SOURCE, [schemas.STORE_SUBSCRIBER]),
}


def about(event_type: str, created_at: Column | None = None) -> dict[str, Column]:
    """What a new envelope says about a payload whose `trade_id` is in scope."""
    source, subscribers = _SENT[event_type]
    created = times.legacy_text(F.current_timestamp()) if created_at is None else created_at
    return {
        "event_id": ids.event_id(F.lit(event_type), F.col("trade_id")),
        "subscribers": F.array(*[F.lit(s) for s in subscribers]),
        "source": F.lit(source),
        "created_at": created,
    }


def with_about(payloads: DataFrame, event_type: str) -> DataFrame:
    """Payloads with the columns of ABOUT; those they have already stay."""
    new = {n: c for n, c in about(event_type).items() if n not in payloads.columns}
    return payloads.withColumns(new)


def rewrap(rows: DataFrame, event_type: str) -> DataFrame:
    """Envelopes of payloads that lie next to the columns of ABOUT."""
    schema, names = _PAYLOADS[event_type]
    return rows.select(
        F.col("event_id").alias("id"),
        "subscribers",
        F.lit(event_type).alias("type"),
        "source",
        payload_json(schema, names).alias("event_data"),
        "created_at",
    )


def wrap_trades(trades: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Trade envelopes, addressed to the hot store and to the alerts."""
    return rewrap(trades.withColumns(about(schemas.TRADE_EVENT, created_at)), schemas.TRADE_EVENT)


def wrap_notifications(notifications: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Notification envelopes, addressed to the hot store only."""
    return rewrap(
        notifications.withColumns(about(schemas.NOTIFICATION_EVENT, created_at)), schemas.NOTIFICATION_EVENT
    )


def to_wire(envelopes: DataFrame) -> DataFrame:
    """Envelope JSON text as column `value`; the payload is nested as an object."""
    head = F.to_json(F.struct("id", "subscribers", "type", "source"))
    tail = F.to_json(F.struct(F.col("created_at").alias("createdAt")))
    return envelopes.select(
        F.concat(
            F.rtrim(head, F.lit("}")),
            F.lit(',"eventData":'),
            F.col("event_data"),
            F.lit(","),
            F.ltrim(tail, F.lit("{")),
        ).alias("value")
    )


def parse_envelopes(wire: DataFrame, value: str = "value") -> DataFrame:
    """Envelope fields of wire text, plus the text itself and `malformed` (null if readable)."""
    shape = "id string, subscribers array<string>, type string, source string, eventData string, createdAt string, malformed string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_json(F.col(value), shape, options)
    return wire.select(F.col(value).alias("value"), F.inline(F.array(parsed))).select(
        "value",
        "id",
        "subscribers",
        "type",
        "source",
        F.col("eventData").alias("event_data"),
        F.col("createdAt").alias("created_at"),
        "malformed",
    )


def unwrap(envelopes: DataFrame, event_type: str, with_about: bool = False) -> DataFrame:
    """Typed payloads of the envelopes of one type (columns of ENVELOPE in).

    `with_about` adds what the envelope says, as the columns of ABOUT.
    """
    return _readable(envelopes, event_type, with_about)[0]


def unwrap_rejects(envelopes: DataFrame, event_type: str) -> DataFrame:
    """Envelopes of that type whose payload does not parse."""
    return _readable(envelopes, event_type)[1]


def _readable(envelopes: DataFrame, event_type: str, with_about: bool = False) -> tuple[DataFrame, DataFrame]:
    schema, names = _PAYLOADS[event_type]
    shape = T.StructType(
        [*schemas.wire_schema(schema, names).fields, T.StructField("malformed", T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_json("event_data", shape, options)
    rows = envelopes.where(F.col("type") == event_type).select(
        *schemas.ENVELOPE.names, F.explode(F.array(parsed)).alias("payload")
    )
    bad = F.col("payload").isNull() | F.col("payload.malformed").isNotNull()
    kept = [F.col("id").alias("event_id"), *[F.col(n) for n in schemas.ABOUT.names[1:]]] if with_about else []
    good = typed_payload(rows.where(~bad), "payload", schema, names, kept)
    return good, rows.where(bad).select(*schemas.ENVELOPE.names)


def fan_out(envelopes: DataFrame) -> DataFrame:
    """One copy of each envelope per subscriber, the addressee in `subscriber`."""
    return envelopes.select(F.explode("subscribers").alias("subscriber"), "*")


def for_subscriber(envelopes: DataFrame, subscriber: str) -> DataFrame:
    """The copies one subscriber receives."""
    return envelopes.where(F.array_contains("subscribers", subscriber))


def dedup_events(events: DataFrame, *keys: str) -> DataFrame:
    """Drop redelivered events; copies agree in the keys (the envelope's `id` by default).

    Equal rows collapse before the shuffle. Of copies that differ in other columns the one with
    the least row hash stays. Keys are compared by 128-bit hashes, so all aggregates are hash
    aggregates over fixed-width values, however long an event is.
    """
    keys = keys or ("id",)
    # Nulls leave a hash as it is; the flag keeps (null, a) and (a, null) apart.
    parts = [c for k in keys for c in (F.col(k).isNull(), F.col(k))]
    hashes = {
        "_key": F.xxhash64(F.lit(1), *parts),
        "_key2": F.xxhash64(F.lit(2), *parts),
        "_row": F.xxhash64(*[c for n in events.columns for c in (F.col(n).isNull(), F.col(n))]),
    }
    once = events.distinct().withColumns(hashes)
    unlike = once.groupBy("_key", "_key2").agg(F.min("_row").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    unlike = unlike.where("_rows > 1").drop("_rows")
    kept = once.join(unlike, ["_key", "_key2"], "left").where(F.col("_least").isNull() | (F.col("_row") == F.col("_least")))
    return kept.select(*events.columns)
