"""Exchange frames: reading, decoding, quarantine, symbol subscription."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.functions import ids, numbers

# Quarantine reasons.
UNDECODABLE = "undecodable"
NOT_A_TRADE = "not_a_trade"
MISSING_FIELD = "missing_field"
BAD_PRICE = "bad_price"
BAD_QUANTITY = "bad_quantity"
NOT_FINITE = "not_finite"

# Fixed value: event type of an aggregate trade, and its stream suffix.
TRADE_FRAME = "aggTrade"
STREAM_SUFFIX = "@aggTrade"


def read_frames(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Text frames, one JSON object a line, as column `value`.

    `options` pass through to the reader, e.g. maxFilesPerTrigger or maxBytesPerTrigger.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def read_frames_kafka(
    spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options: str
) -> DataFrame:
    """Frames from a Kafka topic (needs the Kafka connector on the class path)."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def encode_frames(trades: DataFrame) -> DataFrame:
    """The frame text of each trade; the inverse of `decode_frames`."""
    millis = F.unix_millis
    data = F.struct(
        F.col("event_type").alias("e"),
        millis("event_time").alias("E"),
        F.col("aggregate_id").alias("a"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("first_trade_id").alias("f"),
        F.col("last_trade_id").alias("l"),
        millis("trade_time").alias("T"),
        F.col("is_buyer_maker").alias("m"),
    )
    return trades.select(F.to_json(F.struct("stream", data.alias("data"))).alias("value"))


def _reason() -> Column:
    required = [
        "stream",
        "event_ms",
        "aggregate_id",
        "symbol",
        "price_text",
        "quantity_text",
        "first_trade_id",
        "last_trade_id",
        "trade_ms",
        "is_buyer_maker",
    ]
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return (
        F.when(F.col("malformed").isNotNull(), UNDECODABLE)
        .when(F.coalesce(F.col("event_type"), F.lit("")) != TRADE_FRAME, NOT_A_TRADE)
        .when(missing, MISSING_FIELD)
        .when(F.col("price").isNull(), BAD_PRICE)
        .when(F.col("quantity").isNull(), BAD_QUANTITY)
        .when(~(numbers.is_finite("price") & numbers.is_finite("quantity")), NOT_FINITE)
    )


_STRING = r'"(?:[^"\\]++|\\.)*+"'
# Objects in up to three levels once the strings are out; no brace follows the last one.
_ONE_OBJECT = r"^\s*\{[^{}]*(?:\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}[^{}]*)*\}\s*$"
_NUMBER_FOR_TEXT = r'"data"\s*:\s*\{[^{}]*"[pq]"\s*:\s*[-0-9]'


def parse_frames(frames: DataFrame, value: str = "value") -> DataFrame:
    """Frame text, its fields, and `reason` (null for a good frame).

    The parsed struct passes through `inline`, so a filter on its fields stays above the
    parse and each frame is parsed once.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    text = F.col(value)
    parsed = F.from_json(text, schemas.FRAME_JSON, options).cast(schemas.FRAME_FIELDS)
    # The parser stops after the first value; a frame is one object and nothing else.
    shape = F.regexp_replace(text, _STRING, "")
    # Price and quantity are texts on the wire; with a number there the record is refused.
    cut = ~shape.rlike(_ONE_OBJECT) | text.rlike(_NUMBER_FOR_TEXT)
    fields = (
        frames.select(text.alias("value"), F.inline(F.array(parsed)))
        .select("value", "stream", "data.*", F.when(cut, F.col("value")).otherwise(F.col("malformed")).alias("malformed"))
        .withColumn("price", numbers.parse_float("price_text"))
        .withColumn("quantity", numbers.parse_float("quantity_text"))
    )
    return fields.withColumn("reason", _reason())


def trades_of(parsed: DataFrame) -> DataFrame:
    """Trades of the good frames among `parse_frames` rows."""
    return parsed.where(F.col("reason").isNull()).select(
        ids.trade_id("stream", "aggregate_id").alias("trade_id"),
        "stream",
        "event_type",
        F.timestamp_millis("event_ms").alias("event_time"),
        "aggregate_id",
        "symbol",
        "price",
        "quantity",
        "first_trade_id",
        "last_trade_id",
        F.timestamp_millis("trade_ms").alias("trade_time"),
        "is_buyer_maker",
    )


def rejects_of(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def zero_filled(parsed: DataFrame) -> DataFrame:
    """Every frame as a trade, absent or unreadable fields as zero values.

    An undecodable frame keeps only an id; a number that overflows drops the frame, as
    such a record cannot be published.
    """
    lost = F.col("malformed").isNotNull()

    def kept(column: Column, zero: object) -> Column:
        return F.when(lost, F.lit(zero)).otherwise(F.coalesce(column, F.lit(zero)))

    no_time = F.lit("0001-01-01 00:00:00Z").cast("timestamp")

    def time(ms: str) -> Column:
        return F.when(lost, no_time).otherwise(
            F.timestamp_millis(F.coalesce(F.col(ms), F.lit(0).cast("bigint")))
        )

    keyed = ~lost & F.col("stream").isNotNull() & F.col("aggregate_id").isNotNull()
    finite = lost | (
        F.coalesce(numbers.is_finite("price"), F.lit(True))
        & F.coalesce(numbers.is_finite("quantity"), F.lit(True))
    )
    return parsed.where(finite).select(
        F.when(keyed, ids.trade_id("stream", "aggregate_id"))
        .otherwise(ids.frame_id("value"))
        .alias("trade_id"),
        kept(F.col("stream"), "").alias("stream"),
        kept(F.col("event_type"), "").alias("event_type"),
        time("event_ms").alias("event_time"),
        kept(F.col("aggregate_id"), 0).cast("bigint").alias("aggregate_id"),
        kept(F.col("symbol"), "").alias("symbol"),
        kept(F.col("price"), 0.0).alias("price"),
        kept(F.col("quantity"), 0.0).alias("quantity"),
        kept(F.col("first_trade_id"), 0).cast("bigint").alias("first_trade_id"),
        kept(F.col("last_trade_id"), 0).cast("bigint").alias("last_trade_id"),
        time("trade_ms").alias("trade_time"),
        kept(F.col("is_buyer_maker"), False).alias("is_buyer_maker"),
    )


def decode_frames(frames: DataFrame, on_bad_frame: str = "quarantine", value: str = "value") -> DataFrame:
    """Typed trades of the frames.

    `on_bad_frame="quarantine"` leaves bad frames to `quarantine_frames`;
    `"zero"` keeps them with zero values.
    """
    parsed = parse_frames(frames, value)
    if on_bad_frame == "zero":
        return zero_filled(parsed)
    if on_bad_frame != "quarantine":
        raise ValueError(f"unknown on_bad_frame: {on_bad_frame}")
    return trades_of(parsed)


def quarantine_frames(frames: DataFrame, value: str = "value") -> DataFrame:
    """The frames `decode_frames` leaves out, each with its reason."""
    return rejects_of(parse_frames(frames, value))


def stream_names(symbols: str | Iterable[str]) -> list[str]:
    """Stream names of a comma-separated (or listed) set of symbols."""
    names = symbols.split(",") if isinstance(symbols, str) else list(symbols)
    return [name.strip().lower() + STREAM_SUFFIX for name in names]


def subscribe_symbols(trades: DataFrame, symbols: str | Iterable[str] | DataFrame) -> DataFrame:
    """Trades of the given symbols; a DataFrame with column `symbol` serves long lists."""
    if isinstance(symbols, DataFrame):
        wanted = symbols.select(
            F.concat(F.lower(F.trim("symbol")), F.lit(STREAM_SUFFIX)).alias("stream")
        ).distinct()
        return trades.join(wanted, "stream", "left_semi")
    return trades.where(F.col("stream").isin(stream_names(symbols)))
