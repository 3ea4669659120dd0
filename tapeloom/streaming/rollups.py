"""Rollups over the live tape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom import schemas
from tapeloom.functions import exactsum, ordering, times
from tapeloom.operators.rollup import minute_state
from tapeloom.sources import lake
from tapeloom.streaming.ingest import stream_id


def stream_rollup(trades: DataFrame, grain: str, delay: str, dedup_key: str | None = None) -> DataFrame:
    """Tumbling rollup of a trade stream; a bucket comes out once the watermark passes it.

    Trades more than `delay` behind the latest one are dropped; `start_state_stream` keeps
    them. `triggered_notification` counts where the stream carries it.
    """
    unit, name = schemas.GRAINS[grain]
    rows = trades.withWatermark("trade_time", delay)
    if dedup_key:
        rows = rows.dropDuplicatesWithinWatermark([dedup_key])
    flag = (
        F.col("triggered_notification").cast("bigint")
        if "triggered_notification" in trades.columns
        else F.lit(0).cast("bigint")
    )
    first = ordering.first_key("trade_time", "aggregate_id")
    last = ordering.last_key("trade_time", "aggregate_id")
    window = F.window("trade_time", f"1 {unit}")
    rolled = rows.groupBy("symbol", window.alias("bucket")).agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        *exactsum.sums("price", "price"),
        *exactsum.sums("quantity", "volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(flag).alias("notifications_triggered"),
        F.min_by("price", first).alias("first_price"),
        F.max_by("price", last).alias("last_price"),
    )
    start = F.col("bucket.start")
    return rolled.select(
        "symbol",
        times.utc_date(start).alias("date"),
        start.alias(name),
        "min_price",
        "max_price",
        (exactsum.total("price") / F.col("trade_count")).alias("avg_price"),
        exactsum.total("volume").alias("volume"),
        "trade_count",
        "notifications_triggered",
        "first_price",
        "last_price",
    )


def start_stream_rollup(rolled: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append closed buckets to Parquet, exactly once by the file sink."""
    writer = (
        rolled.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def start_state_stream(trades: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Mergeable minute states of a trade stream under `path`, one run per batch.

    No trade is too late: it makes one more partial state of its minute, which
    `lake.read_merged_rollups(spark, path, grain)` adds to the others, so that rollups of any
    grain are those of the whole tape at all times. Between batches nothing is kept but the
    files; a replayed batch replaces its own.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if "triggered_notification" not in batch.columns:
            batch = batch.withColumn("triggered_notification", F.lit(False))
        lake.write_state(minute_state(batch), path, f"{stream_id(batch)}-{batch_id:012d}")

    writer = trades.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
