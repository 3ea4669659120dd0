"""Live ingest: frames to hot store, alerts and notifications, in one streaming query."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom import schemas
from tapeloom.functions import ids
from tapeloom.operators import alerts
from tapeloom.sources import envelopes, frames
from tapeloom.sources.hot import DOCUMENTS, REJECTS, HotStore
from tapeloom.sources.runs import read_or_empty, write_partitions

#: Stands for the handler of unreadable envelopes among the finished ones.
REJECTED = "__rejected__"

AlertSink = Callable[[DataFrame, str], None]


def stream_id(batch: DataFrame) -> str:
    """Id of the streaming query that a batch belongs to.

    Spark keeps it in the checkpoint: the same after a restart, no other stream's.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _label(stream: str, batch: int) -> str:
    return f"{stream}-{batch:012d}"


def alert_table(path: str) -> AlertSink:
    """Default alert sink: a folder of messages per stream and batch, overwritten on replay."""

    def write(messages: DataFrame, batch: str) -> None:
        messages.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return write


def hot_handler(
    hot: HotStore, rejects: Callable[[DataFrame, str], None] | None = None
) -> Callable[[DataFrame, str], None]:
    """Fan-out handler that appends each event to the hot table named by its type.

    What the envelope says is kept next to the payload.
    Payloads that cannot be read go to `rejects` with a reason, or, without it, to the hot
    table of rejects; events of any other type go to the table of documents as they came.
    """

    def store(received: DataFrame, batch: str) -> None:
        types = (schemas.TRADE_EVENT, schemas.NOTIFICATION_EVENT)
        tables = {t: envelopes.unwrap(received, t, with_about=True) for t in types}
        known = F.coalesce(F.col("type").isin(*types), F.lit(False))
        tables[DOCUMENTS] = received.where(~known)
        bad = reduce(DataFrame.unionByName, [envelopes.unwrap_rejects(received, t) for t in types])
        if rejects:
            rejects(bad, batch)
        else:
            tables[REJECTS] = bad
        hot.append(f"batch-{batch}", tables)

    return store


def _with_trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_ingest(
    source: DataFrame,
    hot: HotStore,
    checkpoint: str,
    alert_sink: AlertSink,
    quarantine: str | None = None,
    on_bad_frame: str = "quarantine",
    threshold: float = alerts.THRESHOLD,
    every: str | None = None,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """Frames (column `value`) to hot trades, alerts and hot notifications.

    Store and alerts subscribe to every trade, so the decoded batch feeds both without a
    detour through envelope text; `start_fan_out` serves envelopes of other producers.

    `dedup_within` drops a trade the feed delivers again within that time of arrival.

    Bounded by the source's rate options (maxFilesPerTrigger, maxBytesPerTrigger,
    maxOffsetsPerTrigger). Ids derive from the frames and partitions are named by batch, so
    a replayed batch after a failure writes the same rows to the same place: either all
    outputs of a batch are there when its offsets commit, or the batch is run again.
    `every` is the trigger interval; without it all available input is taken once.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # Four outputs read the decoded batch; kept on executors' disks, recomputed if lost.
        parsed = frames.parse_frames(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            zero = on_bad_frame == "zero"
            trades = frames.zero_filled(parsed) if zero else frames.trades_of(parsed)
            notices = alerts.build_notifications(trades, threshold)
            label = _label(stream_id(batch), batch_id)
            hot.append(
                f"batch-{label}",
                {schemas.TRADE_EVENT: trades, schemas.NOTIFICATION_EVENT: notices},
            )
            alert_sink(alerts.alert_messages(trades, threshold), label)
            if quarantine and not zero:
                frames.rejects_of(parsed).write.mode("overwrite").json(
                    f"{quarantine.rstrip('/')}/batch={label}"
                )
        finally:
            parsed.unpersist()

    if dedup_within:
        # The id of the trade, whatever the spelling of its frame; a frame without one is its text.
        stream = F.get_json_object("value", "$.stream")
        number = F.get_json_object("value", "$.data.a").try_cast("bigint")
        keyed = source.select(
            "value",
            F.coalesce(ids.trade_id(stream, number), F.sha2("value", 256)).alias("frame_key"),
            F.current_timestamp().alias("arrived"),
        )
        source = dedup_stream(keyed, "frame_key", "arrived", dedup_within)
    writer = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _with_trigger(writer, every).start()


def start_hot_append(source: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Envelopes (columns of ENVELOPE) to Parquet files by type, exactly once by the file sink."""
    writer = (
        source.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("type")
        .outputMode("append")
    )
    return _with_trigger(writer, every).start()


def start_fan_out(
    wire: DataFrame,
    handlers: dict[str, Callable[[DataFrame, str], None]],
    checkpoint: str,
    every: str | None = None,
    rejects: Callable[[DataFrame, str], None] | None = None,
) -> StreamingQuery:
    """Envelope texts to one handler per subscriber.

    A handler gets a label of stream, subscriber and batch, the same when a batch is repeated.
    One that fails holds up no other: the rest of the handlers run, then the batch fails, and
    when it is repeated only those run that have not finished it. What is finished is a table of
    (batch, subscriber) beside the checkpoint.
    """
    spark = wire.sparkSession
    delivered = f"{checkpoint.rstrip('/')}/delivered"

    def finish(label: str, subscriber: str) -> None:
        mark = spark.createDataFrame([(1, label, subscriber)], "done int, batch string, subscriber string")
        write_partitions(mark, delivered, ["batch", "subscriber"])

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        name = stream_id(batch)
        label = _label(name, batch_id)
        marks = read_or_empty(spark, delivered, "done int, batch string, subscriber string")
        # At most one row a handler; other batches' folders are pruned.
        done = {r["subscriber"] for r in marks.where(F.col("batch") == label).select("subscriber").distinct().collect()}
        parsed = envelopes.parse_envelopes(batch).persist(StorageLevel.MEMORY_AND_DISK)
        failed: dict[str, Exception] = {}
        try:
            readable = parsed.where(F.col("malformed").isNull() & F.col("id").isNotNull())
            copies = envelopes.fan_out(readable.select(*schemas.ENVELOPE.names))
            for subscriber, handle in handlers.items():
                if subscriber in done:
                    continue
                mine = copies.where(F.col("subscriber") == subscriber).drop("subscriber")
                try:
                    handle(mine, _label(f"{name}-{subscriber}", batch_id))
                except Exception as error:
                    failed[subscriber] = error
                else:
                    finish(label, subscriber)
            if rejects and REJECTED not in done:
                bad = parsed.where(F.col("malformed").isNotNull() | F.col("id").isNull())
                rejects(bad.select("value"), label)
                finish(label, REJECTED)
        finally:
            parsed.unpersist()
        if failed:
            raise RuntimeError(f"handlers failed: {failed}") from next(iter(failed.values()))

    writer = wire.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _with_trigger(writer, every).start()


def dedup_stream(events: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop redelivered events that come within `delay` of each other."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
