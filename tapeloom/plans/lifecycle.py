"""Hot store to lake: snapshot, archive, curate, roll up, purge.

A run notes the partitions it is going to take before it reads them, so a run that died is
repeated over exactly the rows it had, and overwrites its own output. One write to the table
of runs finishes it: with that its output is in the lake and its input out of the hot store
for everyone who reads with `hot.runs`, never neither and never both.

Feeds write at any time; runs, deletes and compactions are started one after another.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom import schemas
from tapeloom.functions import zorder
from tapeloom.operators import filters, matching, purge
from tapeloom.operators.curate import curated, processed
from tapeloom.operators.rollup import GRAINS, merge_states, minute_state, publish
from tapeloom.session import at_most, session_conf
from tapeloom.sources import envelopes, lake
from tapeloom.sources.hot import PARTS, HotStore
from tapeloom.sources.runs import Runs

TRADES = schemas.TRADE_EVENT
NOTIFICATIONS = schemas.NOTIFICATION_EVENT

Rewrite = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class LakePaths:
    base: str

    def __getattr__(self, name: str) -> str:
        folders = {
            "raw_trades": "raw/trades",
            "raw_notifications": "raw/notifications",
            "curated": "curated",
            "analytics": "analytics",
            "working": "working",
        }
        if name not in folders:
            raise AttributeError(name)
        return f"{self.base.rstrip('/')}/{folders[name]}"


def new_run_id() -> str:
    return f"run-{time.time_ns()}"


def committed_runs(hot: HotStore) -> list[str]:
    """Names of the finished runs; readers of the lake take `hot.runs` itself."""
    return sorted(r["run"] for r in hot.runs.finished().collect())


def pending_runs(hot: HotStore) -> list[str]:
    """Runs that were begun and did not finish."""
    return hot.runs.pending()


def _free_parts(hot: HotStore, table: str) -> DataFrame:
    """Live partitions of a table that no begun run is going to take."""
    parts = hot.live_parts(table).select(
        F.lit(table).alias("table"), F.col("run").alias("of_run"), F.col("batch").alias("part")
    )
    return parts.join(hot.runs.held().drop("run"), ["table", "of_run", "part"], "left_anti")


def _plan(hot: HotStore, run: str) -> bool:
    """Note what a new run takes: all free partitions; false if there are no trades."""
    if not hot.runs.planned(run).isEmpty():
        return True
    trades = _free_parts(hot, TRADES)
    if trades.isEmpty():
        return False
    # Notifications are written before the trades of their batch: listed later, none is missed.
    hot.runs.plan(run, trades.unionByName(_free_parts(hot, NOTIFICATIONS)))
    return True


def _parts_of(planned: DataFrame, table: str) -> DataFrame:
    found = planned.where(F.col("table") == table)
    return found.select(F.col("of_run").alias("run"), F.col("part").alias("batch"))


def archive_and_purge(
    hot: HotStore,
    paths: LakePaths,
    run: str,
    mode: str = "exact",
    max_rows: int | None = None,
    keep_notifications: str = "first",
    dedup: bool = True,
) -> bool:
    """Move the hot trades and their notifications to the lake; false if there are none.

    `max_rows` takes only the oldest trades. `dedup` drops copies of an event, which an
    at-least-once feed brings; without it a tape is taken as free of copies. `keep_notifications="first"` archives one
    notification per key, `"all"` every purged one. Notifications no trade of the run can
    meet stay hot. Repeating a finished run does nothing; repeating a broken one mends it.
    """
    if hot.runs.is_finished(run) or not _plan(hot, run):
        return False
    planned = hot.runs.planned(run)
    spark = hot.spark
    working = f"{paths.working}/run={run}"

    trades = hot.rows(TRADES, _parts_of(planned, TRADES))
    notifications = hot.rows(NOTIFICATIONS, _parts_of(planned, NOTIFICATIONS))
    stored = trades = trades.select(*[c for c in trades.columns if c not in PARTS])
    notifications = notifications.select(*[c for c in notifications.columns if c not in PARTS])
    if dedup:
        trades = envelopes.dedup_events(trades, "trade_id")
        notifications = envelopes.dedup_events(notifications, *schemas.NOTIFICATION.names)
    if max_rows:
        trades = filters.oldest(trades, max_rows)
    if dedup or max_rows:
        # Four outputs read the run's trades; do the shuffle once.
        trades.write.mode("overwrite").parquet(f"{working}/trades")
        trades = spark.read.schema(trades.schema).parquet(f"{working}/trades")

    # Small against the tape and read by three outputs: kept as files, not recomputed.
    matching.match_notifications(trades, notifications, mode).write.mode("overwrite").parquet(f"{working}/matches")
    matches = spark.read.parquet(f"{working}/matches")
    if mode == "by_trade_id":
        met = notifications.join(matches.select("trade_id"), "trade_id", "left_semi")
        left = purge.purge_notifications_by_trade_id(notifications, matches)
    else:
        keys = matches.select("symbol", F.col("key_text").alias("event_time")).distinct()
        met = notifications.join(keys, ["symbol", "event_time"], "left_semi")
        left = purge.purge_notifications_by_key(
            notifications, keys.withColumn("trade_id", F.lit(None).cast("string"))
        )
    met = met.select(*schemas.NOTIFICATION.names)
    if keep_notifications == "first":
        met = matching.first_per_key(met)

    lake.archive_raw_trades(trades.select(*schemas.TRADE.names), paths.raw_trades, run)
    lake.archive_raw_notifications(met, paths.raw_notifications, run)

    flagged = matching.flag_matched(trades.select(*schemas.TRADE.names), matches, stored=True)
    lake.write_curated(curated(processed(flagged)), paths.curated, run)
    tape = processed(flagged, keep=("aggregate_id",))
    write_rollups(minute_state(tape), paths.analytics, run)

    hot.write(NOTIFICATIONS, left, run, "rest")
    if max_rows:
        hot.write(TRADES, purge.purge_trades(stored, trades), run, "rest")
    hot.runs.finish(run, planned)
    lake.delete_folder(spark, working)
    return True


def write_rollups(state: DataFrame, path: str, run: str) -> None:
    """Write a run's minute state once, and the three grains from it."""
    lake.write_state(state, path, run)
    stored = lake.read_state(state.sparkSession, path, [run])
    for grain in GRAINS:
        lake.write_rollup(publish(stored, grain), path, grain, run)


def drain(
    hot: HotStore,
    paths: LakePaths,
    run: str | None = None,
    max_rows: int | None = None,
    **options: object,
) -> list[str]:
    """Finish broken runs, then archive what is hot until nothing is left.

    That is one job, unless `max_rows` asks for runs of bounded size.
    """
    run = run or new_run_id()
    finished = [
        name
        for name in pending_runs(hot)
        if archive_and_purge(hot, paths, name, max_rows=max_rows, **options)
    ]
    turn = 0
    while archive_and_purge(
        hot, paths, f"{run}-{turn}" if turn else run, max_rows=max_rows, **options
    ):
        finished.append(f"{run}-{turn}" if turn else run)
        turn += 1
        if not max_rows:
            break
    return finished


def drain_periodically(
    hot: HotStore,
    paths: LakePaths,
    checkpoint: str,
    every: str | None = None,
    **options: object,
) -> StreamingQuery:
    """Drain now and then every `every` (e.g. "60 minutes") while events arrive.

    The stream is that of the hot trades' files: a new one means there may be something to
    drain. Without `every` what is due is drained once, for an external scheduler.
    """
    spark = hot.spark
    schema = hot.stored(TRADES).schema
    # The stream needs the table's folder to exist.
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*PARTS).parquet(hot.table_path(TRADES))
    arrived = spark.readStream.schema(schema).parquet(hot.table_path(TRADES))

    def drain_batch(events: DataFrame, batch: int) -> None:
        # A repeated batch needs no fixed run id: a broken run is on record in the hot store.
        drain(hot, paths, **options)

    writer = arrived.writeStream.foreachBatch(drain_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


# --- deletes and upkeep of the hot store -------------------------------------------------

#: Ids that go to the files' Bloom filters as a list; longer lists are joined.
LISTED_IDS = 500


def _rewrite(hot: HotStore, table: str, hit: DataFrame, remove: Rewrite, run: str, batch: str, clustered: bool = False) -> int:
    """Replace the partitions `hit` (run, batch) by what `remove` leaves of them; returns how many."""
    # Frozen: what a feed writes from here on is not part of it. One row a partition.
    found = [(table, r["run"], r["batch"]) for r in hit.select(*PARTS).distinct().collect()]
    if not found:
        return 0
    parts = hot.runs.parts(found)
    held = hot.runs.held().join(parts, ["table", "of_run", "part"], "left_semi").select("run").distinct()
    holders = sorted(r["run"] for r in held.collect())
    if holders:
        raise RuntimeError(f"runs {holders} were begun over these rows; finish them first")
    rows = hot.rows(table, _parts_of(parts, table))
    hot.write(table, remove(rows.drop(*PARTS)), run, batch, clustered)
    hot.runs.finish(run, parts)
    return len(found)


def with_ids(rows: DataFrame, ids: DataFrame, column: str = "trade_id") -> tuple[DataFrame, dict[str, str]]:
    """Rows whose id is listed, and the settings to read them with.

    A short list is a filter that files and their row groups answer by Bloom filter.
    """
    wanted = ids.select(column).distinct()
    if not at_most(wanted, LISTED_IDS):
        return rows.join(wanted, column, "left_semi"), {}
    listed = [r[0] for r in wanted.collect() if r[0] is not None]
    setting = {"spark.sql.parquet.pushdown.inFilterThreshold": str(LISTED_IDS)}
    return rows.where(F.col(column).isin(listed)), setting


def _delete_by_id(hot: HotStore, table: str, ids: DataFrame, remove: Callable, run: str) -> int:
    doomed, setting = with_ids(hot.rows(table), ids)
    with session_conf(hot.spark, setting):
        hit = doomed.select(*PARTS).distinct().collect()
    hit = hot.spark.createDataFrame(hit, "run string, batch string")
    return _rewrite(hot, table, hit, lambda rows: remove(rows, ids), run, "rest")


def delete_trades(hot: HotStore, ids: DataFrame, run: str) -> int:
    """Delete hot trades by `trade_id`; returns the number of rewritten partitions."""
    return _delete_by_id(hot, TRADES, ids, purge.purge_trades, run)


def delete_notifications_by_trade_id(hot: HotStore, ids: DataFrame, run: str) -> int:
    return _delete_by_id(hot, NOTIFICATIONS, ids, purge.purge_notifications_by_trade_id, run)


def delete_notifications_by_key(hot: HotStore, keys: DataFrame, run: str) -> int:
    """Delete hot notifications by (symbol, event_time, trade_id) keys with blank wildcards."""
    return _rewrite(
        hot,
        NOTIFICATIONS,
        hot.live_parts(NOTIFICATIONS),
        lambda rows: purge.purge_notifications_by_key(rows, keys),
        run,
        "rest",
    )


def compact(hot: HotStore, table: str, run: str) -> int:
    """Merge the many small partitions of streaming batches into one of well-sized files.

    Trades come out in Z-order of time, price and quantity, so a range of any of them skips
    row groups, whichever others the query leaves open.
    """
    parts = hot.live_parts(table)
    if at_most(parts, 1):
        return parts.count()
    if table == TRADES:
        return _rewrite(hot, table, parts, zorder.clustered, run, "merged", clustered=True)
    return _rewrite(hot, table, parts, lambda rows: rows.hint("rebalance"), run, "merged")


def vacuum(hot: HotStore) -> int:
    """Delete the files of partitions that finished runs took; returns how many.

    To be called when no reader is still on an older view of the store.
    """
    gone = 0
    for table in (TRADES, NOTIFICATIONS):
        there = hot.stored(table).select(*PARTS).distinct()
        for r in there.join(hot.runs.taken(table, "batch"), PARTS, "left_semi").collect():
            gone += lake.delete_folder(hot.spark, f"{hot.table_path(table)}/run={r['run']}/batch={r['batch']}")
    return gone


# --- upkeep of the lake ------------------------------------------------------------------


def compact_lake(runs: Runs, paths: LakePaths, before: str, run: str) -> int:
    """Merge the folders that several runs wrote of one day into one, for days before `before`.

    `before` is a date as text; such days are closed, few late rows come for them. Rows stay as
    they are, but for the minute state, which is merged, and the rollups, which are published
    from it anew. Until the one write that finishes the run, readers by `runs` see the old
    folders (run, day), from then on the new ones. Returns how many were replaced.
    """
    spark = runs.spark
    raw = {lake.RAW_TRADES: paths.raw_trades, lake.RAW_NOTIFICATIONS: paths.raw_notifications}
    sources: dict[str, DataFrame] = {
        table: lake.raw_lines(spark, path, table) for table, path in raw.items() if lake.exists(spark, path)
    }
    if lake.exists(spark, paths.curated):
        sources[lake.CURATED] = lake.curated_rows(spark, paths.curated)
    if lake.exists(spark, f"{paths.analytics}/{lake.STATE}"):
        sources[lake.STATE] = lake.state_rows(spark, paths.analytics)
    taken: list[tuple[str, str, str]] = []
    for table, rows in sources.items():
        live = runs.live(rows, table, "date").where(F.col("date") < before)
        # One row a folder; a run that finishes meanwhile is left for the next time.
        folders = [(r["run"], r["date"]) for r in live.select("run", "date").distinct().collect()]
        runs_of = Counter(date for _, date in folders)
        folders = [(of_run, date) for of_run, date in folders if runs_of[date] > 1]
        if not folders:
            continue
        rows = live.join(spark.createDataFrame(folders, "run string, date string"), ["run", "date"], "left_semi")
        if table in raw:
            lake.write_raw_lines(rows, raw[table], run)
        elif table == lake.CURATED:
            lake.write_curated(rows.select(*schemas.CURATED.names), paths.curated, run)
        else:
            write_rollups(merge_states(rows.select(*schemas.minute_state().names)), paths.analytics, run)
        names = (lake.STATE, *GRAINS) if table == lake.STATE else (table,)
        taken += [(name, of_run, date) for name in names for of_run, date in folders]
    if taken:
        runs.finish(run, runs.parts(taken))
    return len(taken)


def vacuum_lake(runs: Runs, paths: LakePaths) -> int:
    """Delete the folders of runs all of whose days a compaction has taken; returns how many."""
    spark = runs.spark
    tables = {
        lake.RAW_TRADES: paths.raw_trades,
        lake.RAW_NOTIFICATIONS: paths.raw_notifications,
        lake.CURATED: paths.curated,
        **{name: f"{paths.analytics}/{name}" for name in (lake.STATE, *GRAINS)},
    }
    gone = 0
    for table, path in tables.items():
        if not lake.exists(spark, path):
            continue
        there = lake.folders(spark, path, table).distinct()
        left = there.join(runs.taken(table, "date"), ["run", "date"], "left_anti")
        whole = there.select("run").distinct().join(left, "run", "left_anti").join(runs.finished(), "run", "left_semi")
        for r in whole.collect():
            gone += lake.delete_folder(spark, f"{path}/run={r['run']}")
    return gone
