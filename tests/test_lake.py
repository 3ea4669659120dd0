"""Lake round trips, the hot store, and the hot-to-lake runs."""

from __future__ import annotations

import glob
import gzip
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import curate, rollup
from tapeloom.plans import lifecycle
from tapeloom.plans.lifecycle import NOTIFICATIONS, TRADES, LakePaths
from tapeloom.functions import zorder
from tapeloom.session import session_conf
from tapeloom.sources import lake
from tapeloom.sources.hot import HotStore
from tapeloom.sources.runs import FEED

from helpers import at, notice, notices, rows, trade, trades


def flagged(df):
    return df.withColumn("triggered_notification", F.col("aggregate_id") % 2 == 0)


# --- lake ------------------------------------------------------------------------------


def test_raw_trades(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = trades(spark, [trade(1, trade_time=at(3599.5)), trade(2, trade_time=at(3600)), trade(3, symbol='<&"')])
    lake.archive_raw_trades(df, path, "r1")
    lake.archive_raw_trades(df, path, "r1")
    assert rows(lake.read_raw_trades(spark, path)) == rows(df)
    files = glob.glob(f"{path}/run=r1/year=2024/month=01/day=01/hour=*/*.gz")
    assert {f.split("/")[-2] for f in files} == {"hour=00", "hour=01"}
    lines = [line for f in files for line in gzip.open(f, "rt", encoding="utf-8")]
    assert len(lines) == 3
    assert any('"Symbol":"<&\\""' in line for line in lines)


def test_raw_notifications_with_unreadable_time(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = notices(spark, [notice("2024-01-02T00:00:00Z"), notice("yesterday")])
    lake.archive_raw_notifications(df, path, "r1")
    assert rows(lake.read_raw_notifications(spark, path)) == rows(df)
    assert os.path.isdir(f"{path}/run=r1/year=unknown/month=unknown/day=unknown")


def test_legacy_archive(spark, tmp_path):
    folder = tmp_path / "2024" / "01" / "01" / "00"
    folder.mkdir(parents=True)
    record = '{"ID":"%s","Symbol":"%s","EventTime":"2024-01-01T00:00:00.5Z","Price":1}'
    line = record % ("a", "X}{Y") + record % ("b", "B") + record % ("c", 'q}{\\"ID\\":') + "\n"
    with gzip.open(folder / "1.jsonl.gz", "wt") as f:
        f.write(line)
    got = rows(lake.read_raw_trades(spark, str(tmp_path), legacy=True), "trade_id", "symbol", "event_time")
    when = "2024-01-01 00:00:00.500000"
    assert got == [("a", "X}{Y", when), ("b", "B", when), ("c", 'q}{"ID":', when)]


def test_legacy_notifications(spark, tmp_path):
    with gzip.open(tmp_path / "1.jsonl.gz", "wt") as f:
        f.write('{"EventTime":"e1","Price":1.5,"TradeID":"a"}{"EventTime":"e2","Price":2,"TradeID":"b"}\n')
    got = lake.read_raw_notifications(spark, str(tmp_path), legacy=True)
    assert rows(got, "event_time", "price", "trade_id") == [("e1", 1.5, "a"), ("e2", 2.0, "b")]


def test_curated_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "curated")
    df = flagged(trades(spark, [trade(n, symbol="AB"[n % 2], trade_time=at(n * 40_000.5)) for n in range(8)]))
    out = curate.curated(curate.processed(df))
    lake.write_curated(out, path, "r1")
    back = lake.read_curated(spark, path)
    assert back.dtypes == out.dtypes
    assert rows(back) == rows(out)
    pruned = back.where("symbol = 'A' and date = '2024-01-01'")
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "5000"}):
        plan = pruned._jdf.queryExecution().executedPlan().toString()
    found = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    assert "symbol#" in found and "date#" in found
    assert lake.read_curated(spark, path, runs=["other"]).count() == 0


def test_files_are_sorted_and_hot_partition_is_split(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "curated")
    made = spark.range(60_000).select(
        F.lit("HOT").alias("symbol"),
        F.timestamp_micros((F.xxhash64("id") % 1_000_000_000).cast("bigint") * 1000).alias("trade_time"),
        (F.xxhash64("id") / 7.0).alias("price"),
        F.lit(1.0).alias("quantity"),
        F.lit(1).cast("bigint").alias("amount_of_trades"),
        F.lit(True).alias("is_buyer_maker"),
        F.lit(False).alias("triggered_notification"),
        F.lit("1970-01-01").alias("date"),
    )
    made = made.repartition(8)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        lake.write_curated(made, path, "r1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = glob.glob(f"{path}/run=r1/symbol=HOT/date=1970-01-01/*.parquet")
    assert len(files) > 1
    total = 0
    for f in files:
        times = pq.ParquetFile(f).read(["trade_time"])["trade_time"].to_pylist()
        assert times == sorted(times)
        total += len(times)
    assert total == 60_000


def test_rollup_files_and_merge(spark, tmp_path):
    path = str(tmp_path / "analytics")
    df = flagged(trades(spark, [trade(n, trade_time=at(n * 20)) for n in range(12)]))
    for run in (0, 1):
        part = df.where(F.col("aggregate_id") % 2 == run)
        lifecycle.write_rollups(rollup.minute_state(part), path, f"r{run}")
    assert lake.read_rollups(spark, path, "hourly").count() == 2
    assert lake.read_rollups(spark, path, "hourly", runs=["r1"]).count() == 1
    for grain in rollup.GRAINS:
        merged = lake.read_merged_rollups(spark, path, grain)
        assert rows(merged) == rows(rollup.rollup(df, grain))
    some = lake.read_merged_rollups(spark, path, "daily", where=F.col("date") == "2024-01-02")
    assert some.count() == 0


# --- hot store -------------------------------------------------------------------------


@pytest.fixture
def hot(spark, tmp_path):
    return HotStore(spark, str(tmp_path / "hot"))


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def fill(spark, hot, batch, numbers, found=()):
    hot.append(
        batch,
        {
            TRADES: trades(spark, [trade(n, event_time=at(n)) for n in numbers]),
            NOTIFICATIONS: notices(spark, [notice(f"2024-01-01T00:00:{n:02d}Z", trade_id=f"t{n:04d}") for n in found]),
        },
    )


def ids(df):
    return [r[0] for r in rows(df, "trade_id")]


def parts(hot, table=TRADES):
    return rows(hot.live_parts(table))


def test_append_is_idempotent(spark, hot):
    assert hot.scan_trades().count() == 0
    fill(spark, hot, "a", [1, 2])
    fill(spark, hot, "a", [1, 2])
    fill(spark, hot, "b", [3])
    assert ids(hot.scan_trades()) == ["t0001", "t0002", "t0003"]


def test_replayed_batch_replaces_its_rows(spark, hot):
    fill(spark, hot, "a", [1, 2], found=[1])
    fill(spark, hot, "b", [3])
    fill(spark, hot, "a", [1, 2, 4], found=[1])
    assert ids(hot.scan_trades()) == ["t0001", "t0002", "t0003", "t0004"]
    assert ids(hot.scan_notifications()) == ["t0001"]


def test_rows_of_an_unfinished_run_are_invisible(spark, hot):
    fill(spark, hot, "a", [1])
    hot.write(TRADES, trades(spark, [trade(9)]), "run-1", "rest")
    assert ids(hot.scan_trades()) == ["t0001"]
    hot.runs.finish("run-1", hot.runs.parts([(TRADES, FEED, "a")]))
    assert ids(hot.scan_trades()) == ["t0009"]
    # A batch that is replayed after it was taken stays gone.
    fill(spark, hot, "a", [1])
    assert ids(hot.scan_trades()) == ["t0009"]


def test_envelopes_come_back_as_they_came(spark, hot):
    from tapeloom.sources import envelopes

    sent = envelopes.wrap_trades(trades(spark, [trade(1)]), F.lit("then")).withColumn("source", F.lit("elsewhere"))
    hot.append("a", {TRADES: envelopes.unwrap(sent, TRADES, with_about=True)})
    assert rows(hot.scan_envelopes(TRADES)) == rows(sent)
    # Payloads without an envelope get one of their own.
    hot.append("b", {TRADES: trades(spark, [trade(2)])})
    found = hot.scan_envelopes(TRADES).where("source <> 'elsewhere'")
    own = envelopes.wrap_trades(trades(spark, [trade(2)]), F.lit("then"))
    assert rows(found.drop("created_at")) == rows(own.drop("created_at"))


def test_deletes_compaction_and_vacuum(spark, hot):
    for batch, numbers in (("a", [1, 2]), ("b", [3]), ("c", [4])):
        fill(spark, hot, batch, numbers, found=numbers)
    gone = spark.createDataFrame([("t0002",), ("t0003",)], "trade_id string")
    assert lifecycle.delete_trades(hot, gone, "d1") == 2
    assert lifecycle.delete_trades(hot, gone, "d2") == 0
    assert ids(hot.scan_trades()) == ["t0001", "t0004"]
    assert lifecycle.delete_notifications_by_trade_id(hot, gone, "d3") == 2
    key = spark.createDataFrame([("AAAUSDT", "2024-01-01T00:00:04Z", "")], "symbol string, event_time string, trade_id string")
    lifecycle.delete_notifications_by_key(hot, key, "d4")
    assert ids(hot.scan_notifications()) == ["t0001"]
    lifecycle.compact(hot, TRADES, "m1")
    assert parts(hot) == [("m1", "merged")]
    assert lifecycle.vacuum(hot) > 0
    assert lifecycle.vacuum(hot) == 0
    assert ids(hot.scan_trades()) == ["t0001", "t0004"]


def test_delete_by_many_ids_is_a_join(spark, hot, monkeypatch):
    monkeypatch.setattr(lifecycle, "LISTED_IDS", 1)
    fill(spark, hot, "a", [1, 2])
    fill(spark, hot, "b", [3])
    gone = spark.createDataFrame([("t0001",), ("t0002",), (None,)], "trade_id string")
    assert lifecycle.delete_trades(hot, gone, "d1") == 1
    assert ids(hot.scan_trades()) == ["t0003"]


def scanned_rows(df):
    """Rows that the Parquet scans of a plan gave out when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()

    def scans(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName().startswith("Scan parquet"):
            yield node.metrics().apply("numOutputRows").value()
        for at in range(node.children().size()):
            yield from scans(node.children().apply(at))

    return sum(scans(plan))


def test_absent_id_reads_no_row_group(spark, hot):
    """The id lies between the least and the greatest one of the file: only its filter can tell."""
    made = spark.range(0, 40_000, 2, 1).select(F.col("id").alias("n"))
    one = trades(spark, [trade(1)]).drop("trade_id", "aggregate_id")
    all_ids = made.select(F.format_string("t%08d", "n").alias("trade_id"), F.col("n").alias("aggregate_id"))
    hot.append("a", {TRADES: all_ids.crossJoin(F.broadcast(one)).select(*hot.scan_trades().columns)})
    stored = hot.stored(TRADES)
    assert scanned_rows(stored.where("trade_id = 't00020001'")) == 0
    assert scanned_rows(stored.where("aggregate_id = 20001")) == 0
    assert scanned_rows(stored.where("trade_id = 't00020000'")) > 0
    # A delete by a list of ids opens no row group that holds none of them.
    absent = spark.createDataFrame([(f"t{n:08d}",) for n in range(1, 100, 2)], "trade_id string")
    doomed, setting = lifecycle.with_ids(stored, absent)
    with session_conf(spark, setting):
        assert scanned_rows(doomed) == 0


def test_z_order_skips_row_groups(spark, hot):
    """Each of time, price and quantity alone narrows what is read of a merged hot store."""
    n = 60_000
    made = spark.range(0, n, 1, 8)
    one = trades(spark, [trade(1)]).drop("trade_id", "aggregate_id", "trade_time", "price", "quantity")
    tape = made.select(
        F.col("id").cast("string").alias("trade_id"),
        F.col("id").alias("aggregate_id"),
        F.timestamp_micros(F.pmod(F.xxhash64("id"), F.lit(86_400_000_000))).alias("trade_time"),
        F.pow(F.lit(2.0), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1000)) / 100.0).alias("price"),
        F.pow(F.lit(2.0), F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(1000)) / 100.0).alias("quantity"),
    ).crossJoin(F.broadcast(one)).select(*hot.scan_trades().columns)
    before = rows(tape, "trade_id")
    hot.append("a", {TRADES: tape.where("aggregate_id % 2 = 0")})
    hot.append("b", {TRADES: tape.where("aggregate_id % 2 = 1")})
    with session_conf(spark, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        lifecycle.compact(hot, TRADES, "m")
    assert rows(hot.scan_trades(), "trade_id") == before
    stored = hot.stored(TRADES).where("run = 'm'")
    for one_of_four in ("price > 1000", "quantity < 1.1", "trade_time < timestamp '1970-01-01 00:30:00 UTC'"):
        assert scanned_rows(stored.where(one_of_four)) < n / 2
    assert scanned_rows(stored.where("price > 1000 and quantity < 1.1")) < n / 4


def test_z_value_interleaves(spark):
    numbers = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (5, 3, 6), (zorder._TOP,) * 3]
    df = spark.createDataFrame(numbers, "a bigint, b bigint, c bigint")
    got = [r[0] for r in df.select(zorder.interleave(F.col("a"), F.col("b"), F.col("c"))).collect()]
    by_hand = [
        sum(((x >> bit) & 1) << (3 * bit + place) for bit in range(20) for x, place in ((a, 2), (b, 1), (c, 0)))
        for a, b, c in numbers
    ]
    assert got == by_hand


def test_odd_prices_have_a_z_value(spark):
    made = [trade(n, price=p, trade_time=None if n == 3 else at(n)) for n, p in enumerate([float("nan"), float("inf"), -1.0, 0.0, 5.0])]
    df = trades(spark, made)
    assert rows(zorder.clustered(df), "aggregate_id") == rows(df, "aggregate_id")
    assert zorder.clustered(df.where("false")).count() == 0


def test_threads_that_append_lose_nothing(spark, hot):
    def append(worker):
        for n in range(3):
            fill(spark, hot, f"w{worker}-{n}", [worker * 10 + n])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(append, range(4)))
    assert len(ids(hot.scan_trades())) == 12
    assert len(parts(hot)) == 12


def test_time_filter_skips_row_groups(spark, hot, tmp_path):
    fill(spark, hot, "a", range(1, 50))
    file = next((tmp_path / "hot").rglob("type=BinanceTradeEvent/**/*.parquet"))
    column = {c.path_in_schema: c for c in (pq.read_metadata(file).row_group(0).column(i) for i in range(12))}
    assert column["trade_time"].physical_type == "INT64" and column["trade_time"].statistics.has_min_max


def test_empty_symbol_and_left_overs(spark, hot, paths, tmp_path):
    hot.append("a", {TRADES: trades(spark, [trade(1, symbol=""), trade(2, symbol=None), trade(3)])})
    lifecycle.drain(hot, paths, "run-1")
    seen = rows(lake.read_curated(spark, paths.curated, hot.runs), "symbol")
    assert sorted(map(str, seen)) == sorted(map(str, [("",), (None,), ("AAAUSDT",)]))
    daily = lake.read_rollups(spark, paths.analytics, "daily").where("symbol = ''")
    assert daily.first().trade_count == 1
    assert not list((tmp_path / "lake" / "working").rglob("*.parquet"))


def test_overlapping_runs_share_nothing(spark, hot, paths, monkeypatch):
    """A run does not take what a broken one holds, and readers do not see the broken one."""
    fill(spark, hot, "a", [1, 2])
    with monkeypatch.context() as broken:
        broken.setattr(lifecycle, "write_rollups", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lifecycle.archive_and_purge(hot, paths, "run-1")
    assert lake.read_curated(spark, paths.curated, hot.runs).count() == 0
    assert hot.scan_trades().count() == 2
    assert not lifecycle.archive_and_purge(hot, paths, "run-2")
    fill(spark, hot, "b", [3])
    assert lifecycle.archive_and_purge(hot, paths, "run-3")
    assert lake.read_curated(spark, paths.curated, hot.runs).count() == 1
    assert lifecycle.drain(hot, paths, "run-4") == ["run-1"]
    assert lake.read_curated(spark, paths.curated, hot.runs).count() == 3


def test_copies_are_flagged_once(spark, hot, paths):
    for segment in ("a", "b"):
        fill(spark, hot, segment, [1, 2], found=[2])
    lifecycle.drain(hot, paths, "run-1")
    done = lake.read_curated(spark, paths.curated)
    assert (done.count(), done.where("triggered_notification").count()) == (2, 1)


# --- runs ------------------------------------------------------------------------------


def test_drain(spark, hot, paths):
    fill(spark, hot, "a", [1, 2, 3], found=[2, 3, 50])
    # Two notifications of one key: one is archived, both are purged.
    fill(spark, hot, "b", [4], found=[2])
    assert lifecycle.drain(hot, paths, "run-1") == ["run-1"]
    assert hot.scan_trades().count() == 0
    assert ids(hot.scan_notifications()) == ["t0050"]
    assert lake.read_raw_trades(spark, paths.raw_trades).count() == 4
    assert ids(lake.read_raw_notifications(spark, paths.raw_notifications)) == ["t0002", "t0003"]
    done = lake.read_curated(spark, paths.curated, lifecycle.committed_runs(hot))
    assert rows(done, "triggered_notification") == [(False,), (False,), (True,), (True,)]
    daily = lake.read_rollups(spark, paths.analytics, "daily").first()
    assert (daily.trade_count, daily.notifications_triggered) == (4, 2)
    # Nothing left: a further drain, or the same run again, changes nothing.
    assert lifecycle.drain(hot, paths, "run-1") == []
    assert lifecycle.drain(hot, paths, "run-2") == []
    assert lake.read_raw_trades(spark, paths.raw_trades).count() == 4


def test_late_trades_merge_with_earlier_runs(spark, hot, paths):
    fill(spark, hot, "a", [1, 3])
    lifecycle.drain(hot, paths, "run-1")
    fill(spark, hot, "b", [2])
    lifecycle.drain(hot, paths, "run-2")
    assert lake.read_rollups(spark, paths.analytics, "daily").count() == 2
    merged = lake.read_merged_rollups(spark, paths.analytics, "daily", lifecycle.committed_runs(hot))
    assert rows(merged, "trade_count") == [(3,)]


def test_broken_run_is_resumed_over_its_own_rows(spark, hot, paths, monkeypatch):
    fill(spark, hot, "a", [1, 2], found=[1])

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(lake, "write_curated", fail)
        with pytest.raises(OSError):
            lifecycle.drain(hot, paths, "run-1")
    # Nothing was purged, and what arrives meanwhile belongs to the next run.
    assert hot.scan_trades().count() == 2
    assert lifecycle.pending_runs(hot) == ["run-1"]
    with pytest.raises(RuntimeError, match="run-1"):
        lifecycle.delete_trades(hot, spark.createDataFrame([("t0001",)], "trade_id string"), "m")
    fill(spark, hot, "b", [3])
    assert lifecycle.drain(hot, paths, "run-2") == ["run-1", "run-2"]
    done = lake.read_curated(spark, paths.curated, lifecycle.committed_runs(hot))
    assert done.count() == 3
    assert lake.read_raw_trades(spark, paths.raw_trades).count() == 3
    assert hot.scan_trades().count() == 0


@pytest.mark.parametrize("mode", ["compat", "by_trade_id"])
def test_other_modes(spark, hot, paths, mode):
    fill(spark, hot, "a", [1, 2, 3], found=[2, 50])
    lifecycle.drain(hot, paths, "run-1", mode=mode)
    assert ids(hot.scan_notifications()) == ["t0050"]
    done = lake.read_curated(spark, paths.curated)
    assert done.where("triggered_notification").count() == 1


def test_bounded_runs_and_copies(spark, hot, paths):
    fill(spark, hot, "a", [1, 2, 3], found=[1])
    fill(spark, hot, "b", [3, 4, 5])
    finished = lifecycle.drain(hot, paths, "run", max_rows=2, dedup=True)
    assert finished == ["run", "run-1", "run-2"]
    assert ids(lake.read_raw_trades(spark, paths.raw_trades)) == [f"t000{n}" for n in range(1, 6)]
    assert hot.scan_trades().count() == 0
    assert parts(hot) == []


def test_keep_all_notifications(spark, hot, paths):
    fill(spark, hot, "a", [2], found=[2, 2])
    lifecycle.drain(hot, paths, "run", keep_notifications="all", dedup=False)
    assert lake.read_raw_notifications(spark, paths.raw_notifications).count() == 2


def test_drain_periodically(spark, hot, paths, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    fill(spark, hot, "a", [1, 2])
    lifecycle.drain_periodically(hot, paths, checkpoint).awaitTermination()
    assert hot.scan_trades().count() == 0
    lifecycle.drain_periodically(hot, paths, checkpoint).awaitTermination()
    fill(spark, hot, "b", [3])
    lifecycle.drain_periodically(hot, paths, checkpoint).awaitTermination()
    assert lake.read_curated(spark, paths.curated, lifecycle.committed_runs(hot)).count() == 3


def test_empty_store_writes_nothing(spark, hot, paths):
    assert lifecycle.drain(hot, paths, "run") == []
    assert not os.path.exists(paths.base)


# --- upkeep of the lake ------------------------------------------------------------------


def folders(base):
    return len({os.path.dirname(f) for f in glob.glob(f"{base}/**/*.parquet", recursive=True)})


def test_lake_compaction(spark, hot, paths):
    """Closed days become one folder each; readers see the same before, between and after."""
    day = 86_400
    for run in range(3):
        made = [trade(10 * run + n, trade_time=at(n * day + run), event_time=at(n * day)) for n in range(3)]
        hot.append(f"b{run}", {TRADES: trades(spark, made), NOTIFICATIONS: notices(spark, [notice(f"2024-01-0{run + 1}T00:00:00Z")])})
        lifecycle.drain(hot, paths, f"run-{run}", mode="by_trade_id" if run else "exact")

    def seen():
        return [
            rows(lake.read_raw_trades(spark, paths.raw_trades, runs=hot.runs)),
            rows(lake.read_raw_notifications(spark, paths.raw_notifications, runs=hot.runs)),
            rows(lake.read_curated(spark, paths.curated, hot.runs)),
            *[rows(lake.read_merged_rollups(spark, paths.analytics, g, hot.runs)) for g in rollup.GRAINS],
        ]

    before, several = seen(), folders(paths.curated)
    assert several == 9
    assert lifecycle.compact_lake(hot.runs, paths, "2024-01-03", "pack") > 0
    assert seen() == before
    # The day that is not closed keeps its folders, so the runs keep theirs too.
    assert lifecycle.vacuum_lake(hot.runs, paths) == 0
    assert lifecycle.compact_lake(hot.runs, paths, "2024-02-01", "pack-2") > 0
    assert lifecycle.vacuum_lake(hot.runs, paths) > 0
    assert seen() == before
    assert folders(paths.curated) == 3
    # Published rows are one a bucket now.
    assert rows(lake.read_rollups(spark, paths.analytics, "daily", hot.runs)) == before[-1]
    assert lifecycle.compact_lake(hot.runs, paths, "2024-02-01", "pack-3") == 0


def test_broken_lake_compaction_shows_nothing(spark, hot, paths, monkeypatch):
    for run in range(2):
        fill(spark, hot, f"b{run}", [run + 1])
        lifecycle.drain(hot, paths, f"run-{run}")
    before = rows(lake.read_curated(spark, paths.curated, hot.runs))
    with monkeypatch.context() as broken:
        broken.setattr(lifecycle, "write_rollups", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lifecycle.compact_lake(hot.runs, paths, "2024-02-01", "pack")
    assert rows(lake.read_curated(spark, paths.curated, hot.runs)) == before
    assert lifecycle.compact_lake(hot.runs, paths, "2024-02-01", "pack") > 0
    assert rows(lake.read_curated(spark, paths.curated, hot.runs)) == before


def test_late_rows_of_a_packed_day_are_added(spark, hot, paths):
    for run in range(2):
        fill(spark, hot, f"b{run}", [run + 1])
        lifecycle.drain(hot, paths, f"run-{run}")
    lifecycle.compact_lake(hot.runs, paths, "2024-02-01", "pack")
    fill(spark, hot, "b2", [3])
    lifecycle.drain(hot, paths, "run-2")
    assert lake.read_curated(spark, paths.curated, hot.runs).count() == 3
    daily = lake.read_merged_rollups(spark, paths.analytics, "daily", hot.runs)
    assert rows(daily, "trade_count") == [(3,)]


def test_legacy_file_of_one_line_is_cut_while_it_is_read(spark, tmp_path):
    """No row of the reader is longer than a record, whatever the file's one line holds."""
    record = '{"ID":"%d","Symbol":"S","EventTime":"2024-01-01T00:00:00Z","Price":1}'
    n = 20_000
    with gzip.open(tmp_path / "1.jsonl.gz", "wt") as f:
        f.write("".join(record % i for i in range(n)))
    records = lake._legacy_records(spark, str(tmp_path), lake._TRADE_START)
    longest, count = records.agg(F.max(F.length("value")), F.count("*")).first()
    assert count == n and longest < 100
    assert lake.read_raw_trades(spark, str(tmp_path), legacy=True).select("trade_id").distinct().count() == n
