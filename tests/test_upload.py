"""The data source writer over an uploader: whole batches or nothing."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import alerts, rollup
from tapeloom.sources import upload

from helpers import at, rows, trade, trades


def files(path):
    return [f for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)]


def test_batches_are_named_and_replaced(spark, tmp_path):
    base = str(tmp_path)
    name = upload.register(spark, upload.FolderUploader(base), "up_a")
    df = trades(spark, [trade(n) for n in range(20)]).repartition(4)
    upload.upload(df, name, "trades", "b1", maxRecordsPerFile="2")
    upload.upload(df.where("aggregate_id < 5"), name, "trades", "b2")
    assert upload.read_uploaded(spark, base, "trades", schemas.TRADE).count() == 25
    upload.upload(df, name, "trades", "b1")
    assert rows(upload.read_uploaded(spark, base, "trades", schemas.TRADE).dropDuplicates()) == rows(df)
    assert upload.read_uploaded(spark, base, "trades", schemas.TRADE).count() == 25


def test_empty_table(spark, tmp_path):
    name = upload.register(spark, upload.FolderUploader(str(tmp_path)), "up_b")
    upload.upload(trades(spark, []), name, "trades", "b1")
    assert upload.read_uploaded(spark, str(tmp_path), "trades", schemas.TRADE).count() == 0


def test_failed_task_leaves_nothing(spark, tmp_path):
    """One task fails after others have put their files: no manifest, no files."""
    base = str(tmp_path)
    name = upload.register(spark, upload.FolderUploader(base), "up_c")

    def fail(batches):
        for batch in batches:
            yield batch
        raise ValueError("lost")

    df = trades(spark, [trade(n) for n in range(8)]).repartition(4)
    broken = df.where("aggregate_id < 3").coalesce(1).mapInArrow(fail, df.schema)
    with pytest.raises(Exception, match="lost"):
        upload.upload(df.unionByName(broken), name, "trades", "b1")
    assert files(base) == []
    upload.upload(df, name, "trades", "b1")
    assert rows(upload.read_uploaded(spark, base, "trades", schemas.TRADE)) == rows(df)


def test_refusing_uploader(spark, tmp_path):
    """An uploader of the caller's own; tasks know a class made here by value."""

    class Refusing(upload.FolderUploader):
        def put(self, name, data):
            if "/data/" in name:
                raise OSError("quota")
            super().put(name, data)

    name = upload.register(spark, Refusing(str(tmp_path)), "up_d")
    with pytest.raises(Exception, match="quota"):
        upload.upload(trades(spark, [trade(1)]), name, "trades")
    assert files(str(tmp_path)) == []


def test_rollups_round_trip(spark, tmp_path):
    base = str(tmp_path)
    name = upload.register(spark, upload.FolderUploader(base), "up_e")
    df = trades(spark, [trade(n, trade_time=at(n * 1000)) for n in range(20)]).withColumn("triggered_notification", F.lit(False))
    for grain, table in rollup.process(df).items():
        upload.upload(table, name, grain, "run-1")
        assert rows(upload.read_uploaded(spark, base, grain, schemas.rollup(grain))) == rows(table)


def test_stream_of_alerts(spark, tmp_path):
    """A stream through the uploader, restarted: each alert once."""
    base, source, checkpoint = (str(tmp_path / n) for n in ("up", "in", "cp"))
    name = upload.register(spark, upload.FolderUploader(base), "up_f")
    tape = trades(spark, [trade(n, price=3_000_000.0 if n % 2 else 1.0) for n in range(10)])
    for part in range(2):
        tape.where(F.col("aggregate_id") % 2 == part).coalesce(1).write.mode("append").parquet(source)
        stream = alerts.alert_messages(spark.readStream.schema(schemas.TRADE).parquet(source))
        writer = stream.writeStream.format(name).option("table", "alerts").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    batch = alerts.alert_messages(tape)
    assert rows(upload.read_uploaded(spark, base, "alerts", batch.schema)) == rows(batch)
