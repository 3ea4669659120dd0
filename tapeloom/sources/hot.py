"""Hot store: the events that the lake does not have yet, as Parquet tables by event type.

A batch of a feed is the partition (run=feed, batch) of each table, so a replayed batch
replaces its own rows. What a run of the lake, a delete or a compaction leaves of the batches
it took is a partition (run, batch) of that run. `Runs` says which partitions are there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom import schemas
from tapeloom.sources import envelopes
from tapeloom.sources.runs import FEED, Runs, read_or_empty, write_partitions

#: Events of other types, as whole envelopes, and payloads that could not be read.
DOCUMENTS, REJECTS = "documents", "rejects"
TABLES = {
    schemas.TRADE_EVENT: schemas.TRADE,
    schemas.NOTIFICATION_EVENT: schemas.NOTIFICATION,
    DOCUMENTS: schemas.ENVELOPE,
    REJECTS: schemas.ENVELOPE,
}
#: Payloads lie next to the rest of their envelope.
STORED = TABLES | {
    t: T.StructType([*TABLES[t].fields, *schemas.ABOUT.fields])
    for t in (schemas.TRADE_EVENT, schemas.NOTIFICATION_EVENT)
}
PARTS = ["run", "batch"]

# Files are skipped by a Bloom filter where a lookup is by id; its size follows the file's rows.
_LOOKED_UP = ("trade_id", "aggregate_id")
_BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true"}


class HotStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.runs = Runs(spark, f"{self.path}/runs")
        # Not the INT96 default: only plain timestamps have statistics a time filter can use.
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")

    def table_path(self, table: str) -> str:
        return f"{self.path}/type={table}"

    def append(self, batch: str, tables: Mapping[str, DataFrame]) -> None:
        """Write a batch of a feed; a batch written before is replaced.

        Trades come last: who sees those of a batch sees its notifications too.
        """
        for table in sorted(tables, key=lambda t: (t == schemas.TRADE_EVENT, t)):
            self.write(table, tables[table], FEED, batch)

    def write(self, table: str, rows: DataFrame, run: str, batch: str, clustered: bool = False) -> None:
        """Write one partition, sorted by symbol and time unless the rows are `clustered` already.

        Rows without the columns around a payload get those of a new envelope.
        """
        if table in (schemas.TRADE_EVENT, schemas.NOTIFICATION_EVENT):
            rows = envelopes.with_about(rows, table)
        columns = STORED[table].names
        out = rows.select(*columns, F.lit(run).alias("run"), F.lit(batch).alias("batch"))
        order = [c for c in ("symbol", "trade_time", "event_time") if c in columns]
        if order and not clustered:
            out = out.sortWithinPartitions(*PARTS, *order)
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in _LOOKED_UP if c in columns}
        write_partitions(out, self.table_path(table), PARTS, **blooms, **(_BLOOM if blooms else {}))

    def stored(self, table: str) -> DataFrame:
        """All rows of a table with their `run` and `batch`, whether they are there or not."""
        schema = T.StructType([*STORED[table].fields, *[T.StructField(p, T.StringType()) for p in PARTS]])
        return read_or_empty(self.spark, self.table_path(table), schema)

    def live_parts(self, table: str) -> DataFrame:
        """(run, batch) of the partitions that are there."""
        return self.runs.live(self.stored(table).select(*PARTS).distinct(), table, "batch")

    def rows(self, table: str, parts: DataFrame | None = None) -> DataFrame:
        """Payloads, what was around them, `run` and `batch`: of all live rows, or of `parts`."""
        found = self.stored(table)
        if parts is None:
            return self.runs.live(found, table, "batch")
        return found.join(parts.select(*PARTS).distinct(), PARTS, "left_semi").select(*found.columns)

    def scan(self, table: str, parts: DataFrame | None = None) -> DataFrame:
        """Payloads of the live rows, or of the given partitions (run, batch)."""
        return self.rows(table, parts).select(*TABLES[table].names)

    def scan_trades(self, parts: DataFrame | None = None) -> DataFrame:
        return self.scan(schemas.TRADE_EVENT, parts)

    def scan_notifications(self, parts: DataFrame | None = None) -> DataFrame:
        return self.scan(schemas.NOTIFICATION_EVENT, parts)

    def scan_envelopes(self, table: str) -> DataFrame:
        """The live events of a table as envelopes, as they came in."""
        rows = self.rows(table)
        return rows.select(*schemas.ENVELOPE.names) if table in (DOCUMENTS, REJECTS) else envelopes.rewrap(rows, table)
