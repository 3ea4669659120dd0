"""The lake: raw archive (gzip JSON lines), curated and rollup tables (snappy Parquet).

Every write of a run goes to its own `run=` folder and replaces it, so repeating a run
repeats its files instead of adding to them. Rows are rebalanced by partition before a
write: small partitions share a task, a hot one is split over many.

Readers take the rows of all runs, of a list of runs, or of what the finished runs of a
`Runs` table left: then a day that a compaction has merged comes from its one folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom import schemas
from tapeloom.functions import times
from tapeloom.operators import rollup as rollups
from tapeloom.session import session_conf
from tapeloom.sources import envelopes
from tapeloom.sources.runs import Runs

#: Which runs a reader takes rows of.
Chosen = Sequence[str] | Runs | None
#: Names of the lake's tables in a table of runs; the part of a run is a day there.
RAW_TRADES, RAW_NOTIFICATIONS, CURATED, STATE = "raw_trades", "raw_notifications", "curated", "state"

# Row group sizes of the curated and the rollup files.
CURATED_ROW_GROUP = 128 * 1024 * 1024
ROLLUP_ROW_GROUP = 4 * 1024 * 1024

# A record of the concatenated archive starts with its first key.
_TRADE_START = '{"ID":'
_NOTIFICATION_START = '{"EventTime":'

_WRITE_SETTINGS = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    # A folder's rows share a shuffle partition, so more write tasks mean no more files.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


def _write(rows: DataFrame, path: str, parts: list[str], run: str, fmt: str, **options: str) -> None:
    writer = rows.write.mode("overwrite").options(**options).partitionBy(*parts).format(fmt)
    with session_conf(rows.sparkSession, _WRITE_SETTINGS):
        writer.save(f"{path.rstrip('/')}/run={run}")


def _in_runs(rows: DataFrame, runs: Chosen, table: str) -> DataFrame:
    """Rows of the chosen runs (a partition filter, or joins on partition columns)."""
    if runs is None:
        return rows
    if isinstance(runs, Runs):
        return runs.live(rows, table, "date")
    return rows.where(F.col("run").isin(list(runs)))


def _parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # A given schema keeps `date` a string and spares schema inference.
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _folder(spark, path)
    return system.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> bool:
    system, folder = _folder(spark, path)
    return system.delete(folder, True)


def folders(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(run, date) of the rows below a table's folder."""
    if table in (RAW_TRADES, RAW_NOTIFICATIONS):
        return raw_lines(spark, path, table).select("run", "date")
    return spark.read.schema("run string, date string").parquet(path)


# Stands for the empty symbol in a folder's name, where Spark would make it a null.
_EMPTY = "__empty__"


def _to_folder(rows: DataFrame) -> DataFrame:
    return rows.withColumn("symbol", F.when(F.col("symbol") == "", _EMPTY).otherwise(F.col("symbol")))


def _from_folder(rows: DataFrame) -> DataFrame:
    """The symbol again; a filter on it still prunes folders, as it reads folder names only."""
    return rows.withColumn("symbol", F.when(F.col("symbol") == _EMPTY, "").otherwise(F.col("symbol")))


def partition_counts(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Rows per output partition."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


# --- raw archive -----------------------------------------------------------------------


def _time_parts(time: Column, hour: bool) -> dict[str, Column]:
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"} | ({"hour": "HH"} if hour else {})
    return {
        name: F.coalesce(F.date_format(time, pattern), F.lit("unknown"))
        for name, pattern in patterns.items()
    }


def _archive(rows: DataFrame, path: str, run: str, time: Column, hour: bool, schema: T.StructType, names: dict[str, str]) -> None:
    parts = _time_parts(time, hour)
    payload = envelopes.payload_json(schema, names)
    write_raw_lines(rows.select(payload.alias("value"), *[c.alias(n) for n, c in parts.items()]), path, run)


def write_raw_lines(lines: DataFrame, path: str, run: str) -> None:
    """Gzip lines (`value`) by year, month, day and, where they have one, hour."""
    parts = [c for c in ("year", "month", "day", "hour") if c in lines.columns]
    lines = lines.select("value", *parts).hint("rebalance", *parts)
    _write(lines, path, parts, run, "text", compression="gzip")


def archive_raw_trades(trades: DataFrame, path: str, run: str) -> None:
    """Gzip JSON lines by UTC hour of the trade time."""
    _archive(trades, path, run, F.col("trade_time"), True, schemas.TRADE, schemas.TRADE_WIRE)


def archive_raw_notifications(notifications: DataFrame, path: str, run: str) -> None:
    """Gzip JSON lines by UTC day of the event time; an unreadable time goes to `unknown`."""
    _archive(
        notifications,
        path,
        run,
        times.parse_rfc3339("event_time"),
        False,
        schemas.NOTIFICATION,
        schemas.NOTIFICATION_WIRE,
    )


def raw_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Lines of the archive (`value`) with their `run`, `date` and the parts of their time."""
    parts = ["run", "year", "month", "day", *(["hour"] if table == RAW_TRADES else [])]
    schema = ", ".join(f"{c} string" for c in ("value", *parts))
    # Where runs have written no line yet, there are no folders to take the parts from.
    written = "run" in spark.read.text(path).columns
    lines = spark.read.schema(schema).text(path) if written else spark.createDataFrame([], schema)
    return lines.withColumn("date", F.concat_ws("-", "year", "month", "day"))


def _read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    names: dict[str, str],
    start: str,
    legacy: bool,
    runs: Chosen,
    table: str,
) -> DataFrame:
    shape = schemas.wire_schema(schema, names)
    if legacy:
        # Plain YYYY/MM/DD/HH folders, no partition columns. Records follow one another without
        # a newline, so the reader itself cuts where the next one starts.
        rows = _legacy_records(spark, path, start)
    else:
        rows = _in_runs(raw_lines(spark, path, table), runs, table)
    parsed = rows.select(F.explode(F.array(F.from_json("value", shape))).alias("r"))
    return envelopes.typed_payload(parsed, "r", schema, names)


def _legacy_records(spark: SparkSession, path: str, start: str) -> DataFrame:
    """Records of concatenated JSON texts, one a row, split while the file is read.

    The reader's separator is how a record starts: a brace and its first key. Inside a JSON
    text a quote is escaped, so it is never part of a value, and no row is longer than a record.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("lineSep", start).text(path)
    rest = F.rtrim(F.col("value"), F.lit("\n\r\t "))
    # What comes before a file's first record is empty.
    records = rows.where(rest != "").select(F.concat(F.lit(start), rest).alias("value"))
    # A compressed file is one task; spread its records for what follows.
    return records.hint("rebalance")


def read_raw_trades(spark: SparkSession, path: str, legacy: bool = False, runs: Chosen = None) -> DataFrame:
    """Archived trades; `legacy` reads files of concatenated records."""
    return _read_raw(spark, path, schemas.TRADE, schemas.TRADE_WIRE, _TRADE_START, legacy, runs, RAW_TRADES)


def read_raw_notifications(spark: SparkSession, path: str, legacy: bool = False, runs: Chosen = None) -> DataFrame:
    return _read_raw(
        spark,
        path,
        schemas.NOTIFICATION,
        schemas.NOTIFICATION_WIRE,
        _NOTIFICATION_START,
        legacy,
        runs,
        RAW_NOTIFICATIONS,
    )


# --- curated ---------------------------------------------------------------------------


def write_curated(curated: DataFrame, path: str, run: str) -> None:
    """Snappy Parquet by symbol and date, each file in trade-time order."""
    rows = _to_folder(curated).hint("rebalance", "symbol", "date").sortWithinPartitions(
        "symbol", "date", "trade_time"
    )
    options = {"parquet.block.size": str(CURATED_ROW_GROUP), "compression": "snappy"}
    _write(rows, path, ["symbol", "date"], run, "parquet", **options)


def curated_rows(spark: SparkSession, path: str) -> DataFrame:
    """Curated trades with their `run`."""
    return _from_folder(_parquet(spark, path, schemas.CURATED))


def read_curated(spark: SparkSession, path: str, runs: Chosen = None) -> DataFrame:
    """Curated trades; filters on symbol and date prune folders."""
    return _in_runs(curated_rows(spark, path), runs, CURATED).select(*schemas.CURATED.names)


# --- rollups ---------------------------------------------------------------------------


def write_rollup(rows: DataFrame, path: str, grain: str, run: str) -> None:
    """One run's rows of one grain under `path/grain`, sorted by bucket start in each file."""
    name = schemas.GRAINS[grain][1]
    rows = _to_folder(rows).hint("rebalance", "symbol", "date")
    rows = rows.sortWithinPartitions("symbol", "date", name)
    options = {"parquet.block.size": str(ROLLUP_ROW_GROUP), "compression": "snappy"}
    _write(rows, f"{path.rstrip('/')}/{grain}", ["symbol", "date"], run, "parquet", **options)


def write_state(state: DataFrame, path: str, run: str) -> None:
    """One run's minute state, by date."""
    dated = state.withColumn("date", times.utc_date("minute_start"))
    rows = dated.hint("rebalance", "date").sortWithinPartitions("date", "symbol", "minute_start")
    _write(rows, f"{path.rstrip('/')}/state", ["date"], run, "parquet")


def state_rows(spark: SparkSession, path: str) -> DataFrame:
    """Minute state with its `run` and `date`."""
    schema = schemas.minute_state()
    dated = T.StructType([*schema.fields, T.StructField("date", T.StringType())])
    return _parquet(spark, f"{path.rstrip('/')}/state", dated)


def read_state(spark: SparkSession, path: str, runs: Chosen = None) -> DataFrame:
    return _in_runs(state_rows(spark, path), runs, STATE)


def read_rollups(spark: SparkSession, path: str, grain: str, runs: Chosen = None) -> DataFrame:
    """Published rows as written: a bucket has one row per run that touched it."""
    schema = schemas.rollup(grain)
    rows = _from_folder(_in_runs(_parquet(spark, f"{path.rstrip('/')}/{grain}", schema), runs, grain))
    return rows.select(*schema.names)


def read_merged_rollups(
    spark: SparkSession,
    path: str,
    grain: str,
    runs: Chosen = None,
    where: Column | None = None,
) -> DataFrame:
    """One row per bucket over all runs; `where` (on symbol, date) prunes folders first."""
    state = read_state(spark, path, runs)
    if where is not None:
        state = state.where(where)
    return rollups.publish(rollups.merge_states(state), grain)
