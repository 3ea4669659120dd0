"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import work_dir


ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under our own names; other columns cannot clash.

    Python workers started from here on look for this package where the driver found it; on a
    cluster it is installed on the executors or shipped with the job, as any package.
    """
    spark = df.sparkSession
    if spark.conf.get(ROWS_SETTING) == "10000":
        # The default would let ten thousand very long texts into one batch of a worker.
        spark.conf.set(ROWS_SETTING, "2000")
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [known.get("PYTHONPATH"), ROOT]))
    return df.select(*[df[f"`{name}`"].alias(alias) for alias, name in columns.items()])


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo; 0 for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(divisor), F.lit(0).cast("long"))


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once into the shared folder and read back: cuts the lineage for good."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the filter that goes to all tasks: 2 MB, whatever the data.
FILTER_BITS = 1 << 24


def parted(rows: DataFrame, key: str, wanted: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """`rows` whose key may be among the keys of `wanted`, and those whose key is surely not.

    A bitmap of fixed size holds the hashes of the wanted keys. With few of them it keeps most
    rows out of a shuffle; with very many it fills up and lets all through, and stays right.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(5), column), F.lit(FILTER_BITS)) + 1

    marks = wanted.select(place(key).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits")
    )
    marks = stored(marks, f"{label}-filter")
    position = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(_byte, _bit)").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    # Broadcast: FILTER_BITS / 32768 rows of 4 KB at most.
    looked_up = (
        rows.withColumn("_at", place(key)).withColumn("_bucket", F.bitmap_bucket_number("_at"))
        .join(F.broadcast(marks), "_bucket", "left")
        .withColumn("_byte", byte).withColumn("_bit", (position % 8).cast("int")).withColumn("_hit", hit)
    )
    return (
        looked_up.filter("_hit").select(*rows.columns),
        looked_up.filter("NOT _hit").select(*rows.columns),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batch: pa.RecordBatch, column: str, budget: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts sum to about `budget` bytes (at least one row)."""
    sizes = np.asarray(
        pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    start = total = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > budget:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; after the last one its worker gives free memory back.

    Workers wait for further tasks beside an executor's heap, and would keep what the largest
    of their tasks needed.
    """
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with a function of one batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(lambda batches: released(over(batches)), schema)
