"""Finished runs, and the partitions of other runs that they took.

Rows lie in partitions (run, part) of Parquet tables. A run writes its own partitions and is
finished by one write here, which lists what it took: partitions it moved on, replaced or
emptied. Readers join their rows with this table. Those of an unfinished run are not there yet,
those that a finished run took are not there any more, and both change with that one write.

Everything is a Spark write that replaces its own partition, so repeating it changes nothing.
Feeds may write at any time; runs that take partitions are started one after another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The run of rows that come from a feed; they are there as soon as they are written.
FEED = "feed"
#: A partition of a table.
PART = "table string, of_run string, part string"

_FINISHED, _PLANNED = "finished", "planned"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write_partitions(rows: DataFrame, path: str, parts: Sequence[str], **options: str) -> None:
    """Replace the partitions that `rows` has, each as a whole, and leave all others."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    writer.partitionBy(*parts).parquet(path)


class Runs:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _table(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{name}", f"{PART}, run string")

    def _write(self, name: str, run: str, parts: DataFrame) -> None:
        # The row without a table says that the run was here, even if it took nothing.
        mark = self.spark.createDataFrame([(None, None, None)], PART)
        rows = parts.select("table", "of_run", "part").unionByName(mark).coalesce(1)
        write_partitions(rows.withColumn("run", F.lit(run)), f"{self.path}/{name}", ["run"])

    def parts(self, found: Sequence[tuple[str, str, str]]) -> DataFrame:
        return self.spark.createDataFrame(list(found), PART)

    # --- what runs are going to take ----------------------------------------------------

    def plan(self, run: str, parts: DataFrame) -> None:
        """Note what a run is going to take, so that it can be repeated over the same rows."""
        self._write(_PLANNED, run, parts)

    def planned(self, run: str) -> DataFrame:
        return self._table(_PLANNED).where((F.col("run") == run) & F.col("table").isNotNull()).drop("run")

    def held(self) -> DataFrame:
        """Partitions that runs have planned to take and have not taken yet, with their `run`."""
        planned = self._table(_PLANNED)
        return planned.where(F.col("table").isNotNull()).join(self.finished(), "run", "left_anti")

    def pending(self) -> list[str]:
        """Runs that were planned and did not finish."""
        runs = self._table(_PLANNED).select("run").distinct().join(self.finished(), "run", "left_anti")
        return sorted(r["run"] for r in runs.collect())

    # --- what they have taken -----------------------------------------------------------

    def finish(self, run: str, parts: DataFrame) -> None:
        self._write(_FINISHED, run, parts)

    def finished(self) -> DataFrame:
        """(run) of the finished runs."""
        return self._table(_FINISHED).select("run").distinct()

    def is_finished(self, run: str) -> bool:
        return not self.finished().where(F.col("run") == run).isEmpty()

    def taken(self, table: str, part: str = "part") -> DataFrame:
        """(run, `part`) of the partitions of a table that finished runs took."""
        found = self._table(_FINISHED).where(F.col("table") == table)
        return found.select(F.col("of_run").alias("run"), F.col("part").alias(part)).distinct()

    def live(self, rows: DataFrame, table: str, part: str = "part") -> DataFrame:
        """Rows (with `run` and `part`) of feeds and finished runs that nobody took.

        Both joins are on partition columns with a table of one row a partition.
        """
        feed = self.spark.createDataFrame([(FEED,)], "run string")
        there = rows.join(self.finished().unionByName(feed), "run", "left_semi")
        return there.join(self.taken(table, part), ["run", part], "left_anti").select(*rows.columns)
