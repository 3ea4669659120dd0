"""Tables to a place of the caller's own: a Python data source over an `Uploader`.

Each task puts the Parquet bytes of its rows under new names and reports them. The commit puts
one manifest that lists them all, under a name that only the batch decides, and so they are
there at once; a write that fails leaves no manifest, and what its tasks had put is taken back.
A replayed batch of a stream replaces the manifest of its number.
"""

from __future__ import annotations

import contextlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

#: Rows of a file, unless the option `maxRecordsPerFile` says otherwise.
ROWS_PER_FILE = 1_000_000
MANIFESTS = "manifests"


class Uploader(Protocol):
    """Where bytes go. Called in tasks and on the driver, so it has to be picklable."""

    def put(self, name: str, data: bytes) -> None:
        """Store an object as a whole, in place of one of that name."""

    def remove(self, name: str) -> None:
        """Delete an object, if it is there."""


class FolderUploader:
    """Objects as files below a folder that all executors share (any URI pyarrow knows)."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def _at(self, name: str) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(self.base + "/" + name)

    def put(self, name: str, data: bytes) -> None:
        system, path = self._at(name)
        folder, _, file = path.rpartition("/")
        system.create_dir(folder, recursive=True)
        # Written under a name that readers skip, then moved: seen as a whole or not at all.
        hidden = f"{folder}/_{file}.{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as out:
            out.write(data)
        system.move(hidden, path)

    def remove(self, name: str) -> None:
        system, path = self._at(name)
        with contextlib.suppress(FileNotFoundError):
            system.delete_file(path)


@dataclass
class Put(WriterCommitMessage):
    names: list[str]
    rows: int


class _Writer:
    """What batch and stream writes share."""

    def __init__(self, uploader: Uploader, table: str, rows_per_file: int):
        self.uploader, self.table, self.rows_per_file = uploader, table, rows_per_file

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        names: list[str] = []
        held: list[pa.RecordBatch] = []
        rows = total = 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    held.append(batch)
                    rows += batch.num_rows
                if rows >= self.rows_per_file:
                    names.append(self._put(held))
                    total, held, rows = total + rows, [], 0
            if held:
                names.append(self._put(held))
        except BaseException:
            # A failed task reports nothing, so it takes back what it put.
            self._take_back(names)
            raise
        return Put(names, total + rows)

    def _put(self, batches: list[pa.RecordBatch]) -> str:
        out = io.BytesIO()
        pq.write_table(pa.Table.from_batches(batches), out, compression="snappy")
        name = f"{self.table}/data/{uuid.uuid4().hex}.parquet"
        self.uploader.put(name, out.getvalue())
        return name

    def _take_back(self, names: list[str]) -> None:
        for name in names:
            self.uploader.remove(name)

    def _publish(self, messages: list[Put | None], batch: str) -> None:
        puts = [m for m in messages if m is not None]
        lines = [json.dumps({"name": name, "batch": batch}) for m in puts for name in m.names]
        self.uploader.put(f"{self.table}/{MANIFESTS}/{batch}.json", ("\n".join(lines) + "\n").encode())

    def _give_up(self, messages: list[Put | None]) -> None:
        for message in messages:
            if message is not None:
                self._take_back(message.names)


class BatchWriter(_Writer, DataSourceArrowWriter):
    def __init__(self, *args: object, batch: str):
        super().__init__(*args)
        self.batch = batch

    def commit(self, messages: list[Put | None]) -> None:
        self._publish(messages, self.batch)

    def abort(self, messages: list[Put | None]) -> None:
        self._give_up(messages)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Put | None], batchId: int) -> None:
        self._publish(messages, f"{batchId:012d}")

    def abort(self, messages: list[Put | None], batchId: int) -> None:
        self._give_up(messages)


def register(spark: SparkSession, uploader: Uploader, name: str = "upload") -> str:
    """Make `uploader` a sink: `df.write.format(name)` and `df.writeStream.format(name)`.

    Options: `table`, the first part of all names; `batch`, names a batch write, so that its
    repetition replaces it (a new name by default); `maxRecordsPerFile`.
    """

    def args(options: dict[str, str]) -> tuple[Uploader, str, int]:
        return uploader, options["table"], int(options.get("maxRecordsPerFile", ROWS_PER_FILE))

    class UploadSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
            return BatchWriter(*args(self.options), batch=self.options.get("batch", uuid.uuid4().hex))

        def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
            return StreamWriter(*args(self.options))

    spark.dataSource.register(UploadSource)
    return name


def upload(rows: DataFrame, name: str, table: str, batch: str | None = None, **options: str) -> None:
    """Write a table through a registered uploader."""
    named = {"table": table} | ({"batch": batch} if batch else {}) | options
    rows.write.format(name).mode("append").options(**named).save()


def read_uploaded(spark: SparkSession, base: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of all manifests of a table that a FolderUploader wrote."""
    listed = spark.read.schema("name string").json(f"{base}/{table}/{MANIFESTS}").where("name IS NOT NULL")
    # One name a file, as any listing of them.
    names = [f"{base}/{r['name']}" for r in listed.collect()]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
