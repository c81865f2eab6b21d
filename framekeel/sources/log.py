"""A message log in a shared folder: published in epochs that are visible whole or not at all, read by subscription.

Tasks write files of messages below ``data``; an epoch becomes visible when its list of files appears below
``entries``, in one atomic step. What a failed task or epoch left below ``data`` is in no list, so no reader sees it.
An epoch that is published again after a crash finds its entry and discards its files. The folder may be on any file
system that Arrow knows by its URI. A log has one publisher, which the entries name; another one is refused.

The stream's offset is the number of entries read, so a query that starts again on its checkpoint reads each message
once. A named subscription keeps its position in the log as well: a query without checkpoint goes on there, and
without a name it sees what is published after its start.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

FORMAT = "message_log"
#: Rows of a file that are read at a time.
BATCH_ROWS = 1024


class _Folder:
    """Small files of a log on whatever file system its path names."""

    def __init__(self, path: str):
        from pyarrow import fs

        if path.startswith("file:/") and not path.startswith("file:///"):
            path = "file:///" + path.removeprefix("file:").lstrip("/")
        self.fs, root = fs.FileSystem.from_uri(path)
        self.root = root.rstrip("/")

    def exists(self, name: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.root}/{name}").type != fs.FileType.NotFound

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found)

    def read_json(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.root}/{name}") as file:
            return json.loads(file.read())

    def write_json(self, name: str, value: dict) -> None:
        """Write ``name`` so that readers see all of it or nothing."""
        folder = name.rsplit("/", 1)[0]
        self.fs.create_dir(f"{self.root}/{folder}", recursive=True)
        draft = f"{self.root}/{folder}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as file:
            file.write(json.dumps(value).encode())
        self.fs.move(draft, f"{self.root}/{name}")

    def delete(self, name: str) -> None:
        if self.exists(name):
            self.fs.delete_file(f"{self.root}/{name}")


def _entry(number: int) -> str:
    return f"entries/{number:020d}.json"


def _next_entry(folder: _Folder) -> int:
    numbers = [int(n.removesuffix(".json")) for n in folder.names("entries") if not n.startswith(".")]
    return max(numbers, default=-1) + 1


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    rows: int


class _Writer:
    """What writing a table and writing a stream have in common."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.publisher = options.get("publisher") or options.get("checkpointLocation") or ""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.parquet as pq

        folder, name, rows, writer = _Folder(self.path), f"data/{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if writer is None:
                    folder.fs.create_dir(f"{folder.root}/data", recursive=True)
                    writer = pq.ParquetWriter(f"{folder.root}/{name}", batch.schema, filesystem=folder.fs)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return _Written(name if writer is not None else None, rows)

    def publish(self, messages: list, number: int) -> None:
        folder = _Folder(self.path)
        if folder.exists(_entry(number)):
            if folder.read_json(_entry(number))["publisher"] != self.publisher:
                raise ValueError(f"{self.path} has another publisher; give this one a log of its own")
            # The epoch was visible before the publisher stopped; these are its files written once more.
            self.discard(messages)
            return
        files = [{"name": m.name, "rows": m.rows} for m in messages if m is not None and m.name]
        folder.write_json(_entry(number), {"publisher": self.publisher, "files": files})

    def discard(self, messages: list) -> None:
        folder = _Folder(self.path)
        for m in messages:
            if m is not None and m.name:
                folder.delete(m.name)


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        self.publish(messages, batchId)

    def abort(self, messages, batchId):
        self.discard(messages)


class _TableWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages):
        self.publish(messages, _next_entry(_Folder(self.path)))

    def abort(self, messages):
        self.discard(messages)


@dataclass
class _File(InputPartition):
    name: str


class _FileReader:
    def __init__(self, options: dict, schema: StructType):
        self.path, self.columns = options["path"], schema.names

    def files(self, start: int, end: int) -> list[_File]:
        folder = _Folder(self.path)
        return [_File(f["name"]) for n in range(start, end) for f in folder.read_json(_entry(n))["files"]]

    def read(self, partition):
        import pyarrow.parquet as pq

        if partition is None:
            # Spark's stand-in for a log without files.
            return
        folder = _Folder(self.path)
        with folder.fs.open_input_file(f"{folder.root}/{partition.name}") as file:
            yield from pq.ParquetFile(file).iter_batches(BATCH_ROWS, columns=self.columns)


class _TableReader(_FileReader, DataSourceReader):
    def partitions(self):
        return self.files(0, _next_entry(_Folder(self.path)))


class _StreamReader(_FileReader, DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        super().__init__(options, schema)
        self.subscription = options.get("subscription")
        self.earliest = options.get("start", "latest") == "earliest"
        self.seen: int | None = None

    def _position(self) -> str:
        return f"subscriptions/{self.subscription}.json"

    def initialOffset(self):
        folder = _Folder(self.path)
        if self.subscription and folder.exists(self._position()):
            return folder.read_json(self._position())
        return {"entries": 0 if self.earliest else _next_entry(folder)}

    def latestOffset(self):
        folder = _Folder(self.path)
        if self.seen is None:
            self.seen = _next_entry(folder)
        # Entries come one after the other, so the folder is listed once.
        while folder.exists(_entry(self.seen)):
            self.seen += 1
        return {"entries": self.seen}

    def partitions(self, start, end):
        return self.files(start["entries"], end["entries"])

    def commit(self, end):
        if self.subscription:
            _Folder(self.path).write_json(self._position(), end)


class MessageLog(DataSource):
    """Data source ``message_log``; see the module's text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "value string"

    def reader(self, schema):
        return _TableReader(self.options, schema)

    def streamReader(self, schema):
        return _StreamReader(self.options, schema)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a log is appended to")
        return _TableWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options)


def subscribe(
    spark: SparkSession, path: str, subscription: str | None = None, *, start: str = "latest", streaming: bool = True
) -> DataFrame:
    """Messages of the log at ``path``: from where the ``subscription`` stopped, or from ``start`` (``latest``, ``earliest``).

    With ``streaming=False``, the messages that are visible now.
    """
    spark.dataSource.register(MessageLog)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).option("start", start)
    if subscription:
        reader = reader.option("subscription", subscription)
    return reader.load(path)


def publish(
    messages: DataFrame, path: str, checkpoint: str, *, publisher: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Start publishing a stream of ``value`` messages; a micro-batch is visible to readers whole or not at all."""
    messages.sparkSession.dataSource.register(MessageLog)
    writer = messages.select("value").writeStream.format(FORMAT).option("path", path)
    return (
        writer.option("publisher", publisher or checkpoint)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
