"""Keyed records sent to a message sink in requests of bounded size.

A Python data source writes batches and streams alike. Tasks pack records into requests
(a bounded number of records and bytes each) and hand them to a target; once all tasks
of an epoch are done, the driver publishes what they handed over. An epoch that is
written again, after a failure between publishing and Spark's own note of it, finds that
it has been published and is discarded, so no record counts twice.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

from ebbtide.sinks.records import keyed_records

# What a request of the usual message service may hold.
MOST_RECORDS = 500
MOST_BYTES = 5 << 20
FORMAT = "ebbtide_requests"


def packed_requests(
    records: Iterator[tuple[str | None, str]], most_records: int, most_bytes: int
) -> Iterator[list[dict[str, str | None]]]:
    """Records as requests. A record counts with the bytes of its key and its value; one
    that is larger than a request may be is an error, as the service would refuse it."""
    request, held = [], 0
    for key, value in records:
        size = len((key or "").encode()) + len((value or "").encode())
        if size > most_bytes:
            raise ValueError(f"a record of {size} bytes does not fit a request of {most_bytes}")
        if request and (len(request) >= most_records or held + size > most_bytes):
            yield request
            request, held = [], 0
        request.append({"key": key, "value": value})
        held += size
    if request:
        yield request


class FolderTarget:
    """Requests as files of a folder that all executors and the driver reach.

    A task's requests are lines of one file under ``requests``; the files of an epoch
    count once ``epochs/<number>.json`` lists them.
    """

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")

    def put(self, requests: Iterator[list[dict]]) -> str | None:
        """Hand over a task's requests; the name tells the driver what to publish."""
        name, stream = f"requests/{uuid.uuid4().hex}.jsonl", None
        for request in requests:
            if stream is None:
                self.files.create_dir(f"{self.root}/requests", recursive=True)
                stream = self.files.open_output_stream(f"{self.root}/{name}")
            stream.write(json.dumps({"records": request}).encode() + b"\n")
        if stream is None:
            return None
        stream.close()
        return name

    def publish(self, epoch: str, names: list[str]) -> bool:
        """Whether the names count now; not if the epoch has been published before."""
        from pyarrow import fs

        marker = f"{self.root}/epochs/{epoch}.json"
        if self.files.get_file_info(marker).type != fs.FileType.NotFound:
            return False
        self.files.create_dir(f"{self.root}/epochs", recursive=True)
        with self.files.open_output_stream(f"{marker}.new") as stream:
            stream.write(b"".join(json.dumps({"name": n}).encode() + b"\n" for n in names))
        self.files.move(f"{marker}.new", marker)
        return True

    def discard(self, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.root}/{name}")


@dataclass
class Handed(WriterCommitMessage):
    name: str | None
    requests: int
    records: int


class _Sender:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.most_records = int(options.get("mostrecords", MOST_RECORDS))
        self.most_bytes = int(options.get("mostbytes", MOST_BYTES))

    def target(self) -> FolderTarget:
        return FolderTarget(self.path)

    def write(self, iterator) -> Handed:
        sent = [0, 0]

        def counted():
            rows = ((row.key, row.value) for row in iterator)
            for request in packed_requests(rows, self.most_records, self.most_bytes):
                sent[0] += 1
                sent[1] += len(request)
                yield request

        name = self.target().put(counted())
        return Handed(name, *sent)

    def finish(self, messages, epoch: str) -> None:
        names = [m.name for m in messages if m is not None and m.name]
        target = self.target()
        if not target.publish(epoch, names):
            target.discard(names)

    def drop(self, messages) -> None:
        self.target().discard([m.name for m in messages if m is not None and m.name])


class _StreamSender(_Sender, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self.finish(messages, str(batchId))

    def abort(self, messages, batchId: int) -> None:
        self.drop(messages)


class _BatchSender(_Sender, DataSourceWriter):
    def commit(self, messages) -> None:
        self.finish(messages, f"batch-{uuid.uuid4().hex}")

    def abort(self, messages) -> None:
        self.drop(messages)


class RequestSink(DataSource):
    """``format("ebbtide_requests")`` for frames of ``key`` and ``value``; options ``path``,
    ``mostRecords`` and ``mostBytes``. Other message services come in as a subclass
    with a target of their own."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return _StreamSender(self._given())

    def writer(self, schema, overwrite):
        return _BatchSender(self._given())

    def _given(self) -> dict[str, str]:
        return {name.lower(): value for name, value in self.options.items()}


def send_records(
    rows: DataFrame, key: str, path: str, checkpoint: str | None = None, **options: str
) -> StreamingQuery | None:
    """Send each row as a JSON record under its key. A stream needs a ``checkpoint``; it
    takes what is there and ends. A batch is one epoch of its own."""
    rows.sparkSession.dataSource.register(RequestSink)
    records = keyed_records(rows, key)
    if not rows.isStreaming:
        records.write.format(FORMAT).options(path=path, **options).mode("append").save()
        return None
    return (
        records.writeStream.format(FORMAT)
        .options(path=path, checkpointLocation=checkpoint, **options)
        .trigger(availableNow=True)
        .start()
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """``request`` and ``records`` of every request published."""
    named = spark.read.schema("name string").json(f"{path}/epochs")
    found = (
        spark.read.schema("records array<struct<key:string,value:string>>")
        .json(f"{path}/requests")
        .select(
            "records",
            F.regexp_extract("_metadata.file_path", r"(requests/[^/]*)$", 1).alias("name"),
        )
    )
    return found.join(named, "name", "left_semi").withColumnRenamed("name", "request")


# Workers need no copy of this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
