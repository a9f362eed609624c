"""A message queue as a source: drained in a batch, or read as a stream with a bound on the messages of a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


def queue_source(name: str, make_client: Callable[[], Callable[[float], str | None]]) -> type[DataSource]:
    """A source called ``name`` with one column ``value``.

    ``make_client`` is called where the queue is read and gives a function that waits at most so many seconds for a message and
    returns it, or None.  Options: ``max_items`` (default 32) and ``max_wait_ms`` (default 100) of one draining; ``readers`` (default 1) that
    drain at once in a batch.  A stream keeps the messages of a micro-batch until it is committed, so that one that runs
    again has the same; they are taken one draining after the other.  The classes are made here so that they travel to the
    workers by value."""

    def drained(client: Callable[[float], str | None], items: int, wait_ms: int) -> list[tuple[str]]:
        import time

        end, out = time.monotonic() + wait_ms / 1000, []
        while len(out) < items and (left := end - time.monotonic()) > 0:
            message = client(left)
            if message is not None:
                out.append((message,))
        return out

    class Batch(DataSourceReader):
        def __init__(self, options):
            self.items, self.wait, self.readers = int(options.get("max_items", 32)), int(options.get("max_wait_ms", 100)), int(options.get("readers", 1))

        def partitions(self):
            return [InputPartition(i) for i in range(self.readers)]

        def read(self, partition):
            yield from drained(make_client(), self.items, self.wait)

    class Stream(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.items, self.wait = int(options.get("max_items", 32)), int(options.get("max_wait_ms", 100))
            self.client, self.held = None, {}

        def initialOffset(self):  # noqa: N802
            return {"at": 0}

        def read(self, start):
            self.client = self.client or make_client()
            rows = drained(self.client, self.items, self.wait)
            at = int(start["at"])
            self.held[at] = rows
            return iter(rows), {"at": at + len(rows)}

        def readBetweenOffsets(self, start, end):  # noqa: N802
            first, last = int(start["at"]), int(end["at"])
            return iter([row for at in sorted(self.held) if first <= at < last for row in self.held[at]])

        def commit(self, end):
            self.held = {at: rows for at, rows in self.held.items() if at >= int(end["at"])}

    class Queue(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "value string"

        def reader(self, schema):
            return Batch(self.options)

        def simpleStreamReader(self, schema):  # noqa: N802
            return Stream(self.options)

    return Queue


def register(spark: SparkSession, name: str, make_client: Callable[[], Callable[[float], str | None]]) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read a queue."""
    spark.dataSource.register(queue_source(name, make_client))
