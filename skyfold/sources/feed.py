"""A message feed over TCP as a streaming source of Spark: lanes of numbered messages, kept until they are committed.

A feed answers three lines of text:

  lanes                    one line of JSON: {lane: [first position kept, position after the last]}
  read LANE FROM TO        the messages of [FROM, TO): position, 8 bytes; arrival, 8 bytes, microseconds since the
                           epoch; length, 4 bytes; the message. Numbers are big-endian.
  commit LANE TO           one line, once messages before TO need not be kept

Offsets are positions by lane, so Spark's own log says what a batch holds, and a batch that is begun again after a
failure reads the same messages. They are committed once the batch is done. A connection that breaks is made again,
first after `first_s`, then after twice as long each time up to `most_s`; a session that had begun before it broke
starts over with the first. A task that was reading goes on where it was.
"""

from __future__ import annotations

import json
import socket
import struct
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

HEAD = struct.Struct(">QqI")
#: Bytes of messages of an Arrow batch.
BATCH_BYTES = 1 << 20
SCHEMA = "lane string, position long, arrived timestamp, content binary"


class FeedClosed(ConnectionError):
    """The feed couldn't be reached as often as was allowed."""


class Feed:
    """A client that makes its connection again. attempts: failures to connect, one after another, that end it."""

    def __init__(self, host: str, port: int, first_s: float = 1.0, most_s: float = 30.0, attempts: int = 20, timeout_s: float = 30.0):
        self.host, self.port, self.first_s, self.most_s, self.attempts, self.timeout_s = host, port, first_s, most_s, attempts, timeout_s
        self.reconnects, self._pause, self._socket, self._file = 0, first_s, None, None

    def close(self) -> None:
        for x in (self._file, self._socket):
            if x is not None:
                x.close()
        self._socket = self._file = None

    def _connected(self):
        failed = 0
        while self._file is None:
            try:
                self._socket = socket.create_connection((self.host, self.port), self.timeout_s)
                self._file = self._socket.makefile("rwb")
            except OSError as e:
                failed += 1
                if failed >= self.attempts:
                    raise FeedClosed(f"{self.host}:{self.port}: {e}") from e
                self._wait()
        return self._file

    def _wait(self) -> None:
        time.sleep(self._pause)
        self._pause = min(2 * self._pause, self.most_s)

    def _lost(self, begun: bool) -> None:
        """After a broken session: begun, if the feed had answered anything in it."""
        self.close()
        self.reconnects += 1
        if begun:
            self._pause = self.first_s
        self._wait()

    def _line(self, text: str) -> bytes:
        failed = 0
        while True:
            try:
                f = self._connected()
                f.write(text.encode() + b"\n")
                f.flush()
                if (found := f.readline()).endswith(b"\n"):
                    self._pause = self.first_s
                    return found
                raise EOFError
            except (OSError, EOFError) as e:
                if isinstance(e, FeedClosed) or (failed := failed + 1) >= self.attempts:
                    raise
                self._lost(begun=False)

    def lanes(self) -> dict[str, tuple[int, int]]:
        return {k: (int(a), int(b)) for k, (a, b) in json.loads(self._line("lanes")).items()}

    def commit(self, lane: str, to: int) -> None:
        self._line(f"commit {lane} {to}")

    def read(self, lane: str, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
        """(position, arrival, message) of [start, end), each once, whatever happens to connections on the way."""
        at, failed = start, 0
        while at < end:
            begun = at
            try:
                f = self._connected()
                f.write(f"read {lane} {at} {end}\n".encode())
                f.flush()
                while at < end:
                    position, arrived, size = HEAD.unpack(_exactly(f, HEAD.size))
                    body = _exactly(f, size)
                    if position != at:
                        raise ValueError(f"lane {lane}: position {position} came in place of {at}")
                    yield position, arrived, body
                    at, failed = at + 1, 0
            except (OSError, EOFError) as e:
                if isinstance(e, FeedClosed) or (failed := failed + 1) >= self.attempts:
                    raise
                self._lost(begun=at > begun)


def _exactly(f, n: int) -> bytes:
    found = f.read(n)
    if found is None or len(found) < n:
        raise EOFError
    return found


class Stretch(InputPartition):
    """Messages [start, end) of a lane: what one task reads."""

    def __init__(self, lane: str, start: int, end: int):
        self.lane, self.start, self.end = lane, start, end


class FeedReader(DataSourceStreamReader):
    """Batches of at most `prefetch` messages a lane, in tasks of at most `stretch`."""

    def __init__(self, connect: Callable[[], Feed], lanes: list[str] | None, prefetch: int, stretch: int):
        self.connect, self.wanted, self.prefetch, self.stretch = connect, lanes, prefetch, stretch
        self.feed: Feed | None = None
        self.planned: dict[str, int] = {}
        self.told: dict | None = None

    def __getstate__(self):
        return self.__dict__ | {"feed": None}

    def _feed(self) -> Feed:
        self.feed = self.feed or self.connect()
        return self.feed

    def _lanes(self) -> dict[str, tuple[int, int]]:
        found = self._feed().lanes()
        return {k: v for k, v in found.items() if self.wanted is None or k in self.wanted}

    def initialOffset(self) -> dict:
        return {"lanes": {k: first for k, (first, _) in self._lanes().items()}, "reconnects": 0}

    def latestOffset(self) -> dict:
        lanes = self._lanes()
        ends = {k: min(end, max(first, self.planned.get(k, first)) + self.prefetch) for k, (first, end) in lanes.items()}
        if self.told is None or ends != self.told["lanes"]:  # reconnections alone are no batch
            self.told = {"lanes": ends, "reconnects": self._feed().reconnects}
        return self.told

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.planned.update(end["lanes"])
        found = []
        for lane, to in end["lanes"].items():
            at = start["lanes"].get(lane, 0)
            found += [Stretch(lane, k, min(to, k + self.stretch)) for k in range(at, to, self.stretch)]
        return found

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        feed, held, size = self.connect(), [], 0
        try:
            for message in feed.read(partition.lane, partition.start, partition.end):
                held.append(message)
                size += len(message[2])
                if size >= BATCH_BYTES:
                    yield _batch(partition.lane, held)
                    held, size = [], 0
            if held:
                yield _batch(partition.lane, held)
        finally:
            feed.close()

    def commit(self, end: dict) -> None:
        for lane, to in end["lanes"].items():
            self._feed().commit(lane, to)

    def stop(self) -> None:
        if self.feed is not None:
            self.feed.close()


def _batch(lane: str, messages: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    position, arrived, content = zip(*messages, strict=True)
    columns = [pa.array([lane] * len(position)), pa.array(position, pa.int64()), pa.array(arrived, pa.timestamp("us", tz="UTC")), pa.array(content, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["lane", "position", "arrived", "content"])


class MessageFeed(DataSource):
    """Options: host, port, lanes (comma-separated; all by default), prefetch, stretch, firstSeconds, mostSeconds,
    attempts."""

    @classmethod
    def name(cls) -> str:
        return "message_feed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FeedReader:
        own = self.options
        host, port = own["host"], int(own["port"])
        first, most, attempts = float(own.get("firstSeconds", 1)), float(own.get("mostSeconds", 30)), int(own.get("attempts", 20))
        lanes = [x.strip() for x in own["lanes"].split(",")] if own.get("lanes") else None
        return FeedReader(lambda: Feed(host, port, first, most, attempts), lanes, int(own.get("prefetch", 1000)), int(own.get("stretch", 1000)))


def stream_feed(spark: SparkSession, address: str, sensors: list[str] | None = None, **options: object) -> DataFrame:
    """The messages of feed://host:port as a stream of seq, arrived and content. sensors: the lanes that are bound."""
    at = urlsplit(address)
    spark.dataSource.register(MessageFeed)
    reader = spark.readStream.format("message_feed").option("host", at.hostname).option("port", at.port)
    if sensors:
        reader = reader.option("lanes", ",".join(sensors))
    for k, v in options.items():
        reader = reader.option(k, v)
    name = F.concat("lane", F.lit("/"), F.lpad(F.col("position").cast("string"), 20, "0"))
    return reader.load().select(name.alias("path"), "arrived", "content")
