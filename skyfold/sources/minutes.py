"""Minute files as a batch source of Spark: one file a sensor and minute, named by a template.

Nothing is looked for on the driver: partitions are stretches of minutes, told from the span alone, and a task finds its
own files. A span of a year costs the driver as many numbers as there are stretches. Files can be cut into slices on
record bounds, for few and large ones. Conditions on sensor_id and file_minute can leave out files and partitions.

Each whole record is a row; a file that is missing and bytes after its last whole record are a row with `problem`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from skyfold.config import minute_path
from skyfold.functions.timeunits import PER_MINUTE
from skyfold.sources.wire import RECORD

SCHEMA = "file_minute long, sensor_id string, sensor_ordinal int, record_index long, record binary, problem string"
OPTIONS = ("folder", "template", "sensors", "first", "end", "minutesPerTask", "slices")
#: Records of an Arrow batch.
BATCH = 50_000
MISSING, TRAILING = "missing_file", "trailing_bytes"


class Stretch(InputPartition):
    """Minutes [first, end) since the epoch, and of each file the slice-th of `slices` parts."""

    def __init__(self, first: int, end: int, part: int):
        self.first, self.end, self.part = first, end, part


class MinuteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.template = options["folder"], options["template"]
        self.sensors = list(enumerate(options["sensors"].split(",")))
        self.first, self.end = int(options["first"]), int(options["end"])
        self.stretch, self.slices = int(options.get("minutesPerTask", 10)), int(options.get("slices", 1))

    def partitions(self) -> list[Stretch]:
        return [] if not self.sensors else [Stretch(k, min(k + self.stretch, self.end), part) for k in range(self.first, self.end, self.stretch) for part in range(self.slices)]

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # where no partition is planned
            return
        store, root = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        for minute in range(partition.first, partition.end):
            at = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(minutes=minute)
            for ordinal, sensor in self.sensors:
                yield from self._file(store, minute_path(root, self.template, at, sensor), minute * PER_MINUTE, sensor, ordinal, partition.part)

    def _file(self, store: fs.FileSystem, path: str, minute: int, sensor: str, ordinal: int, part: int) -> Iterator[pa.RecordBatch]:
        def rows(first: int, data: bytes, problem: str | None = None) -> pa.RecordBatch:
            n = 1 if problem else len(data) // RECORD
            offsets = np.arange(0, (n + 1) * RECORD, RECORD, dtype=np.int32)
            record = pa.nulls(1, pa.binary()) if problem else pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            columns = [pa.array(np.full(n, minute)), pa.array([sensor] * n), pa.array(np.full(n, ordinal, np.int32)), pa.array(np.arange(first, first + n)), record, pa.array([problem] * n, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

        try:
            file = store.open_input_file(path)
        except FileNotFoundError:
            if part == 0:
                yield rows(0, b"", MISSING)
            return
        with file:
            n, over = divmod(file.size(), RECORD)
            at, end = n * part // self.slices, n * (part + 1) // self.slices
            while at < end:
                step = min(BATCH, end - at)
                data = file.read_at(step * RECORD, at * RECORD)
                if len(data) < step * RECORD:
                    raise OSError(f"{path} has become shorter")
                yield rows(at, data)
                at += step
            if over and part == 0:
                yield rows(n, b"", TRAILING)


class NarrowedReader(MinuteReader):
    """Leaves out what conditions on sensor_id and file_minute leave out.

    Spark keeps a narrowed reader with the scan that it was planned for, so each DataFrame of it takes one query.
    """

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        """Narrows what is read, if it can be told from names."""
        if f.attribute == ("sensor_id",) and isinstance(f, (EqualTo, In)):
            named = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.sensors = [(k, s) for k, s in self.sensors if s in named]
            return True
        if f.attribute != ("file_minute",) or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            return False
        if isinstance(f, EqualTo) and f.value % PER_MINUTE:
            self.end = self.first
        elif isinstance(f, EqualTo):
            self.first, self.end = max(self.first, f.value // PER_MINUTE), min(self.end, f.value // PER_MINUTE + 1)
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.first = max(self.first, f.value // PER_MINUTE + 1 if isinstance(f, GreaterThan) else -(-f.value // PER_MINUTE))
        else:
            self.end = min(self.end, -(-f.value // PER_MINUTE) if isinstance(f, LessThan) else f.value // PER_MINUTE + 1)
        return True


class MinuteFiles(DataSource):
    """Options: folder, template, sensors (comma-separated, in the order that breaks ties), first and end (minutes since
    the epoch), minutesPerTask, slices, narrowed."""

    @classmethod
    def name(cls) -> str:
        return "minute_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MinuteReader:
        kind = NarrowedReader if self.options.get("narrowed") == "true" else MinuteReader
        return kind({k: self.options[k] for k in OPTIONS if k in self.options})


def scan_minutes(spark: SparkSession, folder: str, template: str, first: int, end: int, sensors: list[str], narrowed: bool = False, **options: object) -> DataFrame:
    """Records of the minutes [first, end) since the epoch, unparsed, and problems. narrowed: conditions on sensor_id and
    file_minute reach the scan; such a DataFrame takes one query."""
    spark.dataSource.register(MinuteFiles)
    reader = spark.read.format("minute_files").options(folder=folder, template=template, first=first, end=end, sensors=",".join(sensors))
    if narrowed:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        reader = reader.option("narrowed", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()
