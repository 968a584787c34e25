"""Scans: minute files of declared sensors, message files as a table or a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.functions.timeunits import PER_MINUTE, from_datetime
from skyfold.sources import wire
from skyfold.sources.minutes import scan_minutes

BINARY_FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def read_minutes(spark: SparkSession, folder: str, template: str, minutes: list[datetime], sensors: list[str]) -> DataFrame:
    """Events of every sensor's file of each minute of one span, with frame_reject and problem, in columns that say the
    order of arrival.

    A file that is missing has no events but a row with a problem, as have bytes after the last whole record; any other
    failure to read ends the job.
    """
    first, end = (from_datetime(m) // PER_MINUTE for m in (minutes[0], minutes[-1]))
    return parsed_minutes(scan_minutes(spark, folder, template, first, end + 1, sensors))


def parsed_minutes(scanned: DataFrame) -> DataFrame:
    found = wire.parsed(scanned, minute="file_minute")
    return found.withColumn("frame_reject", F.when(F.col("problem").isNull(), F.col("frame_reject")))


def message_events(messages: DataFrame, sensors: list[str]) -> DataFrame:
    """Events of messages (content, and seq where the table says their order), with header_reject, unknown_sensor
    and frame_reject; a message that is rejected whole keeps one row without a record."""
    headed = wire.with_header(messages)
    unknown = F.col("header_reject").isNull() & ~F.col("sensor_id").isin(*sensors)
    headed = headed.withColumn("unknown_sensor", unknown).drop("content")
    taken = headed.where(F.col("header_reject").isNull() & ~unknown)
    events = wire.parsed(wire.records(taken))
    refused = headed.where(F.col("header_reject").isNotNull() | unknown).drop("body")
    return events.unionByName(refused, allowMissingColumns=True)


def stream_messages(spark: SparkSession, folder: str, most_files: int = 1000) -> DataFrame:
    """A stream of message files, at most so many a batch; offsets are replayed after a failure."""
    files = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", most_files).load(folder)
    return files.select(F.col("path"), F.col("modificationTime").alias("arrived"), "content")
