"""Explicit schemas of the stream; nothing is inferred.

Times are whole numbers of 100 ns since the Unix epoch, UTC: Spark's timestamps have microseconds and would
drop the seventh digit. A timestamp column appears at the sink only, where values lie on block bounds.
"""

from __future__ import annotations

from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("ts_100ns", T.LongType(), False),
        T.StructField("rssi_dbm", T.ShortType(), False),
        T.StructField("frame", T.BinaryType(), False),
        T.StructField("file_minute", T.LongType(), False),
        T.StructField("sensor_ordinal", T.IntegerType(), False),
        T.StructField("record_index", T.LongType(), False),
    ]
)

OUTPUT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("mode_s_code", T.StringType(), False),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("alt", T.IntegerType()),
        T.StructField("call_sign", T.StringType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("on_ground", T.BooleanType(), False),
    ]
)

#: Arrival order: minute by minute, stable by time, ties in the order sensors were declared, then of the file.
ARRIVAL = ("file_minute", "ts_100ns", "sensor_ordinal", "record_index")
