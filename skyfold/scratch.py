"""Where lineage is cut: checkpoints in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read back.

    The folder is the one that spark.checkpoint.dir names; a temporary one only where all runs on one machine.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="skyfold-"))
    return df.checkpoint()
