"""A checkpoint folder for sessions on one machine that name none, such as tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_folder(spark: SparkSession) -> None:
    """Set a checkpoint folder if the session has none and all its tasks run in this process."""
    context = spark.sparkContext
    if (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
            or not (context.master == "local" or context.master.startswith("local["))):
        return
    context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
