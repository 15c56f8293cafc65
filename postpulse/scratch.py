"""Where jobs keep tables and checkpoints that must outlive an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, which all executors share.

    The folder is ``spark.checkpoint.dir`` or what ``setCheckpointDir`` was given; without
    either this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
