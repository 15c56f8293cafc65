"""What the registered queries need of a session."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> None:
    """UTC, and a checkpoint folder of their own where the session has none.

    The own folder is for runs on one machine, as in tests; a cluster without the setting
    gets the library's error.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="postpulse-"))


def prepared(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf)

    return run
