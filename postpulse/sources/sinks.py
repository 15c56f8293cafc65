"""Batch sinks. Each batch owns its folders and overwrites them, so a replay changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .items import item_lines


def write_raw_batch(df: DataFrame, root: str, batch_id: int) -> str:
    """Items of a batch as Parquet in one folder per community.

    The rebalance hint gathers a small community in one file and splits a hot one
    over many tasks.
    """
    path = f"{root}/batch_{batch_id}"
    df.hint("rebalance", "subreddit").write.mode("overwrite").partitionBy("subreddit").parquet(path)
    return path


def write_json_batch(df: DataFrame, root: str, batch_id: int, suffix: str = "") -> str:
    path = f"{root}/batch_{batch_id}{suffix}"
    df.write.mode("overwrite").json(path)
    return path


def write_json_if_any(df: DataFrame, root: str, batch_id: int, suffix: str) -> str | None:
    return None if df.isEmpty() else write_json_batch(df, root, batch_id, suffix)


def write_parquet_batch(df: DataFrame, root: str, batch_id: int) -> str:
    path = f"{root}/batch_{batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_item_lines(df: DataFrame, path: str) -> None:
    """Items as JSON lines, UTF-8."""
    item_lines(df).write.mode("overwrite").text(path)


def publish(df: DataFrame, name: str, everywhere: bool = True) -> None:
    """Make a frame visible by name, to all sessions of the application by default."""
    if everywhere:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
