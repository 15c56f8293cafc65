"""Streaming outputs: window updates, plain appends, de-duplicated items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.ingest import dedupe_stream
from ..operators.mentions import windowed_reference_lists, windowed_references
from .job import JobFolders, latest_per_key
from .tables import KeyedTable, SeenIds

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk instead of on the heap; for long runs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)


def start_windowed_references(
    items: DataFrame,
    root: str,
    interval: str | None = "30 seconds",
    text_col: str = "text",
    dialect: str = "token",
) -> StreamingQuery:
    """Window counts of a stream in update mode, kept as a log of changed windows.

    Each epoch overwrites its own folder, so a replayed epoch leaves the log as it was.
    """
    folders = JobFolders(root)

    def upsert(changed: DataFrame, epoch: int) -> None:
        changed.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(
            f"{folders.windows}/epoch_{epoch}"
        )

    writer = (
        windowed_references(items, text_col=text_col, dialect=dialect)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", folders.checkpoint("windows"))
    )
    return _triggered(writer, interval).start()


def read_windowed_references(spark: SparkSession, root: str) -> DataFrame:
    """Current count of every window seen by :func:`start_windowed_references`."""
    log = spark.read.parquet(f"{JobFolders(root).windows}/epoch_*")
    return latest_per_key(log, ["window_start", "window_end"])


def compact_windows(spark: SparkSession, root: str, target: str) -> str:
    """The current count of every window as one epoch of a new log below ``target``.

    For a stopped query: a later run goes on with ``target`` as its root.
    """
    path = f"{JobFolders(target).windows}/epoch_-1"
    current = read_windowed_references(spark, root).withColumn("epoch", F.lit(-1))
    current.write.mode("overwrite").parquet(path)
    return path


def _newest_windows(rows: DataFrame) -> DataFrame:
    """The row of the last epoch of each window."""
    keys = ["window_start", "window_end"]
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("row"))
    return newest.select(*keys, "row.*")


def window_table(spark: SparkSession, root: str, buckets: int = 16) -> KeyedTable:
    """The table that :func:`start_window_table` keeps; ``read()`` while the stream runs."""
    path = f"{JobFolders(root).windows}-table"
    return KeyedTable(spark, path, ["window_start", "window_end"], _newest_windows, buckets)


def start_window_table(
    items: DataFrame,
    root: str,
    interval: str | None = "30 seconds",
    text_col: str = "text",
    dialect: str = "token",
    buckets: int = 16,
) -> StreamingQuery:
    """Window counts of a stream as a table with one row for each window, updated in place.

    The number of live files is bounded by the buckets, not by the epochs.
    """
    table = window_table(items.sparkSession, root, buckets)

    def upsert(changed: DataFrame, epoch: int) -> None:
        table.upsert(changed.withColumn("epoch", F.lit(epoch).cast("bigint")), epoch)

    writer = (
        windowed_references(items, text_col=text_col, dialect=dialect)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", JobFolders(root).checkpoint("window-table"))
    )
    return _triggered(writer, interval).start()


def start_files(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files, each row exactly once."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def start_closed_windows(
    items: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "30 seconds",
    text_col: str = "text",
    dialect: str = "token",
) -> StreamingQuery:
    """Append each window to files once, when the watermark has passed its end.

    For long runs: nothing is written twice, at the price of waiting for late items.
    """
    closed = windowed_references(items, text_col=text_col, dialect=dialect)
    return start_files(closed, path, checkpoint, interval)


def start_closed_window_lists(
    items: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "30 seconds",
    text_col: str = "text",
    dialect: str = "name",
) -> StreamingQuery:
    """Append the reference lists of each window to files once, when the watermark has passed its
    end. Items up to a minute late are in time; the last windows wait for newer items."""
    closed = windowed_reference_lists(items, text_col=text_col, dialect=dialect)
    return start_files(closed, path, checkpoint, interval)


def start_memory_table(df: DataFrame, name: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to a table in driver memory: for trying things out only."""
    return _triggered(
        df.writeStream.format("memory").outputMode("append").queryName(name), interval
    ).start()


def start_console(df: DataFrame, interval: str | None = None) -> StreamingQuery:
    """Print changed rows in full width: for trying things out only."""
    return _triggered(
        df.writeStream.format("console").outputMode("update").option("truncate", False), interval
    ).start()


def start_deduped_files(
    items: DataFrame, path: str, checkpoint: str, arrival: str = "spark_timestamp",
    remember: str = "1 day", interval: str | None = None,
) -> StreamingQuery:
    """Append the first received copy of each item to files."""
    return start_files(dedupe_stream(items, arrival, remember), path, checkpoint, interval)


def start_first_copies(
    items: DataFrame,
    root: str,
    arrival: str = "spark_timestamp",
    interval: str | None = "30 seconds",
    **sizes: int,
) -> StreamingQuery:
    """The first received copy of each item of the whole run, below ``items`` by batch.

    Unlike :func:`start_deduped_files` no id is ever forgotten: ids are kept in tables, not in the
    state of the stream. ``sizes`` are those of :class:`SeenIds`.
    """
    seen = SeenIds(items.sparkSession, f"{root}/seen", **sizes)

    def process(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            seen.first_copies(batch, batch_id, f"{root}/items/batch_{batch_id}", (arrival,))

    writer = items.writeStream.foreachBatch(process).option(
        "checkpointLocation", JobFolders(root).checkpoint("first-copies")
    )
    return _triggered(writer, interval).start()


def read_first_copies(spark: SparkSession, root: str) -> DataFrame:
    """What :func:`start_first_copies` has kept so far."""
    return spark.read.parquet(f"{root}/items/batch_*").drop("bucket")
