"""The stream job: raw items, statistics, metrics and term weights of each micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import frequent, mentions, sketches, tallies, texts, tfidf
from ..plans.reports import batch_report
from ..schemas import RICH_ITEM, canonicalise
from ..sources import sinks
from ..sources.batches import read_batches
from .tables import KeyedTable

DETAIL_SUFFIXES = {
    "user_ref": "_user_refs",
    "subreddit_ref": "_subreddit_refs",
    "url_ref": "_url_refs",
}


@dataclass(frozen=True)
class JobFolders:
    """Folders of a job below one root that all executors share."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def tallies(self) -> str:
        return f"{self.root}/tallies"

    @property
    def terms(self) -> str:
        return f"{self.root}/terms"

    @property
    def sketches(self) -> str:
        return f"{self.root}/sketches"

    @property
    def texts(self) -> str:
        return f"{self.root}/texts"

    @property
    def vocabulary(self) -> str:
        return f"{self.root}/vocabulary"

    @property
    def running(self) -> str:
        return f"{self.root}/running"

    @property
    def windows(self) -> str:
        return f"{self.root}/windows"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"


def process_batch(
    batch: DataFrame, batch_id: int, folders: JobFolders, show: bool = False
) -> None:
    """Store one batch and everything computed from it.

    The batch is parsed once and written; statistics read the stored columns they need.
    Tallies and term statistics are written too, and the small outputs come from
    those tables. The history is kept as running tables, each version made from the one
    before and this batch. Any failure fails the batch; its folders are overwritten on replay.
    """
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    sinks.write_raw_batch(canonicalise(batch), folders.raw, batch_id)
    raw = read_batches(spark, folders.raw, _stored_schema(batch), batch_id, merge=False)
    sinks.publish(raw, "raw")

    tally_path = sinks.write_parquet_batch(tallies.tally(raw), folders.tallies, batch_id)
    tallied = spark.read.parquet(tally_path)
    metrics = tallies.metrics_from_tally(tallied, batch_id)
    metrics_path = sinks.write_json_batch(metrics, folders.metrics, batch_id)
    sinks.publish(spark.read.schema(metrics.schema).json(metrics_path), "metrics")
    for kind, suffix in DETAIL_SUFFIXES.items():
        counts = tallies.mention_counts_from_tally(tallied, kind)
        sinks.write_json_if_any(counts, folders.metrics, batch_id, suffix)
    communities = tallies.community_stats_from_tally(tallied)
    sinks.write_json_batch(communities, folders.metrics, batch_id, "_subreddit_stats")
    authors = tallies.author_stats_from_tally(tallied)
    sinks.write_json_batch(authors, folders.metrics, batch_id, "_author_stats")

    long_texts = tfidf.long_enough(raw, "full_text")
    terms_path = sinks.write_parquet_batch(
        tfidf.term_stats(long_texts, "full_text"), folders.terms, batch_id
    )
    terms = spark.read.parquet(terms_path)
    words = tfidf.top_words(tfidf.word_scores(terms))
    sinks.write_json_if_any(words, folders.metrics, batch_id, "_tfidf_top_words")
    running_terms(spark, folders).upsert(terms, batch_id)
    sketch_path = sinks.write_parquet_batch(sketches.sketch(raw), folders.sketches, batch_id)
    running_sketches(spark, folders).upsert(spark.read.parquet(sketch_path), batch_id)
    stored = spark.read.schema(metrics.schema).json(metrics_path)
    running_range(spark, folders).upsert(tallies.running_time_range(stored), batch_id)
    if show:
        for frame in batch_report(raw, tallied, metrics).values():
            frame.show(truncate=False)


def _stored_schema(batch: DataFrame) -> StructType:
    extra = [f for f in batch.schema.fields if f.name not in RICH_ITEM.names]
    return StructType([*RICH_ITEM.fields, *extra])


def running_terms(spark: SparkSession, folders: JobFolders) -> KeyedTable:
    """Term statistics of all batches so far."""
    return KeyedTable(spark, f"{folders.running}/terms", ["word"], tfidf.merge_term_stats)


def running_range(spark: SparkSession, folders: JobFolders) -> KeyedTable:
    """Time range and number of items of all batches so far, in one row."""
    return KeyedTable(spark, f"{folders.running}/range", [], tallies.merge_time_ranges, 1)


def running_sketches(spark: SparkSession, folders: JobFolders) -> KeyedTable:
    """Mergeable statistics of all batches so far, in one row."""
    return KeyedTable(spark, f"{folders.running}/sketches", [], sketches.merge, 1)


def running_vocabulary(spark: SparkSession, folders: JobFolders) -> KeyedTable:
    """The summary of terms and phrases of all batches so far, in one row each."""
    return KeyedTable(spark, f"{folders.running}/vocabulary", ["kind"], frequent.merge, 1)


def process_vocabulary(batch: DataFrame, batch_id: int, folders: JobFolders) -> None:
    """Store the cleaned texts of a batch and the summary of their terms, and add it to the running one.

    Works for rich and lean items. A replay writes the same folders and the same version.
    """
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    texts_path = sinks.write_parquet_batch(texts.item_texts(batch), folders.texts, batch_id)
    cleaned = spark.read.schema("text string").parquet(texts_path)
    path = sinks.write_parquet_batch(frequent.summary(cleaned), folders.vocabulary, batch_id)
    running_vocabulary(spark, folders).upsert(spark.read.parquet(path), batch_id)


def lean_outputs(batch: DataFrame) -> dict[str, DataFrame]:
    """What a batch of lean items shows, by the name of the view."""
    words = tfidf.tfidf_top_words(batch, "text")
    return {
        "current_batch": batch,
        "batch_references": mentions.reference_totals(batch),
        "batch_windows": mentions.windowed_reference_lists(batch),
        "batch_tfidf": words,
        "batch_sentiment": texts.with_polarity(batch),
        "batch_authors": tallies.top_authors(batch),
        "batch_time_range": tallies.time_range(batch),
    }


def process_lean_batch(batch: DataFrame, batch_id: int, folders: JobFolders) -> None:
    """Store a batch of lean items and its outputs, and publish them under their names.

    Its term statistics and time range are stored too, and added to the running tables from
    which time range and top words over all batches so far are read.
    """
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    stored = sinks.write_parquet_batch(batch, folders.raw, batch_id)
    outputs = lean_outputs(spark.read.schema(batch.schema).parquet(stored))
    sinks.publish(outputs.pop("current_batch"), "current_batch")
    for name, frame in outputs.items():
        path = sinks.write_json_batch(frame, folders.metrics, batch_id, f"_{name}")
        sinks.publish(spark.read.schema(frame.schema).json(path), name)
    lean = spark.read.schema(batch.schema).parquet(stored)
    terms = sinks.write_parquet_batch(tfidf.term_stats(lean, "text"), folders.terms, batch_id)
    running_terms(spark, folders).upsert(spark.read.parquet(terms), batch_id)
    span = sinks.write_parquet_batch(tallies.time_range(lean), folders.tallies, batch_id)
    span_row = spark.read.parquet(span).drop("time_range_seconds")
    running_range(spark, folders).upsert(span_row, batch_id)
    for name, frame in lean_history(spark, folders.root).items():
        sinks.publish(frame, name)


def lean_history(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Time range and top words over all batches of a lean job, by the name of the view."""
    bounds = running_range(spark, JobFolders(root)).read()
    span = F.floor(F.col("latest_post") - F.col("earliest_post"))
    return {
        "history_time_range": bounds.withColumn("time_range_seconds", span),
        "history_tfidf": history_top_words(spark, root),
    }


def _start(items: DataFrame, folders: JobFolders, interval: str | None, name: str, process):
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        items.writeStream.foreachBatch(process)
        .option("checkpointLocation", folders.checkpoint(name))
        .trigger(**trigger)
        .queryName(name)
        .start()
    )


def start_job(
    items: DataFrame,
    root: str,
    interval: str | None = "30 seconds",
    show: bool = False,
    name: str = "items",
) -> StreamingQuery:
    """Run :func:`process_batch` on every micro-batch; without ``interval`` on what is there.

    A restart continues from the checkpoint below ``root``; nothing is ever wiped.
    """
    folders = JobFolders(root)

    def process(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, folders, show)

    return _start(items, folders, interval, name, process)


def start_lean_job(
    items: DataFrame, root: str, interval: str | None = "30 seconds", name: str = "lean_items"
) -> StreamingQuery:
    """Run :func:`process_lean_batch` on every micro-batch."""
    folders = JobFolders(root)

    def process(batch: DataFrame, batch_id: int) -> None:
        process_lean_batch(batch, batch_id, folders)

    return _start(items, folders, interval, name, process)


def start_vocabulary(
    items: DataFrame, root: str, interval: str | None = "30 seconds", name: str = "vocabulary"
) -> StreamingQuery:
    """Run :func:`process_vocabulary` on every micro-batch."""
    folders = JobFolders(root)

    def process(batch: DataFrame, batch_id: int) -> None:
        process_vocabulary(batch, batch_id, folders)

    return _start(items, folders, interval, name, process)


def _vocabulary(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    folders = JobFolders(root)
    cleaned = spark.read.schema("text string").parquet(f"{folders.texts}/batch_*")
    return running_vocabulary(spark, folders).read(), cleaned


def history_top_terms(
    spark: SparkSession, root: str, n: int = 12, frequent_only: bool = True
) -> DataFrame:
    """Top terms over all batches so far: from the running summary, and the texts where it is not sure."""
    return frequent.top_terms(*_vocabulary(spark, root), n, frequent_only=frequent_only)


def history_top_phrases(
    spark: SparkSession, root: str, n: int = 8, frequent_only: bool = True
) -> DataFrame:
    """Top phrases over all batches so far, as :func:`history_top_terms`."""
    return frequent.top_phrases(*_vocabulary(spark, root), n, frequent_only=frequent_only)


def history_top_words(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """Top words over all batches so far, from their running term statistics."""
    stats = running_terms(spark, JobFolders(root)).read()
    return tfidf.top_words(tfidf.word_scores(stats), n)


def history_time_range(spark: SparkSession, root: str) -> DataFrame:
    """Time range over all batches so far, from one running row."""
    return running_range(spark, JobFolders(root)).read()


def history_figures(spark: SparkSession, root: str) -> DataFrame:
    """Figures over all batches so far, from one row of sketches: no item is read again."""
    return sketches.figures(running_sketches(spark, JobFolders(root)).read())


def history_growth(spark: SparkSession, root: str) -> DataFrame:
    """The same figures after each batch, from the stored row of sketches of each."""
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch_(\d+)/", 1).cast("bigint")
    stored = spark.read.parquet(f"{JobFolders(root).sketches}/batch_*")
    rows = stored.select(number.alias("batch_number"), "*")
    return sketches.figures(sketches.running(rows))


def history_items(spark: SparkSession, root: str) -> DataFrame:
    """All stored items with their batch number."""
    return read_batches(spark, JobFolders(root).raw)


def await_all(spark: SparkSession) -> None:
    """Wait until every active query has ended; the first failure is raised."""
    while spark.streams.active:
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()


def latest_per_key(changes: DataFrame, keys: list[str], version: str = "epoch") -> DataFrame:
    """Last version of each row of an update log."""
    rest = [c for c in changes.columns if c not in (*keys, version)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("row"))
    return newest.select(*keys, "row.*")
