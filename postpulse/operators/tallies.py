"""Counts per community, author, score and reference, and the metrics built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import clock_text, epoch_to_timestamp
from ..schemas import METRICS
from .ingest import DELETED_AUTHOR

COMMUNITY, AUTHOR = "community", "author"
REFERENCE_KINDS = {
    "user_ref": "user_references",
    "subreddit_ref": "subreddit_references",
    "url_ref": "url_references",
}


def _entry(kind: str, key: str, item_type: str = "cast(null as string)") -> str:
    return f"named_struct('kind', '{kind}', 'key', {key}, 'type', {item_type})"


def tally(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Everything a batch's statistics need, from one pass over the items.

    One row per (``by``, kind, key): kind ``community`` is keyed by community and
    item type, ``author`` by author, the reference kinds by the referenced name.
    Hot communities and authors are summed before the shuffle.
    """
    entries = [f"array({_entry(COMMUNITY, 'subreddit', 'type')}, {_entry(AUTHOR, 'author')})"]
    for kind, column in REFERENCE_KINDS.items():
        if column in df.columns:
            names = f"coalesce({column}, cast(array() as array<string>))"
            entries.append(f"transform({names}, name -> {_entry(kind, 'name')})")
    rows = df.select(
        *by,
        "score",
        "num_comments",
        "created_utc",
        F.expr(f"inline_outer(concat({', '.join(entries)}))"),
    )
    counted = rows.groupBy(*by, "kind", "key", "type").agg(
        F.count("*").alias("n"),
        F.count("score").alias("score_n"),
        F.sum("score").alias("score_sum"),
        F.min("score").alias("score_min"),
        F.max("score").alias("score_max"),
        F.sum("num_comments").alias("comments_sum"),
        F.min("created_utc").alias("created_min"),
        F.max("created_utc").alias("created_max"),
    )
    return counted.filter(f"kind in ('{COMMUNITY}', '{AUTHOR}') or key is not null")


def metrics_from_tally(
    tallied: DataFrame, batch_id: str | int, processing_time: Column | None = None
) -> DataFrame:
    """The metrics row of a batch; with a column name as ``batch_id`` one row per batch.

    ``total_*_references`` count distinct names; the ``*_mentions`` behind the declared
    columns count every mention.
    """
    keys = [batch_id] if isinstance(batch_id, str) else []
    community = f"kind = '{COMMUNITY}'"
    author = f"kind = '{AUTHOR}' and key <> '{DELETED_AUTHOR}'"

    def total(value: str, condition: str) -> str:
        return f"coalesce(sum(case when {condition} then {value} end), 0)"

    def biggest(condition: str) -> str:
        # Smallest of (-n, key, type): the largest group, ties by name.
        rank = f"case when {condition} then struct(-n, key, type) end"
        return f"coalesce(min_by(case when {condition} then key end, {rank}), 'unknown')"

    figures = {
        "total_records": total("n", community),
        "first": "min(created_min)",
        "last": "max(created_max)",
        "posts_count": total("n", f"{community} and type = 'post'"),
        "comments_count": total("n", f"{community} and type = 'comment'"),
        # A missing community counts as one more value.
        "unique_subreddits": f"""count(distinct case when {community} then key end)
            + coalesce(max(case when {community} and key is null then 1 end), 0)""",
        "unique_authors": f"count_if({author})",
        "avg_score": f"""coalesce(
            sum(case when {community} then score_sum end)
            / nullif(sum(case when {community} then score_n end), 0), 0)""",
        "max_score": "coalesce(max(score_max), 0)",
        "min_score": "coalesce(min(score_min), 0)",
        "top_subreddit": biggest(community),
        "most_active_author": biggest(author),
    }
    for kind, column in REFERENCE_KINDS.items():
        figures[f"total_{column}"] = f"count_if(kind = '{kind}')"
        figures[f"{kind}_mentions"] = total("n", f"kind = '{kind}'")
    summed = tallied.groupBy(*keys).agg(*[F.expr(e).alias(n) for n, e in figures.items()])
    start, end = epoch_to_timestamp(F.col("first")), epoch_to_timestamp(F.col("last"))
    span = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    values = {
        "batch_id": F.col(batch_id) if keys else F.lit(batch_id),
        "processing_time": now if processing_time is None else processing_time,
        "time_range_seconds": F.coalesce(span, F.lit(0)),
        "earliest_post": clock_text(start, " "),
        "latest_post": clock_text(end, " "),
    }
    declared = [
        values.get(f.name, F.col(f.name) if f.name in figures else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in METRICS.fields
    ]
    return summed.select(*declared, *[f"{kind}_mentions" for kind in REFERENCE_KINDS])


def batch_metrics(
    df: DataFrame, batch_id: str | int, processing_time: Column | None = None
) -> DataFrame:
    """Metrics of items that carry reference lists. ``batch_id``: a number or the batch column."""
    by = [batch_id] if isinstance(batch_id, str) else []
    return metrics_from_tally(tally(df, by), batch_id, processing_time)


def community_stats_from_tally(tallied: DataFrame) -> DataFrame:
    return tallied.filter(F.col("kind") == COMMUNITY).select(
        F.col("key").alias("subreddit"),
        "type",
        F.col("n").alias("item_count"),
        (F.col("score_sum") / F.when(F.col("score_n") > 0, F.col("score_n"))).alias("avg_score"),
        F.col("comments_sum").alias("total_comments"),
        F.col("score_max").alias("max_score"),
        F.col("score_min").alias("min_score"),
    )


def author_stats_from_tally(tallied: DataFrame) -> DataFrame:
    return tallied.filter((F.col("kind") == AUTHOR) & (F.col("key") != DELETED_AUTHOR)).select(
        F.col("key").alias("author"),
        F.col("n").alias("posts_count"),
        (F.col("score_sum") / F.when(F.col("score_n") > 0, F.col("score_n"))).alias("avg_score"),
        F.col("comments_sum").alias("total_comments"),
    )


def mention_counts_from_tally(tallied: DataFrame, kind: str) -> DataFrame:
    return tallied.filter(F.col("kind") == kind).select(
        F.col("key").alias(kind), F.col("n").alias("mention_count")
    )


def community_stats(df: DataFrame) -> DataFrame:
    """Items, scores and comments per community and type, largest first."""
    return (
        df.groupBy("subreddit", "type")
        .agg(
            F.count("*").alias("item_count"),
            F.avg("score").alias("avg_score"),
            F.sum("num_comments").alias("total_comments"),
            F.max("score").alias("max_score"),
            F.min("score").alias("min_score"),
        )
        .orderBy(F.desc("item_count"), "subreddit", "type")
    )


def author_stats(df: DataFrame) -> DataFrame:
    """Items, scores and comments per author without deleted ones, most active first."""
    return (
        df.filter(F.col("author") != DELETED_AUTHOR)
        .groupBy("author")
        .agg(
            F.count("*").alias("posts_count"),
            F.avg("score").alias("avg_score"),
            F.sum("num_comments").alias("total_comments"),
        )
        .orderBy(F.desc("posts_count"), "author")
    )


def top_authors(df: DataFrame, n: int = 5) -> DataFrame:
    return df.groupBy("author").count().orderBy(F.desc("count"), "author").limit(n)


def top_communities(df: DataFrame, n: int = 3) -> DataFrame:
    named = df.filter(F.col("subreddit").isNotNull())
    return named.groupBy("subreddit").count().orderBy(F.desc("count"), "subreddit").limit(n)


def time_range(df: DataFrame) -> DataFrame:
    """Earliest and latest item, span in whole seconds, number of items."""
    bounds = df.agg(
        F.min("created_utc").alias("earliest_post"),
        F.max("created_utc").alias("latest_post"),
        F.count("*").alias("total_items"),
    )
    span = F.floor(F.col("latest_post") - F.col("earliest_post"))
    return bounds.withColumn("time_range_seconds", F.coalesce(span, F.lit(0)).cast("bigint"))


def running_time_range(metrics: DataFrame) -> DataFrame:
    """Time range of all batches so far, from their small metrics rows."""
    return metrics.agg(
        F.min("earliest_post").alias("earliest_post"),
        F.max("latest_post").alias("latest_post"),
        F.sum("total_records").alias("total_items"),
    )


def merge_time_ranges(ranges: DataFrame) -> DataFrame:
    """Several time ranges (earliest_post, latest_post, total_items) as one."""
    return ranges.agg(
        F.min("earliest_post").alias("earliest_post"),
        F.max("latest_post").alias("latest_post"),
        F.sum("total_items").alias("total_items"),
    )


def kpi(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Headline numbers of a set of items as one row."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    present = set(df.columns)
    values = [F.count("*").alias("total_records")]
    if "type" in present:
        values += [
            F.count_if(F.col("type") == "post").alias("posts"),
            F.count_if(F.col("type") == "comment").alias("comments"),
        ]
    if "subreddit" in present:
        values.append(distinct("subreddit").alias("communities"))
    if "author" in present:
        values.append(distinct("author").alias("authors"))
    if "score" in present:
        values += [
            F.avg("score").alias("avg_score"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
        ]
    if "batch_number" in present:
        values += [
            F.min("batch_number").alias("first_batch"),
            F.max("batch_number").alias("last_batch"),
        ]
    cards = df.agg(*values)
    if "type" in present:
        ratio = F.concat_ws(":", F.col("posts").cast("string"), F.col("comments").cast("string"))
        cards = cards.withColumn("post_comment_ratio", ratio)
    return cards


