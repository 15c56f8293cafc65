"""Shaping raw posts and comments into items, de-duplication and selection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.references import KINDS, references
from ..functions.text import stripped
from ..functions.values import clock_text, column_or, epoch_to_timestamp
from ..schemas import LEAN_ITEM, REFERENCE_COLUMNS, RICH_ITEM

DELETED_AUTHOR = "[deleted]"
# Bodies of comments that are gone.
REMOVED_BODIES = ("", "[deleted]", "[removed]")


def _as_rich(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RICH_ITEM.fields
        ]
    )


def _reference_lists(text: Column, dialect: str) -> dict[str, Column]:
    return {
        name: references(text, kind, dialect) for name, kind in zip(REFERENCE_COLUMNS, KINDS)
    }


def posts_to_items(
    posts: DataFrame, received: Column | None = None, dialect: str = "producer"
) -> DataFrame:
    """Raw posts (id, title, selftext, author, score, ...) as rich items."""
    body = column_or(posts, "selftext", "")
    full_text = F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")), body)
    same = ("id", "subreddit", "title", "score", "num_comments", "created_utc", "url", "permalink")
    flags = ("is_self", "over_18", "spoiler", "locked")
    values = {name: column_or(posts, name) for name in same + flags}
    values |= {
        "type": F.lit("post"),
        "text": body,
        "full_text": stripped(full_text),
        "author": column_or(posts, "author", DELETED_AUTHOR),
        "upvote_ratio": column_or(posts, "upvote_ratio", 0.0),
        "created_datetime": clock_text(epoch_to_timestamp(F.col("created_utc"))),
        "timestamp_received": clock_text(F.current_timestamp()) if received is None else received,
    }
    values |= _reference_lists(full_text, dialect)
    return _as_rich(posts, values)


def drop_removed(comments: DataFrame, body: str = "body") -> DataFrame:
    return comments.filter(~F.coalesce(F.col(body), F.lit("")).isin(*REMOVED_BODIES))


def comments_to_items(
    comments: DataFrame, received: Column | None = None, dialect: str = "producer"
) -> DataFrame:
    """Raw comments (id, post_id, body, author, score, ...) as rich items, removed ones dropped."""
    kept = drop_removed(comments)
    same = ("id", "subreddit", "post_id", "score", "created_utc", "permalink", "is_submitter")
    values = {name: column_or(kept, name) for name in same}
    values |= {
        "type": F.lit("comment"),
        "text": F.col("body"),
        "full_text": F.col("body"),
        "author": column_or(kept, "author", DELETED_AUTHOR),
        "created_datetime": clock_text(epoch_to_timestamp(F.col("created_utc"))),
        "timestamp_received": clock_text(F.current_timestamp()) if received is None else received,
    }
    values |= _reference_lists(F.col("body"), dialect)
    return _as_rich(kept, values)


def submissions_to_lean(posts: DataFrame) -> DataFrame:
    """Raw posts as lean items; the body follows the title after a blank."""
    text = F.concat_ws(" ", F.col("title"), F.nullif(column_or(posts, "selftext"), F.lit("")))
    return posts.select(
        F.lit("submission").alias("type"),
        "subreddit",
        "id",
        text.alias("text"),
        F.col("created_utc").cast("double").alias("created_utc"),
        column_or(posts, "author", DELETED_AUTHOR).alias("author"),
    ).to(LEAN_ITEM)


def comments_to_lean(comments: DataFrame) -> DataFrame:
    return comments.select(
        F.lit("comment").alias("type"),
        "subreddit",
        "id",
        F.col("body").alias("text"),
        F.col("created_utc").cast("double").alias("created_utc"),
        column_or(comments, "author", DELETED_AUTHOR).alias("author"),
    ).to(LEAN_ITEM)


def merge_items(*frames: DataFrame) -> DataFrame:
    """Several item frames, batch or streaming, as one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def only_communities(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.filter(F.col("subreddit").isin(*names))


def dedupe(df: DataFrame, order: Iterable[str] = ("timestamp_received",)) -> DataFrame:
    """One row per (type, id): the first by ``order``, by default the first received.

    Copies meet in the map-side aggregate, so an id with very many copies sends one
    row per task. Rows that tie in ``order`` are settled by their whole content,
    which makes a recomputed task pick the same row again.
    """
    keys = ("type", "id")
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def dedupe_stream(
    df: DataFrame, arrival: str = "spark_timestamp", remember: str = "1 day"
) -> DataFrame:
    """First received copy of each (type, id); ids are forgotten ``remember`` after arrival.

    The watermark follows the arrival, not the creation: an old item that is seen for the
    first time arrives now, so it is never late.
    """
    return df.withWatermark(arrival, remember).dropDuplicatesWithinWatermark(["type", "id"])


def _first_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    # The rank filter becomes a limit per group before the shuffle, so a hot group
    # sends at most n rows per task.
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def newest_per_community(df: DataFrame, n: int = 3) -> DataFrame:
    return _first_per_group(df, "subreddit", [F.desc("created_utc"), F.asc("id")], n)


def first_comments(df: DataFrame, n: int = 2, position: str | None = None) -> DataFrame:
    """First ``n`` comments of each post in listing order, else by time and id."""
    order = [F.asc(position)] if position else [F.asc("created_utc")]
    return _first_per_group(df, "post_id", [*order, F.asc("id")], n)
