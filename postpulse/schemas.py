"""Declared schemas of items and metrics, and the mapping onto the rich item."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT, WHOLE, LONG, REAL, FLAG = (
    StringType(),
    IntegerType(),
    LongType(),
    DoubleType(),
    BooleanType(),
)


# Field names, order and types of the three row kinds.
RICH_ITEM = StructType(
    [
        StructField("id", TEXT),
        StructField("type", TEXT),
        StructField("subreddit", TEXT),
        StructField("title", TEXT),
        StructField("text", TEXT),
        StructField("full_text", TEXT),
        StructField("author", TEXT),
        StructField("score", WHOLE),
        StructField("upvote_ratio", FloatType()),
        StructField("num_comments", WHOLE),
        StructField("created_utc", REAL),
        StructField("created_datetime", TEXT),
        StructField("url", TEXT),
        StructField("permalink", TEXT),
        StructField("post_id", TEXT),
        StructField("is_self", FLAG),
        StructField("is_submitter", FLAG),
        StructField("over_18", FLAG),
        StructField("spoiler", FLAG),
        StructField("locked", FLAG),
        StructField("user_references", ArrayType(TEXT)),
        StructField("subreddit_references", ArrayType(TEXT)),
        StructField("url_references", ArrayType(TEXT)),
        StructField("timestamp_received", TEXT),
    ]
)

LEAN_ITEM = StructType(
    [
        StructField("type", TEXT),
        StructField("subreddit", TEXT),
        StructField("id", TEXT),
        StructField("text", TEXT),
        StructField("created_utc", REAL),
        StructField("author", TEXT),
    ]
)

METRICS = StructType(
    [
        StructField("batch_id", LONG),
        StructField("processing_time", TEXT),
        StructField("total_records", LONG),
        StructField("time_range_seconds", LONG),
        StructField("earliest_post", TEXT),
        StructField("latest_post", TEXT),
        StructField("posts_count", LONG),
        StructField("comments_count", LONG),
        StructField("unique_subreddits", LONG),
        StructField("unique_authors", LONG),
        StructField("avg_score", REAL),
        StructField("max_score", LONG),
        StructField("min_score", LONG),
        StructField("total_user_references", LONG),
        StructField("total_subreddit_references", LONG),
        StructField("total_url_references", LONG),
        StructField("top_subreddit", TEXT),
        StructField("most_active_author", TEXT),
    ]
)

REFERENCE_COLUMNS = ("user_references", "subreddit_references", "url_references")


def canonicalise(df: DataFrame) -> DataFrame:
    """Any lean or rich item frame as the rich item.

    Absent columns become NULL, ``submission`` becomes ``post`` and ``full_text``
    falls back to ``text``. Columns outside the rich schema are kept at the end.
    """
    present = set(df.columns)
    columns = []
    for field in RICH_ITEM.fields:
        if field.name == "type":
            kind = F.col("type")
            value = F.when(kind == "submission", F.lit("post")).otherwise(kind)
        elif field.name == "full_text":
            sources = [F.col(c) for c in ("full_text", "text") if c in present]
            value = F.coalesce(*sources) if sources else F.lit(None)
        elif field.name in present:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    extra = [F.col(c) for c in df.columns if c not in set(RICH_ITEM.names)]
    return df.select(*columns, *extra)
