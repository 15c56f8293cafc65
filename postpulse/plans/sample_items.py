"""Items, raw posts and raw comments derived from general event, text and dialogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Words that the short item texts are made of.
ITEM_WORDS = "good great love bad terrible not okay meh how code game news think my"


def items_from_events(events: DataFrame) -> DataFrame:
    """One item per event: a third are posts, the event type is the community."""
    words = f"split('{ITEM_WORDS}', ' ')"
    return events.selectExpr(
        "concat('e', cast(event_id as string)) as id",
        "case when event_id % 3 = 0 then 'post' else 'comment' end as type",
        "event_type as subreddit",
        "case when user_id % 29 = 0 then '[deleted]'"
        " else concat('user_', cast(user_id as string)) end as author",
        "cast(floor(value) as int) as score",
        "case when event_id % 3 = 0 then cast(event_id % 17 as int) end as num_comments",
        # Zone-free: the difference from the epoch, both without a time zone.
        "cast(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as double) / 1e6"
        " as created_utc",
        f"""concat(
            element_at({words}, cast(event_id % 14 + 1 as int)), ' ',
            element_at({words}, cast(event_id * 5 % 14 + 1 as int)), ' ',
            case when event_id % 2 = 0
                 then concat('/u/user_', cast(user_id % 11 as string), ' ') else '' end,
            case when event_id % 5 = 0 then concat('/r/', event_type, ' ') else '' end,
            case when event_id % 7 = 0
                 then concat('https://ex.org/', cast(event_id % 50 as string), ' ') else '' end,
            'end') as text""",
        "event_id % 8 as batch_number",
    )


def posts_from_documents(documents: DataFrame) -> DataFrame:
    """One raw post per document: the first line is the title, the rest the body."""
    number = F.col("doc_id")
    return documents.select(
        F.concat(F.lit("d"), number.cast("string")).alias("id"),
        F.col("source").alias("subreddit"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("selftext"),
        F.when(number % 10 != 0, F.concat(F.lit("writer_"), (number % 97).cast("string"))).alias(
            "author"
        ),
        (number % 501 - 50).cast("int").alias("score"),
        F.when(number % 4 != 0, (number % 100) / 100.0).alias("upvote_ratio"),
        (number % 23).cast("int").alias("num_comments"),
        (1_700_000_000 + number * 37.5).alias("created_utc"),
        F.concat(F.lit("https://ex.org/d/"), number.cast("string")).alias("url"),
        F.concat(F.lit("/r/"), F.col("source"), F.lit("/"), number.cast("string")).alias(
            "permalink"
        ),
        F.lit(True).alias("is_self"),
        (number % 50 == 0).alias("over_18"),
        F.lit(False).alias("spoiler"),
        (number % 13 == 0).alias("locked"),
    )


def comments_from_conversations(conversations: DataFrame) -> DataFrame:
    """One raw comment per turn; every ninth is gone."""
    conv, turn = F.col("conv_id"), F.col("turn")
    return conversations.select(
        F.concat_ws("_", F.lit("c"), conv.cast("string"), turn.cast("string")).alias("id"),
        F.concat(F.lit("d"), conv.cast("string")).alias("post_id"),
        F.col("role").alias("subreddit"),
        F.when((conv + turn) % 9 == 8, "[removed]").otherwise(F.col("text")).alias("body"),
        F.when(conv % 10 != 0, F.col("role")).alias("author"),
        ((conv * 7 + turn) % 90 - 10).cast("int").alias("score"),
        (1_700_000_000 + conv * 60 + turn * 2.25).alias("created_utc"),
        F.concat_ws("/", F.lit("/c"), conv.cast("string"), turn.cast("string")).alias("permalink"),
        (turn % 2 == 0).alias("is_submitter"),
        turn.alias("position"),
    )
