"""Author ranking, activity levels and contributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import bins, half_even

# Number of posts up to which a level reaches.
ACTIVITY_LEVELS = (
    (0, None),
    (1, "Single Post"),
    (3, "Low (2-3)"),
    (10, "Medium (4-10)"),
    (None, "High (10+)"),
)


def user_scores(df: DataFrame) -> DataFrame:
    """Score figures per author, rounded; rows without author are left out."""
    return (
        df.filter(F.col("author").isNotNull())
        .groupBy("author")
        .agg(
            F.count("score").alias("score_count"),
            F.coalesce(F.sum("score"), F.lit(0)).alias("total_score"),
            half_even(F.avg("score")).alias("avg_score"),
            half_even(F.stddev_samp("score")).alias("score_stddev"),
            F.count("id").alias("post_count"),
        )
    )


def top_users(scores: DataFrame, n: int = 10) -> DataFrame:
    ranked = scores.orderBy(F.desc("total_score"), "author").limit(n)
    return ranked.select("author", "post_count", "total_score", "avg_score")


def with_activity_level(scores: DataFrame) -> DataFrame:
    """Add the activity level and its place in the order of levels."""
    count = F.col("post_count")
    names = [name for _, name in ACTIVITY_LEVELS if name]
    level = bins(count, ACTIVITY_LEVELS)
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("activity_level"))
    return scores.withColumn("activity_level", level).withColumn("level_order", order.cast("int"))


def activity_levels(scores: DataFrame) -> DataFrame:
    """Number of authors per activity level."""
    levels = with_activity_level(scores).filter(F.col("activity_level").isNotNull())
    return levels.groupBy("level_order", "activity_level").agg(F.count("*").alias("authors"))


def user_summary(scores: DataFrame) -> DataFrame:
    """Number of authors, their means, the most active and the highest scoring author."""

    def best(value: str) -> Column:
        return F.min_by("author", F.struct((-F.col(value)).alias("v"), F.col("author")))

    return scores.agg(
        F.count("*").alias("authors"),
        F.avg("post_count").alias("mean_posts"),
        F.avg("avg_score").alias("mean_avg_score"),
        best("post_count").alias("most_active"),
        F.max("post_count").alias("most_posts"),
        best("total_score").alias("highest_scoring"),
        F.max("total_score").alias("highest_score"),
    )


def sample_authors(scores: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Exactly ``n`` random authors (all, if there are fewer), by the MD5 of name and seed."""
    draw = F.md5(F.concat("author", F.lit(f":{seed}")))
    return scores.orderBy(draw, "author").limit(n)


def top_contributors(enriched: DataFrame, n: int = 8) -> DataFrame:
    """Authors with most engagement, ascending; none if there is one author only."""
    totals = (
        enriched.filter(F.col("author").isNotNull())
        .groupBy("author")
        .agg(F.coalesce(F.sum("engagement_score"), F.lit(0)).alias("engagement"))
    )
    top = totals.orderBy(F.desc("engagement"), "author").limit(max(n, 2))
    # The window sees the few rows that are left.
    authors = F.count("*").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc("engagement"), "author"))
    several = top.withColumns({"_authors": authors, "_place": place})
    kept = several.filter((F.col("_authors") > 1) & (F.col("_place") <= n))
    return kept.drop("_authors", "_place").orderBy("engagement", F.desc("author"))
