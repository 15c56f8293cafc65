"""Report feeds: what each chart or table of a report shows, as a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import title_label
from ..operators import authors, distribution, history, tallies, texts


def batch_report(items: DataFrame, tallied: DataFrame, metrics: DataFrame) -> dict[str, DataFrame]:
    """Metrics row, the top five of each statistic and three sample items of a batch."""

    def top(df: DataFrame, count: str, *ties: str) -> DataFrame:
        return df.orderBy(F.desc(count), *ties).limit(5)

    report = {
        "metrics": metrics,
        "communities": top(
            tallies.community_stats_from_tally(tallied), "item_count", "subreddit", "type"
        ),
        "authors": top(tallies.author_stats_from_tally(tallied), "posts_count", "author"),
    }
    for kind in tallies.REFERENCE_KINDS:
        counts = tallies.mention_counts_from_tally(tallied, kind)
        report[kind] = top(counts, "mention_count", kind)
    report["sample"] = items.select("type", "subreddit", "author", "score", "full_text").limit(3)
    return report


def overview(items: DataFrame) -> dict[str, DataFrame]:
    """Headline cards and the largest communities."""
    return {"cards": tallies.kpi(items), "communities": tallies.top_communities(items)}


def text_report(enriched: DataFrame) -> dict[str, DataFrame]:
    """Charts and figures over enriched texts.

    Many feeds read the same frame: pass a stored table of enriched texts.
    """
    return {
        "sentiment_distribution": labelled(
            distribution.category_shares(enriched, "sentiment_category"), "sentiment_category"
        ),
        "topics": labelled(distribution.category_shares(enriched, "topic"), "topic"),
        "complexity": text_complexity(enriched),
        "terms": texts.top_terms(enriched),
        "phrases": texts.top_phrases(enriched),
        "engagement": engagement_points(enriched),
        "questions": texts.question_counts(enriched),
        "contributors": authors.top_contributors(enriched),
        "sentiment_histogram": distribution.histogram(enriched, "sentiment", 30),
        "summary": texts.text_summary(enriched),
        "vocabulary": texts.unique_terms(enriched),
        "correlation": texts.engagement_correlation(enriched),
        "top_terms": texts.top_terms(enriched, 5, frequent_only=False),
        "top_phrases": texts.top_phrases(enriched, 3, frequent_only=False),
    }


def labelled(df: DataFrame, column: str) -> DataFrame:
    """Add a readable label of a category."""
    return df.withColumn("label", title_label(F.col(column)))


def text_complexity(enriched: DataFrame) -> DataFrame:
    return enriched.select("word_count", "length", "sentiment")


def engagement_points(enriched: DataFrame) -> DataFrame:
    return enriched.select("sentiment", "engagement_score", "word_count")


def author_report(items: DataFrame) -> dict[str, DataFrame]:
    """Author ranking, score distribution, activity levels and summary."""
    scores = authors.user_scores(items)
    return {
        "top_users": authors.top_users(scores),
        "avg_score_histogram": distribution.histogram(scores, "avg_score", 25),
        "activity_points": authors.sample_authors(scores),
        "activity_levels": authors.activity_levels(scores),
        "summary": authors.user_summary(scores),
    }


def history_report(items: DataFrame) -> dict[str, DataFrame]:
    """Statistics per batch, box plots of the first eight batches, and insights.

    Without a batch column the whole set is one row, with a score histogram.
    """
    if "batch_number" not in items.columns:
        report = {"statistics": history.overall_history(items)}
        if "score" in items.columns:
            report["score_histogram"] = distribution.histogram(items, "score", 30)
        return report
    statistics = history.batch_history(items)
    report = {"statistics": statistics, "insights": history.insights(statistics)}
    if "score" in items.columns:
        report["score_box"] = distribution.box_stats(items, "score", "batch_number", 8)
        report["score_outliers"] = distribution.box_outliers(items, "score", "batch_number", 8)
    return report
