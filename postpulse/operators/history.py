"""Statistics per stored batch and what they say about the trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.values import half_even, title_label
from .distribution import beside, exact_quantiles

SCORE_FIGURES = ("score_mean", "score_median", "score_std", "score_min", "score_max")


ORDER = ("id_count", *SCORE_FIGURES, "posts", "unique_authors", "unique_subreddits")


def _sketches(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Approximate statistics from the columns that are present, in one aggregate."""
    rules = {
        "id": [F.count("id").alias("id_count")],
        "score": [
            F.avg("score").alias("score_mean"),
            F.stddev_samp("score").alias("score_std"),
            F.min("score").alias("score_min"),
            F.max("score").alias("score_max"),
            F.percentile_approx("score", 0.5).cast("double").alias("score_median"),
        ],
        "type": [F.count_if(F.col("type") == "post").alias("posts")],
        "author": [F.approx_count_distinct("author").alias("unique_authors")],
        "subreddit": [F.approx_count_distinct("subreddit").alias("unique_subreddits")],
    }
    chosen = [rule for name, group in rules.items() if name in df.columns for rule in group]
    return df.groupBy(*by).agg(*chosen)


def _exact(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same statistics from one tally of all values: one scan, one shuffle of counts."""
    by = list(by)
    kinds = [c for c in ("id", "score", "type", "author", "subreddit") if c in df.columns]
    # Ids are only counted, so they all have the same key.
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            (
                F.when(F.col("id").isNotNull(), "")
                if kind == "id"
                else F.lit(None).cast("string")
                if kind == "score"
                else F.col(kind)
            ).alias("key"),
            (F.col("score").cast("double") if kind == "score" else F.lit(None).cast("double")).alias(
                "value"
            ),
        )
        for kind in kinds
    ]
    rows = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
    tally = rows.groupBy(*by, "kind", "key", "value").agg(F.count("*").alias("n"))
    kind, n, value = F.col("kind"), F.col("n"), F.col("value")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    scored = (kind == "score") & value.isNotNull()
    rules = {
        "id": {"id_count": total((kind == "id") & F.col("key").isNotNull())},
        "score": {
            "score_n": total(scored),
            "score_sum": F.sum(F.when(scored, n * value)),
            "score_min": F.min(F.when(scored, value)),
            "score_max": F.max(F.when(scored, value)),
        },
        "type": {"posts": total((kind == "type") & (F.col("key") == "post"))},
        "author": {"unique_authors": F.count_if((kind == "author") & F.col("key").isNotNull())},
        "subreddit": {
            "unique_subreddits": F.count_if((kind == "subreddit") & F.col("key").isNotNull())
        },
    }
    figures = {name: rule for k in kinds for name, rule in rules[k].items()}
    stats = tally.groupBy(*by).agg(*[rule.alias(name) for name, rule in figures.items()])
    if "score" not in kinds:
        return stats

    stats = stats.withColumn("score_mean", F.col("score_sum") / F.nullif("score_n", F.lit(0)))
    # Conditions on the count stay above the tally, so that its shuffle is read again.
    scores = tally.filter(F.when(scored, n) > 0).select(*by, "value", "n")
    squares = beside(scores, stats.select(*by, "score_mean"), by).groupBy(*by).agg(
        F.sum(n * (value - F.col("score_mean")) * (value - F.col("score_mean"))).alias("squares")
    )
    medians = exact_quantiles(scores, by, {"score_median": 0.5})
    if not by:
        # Without scores there is no row; an aggregate of none is one row of NULL.
        medians = medians.agg(F.max("score_median").alias("score_median"))
    spread = F.sqrt(F.col("squares") / F.nullif(F.col("score_n") - 1, F.lit(0)))
    kept = df.schema["score"].dataType
    return beside(beside(stats, squares, by, "left"), medians, by, "left").withColumns(
        {
            "score_std": spread,
            "score_min": F.col("score_min").cast(kept),
            "score_max": F.col("score_max").cast(kept),
        }
    )


def _statistics(df: DataFrame, by: Sequence[str], approximate: bool) -> DataFrame:
    if not {"id", "score", "type", "author", "subreddit"}.intersection(df.columns):
        raise ValueError("none of id, score, type, author, subreddit is present")
    stats = _sketches(df, by) if approximate else _exact(df, by)
    rounded = {"score_mean", "score_median", "score_std"}
    return stats.select(
        *by,
        *[
            half_even(F.col(c)).alias(c) if c in rounded else F.col(c)
            for c in ORDER
            if c in stats.columns
        ],
    )


def batch_history(
    df: DataFrame, by: str = "batch_number", approximate: bool = False
) -> DataFrame:
    """One row of statistics per batch, from the columns that are present.

    ``approximate`` takes sketches for the median and the distinct counts.
    """
    return _statistics(df, [by], approximate)


def overall_history(df: DataFrame, approximate: bool = False) -> DataFrame:
    """The same statistics over all rows, labelled ``Overall``."""
    overall = _statistics(df, [], approximate)
    return overall.select(F.lit("Overall").alias("label"), *overall.columns)


def insights(history: DataFrame, by: str = "batch_number", n: int | None = 5) -> DataFrame:
    """Mean, range and trend of the first ``n`` figures of a history.

    The trend compares last and first batch; no growth counts as decreasing, one
    batch alone has no trend.
    """
    figures = [c for c in history.columns if c != by][:n]
    values = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("figure"),
                    F.col(c).cast("double").alias("value"),
                )
                for i, c in enumerate(figures)
            ]
        )
    )
    rows = history.select(by, values.alias("f")).select(by, "f.*")
    last, first = F.col("last_value"), F.col("first_value")
    trend = F.when(F.col("batches") > 1, F.when(last > first, "increasing").otherwise("decreasing"))
    return (
        rows.groupBy("position", "figure")
        .agg(
            F.avg("value").alias("mean"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min_by("value", by).alias("first_value"),
            F.max_by("value", by).alias("last_value"),
            F.count("*").alias("batches"),
        )
        .select(
            "position",
            "figure",
            title_label(F.col("figure")).alias("label"),
            "mean",
            "min",
            "max",
            trend.alias("trend"),
        )
    )
