"""Mergeable statistics: small rows per batch that add up to those of all batches.

Distinct counts are HyperLogLog sketches, quantiles are KLL sketches; counts, sums and bounds are
exact. A row has a bounded size whatever it has seen, so figures over a whole run need no item again.
The exact statistics of :mod:`history` stay the default; these are the ones that can be kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import half_even
from .distribution import QUANTILE_BINS

#: Registers of a distinct count, as a power of two: a standard error of about 0.8 %.
REGISTERS = 14
#: Size of a quantile sketch: ranks are off by about 0.2 % at most.
QUANTILE_SIZE = 4096
NUMBERS = ("id_count", "posts", "score_n", "score_sum", "score_squares")


def _squares(n: Column, total: Column, squares: Column) -> Column:
    """Sum of squared distances from the mean."""
    return F.greatest(squares - total * total / F.nullif(n, F.lit(0)), F.lit(0.0))


def sketch(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row of mergeable statistics for each group of items, or for all of them.

    NULL ids, scores, authors and communities are not counted, nor are scores that are NaN.
    """
    score = F.col("score").cast("double")
    score = F.when(~F.isnan(score), score)
    return items.groupBy(*by).agg(
        F.count("id").alias("id_count"),
        F.count_if(F.col("type") == "post").alias("posts"),
        F.count(score).alias("score_n"),
        F.coalesce(F.sum(score), F.lit(0.0)).alias("score_sum"),
        F.coalesce(F.sum(score * score), F.lit(0.0)).alias("score_squares"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
        F.hll_sketch_agg("author", F.lit(REGISTERS)).alias("authors"),
        F.hll_sketch_agg("subreddit", F.lit(REGISTERS)).alias("subreddits"),
        F.kll_sketch_agg_double(score, F.lit(QUANTILE_SIZE)).alias("scores"),
    )


def _sums() -> dict[str, Column]:
    return {
        **{c: F.sum(c) for c in NUMBERS},
        "score_min": F.min("score_min"),
        "score_max": F.max("score_max"),
        "authors": F.hll_union_agg("authors"),
        "subreddits": F.hll_union_agg("subreddits"),
        "scores": F.kll_merge_agg_double("scores", F.lit(QUANTILE_SIZE)),
    }


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`sketch` added up, for each group or all together."""
    return sketches.groupBy(*by).agg(*[rule.alias(name) for name, rule in _sums().items()])


def running(sketches: DataFrame, by: str = "batch_number") -> DataFrame:
    """For each group the sum of its own row and those of all groups before it.

    One window over the rows of :func:`sketch`: as many as there are batches, not items.
    """
    so_far = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = [rule.over(so_far).alias(name) for name, rule in _sums().items()]
    return merge(sketches, [by]).select(by, *grown)


def figures(sketches: DataFrame) -> DataFrame:
    """The figures of a history from rows of sketches, with quartiles; other columns stay.

    Quantiles are values that occur. Without any score all figures of scores are NULL.
    """
    n, total = F.col("score_n"), F.col("score_sum")

    def quantile(share: float) -> Column:
        return F.when(n > 0, F.kll_sketch_get_quantile_double("scores", F.lit(share)))

    spread = _squares(n, total, F.col("score_squares")) / F.nullif(n - 1, F.lit(0))
    return sketches.select(
        *[c for c in sketches.columns if c not in _sums()],
        "id_count",
        half_even(total / F.nullif(n, F.lit(0))).alias("score_mean"),
        quantile(0.25).alias("score_q1"),
        quantile(0.5).alias("score_median"),
        quantile(0.75).alias("score_q3"),
        half_even(F.sqrt(spread)).alias("score_std"),
        "score_min",
        "score_max",
        "posts",
        F.hll_sketch_estimate("authors").alias("unique_authors"),
        F.hll_sketch_estimate("subreddits").alias("unique_subreddits"),
    )


def score_edges(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, edges) of stored sketches, for :func:`distribution.exact_quantiles`.

    Take stored rows: a sketch that is computed twice need not be the same.
    """
    shares = F.array(*[F.lit(i / QUANTILE_BINS) for i in range(1, QUANTILE_BINS)])
    edges = F.array_distinct(F.kll_sketch_get_quantile_double("scores", shares))
    return sketches.select(*by, F.when(F.col("score_n") > 0, edges).alias("edges"))
