"""Value counts, shares, histograms and box-plot figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import share_of


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value of a column; counts and total share one shuffle."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        column, "count", share_of(F.col("count"), F.col("total")).alias("percent")
    )


def beside(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by``, NULL equal to NULL; without ``by`` the one row of ``right`` to all.

    A plain equality would infer a filter on the keys, which moves below the counts of one
    side only, so that the rows would be read again.
    """
    if not by:
        if how == "left":
            return left.join(F.broadcast(right), F.lit(True), how)
        return left.crossJoin(F.broadcast(right))
    renamed = right.select(
        *[F.col(c).alias(f"_{c}") if c in by else F.col(c) for c in right.columns]
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return left.join(renamed, same, how).drop(*[f"_{c}" for c in by])


def _all_counts(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Rows per value; a NULL value has none, but keeps its group in the table."""
    value = F.col(column).cast("double")
    return df.groupBy(*by, value.alias("value")).agg(F.count(column).alias("n"))


def _of_numbers(counts: DataFrame) -> DataFrame:
    # The condition depends on the count, so it stays above the aggregate: all readers of
    # the counts have the same shuffle, and a computed column is not repeated below.
    return counts.filter(F.when(~F.isnan("value"), F.col("n")) > 0)


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """How often each value occurs, NULL and NaN left out: the small input of the figures below."""
    return _of_numbers(_all_counts(df, column, by))


QUANTILE_BINS = 256
#: Different values of a group that are looked at, about, to find the edges of its bins.
SAMPLED_VALUES = 8192


def sampled_edges(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, edges): sorted values that part the different values of each group into even bins.

    They are quantiles of a sample that a hash of the value draws, so every run, and every task
    that is run again, finds the same. Sizes follow the different values, not their range: an
    outlier moves no edge.
    """
    sizes = counts.groupBy(*by).agg(F.count("*").alias("values"), F.min("value").alias("low"))
    one_in = F.greatest(F.lit(1), F.ceil(F.col("values") / SAMPLED_VALUES))
    drawn = (F.pmod(F.xxhash64("value"), one_in) == 0) | (F.col("value") == F.col("low"))
    sample = (
        beside(counts, sizes, by)
        .filter(drawn)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )
    places = F.sequence(F.lit(1), F.lit(QUANTILE_BINS - 1))
    size = F.size("sample")
    edges = F.transform(
        places, lambda i: F.get("sample", F.floor(i * size / QUANTILE_BINS).cast("int"))
    )
    return sample.select(*by, F.array_distinct(edges).alias("edges"))


def _bin_of(value: Column, edges: Column) -> Column:
    """How many edges are at most ``value``, by halving."""
    steps = F.array(*[F.lit(QUANTILE_BINS >> i) for i in range(1, QUANTILE_BINS.bit_length())])

    def further(at: Column, step: Column) -> Column:
        fits = (at + step <= F.size(edges)) & (value >= F.get(edges, at + step - 1))
        return F.when(fits, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def exact_quantiles(
    counts: DataFrame, by: Sequence[str], shares: dict[str, float], edges: DataFrame | None = None
) -> DataFrame:
    """Interpolated quantiles of value counts (value, n), one column for each name in ``shares``.

    Values are first counted in bins; only the bins that hold a wanted rank are sorted, each in
    its own window. ``edges`` (by, edges: a sorted array) may come from stored sketches, else
    from :func:`sampled_edges`. They decide how the work is split, never the result.
    """
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    known = sampled_edges(counts, by) if edges is None else edges.select(*by, "edges")
    bounds = beside(totals, known, by, "left")
    place = F.coalesce(_bin_of(F.col("value"), F.col("edges")), F.lit(0))
    binned = beside(counts, bounds, by).withColumn("bin", place).drop("edges")
    ranks = F.array_sort(
        F.array_distinct(
            F.concat(
                *[
                    F.array(F.floor((F.col("total") - 1) * q), F.ceil((F.col("total") - 1) * q))
                    for q in shares.values()
                ]
            )
        )
    )
    in_order = Window.partitionBy(*by).orderBy("bin")
    bins = (
        binned.groupBy(*by, "bin", "total")
        .agg(F.sum("n").alias("m"))
        .withColumn("before", F.sum("m").over(in_order) - F.col("m"))
        .withColumn(
            "ranks",
            F.filter(
                ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("m"))
            ),
        )
        .filter(F.size("ranks") > 0)
        .select(*by, "bin", "before", "ranks")
    )
    inside = Window.partitionBy(*by, "bin").orderBy("value")
    found = (
        beside(binned, bins, [*by, "bin"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .withColumn(
            "ranks",
            F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))),
        )
        .select(*by, "total", "value", F.explode("ranks").alias("rank"))
    )
    at = found.groupBy(*by, "total").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")
    )

    def quantile(q: float):
        position = (F.col("total") - 1) * q
        low = F.element_at("at", F.floor(position))
        high = F.element_at("at", F.ceil(position))
        return low + (high - low) * (position - F.floor(position))

    return at.select(*by, *[quantile(q).alias(name) for name, q in shares.items()])


def histogram(df: DataFrame, column: str, bin_count: int) -> DataFrame:
    """Equal-width bins between smallest and largest value; empty bins are left out.

    Bounds and bins both read the same value counts, so the rows are scanned once and
    the shuffled counts are reused.
    """
    counts = value_counts(df, column)
    bounds = counts.agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("total")
    )
    width = (F.col("high") - F.col("low")) / bin_count
    position = F.when(width > 0, F.floor((F.col("value") - F.col("low")) / width)).otherwise(0)
    binned = counts.crossJoin(F.broadcast(bounds)).withColumn(
        "bin", F.least(position, F.lit(bin_count - 1)).cast("int")
    )
    return binned.groupBy("bin", "low", "high", "total").agg(F.sum("n").alias("count")).select(
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "count",
        share_of(F.col("count"), F.col("total")).alias("percent"),
    )


def _box_counts(df: DataFrame, column: str, by: str, first: int | None) -> DataFrame:
    """Value counts of all groups, or of the ``first`` smallest; the rows are scanned once."""
    everything = _all_counts(df, column, [by])
    counts = _of_numbers(everything)
    if first is None:
        return counts
    # The (true) condition keeps the counts alive, so that both readers share one shuffle.
    groups = everything.groupBy(by).agg(F.sum("n").alias("_rows")).filter("_rows >= 0")
    chosen = groups.orderBy(by).limit(first).select(by)
    return beside(counts, F.broadcast(chosen), [by])


def _quartiles(counts: DataFrame, by: str) -> DataFrame:
    stats = counts.groupBy(by).agg(
        F.sum("n").alias("n_items"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    quartiles = exact_quantiles(counts, [by], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q1, q3 = F.col("q1"), F.col("q3")
    return beside(stats, quartiles, [by]).select(
        by,
        "n_items",
        "min",
        "q1",
        "median",
        "q3",
        "max",
        (q1 - 1.5 * (q3 - q1)).alias("lower_fence"),
        (q3 + 1.5 * (q3 - q1)).alias("upper_fence"),
    )


def box_stats(df: DataFrame, column: str, by: str, first: int | None = None) -> DataFrame:
    """Quartiles, whiskers and number of outliers per group.

    Works on value counts, so a group with a third of all rows is as small as its
    number of different values. Whiskers end at the outermost value inside the fences,
    which lie 1.5 interquartile ranges from the quartiles.
    """
    counts = _box_counts(df, column, by, first)
    fences = _quartiles(counts, by)
    value = F.col("value")
    inside = value.between(F.col("lower_fence"), F.col("upper_fence"))
    figures = ["n_items", "min", "q1", "median", "q3", "max"]
    return (
        beside(counts, fences, [by])
        .groupBy(by, *figures)
        .agg(
            F.min(F.when(inside, value)).alias("lower_whisker"),
            F.max(F.when(inside, value)).alias("upper_whisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def box_outliers(df: DataFrame, column: str, by: str, first: int | None = None) -> DataFrame:
    """Values outside the fences with their number of items."""
    counts = _box_counts(df, column, by, first)
    outside = ~F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return beside(counts, _quartiles(counts, by), [by]).filter(outside).select(by, "value", "n")
