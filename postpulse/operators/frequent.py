"""Mergeable summaries of term counts: the top terms of a run, with bounds for what they leave out.

A summary keeps up to ``SIZE`` terms of each kind. The true count of a kept term lies between ``count``
and ``count + error``, that of any other term is at most ``cut``. The bounds are exact, nothing is drawn
by chance, and they hold for sums of summaries as well. So :func:`top_terms` and :func:`top_phrases` know
which terms can be among the first n: they count those alone, or read no text if no error is left. Only
where the bounds leave the first n open are all terms counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import texts

#: Terms that a summary keeps of each kind.
SIZE = 2000
#: Parts of a group of terms that are ranked apart.
PARTS = 64


def _highest() -> Column:
    return F.col("count") + F.col("error")


def _cut_off(rows: DataFrame, keys: Sequence[str], size: int, least_cut: Column) -> DataFrame:
    """The ``size`` rows (term, count, error) of each group with the highest bounds, as one row.

    Terms are thinned out in parts of each group first, so that no task sorts a whole group.
    """
    order = [_highest().desc(), "term"]
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).alias("part")
    parted = Window.partitionBy(*keys, "part").orderBy(*order)
    thinned = rows.select("*", part).withColumn("place", F.row_number().over(parted))
    thinned = thinned.filter(F.col("place") <= size + 1).drop("part", "place")
    whole = Window.partitionBy(*keys).orderBy(*order)
    placed = thinned.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= size + 1)
    kept = F.col("place") <= size
    return placed.groupBy(*keys).agg(
        F.greatest(F.coalesce(F.max(F.when(~kept, _highest())), F.lit(0)), F.max(least_cut)).alias("cut"),
        F.collect_list(F.when(kept, F.struct("term", "count", "error"))).alias("terms"),
    )


def summary(
    cleaned: DataFrame, by: Sequence[str] = (), text_col: str = "text", size: int = SIZE
) -> DataFrame:
    """One row (by, kind, cut, terms) for each group and kind that has a term.

    Terms are those of :func:`texts.term_counts`; a NULL text has none.
    """
    counts = texts.term_counts(cleaned, text_col, by)
    rows = counts.withColumn("error", F.lit(0).cast("bigint"))
    return _cut_off(rows, [*by, "kind"], size, F.lit(0).cast("bigint"))


def merge(summaries: DataFrame, size: int = SIZE) -> DataFrame:
    """Summaries of any number of batches as one row for each kind.

    A batch that does not keep a term may still have had it as often as its ``cut`` says.
    """
    totals = summaries.groupBy("kind").agg(F.sum("cut").alias("all_cuts"))
    entries = summaries.select("kind", "cut", F.inline("terms"))
    added = entries.groupBy("kind", "term").agg(
        F.sum("count").alias("count"), F.sum("error").alias("error"), F.sum("cut").alias("own_cuts")
    )
    # One row for each kind.
    rows = added.join(F.broadcast(totals), "kind").select(
        "kind", "term", "count", (F.col("error") + F.col("all_cuts") - F.col("own_cuts")).alias("error"),
        "all_cuts",
    )
    return _cut_off(rows, ["kind"], size, F.col("all_cuts"))


def _candidates(
    merged: DataFrame, kind: str, n: int, least: int, wanted: Column
) -> tuple[bool, list]:
    """Whether the first n are surely kept, and the kept (term, count, error) that can be among them."""
    of_kind = merged.filter(F.col("kind") == kind)
    cut = of_kind.agg(F.coalesce(F.max("cut"), F.lit(0))).first()[0]
    # At most ``size`` rows.
    rows = of_kind.select(F.inline("terms")).filter(wanted).collect()
    counts = sorted((r["count"] for r in rows), reverse=True)
    floor = max(counts[n - 1], least) if len(counts) >= n else least
    return cut < floor, [r for r in rows if r["count"] + r["error"] >= floor]


def _top(
    merged: DataFrame, cleaned: DataFrame, kind: str, n: int, least: int, wanted: Column, text_col: str
) -> DataFrame:
    if n < 1:
        raise ValueError("n must be at least 1")
    complete, found = _candidates(merged, kind, n, least, wanted)
    if complete and not any(r["error"] for r in found):
        rows = [(r["term"], r["count"]) for r in found]
        counts = merged.sparkSession.createDataFrame(rows, "term string, count bigint")
    else:
        counts = texts.counts_of_kind(cleaned, text_col, kind == "phrase")
        counts = counts.filter(F.col("term").isin([r["term"] for r in found]) if complete else wanted)
    return counts.filter(F.col("count") >= least).orderBy(F.desc("count"), "term").limit(n)


def top_terms(
    merged: DataFrame, cleaned: DataFrame, n: int = 12, text_col: str = "text", frequent_only: bool = True
) -> DataFrame:
    """The rows of :func:`texts.top_terms` over ``cleaned``, of which ``merged`` is the summary."""
    wanted = F.length("term") > 3 if frequent_only else F.lit(True)
    return _top(merged, cleaned, "term", n, 2 if frequent_only else 1, wanted, text_col)


def top_phrases(
    merged: DataFrame, cleaned: DataFrame, n: int = 8, text_col: str = "text", frequent_only: bool = True
) -> DataFrame:
    """The rows of :func:`texts.top_phrases` over ``cleaned``, of which ``merged`` is the summary."""
    return _top(merged, cleaned, "phrase", n, 2 if frequent_only else 1, F.lit(True), text_col)
