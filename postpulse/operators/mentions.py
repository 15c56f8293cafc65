"""Reference lists, mention counts and sliding event-time windows over them."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.references import KINDS, reference_count, references
from ..schemas import REFERENCE_COLUMNS

COUNT_COLUMNS = tuple(f"{kind}_ref_count" for kind in KINDS)


def extract_references(df: DataFrame, text_col: str = "text", dialect: str = "name") -> DataFrame:
    """Add the three reference lists found in ``text_col``."""
    return df.withColumns(
        {
            name: references(F.col(text_col), kind, dialect)
            for name, kind in zip(REFERENCE_COLUMNS, KINDS)
        }
    )


def mention_rows(df: DataFrame, references_col: str, name: str) -> DataFrame:
    """One row per mention, with the item's id, community and arrival time where present."""
    kept = [c for c in ("id", "subreddit", "timestamp_received") if c in df.columns]
    # The outer form keeps the optimizer from repeating the extraction in a filter.
    rows = df.select(*kept, F.explode_outer(references_col).alias(name))
    return rows.filter(F.col(name).isNotNull())


def mention_counts(
    df: DataFrame, references_col: str, name: str, top: int | None = None, ranked: bool = True
) -> DataFrame:
    """Mentions per referenced name; ranked, cut to ``top`` when given."""
    counts = mention_rows(df, references_col, name).groupBy(name).agg(
        F.count("*").alias("mention_count")
    )
    if not ranked and top is None:
        return counts
    counts = counts.orderBy(F.desc("mention_count"), name)
    return counts if top is None else counts.limit(top)


def reference_totals(df: DataFrame, text_col: str = "text", dialect: str = "word") -> DataFrame:
    """One row: how many users, communities and URLs the texts mention."""
    return df.agg(
        *[
            F.coalesce(
                F.sum(reference_count(references(F.col(text_col), kind, dialect))), F.lit(0)
            ).alias(name)
            for kind, name in zip(KINDS, ("user_refs", "sub_refs", "url_refs"))
        ]
    )


def _event_time(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _window_columns(window: Column) -> list[Column]:
    return [window["start"].alias("window_start"), window["end"].alias("window_end")]


def windowed_references(
    df: DataFrame,
    text_col: str = "text",
    time_col: str = "created_utc",
    dialect: str = "token",
    length: int = 60,
    slide: int = 5,
    watermark: str = "1 minute",
) -> DataFrame:
    """Reference counts per sliding window of ``length`` seconds every ``slide`` seconds.

    A table is first summed into panes of the common divisor, so an item counts
    once before the shuffle and only the few panes fan out into windows. A stream
    goes into its windows directly, as update mode allows one aggregation; its state
    holds the open windows only.
    """
    counts = {
        name: reference_count(references(F.col(text_col), kind, dialect))
        for name, kind in zip(COUNT_COLUMNS, KINDS)
    }
    rows = df.select(
        _event_time(time_col).alias("created_ts"), *[c.alias(n) for n, c in counts.items()]
    )
    sums = [F.sum(n).alias(n) for n in COUNT_COLUMNS]
    if df.isStreaming:
        rows = rows.withWatermark("created_ts", watermark)
    else:
        pane = F.window("created_ts", f"{gcd(length, slide)} seconds")
        rows = rows.groupBy(pane.alias("pane")).agg(*sums)
        rows = rows.select(F.col("pane.start").alias("created_ts"), *COUNT_COLUMNS)
    window = F.window("created_ts", f"{length} seconds", f"{slide} seconds")
    windows = rows.groupBy(window.alias("window")).agg(*sums)
    return windows.select(*_window_columns(F.col("window")), *COUNT_COLUMNS)


def windowed_reference_lists(
    df: DataFrame,
    text_col: str = "text",
    time_col: str = "created_utc",
    dialect: str = "name",
    length: int = 60,
    slide: int = 5,
    watermark: str = "1 minute",
) -> DataFrame:
    """The reference lists of the items of each sliding window, with their number of items.

    One row for each window and triple of lists (users, subreddits, urls), ``copies`` items
    each; totals come from :func:`windowed_references`. Items are counted in panes first, so a
    busy window costs its different triples, and its rows need not be in one place.

    On a stream these are two aggregations in a row, for append mode: a pane is handed on when
    the watermark has passed it, a window when all its panes are.
    """
    lists = ("users", "subreddits", "urls")
    rows = df.select(
        _event_time(time_col).alias("ts"),
        *[references(F.col(text_col), kind, dialect).alias(n) for n, kind in zip(lists, KINDS)],
    )
    if df.isStreaming:
        rows = rows.withWatermark("ts", watermark)
    pane = F.window("ts", f"{gcd(length, slide)} seconds").alias("pane")
    triples = rows.groupBy(pane, *lists).agg(F.count("*").alias("copies"))
    window = F.window("pane", f"{length} seconds", f"{slide} seconds").alias("window")
    windows = triples.groupBy(window, *lists).agg(F.sum("copies").alias("copies"))
    return windows.select(*_window_columns(F.col("window")), *lists, "copies")
