"""Enriched text rows and the figures drawn from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as t
from ..functions.lexicons import SENTIMENT_WEIGHTS, TEXT_COLUMNS
from ..functions.values import bins

UNKNOWN = "unknown"


def with_clean_text(df: DataFrame, text_col: str = "text", name: str = "clean") -> DataFrame:
    return df.withColumn(name, t.clean(F.col(text_col)))


def once(df: DataFrame, *columns: str) -> DataFrame:
    """Keep costly columns from being computed again.

    A filter on a computed column is normally moved below it and repeats the whole
    expression. Values that pass through a one-element list stay where they are.
    """
    rest = [c for c in df.columns if c not in columns]
    values = F.array(F.struct(*columns))
    return df.select(*rest, F.inline_outer(values)).select(*df.columns)


def with_sentiment(df: DataFrame, cleaned_col: str = "clean") -> DataFrame:
    """Add word count, sentiment and its category, topic and question flag.

    The token list and the short list of lexicon words are built once per row.
    """
    staged = df.withColumn("_words", t.tokens(F.col(cleaned_col)))
    staged = staged.withColumn("_hits", t.lexicon_hits("_words"))
    staged = staged.withColumns(
        {"word_count": F.size("_words"), "_negated": t.negated_words("_words", "_hits")}
    ).drop("_words")
    staged = once(staged, cleaned_col, "word_count", "_hits", "_negated")
    staged = staged.withColumns(
        {
            "sentiment": t.sentiment("_hits", "word_count", "_negated"),
            "_topics": t.topic_counts("_hits"),
        }
    )
    return staged.withColumns(
        {
            "sentiment_category": t.sentiment_category(F.col("sentiment")),
            "topic": t.topic("_topics"),
            "has_question": t.is_question(F.col(cleaned_col)),
        }
    ).drop("_hits", "_negated", "_topics")


def _text_columns(df: DataFrame, text_cols: Sequence[str] | None) -> tuple[list[str], Column]:
    """The text columns of items, and whether any of them has content."""
    columns = [c for c in TEXT_COLUMNS if c in df.columns] if text_cols is None else list(text_cols)
    if not columns:
        raise ValueError("no text column present")
    has_text = F.lit(False)
    for c in columns:
        has_text = has_text | t.has_content(F.col(c))
    return columns, has_text


def item_texts(df: DataFrame, text_cols: Sequence[str] | None = None) -> DataFrame:
    """The column ``text`` of :func:`enrich` alone."""
    columns, has_text = _text_columns(df, text_cols)
    return df.filter(has_text).select(t.combine(columns).alias("text"))


def enrich(
    df: DataFrame,
    text_cols: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    comments_as_zero: bool = False,
) -> DataFrame:
    """The twelve text figures of every item that has any text.

    ``text_cols`` defaults to the known text columns that are present. A missing
    number of comments leaves the engagement NULL unless ``comments_as_zero``.
    """
    present = set(df.columns)
    columns, has_text = _text_columns(df, text_cols)

    def given(name: str, default) -> Column:
        return F.col(name) if name in present else F.lit(default)

    comments = given("num_comments", 0)
    if comments_as_zero:
        comments = F.coalesce(comments, F.lit(0))
    base = df.filter(has_text).select(
        *keep,
        t.combine(columns).alias("text"),
        F.concat_ws(" ", *columns).alias("original_text"),
        given("subreddit", UNKNOWN).alias("subreddit"),
        given("author", UNKNOWN).alias("author"),
        given("score", 0).alias("score"),
        (given("score", 0) + comments * 2).alias("engagement_score"),
    )
    return (
        with_sentiment(base, "text")
        .withColumn("length", F.length("text"))
        .select(
            *keep,
            "text",
            "original_text",
            "length",
            "word_count",
            "subreddit",
            "author",
            "score",
            "sentiment",
            "sentiment_category",
            "topic",
            "has_question",
            "engagement_score",
        )
    )


def question_counts(enriched: DataFrame) -> DataFrame:
    """Statements and questions with their share, as one row."""
    counted = enriched.agg(
        F.count_if(~F.col("has_question")).alias("statements"),
        F.count_if(F.col("has_question")).alias("questions"),
    )
    entries = F.nullif(F.col("questions") + F.col("statements"), F.lit(0))
    share = F.lit(100.0) * F.col("questions") / entries
    return counted.withColumns(
        {"question_percent": share, "statement_percent": F.lit(100.0) - share}
    )


def text_summary(enriched: DataFrame) -> DataFrame:
    """Means and spreads of length, word count and sentiment."""
    return enriched.agg(
        F.count("*").alias("entries"),
        F.avg("length").alias("mean_length"),
        F.stddev_samp("length").alias("std_length"),
        F.avg("word_count").alias("mean_words"),
        F.stddev_samp("word_count").alias("std_words"),
        F.avg("sentiment").alias("mean_sentiment"),
        F.stddev_samp("sentiment").alias("std_sentiment"),
        F.min("sentiment").alias("min_sentiment"),
        F.max("sentiment").alias("max_sentiment"),
    )


def _strength(value: Column, weak: str) -> Column:
    magnitude = F.abs(value)
    return bins(magnitude, [(0.1, "minimal"), (0.2, weak), (0.3, "moderately"), (None, "strongly")])


def _direction(value: Column, up: str, down: str) -> Column:
    return F.when(value > 0.1, up).when(value < -0.1, down)


def engagement_correlation(enriched: DataFrame) -> DataFrame:
    """Correlation of engagement with sentiment and with length, in words as well."""
    pairs = enriched.filter(F.col("engagement_score").isNotNull())
    corr = pairs.agg(
        F.corr("sentiment", F.col("engagement_score").cast("double")).alias("sentiment_corr"),
        F.corr(
            F.col("word_count").cast("double"), F.col("engagement_score").cast("double")
        ).alias("length_corr"),
    )
    sentiment, length = F.col("sentiment_corr"), F.col("length_corr")
    return corr.withColumns(
        {
            "sentiment_strength": _strength(sentiment, "weakly"),
            "sentiment_direction": _direction(sentiment, "positively", "negatively"),
            "length_strength": _strength(length, "slightly"),
            "length_direction": _direction(length, "longer", "shorter"),
        }
    )


def _term_rows(cleaned: DataFrame, text_col: str, by: Sequence[str] = ()) -> DataFrame:
    words = cleaned.select(*by, t.meaningful_words(text_col).alias("words"))
    pairs = words.withColumn("pairs", t.bigrams("words"))
    entries = pairs.select(
        *by,
        F.expr(
            """explode(array(named_struct('kind', 'term', 'items', words),
                             named_struct('kind', 'phrase', 'items', pairs))) as e"""
        ),
    )
    rows = entries.select(*by, "e.kind", F.explode_outer("e.items").alias("term"))
    return rows.filter(F.col("term").isNotNull())


def _dealt(cleaned: DataFrame, text_col: str, by: Sequence[str] = ()) -> DataFrame:
    """The texts in parts of bounded size, however large the files or row groups they come from.

    A task holds the different pairs of its part before their shuffle, several times the bytes of
    the texts. Copies from different tasks go to different parts.
    """
    return cleaned.select(*by, text_col).repartition(F.col(text_col), F.spark_partition_id())


def term_counts(
    cleaned: DataFrame, text_col: str = "text", by: Sequence[str] = ()
) -> DataFrame:
    """Occurrences of every meaningful word and every pair of neighbours, in one pass, by group.

    ``kind`` is ``term`` or ``phrase``. Counting starts before the shuffle, so frequent
    words travel once per task.
    """
    rows = _term_rows(_dealt(cleaned, text_col, by), text_col, by)
    return rows.groupBy(*by, "kind", "term").agg(F.count("*").alias("count"))


def counts_of_kind(cleaned: DataFrame, text_col: str, phrases: bool) -> DataFrame:
    """Occurrences of every meaningful word, or of every pair of neighbours."""
    texts = _dealt(cleaned, text_col) if phrases else cleaned
    words = texts.select(t.meaningful_words(text_col).alias("items"))
    if phrases:
        words = words.select(t.bigrams("items").alias("items"))
    rows = words.select(F.explode_outer("items").alias("term"))
    rows = rows.filter(F.col("term").isNotNull())
    return rows.groupBy("term").agg(F.count("*").alias("count"))


def top_terms(
    cleaned: DataFrame, n: int = 12, text_col: str = "text", frequent_only: bool = True
) -> DataFrame:
    """Most frequent words; by default of four and more letters and found twice or more."""
    counts = counts_of_kind(cleaned, text_col, phrases=False)
    if frequent_only:
        counts = counts.filter((F.col("count") > 1) & (F.length("term") > 3))
    return counts.orderBy(F.desc("count"), "term").limit(n)


def top_phrases(
    cleaned: DataFrame, n: int = 8, text_col: str = "text", frequent_only: bool = True
) -> DataFrame:
    """Most frequent pairs of neighbouring words, by default found twice or more."""
    counts = counts_of_kind(cleaned, text_col, phrases=True)
    if frequent_only:
        counts = counts.filter(F.col("count") > 1)
    return counts.orderBy(F.desc("count"), "term").limit(n)


def unique_terms(
    cleaned: DataFrame, text_col: str = "text", approximate: bool = False
) -> DataFrame:
    """How many different words and pairs there are.

    The exact numbers shuffle the texts and every different pair once; the approximate ones only a
    sketch per task.
    """
    if approximate:
        rows, kind = _term_rows(cleaned, text_col), F.col("kind")
        return rows.agg(
            F.approx_count_distinct(F.when(kind == "term", F.col("term"))).alias("unique_terms"),
            F.approx_count_distinct(F.when(kind == "phrase", F.col("term"))).alias(
                "unique_phrases"
            ),
        )
    words = _dealt(cleaned, text_col).select(t.meaningful_words(text_col).alias("words"))
    both = words.select(F.concat("words", t.bigrams("words")).alias("items"))
    rows = both.select(F.explode_outer("items").alias("term")).filter(F.col("term").isNotNull())
    # No word holds a blank.
    phrase = F.col("term").contains(" ")
    return rows.distinct().agg(
        F.count_if(~phrase).alias("unique_terms"), F.count_if(phrase).alias("unique_phrases")
    )


def polarity(
    df: DataFrame, lexicon: DataFrame, key: Sequence[str], text_col: str = "text"
) -> DataFrame:
    """Mean polarity of the lexicon words in each item, 0.0 where there are none.

    ``lexicon`` is a table (word, polarity), ``key`` identifies an item. The words of an item
    are counted inside their row and joined to the lexicon; adaptive execution picks the join
    and splits frequent words. Only matches are shuffled back to their item.
    """
    words = t.tokens(t.clean(F.col(text_col)))
    runs = df.select(*key, F.sort_array(words).alias("_sorted"))
    runs = runs.withColumn("_starts", t.run_starts(F.col("_sorted")))
    terms = t.term_frequencies(F.col("_sorted"), F.col("_starts"))
    rows = runs.select(*key, terms.alias("_terms")).select(*key, F.inline_outer("_terms"))
    matched = rows.join(lexicon.select("word", "polarity"), "word", "left")
    hits = F.when(F.col("polarity").isNotNull(), F.col("tf"))
    mean = F.sum(F.col("polarity") * F.col("tf")) / F.nullif(F.sum(hits), F.lit(0))
    return matched.groupBy(*key).agg(F.coalesce(mean, F.lit(0.0)).alias("polarity"))


def default_lexicon() -> dict[str, float]:
    """The sentiment words with half their weight: from -1 to 1."""
    return {w: weight / 2 for group, weight in SENTIMENT_WEIGHTS for w in group}


def with_polarity(
    df: DataFrame,
    text_col: str = "text",
    lexicon: Mapping[str, float] | None = None,
    name: str = "sentiment",
) -> DataFrame:
    """Add the mean polarity by a small lexicon that travels inside the plan."""
    words = df.withColumn("_words", t.tokens(t.clean(F.col(text_col))))
    lexicon = default_lexicon() if lexicon is None else lexicon
    return words.withColumn(name, t.polarity("_words", lexicon)).drop("_words")


def score_with(
    df: DataFrame,
    scorer: Callable[[pd.Series], pd.Series],
    text_col: str = "text",
    name: str = "sentiment",
) -> DataFrame:
    """Add the score of a caller's own function over batches of texts; 0.0 without text.

    The only way into Python: for scorers that Spark expressions cannot state.
    """

    def scored(texts: pd.Series) -> pd.Series:
        return scorer(texts.fillna(""))

    text = F.col(text_col)
    value = F.pandas_udf(scored, "double")(text)
    return df.withColumn(
        name, F.when(F.coalesce(text, F.lit("")) != "", value).otherwise(F.lit(0.0))
    )


def mean_sentiment(df: DataFrame, column: str = "sentiment") -> DataFrame:
    return df.agg(F.avg(column).alias("avg_sentiment"))


