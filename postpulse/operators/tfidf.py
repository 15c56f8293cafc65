"""Term weights: exact per word, and hashed vectors."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as t
from ..functions.lexicons import ENGLISH_STOP_WORDS
from .texts import once

MIN_TEXT_LENGTH = 10


def long_enough(df: DataFrame, text_col: str) -> DataFrame:
    """Rows whose text is worth weighing."""
    return df.filter(F.length(text_col) > MIN_TEXT_LENGTH)


def term_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Per word: items that hold it (``df``) and its highest count in one item (``max_tf``).

    Words are counted inside their own row, so only one small record per word and task
    is shuffled. The row without a word carries the number of items in ``n_items``.
    Tables of several sets can be added up with :func:`merge_term_stats`.
    """
    texts = df.filter(F.col(text_col).isNotNull())
    words = texts.select(
        F.sort_array(t.plain_tokens(text_col, ENGLISH_STOP_WORDS)).alias("sorted")
    )
    runs = words.withColumn("starts", t.run_starts(F.col("sorted")))
    pairs = runs.select(t.term_frequencies(F.col("sorted"), F.col("starts")).alias("terms"))
    item = F.array(
        F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).alias("tf"))
    )
    # inline_outer: the plain form would infer a filter that repeats the whole chain.
    rows = pairs.select(F.inline_outer(F.concat(item, F.col("terms"))))
    return rows.groupBy("word").agg(
        F.count("*").alias("df"),
        F.max("tf").alias("max_tf"),
        F.count_if(F.col("word").isNull()).alias("n_items"),
    )


def merge_term_stats(stats: DataFrame) -> DataFrame:
    """Term statistics of several batches as one; history never goes back to the texts."""
    return stats.groupBy("word").agg(
        F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.sum("n_items").alias("n_items")
    )


def _idf(n_items: Column, df: Column) -> Column:
    return F.log((n_items + 1) / (df + 1))


def word_scores(stats: DataFrame) -> DataFrame:
    """Best TF-IDF of each word: as the IDF depends on the word only, max(tf) * idf."""
    # max_by over the whole row keeps every column of the statistics alive, so both
    # sides of the join have the same plan and share one scan and one shuffle.
    whole_row = F.struct("n_items", "df", "max_tf", "word")
    size = stats.agg(F.max_by("n_items", whole_row).alias("set_size"))
    words = stats.filter(F.col("n_items") == 0)
    return words.crossJoin(F.broadcast(size)).select(
        "word", (F.col("max_tf") * _idf(F.col("set_size"), F.col("df"))).alias("score")
    )


def top_words(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("score"), "word").limit(n)


def tfidf_top_words(df: DataFrame, text_col: str = "text", n: int = 10) -> DataFrame:
    return top_words(word_scores(term_stats(df, text_col)), n)


def tfidf_vectors(
    df: DataFrame, text_col: str = "full_text", num_features: int = 1000
) -> DataFrame:
    """Hashed TF-IDF: id, words without stop words, weights as an array of (bucket, weight).

    Buckets come from the hashing transformer, which learns nothing. Their document
    frequencies are one row of ``num_features`` numbers, so no job runs before the action.
    Texts are tokenised and hashed once: weights and frequencies read one shuffle by id.
    """
    texts = long_enough(once(df.select("id", text_col), text_col), text_col)
    words = t.plain_tokens(text_col, ENGLISH_STOP_WORDS)
    counted = HashingTF(
        inputCol="filtered_words", outputCol="counts", numFeatures=num_features
    ).transform(texts.select("id", words.alias("filtered_words")))
    sparse = F.unwrap_udt("counts")
    buckets = F.zip_with(
        sparse["indices"], sparse["values"], lambda i, n: F.struct(i.alias("bucket"), n.alias("tf"))
    )
    # A list of one row is not pruned, so both readers have the same plan below the shuffle.
    row = F.struct("filtered_words", buckets.alias("buckets"))
    rows = counted.select("id", F.array(row).alias("row")).hint("rebalance", "id")
    rows = rows.select("id", F.inline_outer("row"))
    # The entry without a bucket counts the texts.
    entries = F.concat(F.array(F.lit(-1)), F.col("buckets.bucket"))
    frequency = (
        rows.select(F.explode(entries).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))
    )
    size = F.max(F.when(F.col("bucket") == -1, F.col("df")))
    known = frequency.agg(
        size.alias("n"), F.map_from_entries(F.collect_list(F.struct("bucket", "df"))).alias("dfs")
    )
    # An array, as a map is searched from its start.
    places = F.sequence(F.lit(0), F.lit(num_features - 1))
    known = known.select("n", F.transform(places, lambda i: F.element_at("dfs", i)).alias("dfs"))
    weights = F.transform(
        "buckets",
        lambda x: F.struct(
            x["bucket"].alias("bucket"),
            (x["tf"] * _idf(F.col("n"), F.get("dfs", x["bucket"]))).alias("weight"),
        ),
    )
    return rows.crossJoin(F.broadcast(known)).select(
        "id", "filtered_words", weights.alias("features")
    )
