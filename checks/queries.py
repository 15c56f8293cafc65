"""The registered queries: each reads the given tables whole and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from postpulse.files import Files
from postpulse.functions import lexicons, text as text_functions
from postpulse.operators import (
    authors,
    distribution,
    frequent,
    history,
    ingest,
    mentions,
    sketches,
    tallies,
    texts,
    tfidf,
)
from postpulse.plans import reports
from postpulse.plans.sample_items import (
    comments_from_conversations,
    items_from_events,
    posts_from_documents,
)
from postpulse.schemas import LEAN_ITEM, REFERENCE_COLUMNS, RICH_ITEM, canonicalise
from postpulse.scratch import shared_folder
from postpulse.sources import batches, sinks
from postpulse.sources.items import (
    item_lines,
    parse_lines,
    parse_times,
    read_items_stream,
    stamp,
)
from postpulse.streaming import job, windows

RECEIVED = "2024-01-01T00:00:00"
ITEM_COLUMNS = [
    "id", "type", "subreddit", "author", "score", "num_comments", "created_utc", "text",
]
# A batch of a stream arrives in so many files at most.
MOST_FILES = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def items(spark: SparkSession, sf: str) -> DataFrame:
    return items_from_events(table(spark, sf, "events"))


def items_with_references(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.extract_references(items(spark, sf))


def rich_items(spark: SparkSession, sf: str) -> DataFrame:
    return canonicalise(items_with_references(spark, sf))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    columns = table(spark, sf, "documents").select("doc_id", "text", "source")
    return posts_from_documents(columns)


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", F.concat_ws(" ", "url", "html").alias("text")
    )


def enriched_items(spark: SparkSession, sf: str) -> DataFrame:
    return texts.enrich(items(spark, sf), keep=["id"])


def enriched_documents(spark: SparkSession, sf: str) -> DataFrame:
    return texts.enrich(documents(spark, sf), keep=["doc_id"])


def polarity_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(texts.default_lexicon().items()), "word string, polarity double"
    )


def joined(df: DataFrame, *columns: str, separator: str = " ") -> DataFrame:
    """List columns as text, so that both engines compare them alike."""
    return df.withColumns({c: F.array_join(c, separator) for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- items ---------------------------------------------------------------------------


def items_canonical(spark, sf):
    lean = items(spark, sf).withColumn(
        "type", F.when(F.col("type") == "post", "submission").otherwise(F.col("type"))
    )
    return canonicalise(lean).select(*ITEM_COLUMNS, "full_text", "title", "url", "batch_number")


def json_roundtrip(spark, sf):
    lines = item_lines(rich_items(spark, sf).select(*RICH_ITEM.names))
    return joined(parse_lines(lines), *REFERENCE_COLUMNS).select(*ITEM_COLUMNS, *REFERENCE_COLUMNS)


def parse_json_lines(spark, sf):
    lines = table(spark, sf, "events").select(F.col("props").alias("value"))
    schema = StructType([StructField("k", IntegerType())])
    return parse_lines(lines, schema).groupBy("k").agg(F.count("*").alias("n"))


def parsed_times(spark, sf):
    shaped = ingest.posts_to_items(raw_posts(spark, sf), F.lit(RECEIVED))
    timed = parse_times(shaped)
    return timed.select(
        "id",
        F.unix_micros("created_datetime").alias("created_micros"),
        F.unix_micros("timestamp_received").alias("received_micros"),
    )


def posts_to_items(spark, sf):
    posts = raw_posts(spark, sf)
    shaped = joined(ingest.posts_to_items(posts, F.lit(RECEIVED)), *REFERENCE_COLUMNS)
    return shaped.withColumn("upvote_ratio", F.round(F.col("upvote_ratio").cast("double"), 2))


def comments_to_items(spark, sf):
    comments = comments_from_conversations(table(spark, sf, "conversations"))
    shaped = joined(ingest.comments_to_items(comments, F.lit(RECEIVED)), *REFERENCE_COLUMNS)
    return shaped.drop("title", "upvote_ratio", "num_comments", "url", "is_self", "over_18",
                       "spoiler", "locked")


def lean_items(spark, sf):
    posts = raw_posts(spark, sf)
    comments = comments_from_conversations(table(spark, sf, "conversations"))
    return ingest.merge_items(
        ingest.submissions_to_lean(posts), ingest.comments_to_lean(comments)
    ).select(*LEAN_ITEM.names)


def merge_dedupe(spark, sf):
    once = items(spark, sf).withColumn("timestamp_received", F.lit("2024-01-01T01:00:00"))
    # The copy that came first has the larger content.
    earlier = {"timestamp_received": F.lit(RECEIVED), "score": F.col("score") + 1}
    later = once.withColumns(earlier)
    kept = ingest.only_communities(ingest.merge_items(once, later), ["click", "view", "error"])
    return ingest.dedupe(kept).select(*ITEM_COLUMNS)


def newest_per_community(spark, sf):
    return ingest.newest_per_community(items(spark, sf)).select(*ITEM_COLUMNS)


def first_comments(spark, sf):
    comments = comments_from_conversations(table(spark, sf, "conversations"))
    return ingest.first_comments(comments, position="position").select(
        "id", "post_id", "position", "body"
    )


# --- references ----------------------------------------------------------------------


def user_mentions(spark, sf):
    return mentions.mention_counts(items_with_references(spark, sf), "user_references", "user_ref")


def community_mentions(spark, sf):
    return mentions.mention_counts(
        items_with_references(spark, sf), "subreddit_references", "subreddit_ref"
    )


def url_mentions(spark, sf):
    found = mentions.extract_references(pages(spark, sf), dialect="token")
    return mentions.mention_counts(found, "url_references", "url_ref")


def reference_dialects(spark, sf):
    out = pages(spark, sf)
    names = []
    for dialect in ("producer", "token", "word", "name"):
        out = mentions.extract_references(out, dialect=dialect)
        for column in REFERENCE_COLUMNS:
            name = f"{dialect}_{column}"
            names.append(name)
            out = out.withColumnRenamed(column, name)
    return joined(out, *names, separator="|").drop("text")


def reference_totals(spark, sf):
    return mentions.reference_totals(items(spark, sf))


def windowed_references(spark, sf):
    return epoch_windows(mentions.windowed_references(items(spark, sf)))


def epoch_windows(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.unix_seconds(c) for c in ("window_start", "window_end")}
    )


def windowed_reference_lists(spark, sf):
    lists = mentions.windowed_reference_lists(items(spark, sf))
    return epoch_windows(joined(lists, "users", "subreddits", "urls"))


def put_in_order(spark: SparkSession, frames: list[DataFrame]) -> tuple[str, int]:
    """A folder that gets each frame in turn as so many Parquet files, and that number.

    The number follows the input of the first frame, so that all its tasks write. A frame with
    fewer rows than files has empty files too: a stream that takes the number of files at a time
    takes one frame.
    """
    folder = shared_folder(spark, "arrivals")
    files = Files(spark, folder)
    each = min(MOST_FILES, frames[0].rdd.getNumPartitions())
    for i, frame in enumerate(frames, 1):
        # By content: dealt in turn, all rows would be sorted first.
        spread = frame.repartition(each, *frame.columns) if each > 1 else frame.coalesce(1)
        spread.write.mode("append").parquet(folder)
        for _ in range(i * each - len(files.matching(f"{folder}/*.parquet"))):
            frame.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return folder, each


def time_slices(df: DataFrame, n: int = 4) -> list[DataFrame]:
    """The items in ``n`` parts of equal time span, in order."""
    low, high = df.agg(F.min("created_utc"), F.max("created_utc")).first()
    part = F.least(F.floor((F.col("created_utc") - low) / (high - low) * n), F.lit(n - 1))
    return [df.filter(part == i) for i in range(n)]


def arriving(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """A stream that gets one frame in each micro-batch."""
    folder, each = put_in_order(spark, frames)
    source = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", each)
    return stamp(source.parquet(folder))


def windowed_references_stream(spark, sf):
    root = shared_folder(spark, "windows")
    stream = arriving(spark, time_slices(items(spark, sf)))
    windows.start_windowed_references(stream, root, None).awaitTermination()
    return epoch_windows(windows.read_windowed_references(spark, root))


def stream_dedupe(spark, sf):
    """Old and new items arrive mixed, then a changed copy of each; eight micro-batches."""
    root = shared_folder(spark, "dedupe")
    parts = time_slices(items(spark, sf).select(*ITEM_COLUMNS))
    first = [parts[i] for i in (2, 0, 3, 1)]
    again = [p.withColumn("score", F.col("score") - 1) for p in parts]
    windows.start_deduped_files(
        arriving(spark, first + again), f"{root}/items", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/items").select(*ITEM_COLUMNS)


def window_table_stream(spark, sf):
    root = shared_folder(spark, "window-table")
    stream = arriving(spark, time_slices(items(spark, sf)))
    windows.start_window_table(stream, root, None).awaitTermination()
    return epoch_windows(windows.window_table(spark, root).read().drop("epoch"))


def windowed_reference_lists_stream(spark, sf):
    """Some items before the end of a slice come with the next one; a late item closes the last windows."""
    frames = time_slices(items(spark, sf))
    waiting, batches_ = None, []
    for frame in frames:
        end = frame.agg(F.max("created_utc")).first()[0]
        late = (F.col("created_utc") > end - 50) & (F.col("created_utc") < end) & (F.crc32("id") % 2 == 0)
        batch = frame.filter(~late)
        batches_.append(batch if waiting is None else batch.unionByName(waiting))
        waiting = frame.filter(late)
    closing = frames[-1].limit(1).withColumn("created_utc", F.lit(end + 86400))
    last = closing.withColumn("text", F.lit(""))
    batches_ += [last.unionByName(waiting)]
    root = shared_folder(spark, "window-lists")
    windows.start_closed_window_lists(
        arriving(spark, batches_), f"{root}/lists", f"{root}/checkpoint", None
    ).awaitTermination()
    lists = spark.read.parquet(f"{root}/lists")
    return epoch_windows(joined(lists, "users", "subreddits", "urls"))


def stream_first_copies(spark, sf):
    """Old and new items arrive mixed, then a changed copy of each, two days apart from batch to batch."""
    root = shared_folder(spark, "first-copies")
    parts = time_slices(items(spark, sf).select(*ITEM_COLUMNS))
    first = [parts[i] for i in (2, 0, 3, 1)]
    again = [p.withColumn("score", F.col("score") - 1) for p in parts]
    frames = [
        f.withColumn("received", F.lit(86400 * 2 * i)) for i, f in enumerate(first + again)
    ]
    windows.start_first_copies(arriving(spark, frames), root, "received", None).awaitTermination()
    return windows.read_first_copies(spark, root).select(*ITEM_COLUMNS)


# --- statistics ----------------------------------------------------------------------


def time_range(spark, sf):
    return tallies.time_range(items(spark, sf))


def community_stats(spark, sf):
    return tallies.community_stats(items(spark, sf))


def author_stats(spark, sf):
    return tallies.author_stats(items(spark, sf))


def top_authors(spark, sf):
    return tallies.top_authors(items(spark, sf))


def top_communities(spark, sf):
    return tallies.top_communities(items(spark, sf))


def batch_metrics(spark, sf):
    return tallies.batch_metrics(
        items_with_references(spark, sf), "batch_number", F.lit("2024-01-01 00:00:00")
    )


def kpi_cards(spark, sf):
    return tallies.kpi(items(spark, sf))


def batch_history(spark, sf):
    return history.batch_history(items(spark, sf))


def overall_history(spark, sf):
    return history.overall_history(items(spark, sf))


def batch_insights(spark, sf):
    return rounded(history.insights(batch_history(spark, sf)), 6, "mean")


def score_histogram(spark, sf):
    return distribution.histogram(items(spark, sf), "score", 30)


def twelve_batches(spark: SparkSession, sf: str) -> DataFrame:
    number = F.substring("id", 2, 20).cast("bigint")
    return items(spark, sf).withColumn("batch_number", number % 12)


def score_box(spark, sf):
    return distribution.box_stats(twelve_batches(spark, sf), "score", "batch_number", 8)


def exact_growth(df: DataFrame, column: str, by: str) -> DataFrame:
    """Different values of a column up to each group: each counts where it comes first."""
    first = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(by).alias(by))
    so_far = Window.orderBy(by)
    counts = df.groupBy(by).agg(F.lit(0).alias("n")).unionByName(
        first.groupBy(by).agg(F.count("*").cast("int").alias("n"))
    )
    return counts.groupBy(by).agg(F.sum("n").alias("n")).select(by, F.sum("n").over(so_far).alias(column))


def cumulative_figures(spark, sf):
    """Figures after each batch from the sketches of the batches, their distinct counts beside
    the exact ones."""
    df = twelve_batches(spark, sf)
    grown = sketches.figures(sketches.running(sketches.sketch(df, ["batch_number"])))
    for name in ("author", "subreddit"):
        grown = grown.join(exact_growth(df, name, "batch_number"), "batch_number")

    def close(estimate, exact):
        return F.abs(F.col(estimate) - F.col(exact)) <= 1 + 4 * 0.0082 * F.col(exact)

    return grown.select(
        "batch_number", "id_count", "posts", "score_mean", "score_min", "score_max", "author", "subreddit",
        (close("unique_authors", "author") & close("unique_subreddits", "subreddit")).alias("close"),
    )


def score_outliers(spark, sf):
    return distribution.box_outliers(twelve_batches(spark, sf), "score", "batch_number", 8)


def user_scores(spark, sf):
    return authors.user_scores(items(spark, sf))


def top_users(spark, sf):
    return authors.top_users(user_scores(spark, sf))


def avg_score_histogram(spark, sf):
    return rounded(
        distribution.histogram(user_scores(spark, sf), "avg_score", 25), 6, "bin_start", "bin_end"
    )


def activity_levels(spark, sf):
    return authors.activity_levels(user_scores(spark, sf))


def user_summary(spark, sf):
    return rounded(
        authors.user_summary(user_scores(spark, sf)), 6, "mean_posts", "mean_avg_score"
    )


def sample_authors(spark, sf):
    return authors.sample_authors(user_scores(spark, sf))


def top_contributors(spark, sf):
    return authors.top_contributors(enriched_items(spark, sf))


# --- texts ---------------------------------------------------------------------------


def clean_text(spark, sf):
    return texts.with_clean_text(documents(spark, sf)).select("doc_id", "clean")


def clean_pages(spark, sf):
    return texts.with_clean_text(pages(spark, sf)).select("page_id", "clean")


def sentiment(spark, sf):
    return enriched_items(spark, sf).select("id", "sentiment", "sentiment_category")


def sentiment_documents(spark, sf):
    return enriched_documents(spark, sf).select("doc_id", "sentiment", "sentiment_category")


def sentiment_distribution(spark, sf):
    return rounded(
        reports.labelled(
            distribution.category_shares(enriched_items(spark, sf), "sentiment_category"),
            "sentiment_category",
        ),
        6,
        "percent",
    )


def sentiment_histogram(spark, sf):
    return rounded(
        distribution.histogram(enriched_items(spark, sf), "sentiment", 30),
        6,
        "bin_start",
        "bin_end",
    )


def topics(spark, sf):
    return rounded(
        distribution.category_shares(enriched_items(spark, sf), "topic"), 6, "percent"
    )


def question_ratio(spark, sf):
    return rounded(
        texts.question_counts(enriched_documents(spark, sf)),
        6,
        "question_percent",
        "statement_percent",
    )


def enriched_text(spark, sf):
    return enriched_items(spark, sf)


def enriched_posts(spark, sf):
    posts = raw_posts(spark, sf)
    rich = ingest.posts_to_items(posts, F.lit(RECEIVED))
    return texts.enrich(rich, keep=["id"]).drop("original_text")


def text_complexity(spark, sf):
    return reports.text_complexity(enriched_documents(spark, sf))


def engagement_points(spark, sf):
    return reports.engagement_points(enriched_items(spark, sf))


def cleaned_documents(spark: SparkSession, sf: str) -> DataFrame:
    return texts.with_clean_text(documents(spark, sf)).select(F.col("clean").alias("text"))


def meaningful_words(spark, sf):
    cleaned = texts.with_clean_text(documents(spark, sf)).withColumn(
        "words", text_functions.meaningful_words("clean")
    )
    paired = cleaned.withColumn("pairs", text_functions.bigrams("words"))
    return joined(paired, "words").withColumn("pairs", F.array_join("pairs", "|")).select(
        "doc_id", "words", "pairs"
    )


def top_terms(spark, sf):
    return texts.top_terms(cleaned_documents(spark, sf))


def top_phrases(spark, sf):
    return texts.top_phrases(cleaned_documents(spark, sf))


def top_terms_items(spark, sf):
    return texts.top_terms(enriched_items(spark, sf), 5, frequent_only=False)


def top_phrases_items(spark, sf):
    return texts.top_phrases(enriched_items(spark, sf), 3, frequent_only=False)


def unique_terms(spark, sf):
    return texts.unique_terms(cleaned_documents(spark, sf))


def both_kinds(terms: DataFrame, phrases: DataFrame) -> DataFrame:
    return terms.select(F.lit("term").alias("kind"), "*").unionByName(
        phrases.select(F.lit("phrase").alias("kind"), "*")
    )


def cumulative_terms(spark, sf):
    """Top terms and phrases over twelve batches of documents, by the stored summaries of the batches."""
    cleaned = texts.with_clean_text(documents(spark, sf)).select(
        (F.col("doc_id") % 12).alias("batch_number"), F.col("clean").alias("text")
    )
    path = shared_folder(spark, "vocabulary")
    frequent.summary(cleaned, ["batch_number"]).write.parquet(path)
    merged = frequent.merge(spark.read.parquet(path))
    return both_kinds(frequent.top_terms(merged, cleaned), frequent.top_phrases(merged, cleaned))


def job_history_terms(spark, sf):
    """Top terms and phrases over four micro-batches, from their running summary."""
    root = shared_folder(spark, "vocabulary-job")
    stream = line_stream(spark, items(spark, sf), LEAN_ITEM).select(*LEAN_ITEM.names)
    job.start_vocabulary(stream, root, interval=None, name=root[-32:]).awaitTermination()
    return both_kinds(
        job.history_top_terms(spark, root, 5, frequent_only=False),
        job.history_top_phrases(spark, root, 3, frequent_only=False),
    )


def engagement_correlation(spark, sf):
    return rounded(
        texts.engagement_correlation(enriched_items(spark, sf)), 6, "sentiment_corr", "length_corr"
    )


def text_summary(spark, sf):
    return rounded(
        texts.text_summary(enriched_documents(spark, sf)),
        6,
        "mean_length", "std_length", "mean_words", "std_words", "mean_sentiment",
        "std_sentiment", "min_sentiment", "max_sentiment",
    )


def tfidf_top_words(spark, sf):
    return rounded(tfidf.tfidf_top_words(documents(spark, sf)), 6, "score")


def tfidf_words(spark, sf):
    stats = tfidf.term_stats(documents(spark, sf))
    return rounded(tfidf.word_scores(stats), 6, "score")


def plain_tokens(spark, sf):
    words = documents(spark, sf).withColumn(
        "words", text_functions.plain_tokens("text", lexicons.ENGLISH_STOP_WORDS)
    )
    return joined(words, "words").drop("text")


def tfidf_vectors(spark, sf):
    posts = ingest.posts_to_items(raw_posts(spark, sf), F.lit(RECEIVED))
    vectors = tfidf.tfidf_vectors(posts)
    rows = vectors.select("id", F.size("filtered_words").alias("words"), F.inline("features"))
    return rounded(rows, 6, "weight")


def polarity(spark, sf):
    scored = texts.polarity(
        items(spark, sf), polarity_words(spark), key=["type", "id"], text_col="text"
    )
    return rounded(scored, 6, "polarity")


def mean_polarity(spark, sf):
    return rounded(
        texts.mean_sentiment(texts.with_polarity(documents(spark, sf))), 6, "avg_sentiment"
    )


# --- stored batches ------------------------------------------------------------------


def _stored(spark: SparkSession, sf: str) -> str:
    """The items of one event table, stored as two batches of the stream job's layout."""
    root = shared_folder(spark, "stored")
    rich = rich_items(spark, sf)
    for number in (0, 1):
        sinks.write_raw_batch(
            rich.filter(F.col("batch_number") % 2 == number).drop("batch_number"), root, number
        )
    return root


def batch_files(spark, sf):
    stored = batches.read_batches(spark, _stored(spark, sf))
    return batches.batch_files(stored)


def stored_batches_roundtrip(spark, sf):
    stored = batches.read_batches(spark, _stored(spark, sf))
    return stored.select(*ITEM_COLUMNS, "batch_number")


def merged_batches(spark, sf):
    """Two batches of different columns: the second has a flair, wider scores and weights with fractions."""
    root = shared_folder(spark, "merged")
    rich = rich_items(spark, sf)
    parts = [rich.filter(F.col("batch_number") % 2 == n).drop("batch_number") for n in (0, 1)]
    sinks.write_raw_batch(parts[0].withColumn("weight", F.col("score") % 7), root, 0)
    second = {
        "flair": F.concat(F.lit("f"), "author"),
        "weight": F.col("score") / 4,
        "score": F.col("score").cast("bigint"),
    }
    sinks.write_raw_batch(parts[1].withColumns(second), root, 1)
    stored = batches.read_batches(spark, root)
    return stored.select(*ITEM_COLUMNS, "weight", "flair", "batch_number")


def current_batch(spark, sf):
    stored = batches.read_batches(spark, _stored(spark, sf))
    return batches.latest_batch(stored).select(*ITEM_COLUMNS, "batch_number")


def line_stream(spark: SparkSession, df: DataFrame, schema: StructType) -> DataFrame:
    """The items as JSON lines, one file and micro-batch for each of four batch numbers."""
    folder = shared_folder(spark, "lines")
    for number in range(4):
        part = df.filter(F.col("batch_number") % 4 == number).select(*schema.names)
        item_lines(part).coalesce(1).write.mode("append").text(folder)
    return read_items_stream(spark, "text", schema, folder, maxFilesPerTrigger="1")


def job_root(spark: SparkSession, sf: str) -> str:
    """Outputs of the stream job over all events in four micro-batches of JSON lines."""
    root = shared_folder(spark, "job")
    stream = line_stream(spark, rich_items(spark, sf), RICH_ITEM)
    job.start_job(stream, root, interval=None, name=root[-32:]).awaitTermination()
    return root


def details(spark: SparkSession, root: str, suffix: str, schema: str) -> DataFrame:
    """One kind of output with the number of its batch."""
    rows = spark.read.schema(schema).json(f"{job.JobFolders(root).metrics}/batch_*{suffix}")
    number = batches.batch_number(F.col("_metadata.file_path"))
    return rows.select(number.alias("batch_number"), "*")


def job_metrics(spark, sf):
    stored = batches.read_metrics(spark, job.JobFolders(job_root(spark, sf)).metrics)
    return stored.drop("processing_time")


def job_user_refs(spark, sf):
    return details(spark, job_root(spark, sf), "_user_refs", "user_ref string, mention_count bigint")


def job_subreddit_refs(spark, sf):
    schema = "subreddit_ref string, mention_count bigint"
    return details(spark, job_root(spark, sf), "_subreddit_refs", schema)


def job_url_refs(spark, sf):
    return details(spark, job_root(spark, sf), "_url_refs", "url_ref string, mention_count bigint")


def job_community_stats(spark, sf):
    schema = (
        "subreddit string, type string, item_count bigint, avg_score double, "
        "total_comments bigint, max_score int, min_score int"
    )
    return details(spark, job_root(spark, sf), "_subreddit_stats", schema)


def job_author_stats(spark, sf):
    schema = "author string, posts_count bigint, avg_score double, total_comments bigint"
    return details(spark, job_root(spark, sf), "_author_stats", schema)


def job_top_words(spark, sf):
    words = details(spark, job_root(spark, sf), "_tfidf_top_words", "word string, score double")
    return rounded(words, 6, "score")


def job_history_time_range(spark, sf):
    return job.history_time_range(spark, job_root(spark, sf))


def job_history_top_words(spark, sf):
    return rounded(job.history_top_words(spark, job_root(spark, sf)), 6, "score")


def lean_job_root(spark: SparkSession, sf: str) -> str:
    root = shared_folder(spark, "lean-job")
    stream = line_stream(spark, items(spark, sf), LEAN_ITEM).select(*LEAN_ITEM.names)
    job.start_lean_job(stream, root, interval=None, name=root[-32:]).awaitTermination()
    return root


def lean_job_references(spark, sf):
    schema = "user_refs bigint, sub_refs bigint, url_refs bigint"
    return details(spark, lean_job_root(spark, sf), "_batch_references", schema)


def lean_job_time_range(spark, sf):
    schema = "earliest_post double, latest_post double, total_items bigint, time_range_seconds bigint"
    return details(spark, lean_job_root(spark, sf), "_batch_time_range", schema)


def lean_job_authors(spark, sf):
    return details(spark, lean_job_root(spark, sf), "_batch_authors", "author string, count bigint")


def lean_job_top_words(spark, sf):
    words = details(spark, lean_job_root(spark, sf), "_batch_tfidf", "word string, score double")
    return rounded(words, 6, "score")


def lean_history_time_range(spark, sf):
    return job.lean_history(spark, lean_job_root(spark, sf))["history_time_range"]


def lean_history_top_words(spark, sf):
    return rounded(job.lean_history(spark, lean_job_root(spark, sf))["history_tfidf"], 6, "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = [
        items_canonical, json_roundtrip, parse_json_lines, parsed_times, posts_to_items, comments_to_items, lean_items,
        merge_dedupe, newest_per_community, first_comments,
        user_mentions, community_mentions, url_mentions, reference_dialects, reference_totals,
        windowed_references, windowed_reference_lists, windowed_references_stream, stream_dedupe,
        window_table_stream, windowed_reference_lists_stream, stream_first_copies,
        time_range, community_stats, author_stats, top_authors, top_communities, batch_metrics,
        kpi_cards, batch_history, overall_history, batch_insights, score_histogram, score_box,
        cumulative_figures, score_outliers, user_scores, top_users, avg_score_histogram, activity_levels,
        user_summary, sample_authors, top_contributors,
        clean_text, clean_pages, sentiment, sentiment_documents, sentiment_distribution,
        sentiment_histogram, topics, question_ratio, enriched_text, enriched_posts,
        text_complexity, engagement_points, meaningful_words, top_terms, top_phrases, top_terms_items,
        top_phrases_items, unique_terms, cumulative_terms, engagement_correlation, text_summary,
        tfidf_top_words, tfidf_words, plain_tokens, tfidf_vectors, polarity, mean_polarity,
        batch_files, stored_batches_roundtrip, merged_batches, current_batch,
        job_metrics, job_user_refs, job_subreddit_refs, job_url_refs, job_community_stats,
        job_author_stats, job_top_words, job_history_time_range, job_history_top_words,
        job_history_terms,
        lean_job_references, lean_job_time_range, lean_job_authors, lean_job_top_words,
        lean_history_time_range, lean_history_top_words,
    ]
    return {f.__name__: f for f in chosen}
