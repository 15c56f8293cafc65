import os

import pytest
from pyspark.sql import functions as F

from postpulse.operators import mentions, tallies, tfidf
from postpulse.schemas import LEAN_ITEM, METRICS, canonicalise
from postpulse.sources import sinks
from postpulse.sources.batches import read_metrics
from postpulse.sources.items import read_items_stream
from postpulse.streaming import job, windows

ROWS = [
    ("post", "a", "1", "spark is great /u/ann https://x.y", 1700000000.0, "bob"),
    ("comment", "a", "2", "thanks /u/ann see /r/b please", 1700000004.0, "ann"),
    ("comment", "b", "3", "nothing at all to see here", 1700000030.0, "[deleted]"),
    ("submission", "b", "4", "short", 1700000065.0, None),
]


def write_lines(spark, rows, path):
    df = spark.createDataFrame(rows, LEAN_ITEM)
    sinks.write_item_lines(df.coalesce(1), path)


def put_file(spark, rows, folder, name, tmp_path):
    """One JSON-lines file under a chosen name, so that files arrive in order."""
    staging = str(tmp_path / f"staging-{name}")
    write_lines(spark, rows, staging)
    [part] = [f for f in os.listdir(staging) if f.endswith(".txt")]
    os.makedirs(folder, exist_ok=True)
    with open(f"{staging}/{part}") as source, open(f"{folder}/{name}", "w") as target:
        target.write(source.read())


def stream(spark, folder, **options):
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder, **options)
    return mentions.extract_references(lean, dialect="name")


def run_job(spark, folder, root, **options):
    job.start_job(stream(spark, folder, **options), root, interval=None).awaitTermination()


def test_job_outputs(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    write_lines(spark, ROWS, folder)
    run_job(spark, folder, root)
    batch = canonicalise(mentions.extract_references(spark.createDataFrame(ROWS, LEAN_ITEM)))
    expected = tallies.batch_metrics(batch, 0).select(METRICS.names).first().asDict()
    got = read_metrics(spark, f"{root}/metrics").first().asDict()
    for row in (expected, got):
        row.pop("processing_time")
    assert got == expected
    assert (got["posts_count"], got["total_records"], got["total_user_references"]) == (2, 4, 1)
    found = sorted(os.listdir(f"{root}/metrics"))
    assert found == [
        "batch_0", "batch_0_author_stats", "batch_0_subreddit_refs", "batch_0_subreddit_stats",
        "batch_0_tfidf_top_words", "batch_0_url_refs", "batch_0_user_refs",
    ]
    refs = spark.read.json(f"{root}/metrics/batch_0_user_refs").collect()
    assert [(r.user_ref, r.mention_count) for r in refs] == [("ann", 2)]
    assert spark.table("global_temp.metrics").first().total_records == 4
    assert spark.table("global_temp.raw").count() == 4
    words = spark.read.json(f"{root}/metrics/batch_0_tfidf_top_words")
    texts = tfidf.long_enough(batch, "full_text")
    expected_words = tfidf.tfidf_top_words(texts, "full_text")
    assert sorted(map(tuple, words.select("word", "score").collect())) == sorted(
        map(tuple, expected_words.collect())
    )


def test_restart_continues_and_history_adds_up(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    put_file(spark, ROWS[:2], folder, "1.txt", tmp_path)
    run_job(spark, folder, root)
    put_file(spark, ROWS[2:], folder, "2.txt", tmp_path)
    run_job(spark, folder, root)
    run_job(spark, folder, root)
    stored = job.history_items(spark, root)
    assert sorted((r.id, r.batch_number) for r in stored.collect()) == [
        ("1", 0), ("2", 0), ("3", 1), ("4", 1),
    ]
    bounds = job.history_time_range(spark, root).first()
    assert bounds.total_items == 4
    assert bounds.earliest_post == "2023-11-14 22:13:20"
    assert bounds.latest_post == "2023-11-14 22:14:25"
    whole = canonicalise(spark.createDataFrame(ROWS, LEAN_ITEM))
    expected = tfidf.tfidf_top_words(tfidf.long_enough(whole, "full_text"), "full_text")
    got = job.history_top_words(spark, root)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in expected.collect()]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    folders = job.JobFolders(str(tmp_path / "out"))
    batch = mentions.extract_references(spark.createDataFrame(ROWS, LEAN_ITEM))
    job.process_batch(batch, 3, folders)
    job.process_batch(batch, 3, folders)
    assert job.history_items(spark, folders.root).count() == 4
    assert read_metrics(spark, folders.metrics).count() == 1


def test_lean_job(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    write_lines(spark, ROWS, folder)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder).select(*LEAN_ITEM.names)
    job.start_lean_job(lean, root, interval=None).awaitTermination()

    def view(name):
        return spark.table(f"global_temp.{name}")

    assert view("current_batch").count() == 4
    assert tuple(view("batch_references").first()) == (2, 1, 1)
    users = F.sum(F.size("users") * F.col("copies"))
    assert view("batch_windows").agg(users).first()[0] == 24
    assert tuple(view("history_time_range").first()) == (1700000000.0, 1700000065.0, 4, 65)
    assert view("history_tfidf").collect() == view("batch_tfidf").select("word", "score").collect()
    assert 0 < view("batch_tfidf").count() <= 10
    by_id = {r.id: r.sentiment for r in view("batch_sentiment").collect()}
    assert by_id == {"1": 0.5, "2": 0.0, "3": 0.0, "4": 0.0}
    assert view("batch_authors").count() == 4
    assert view("batch_time_range").first().time_range_seconds == 65


def test_empty_batch_is_skipped(spark, tmp_path):
    folders = job.JobFolders(str(tmp_path / "out"))
    job.process_batch(spark.createDataFrame([], LEAN_ITEM), 0, folders)
    assert not os.path.exists(folders.root)


def test_failure_stops_the_query(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_lines(spark, ROWS, folder)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder).withColumn(
        "score", F.raise_error(F.lit("broken"))
    )
    query = job.start_job(lean, str(tmp_path / "out"), interval=None, name="failing")
    with pytest.raises(Exception, match="broken"):
        query.awaitTermination()


def test_window_stream_equals_table(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    put_file(spark, ROWS[:2], folder, "1.txt", tmp_path)
    put_file(spark, ROWS[2:], folder, "2.txt", tmp_path)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder, maxFilesPerTrigger="1")
    windows.start_windowed_references(lean, root, None).awaitTermination()
    got = windows.read_windowed_references(spark, root)
    expected = mentions.windowed_references(spark.createDataFrame(ROWS, LEAN_ITEM))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_window_stream_with_state_on_disk(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    write_lines(spark, ROWS, folder)
    windows.use_rocksdb(spark)
    try:
        lean = read_items_stream(spark, "text", LEAN_ITEM, folder)
        windows.start_windowed_references(lean, root, None).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = windows.read_windowed_references(spark, root)
    assert got.agg(F.sum("user_ref_count")).first()[0] == 24


def test_late_item_is_dropped(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    start = 1700000000.0
    late = [("post", "a", "9", "/u/late /u/late", start, "x")]
    for i, rows in enumerate(
        [
            [("post", "a", "1", "/u/one", start, "x")],
            [("post", "a", "2", "/u/two", start + 600, "x")],
            late,
        ]
    ):
        put_file(spark, rows, folder, f"{i}.txt", tmp_path)
        lean = read_items_stream(spark, "text", LEAN_ITEM, folder)
        windows.start_windowed_references(lean, root, None).awaitTermination()
    got = windows.read_windowed_references(spark, root)
    assert got.agg(F.sum("user_ref_count")).first()[0] == 24


def test_closed_windows_are_written_once(spark, tmp_path):
    folder, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    start = 1700000000.0
    for i, at in enumerate([start, start + 3, start + 600, start + 1200]):
        put_file(spark, [("post", "a", str(i), "/u/x", at, "x")], folder, f"{i}.txt", tmp_path)
        lean = read_items_stream(spark, "text", LEAN_ITEM, folder)
        windows.start_closed_windows(lean, out, chk, None).awaitTermination()
    got = spark.read.parquet(out)
    everything = spark.createDataFrame(
        [(start,), (start + 3,), (start + 600,)], "created_utc double"
    ).withColumn("text", F.lit("/u/x"))
    expected = mentions.windowed_references(everything)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_duplicates_are_dropped_across_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put_file(spark, ROWS[:3], folder, "1.txt", tmp_path)
    put_file(spark, ROWS[1:3], folder, "2.txt", tmp_path)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder, maxFilesPerTrigger="1")
    windows.start_deduped_files(lean, out, str(tmp_path / "chk")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_old_items_that_arrive_first_time_are_kept(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, at in enumerate([10000.0, 10100.0, 9000.0, 10200.0, 9000.0]):
        rows = [("post", "a", str(int(at)), f"text {i}", at, "x")]
        put_file(spark, rows, folder, f"{i}.txt", tmp_path)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder, maxFilesPerTrigger="1")
    windows.start_deduped_files(lean, out, str(tmp_path / "chk")).awaitTermination()
    got = sorted((r.id, r.text) for r in spark.read.parquet(out).collect())
    assert got == [("10000", "text 0"), ("10100", "text 1"), ("10200", "text 3"), ("9000", "text 2")]


def test_window_log_is_compacted(spark, tmp_path):
    folder, root, target = (str(tmp_path / n) for n in ("in", "out", "compact"))
    put_file(spark, ROWS[:2], folder, "1.txt", tmp_path)
    put_file(spark, ROWS[2:], folder, "2.txt", tmp_path)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder, maxFilesPerTrigger="1")
    windows.start_windowed_references(lean, root, None).awaitTermination()
    windows.compact_windows(spark, root, target)
    old, new = (windows.read_windowed_references(spark, r) for r in (root, target))
    assert new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()


def test_broken_file_of_a_batch_stops_the_job(spark, tmp_path, monkeypatch):
    folders = job.JobFolders(str(tmp_path / "out"))
    batch = mentions.extract_references(spark.createDataFrame(ROWS, LEAN_ITEM))
    real = sinks.write_raw_batch

    def broken(df, root, batch_id):
        path = real(df, root, batch_id)
        with open(f"{path}/subreddit=a/broken.parquet", "wb") as f:
            f.write(b"no parquet at all")
        return path

    monkeypatch.setattr(sinks, "write_raw_batch", broken)
    with pytest.raises(Exception, match="(?i)parquet"):
        job.process_batch(batch, 0, folders)


def test_memory_and_console_sinks(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_lines(spark, ROWS, folder)
    lean = read_items_stream(spark, "text", LEAN_ITEM, folder).select("id", "text")
    windows.start_memory_table(lean, "seen_items").awaitTermination()
    assert spark.table("seen_items").count() == 4
    spark.streams.resetTerminated()
    query = windows.start_console(lean)
    job.await_all(spark)
    assert query.exception() is None and not query.isActive


def test_column_formats_and_arrival_time(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(ROWS, LEAN_ITEM).write.parquet(path)
    df = read_items_stream(spark, "parquet", LEAN_ITEM, path)
    assert df.columns == [*LEAN_ITEM.names, "spark_timestamp", "processing_timestamp"]
    assert df.isStreaming
