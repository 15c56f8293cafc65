"""Running tables, upserts while a table is read, and ids that are never forgotten."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from postpulse.operators import mentions, tfidf
from postpulse.schemas import LEAN_ITEM
from postpulse.sources.items import read_items_stream
from postpulse.streaming import job, tables, windows
from tests.test_streaming import put_file

START = 1700000000.0


def newest(rows):
    return rows.groupBy("k").agg(F.max("v").alias("v"))


def sums(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def content(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def test_upserts_replace_rows_and_keep_the_others(spark, tmp_path):
    table = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], newest, buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(frame(spark, [("a", 0), ("b", 0), (None, 0)]), 0)
    before = table.read()
    table.upsert(frame(spark, [("b", 1), ("c", 1)]), 1)
    assert content(table) == [("a", 0), ("b", 1), ("c", 1), (None, 0)]
    # A reader of the version before still has its files.
    assert sorted(map(tuple, before.collect()), key=repr) == [("a", 0), ("b", 0), (None, 0)]
    table.upsert(frame(spark, [(None, 2)]), 2)
    table.upsert(frame(spark, []), 3)
    assert content(table) == [("a", 0), ("b", 1), ("c", 1), (None, 2)]


def test_replays_and_new_runs(spark, tmp_path):
    table = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], sums, buckets=2)
    for version, n in enumerate((1, 10, 100)):
        table.upsert(frame(spark, [("a", n)], "k string, n bigint"), version)
    table.upsert(frame(spark, [("a", 100)], "k string, n bigint"), 2)
    assert content(table) == [("a", 111)]
    # A run that starts over does not add to the old one.
    table.upsert(frame(spark, [("a", 5)], "k string, n bigint"), 0)
    assert content(table) == [("a", 5)]


def test_failed_batch_publishes_nothing(spark, tmp_path):
    table = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], sums, buckets=2)
    table.upsert(frame(spark, [("a", 1)], "k string, n bigint"), 0)
    broken = frame(spark, [("a", 1)], "k string, n bigint").withColumn(
        "n", F.raise_error(F.lit("broken")).cast("bigint")
    )
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken, 1)
    assert content(table) == [("a", 1)]
    table.upsert(frame(spark, [("a", 2)], "k string, n bigint"), 1)
    assert content(table) == [("a", 3)]


def parquet_files(folder):
    return glob.glob(f"{folder}/**/*.parquet", recursive=True)


def test_live_files_do_not_grow_with_the_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tables.KeyedTable(spark, path, ["k"], newest, buckets=3)
    counts = []
    for version in range(9):
        rows = [(f"k{i}", version) for i in range(version, 40 + version)]
        table.upsert(frame(spark, rows), version)
        counts.append(len(parquet_files(path)))
    assert max(counts) <= 2 * 3 and len(table.read().inputFiles()) <= 3
    assert len(os.listdir(f"{path}/versions")) <= 4  # two versions and their checksums
    assert content(table) == sorted((f"k{i}", min(i, 8)) for i in range(48))


def rows_of(batch, n=6):
    at = START + 7 * batch
    return [("post", "a", f"{batch}-{i}", f"word{i} only{batch} here /u/ann", at + i, "x") for i in range(n)]


def test_history_reads_no_more_files_with_more_batches(spark, tmp_path):
    folders = job.JobFolders(str(tmp_path / "out"))
    lean = job.JobFolders(str(tmp_path / "lean"))
    read, everything = [], []
    for batch in range(3):
        everything += rows_of(batch)
        frame_ = spark.createDataFrame(rows_of(batch), LEAN_ITEM)
        job.process_batch(mentions.extract_references(frame_), batch, folders)
        job.process_lean_batch(frame_, batch, lean)
        stats = job.running_terms(spark, folders).read()
        read.append(len(stats.inputFiles()))
        words = job.history_top_words(spark, lean.root).inputFiles()
        assert all("/running/" in f for f in words) and len(words) <= 2 * 16
    assert max(read) <= 16
    whole = spark.createDataFrame(everything, LEAN_ITEM)
    expected = tfidf.tfidf_top_words(whole, "text")
    assert job.history_top_words(spark, lean.root).collect() == expected.collect()
    assert job.history_top_words(spark, folders.root).collect() == expected.collect()
    assert job.history_time_range(spark, folders.root).first().total_items == 18
    span = job.lean_history(spark, lean.root)["history_time_range"].first()
    assert tuple(span) == (START, START + 19, 18, 19)
    # The last batch once more.
    job.process_lean_batch(spark.createDataFrame(rows_of(2), LEAN_ITEM), 2, lean)
    assert job.history_top_words(spark, lean.root).collect() == expected.collect()


def lean_stream(spark, folder):
    return read_items_stream(spark, "text", LEAN_ITEM, folder, maxFilesPerTrigger="1")


def test_window_table_equals_log_and_goes_on_after_a_restart(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    everything = []
    for batch in range(4):
        # Each batch changes windows of the one before.
        everything += rows_of(batch)
        put_file(spark, rows_of(batch), folder, f"{batch}.txt", tmp_path)
        if batch % 2:
            windows.start_window_table(lean_stream(spark, folder), root, None, buckets=4).awaitTermination()
    got = windows.window_table(spark, root, 4).read()
    expected = mentions.windowed_references(spark.createDataFrame(everything, LEAN_ITEM))
    assert sorted(map(tuple, got.drop("epoch").collect())) == sorted(map(tuple, expected.collect()))
    assert {r.epoch for r in got.collect()} >= {1, 3} and len(got.inputFiles()) <= 4


def test_window_lists_of_a_stream_with_late_items(spark, tmp_path):
    folder, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    texts = ["/u/ann", "/u/bob /r/x", "nothing", "/u/ann"]
    rows = [("post", "a", str(i), texts[i % 4], START + 11 * i, "x") for i in range(40)]
    # Every third item comes one batch late, up to a minute behind the newest one.
    batches = [[], [], [], [], []]
    for i, row in enumerate(rows):
        batches[i // 10 + (i % 10 > 5 and i % 3 == 0)].append(row)
    batches.append([("post", "a", "end", "", START + 9999, "x")])
    for number, batch in enumerate(batches):
        put_file(spark, batch[::-1], folder, f"{number}.txt", tmp_path)
    lean = lean_stream(spark, folder)
    query = windows.start_closed_window_lists(lean, out, chk, None)
    query.awaitTermination()
    got = spark.read.parquet(out)
    expected = mentions.windowed_reference_lists(spark.createDataFrame(rows, LEAN_ITEM))
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert got.count() > 100
    # Beyond the watermark an item is dropped, and nothing is written twice after a restart.
    put_file(spark, [("post", "a", "late", "/u/late", START, "x")], folder, "8.txt", tmp_path)
    windows.start_closed_window_lists(lean_stream(spark, folder), out, chk, None).awaitTermination()
    assert spark.read.parquet(out).count() == expected.count()


def ids(spark, numbers, received=0):
    rows = [("post", None if n is None else f"id{n}", f"{received}", received) for n in numbers]
    return spark.createDataFrame(rows, "type string, id string, text string, received int")


def take(seen, spark, root, numbers, version):
    target = f"{root}/items/{version}"
    seen.first_copies(ids(spark, numbers, version), version, target, ("received",))
    return sorted((r.id or "", r.text) for r in spark.read.parquet(target).collect())


@pytest.mark.parametrize("sizes", [{}, {"pages": 1, "hashes": 1, "buckets": 1}])
def test_ids_are_never_forgotten(spark, tmp_path, sizes):
    root = str(tmp_path / "seen")
    seen = tables.SeenIds(spark, root, fan=2, **sizes)
    first = take(seen, spark, root, [*range(300), 5, None, None], 0)
    assert first == sorted([("", "0"), *((f"id{i}", "0") for i in range(300))])
    for version in range(1, 6):
        got = take(seen, spark, root, range(100 * version, 100 * version + 300), version)
        assert got == sorted((f"id{i}", str(version)) for i in range(100 * version + 200, 100 * version + 300))
    assert take(seen, spark, root, [0, None, 799, 800], 6) == [("id800", "6")]
    # The same batch again gives the same rows, and so does what follows.
    assert take(seen, spark, root, [0, None, 799, 800], 6) == [("id800", "6")]
    assert take(seen, spark, root, [800, 801], 7) == [("id801", "7")]
    # Folders grow with the logarithm of the batches.
    assert len(seen.versions.latest()["folders"]) <= 4


def test_only_known_buckets_are_opened(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "seen")
    seen = tables.SeenIds(spark, root, buckets=8)
    opened = []
    real = tables.SeenIds._open
    monkeypatch.setattr(
        tables.SeenIds, "_open", lambda s, state, b: opened.append(b) or real(s, state, b)
    )
    take(seen, spark, root, range(500), 0)
    assert len(take(seen, spark, root, range(500, 1000), 1)) == 500
    assert opened == [[], []]
    assert take(seen, spark, root, [3, 2000], 2) == [("id2000", "2")]
    assert len(opened[2]) == 1


def test_first_copies_stream(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    for batch, rows in enumerate([rows_of(0), rows_of(1), [*rows_of(0), *rows_of(2)], rows_of(0)]):
        put_file(spark, rows, folder, f"{batch}.txt", tmp_path)
        windows.start_first_copies(lean_stream(spark, folder), root, interval=None).awaitTermination()
    got = windows.read_first_copies(spark, root)
    assert sorted(r.id for r in got.collect()) == sorted(r[2] for b in range(3) for r in rows_of(b))
