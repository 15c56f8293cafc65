import json
import os
import time

import pytest
from pyspark.sql import functions as F

from postpulse import scratch
from postpulse.schemas import LEAN_ITEM, RICH_ITEM, canonicalise
from postpulse.sources import batches, items, sinks


def rich(spark, rows):
    df = spark.createDataFrame(rows, "id string, subreddit string, text string, score int")
    return canonicalise(df.withColumn("type", F.lit("post")))


def test_bad_lines_and_fields(spark):
    lines = spark.createDataFrame(
        [('{"id":"a","score":"x"}',), ("{bad",), ('{"id":"b","score":3}',)], "value string"
    )
    rows = items.parse_lines(lines).collect()
    assert [(r.id, r.score) for r in rows] == [("a", None), (None, None), ("b", 3)]
    kept = items.parse_lines(lines, LEAN_ITEM, corrupt_column="_corrupt").collect()
    assert [r._corrupt for r in kept] == [None, "{bad", None]


def test_json_lines_roundtrip(spark, tmp_path):
    df = rich(spark, [("1", "s", "é 世界", 3)])
    path = str(tmp_path / "lines")
    sinks.write_item_lines(df.coalesce(1), path)
    [part] = [f for f in os.listdir(path) if f.endswith(".txt")]
    with open(f"{path}/{part}", encoding="utf-8") as f:
        line = f.read()
    assert line.endswith("\n") and "世界" in line
    assert json.loads(line)["text"] == "é 世界"
    back = items.read_items(spark, path)
    assert back.columns == RICH_ITEM.names
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_times_are_parsed_where_present(spark):
    df = spark.createDataFrame(
        [("2024-05-01T10:00:00.5",), ("2024-05-01T10:00:00",), ("no time",), (None,)],
        "created_datetime string",
    )
    rows = [r.created_datetime for r in items.parse_times(df).collect()]
    assert [r and r.microsecond for r in rows] == [500000, 0, None, None]


def test_stored_batches(spark, tmp_path):
    root = str(tmp_path / "raw")
    sinks.write_raw_batch(rich(spark, [("1", "a", "x", 1), ("2", "b", "y", 2)]), root, 0)
    sinks.write_raw_batch(rich(spark, [("3", "a", "z", 3)]), root, 12)
    sinks.write_raw_batch(rich(spark, [("3", "a", "z", 3)]), root, 12)
    assert sorted(os.listdir(f"{root}/batch_0"))[-2:] == ["subreddit=a", "subreddit=b"]
    stored = batches.read_batches(spark, root)
    assert stored.columns == [*RICH_ITEM.names, "batch_number", "file_path", "file_timestamp"]
    rows = stored.orderBy("id").collect()
    assert [(r.id, r.subreddit, r.batch_number) for r in rows] == [
        ("1", "a", 0), ("2", "b", 0), ("3", "a", 12),
    ]
    assert "batch_12" in rows[2].file_path and rows[2].file_timestamp is not None
    files = batches.batch_files(stored).collect()
    assert [tuple(r) for r in files] == [(0, 2, 2), (12, 1, 1)]
    assert [r.id for r in batches.current_batch(spark, root).collect()] == ["3"]
    assert [r.id for r in batches.latest_batch(stored).collect()] == ["3"]
    # An unreadable file is an error, or passed over on demand and then listed.
    assert batches.files_without_rows(spark, root, stored).isEmpty()
    with open(f"{root}/batch_12/subreddit=a/broken.parquet", "wb") as f:
        f.write(b"no parquet at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        batches.read_batches(spark, root).count()
    some = batches.read_batches(spark, root, skip_broken=True)
    assert some.count() == 3
    [skipped] = batches.files_without_rows(spark, root, some).collect()
    assert skipped.path.endswith("broken.parquet") and not skipped.is_parquet


def test_batches_of_other_layouts(spark, tmp_path):
    root = str(tmp_path / "raw")
    sinks.write_raw_batch(rich(spark, [("1", "a", "x", 1)]), root, 3)
    rich(spark, [("2", "b", "y", 2)]).write.parquet(f"{root}/batch_7")
    rich(spark, [("3", "c", "z", 3)]).write.parquet(f"{root}/elsewhere")
    rows = batches.read_batches(spark, root).orderBy("id").collect()
    assert [(r.id, r.subreddit, r.batch_number) for r in rows] == [
        ("1", "a", 3), ("2", "b", 7), ("3", "c", 0),
    ]
    assert [r.id for r in batches.read_batches(spark, root, batch=7).collect()] == ["2"]
    assert [r.id for r in batches.current_batch(spark, root).collect()] == ["2"]


def test_one_community_lists_its_folders_only(spark, tmp_path):
    root, target = str(tmp_path / "raw"), str(tmp_path / "compact")
    for number in (1, 2):
        for part in range(3):
            rows = rich(spark, [(f"{number}{part}", "a", "x", 1), (f"{number}{part}b", "b", "y", 2)])
            rows.write.mode("append").partitionBy("subreddit").parquet(f"{root}/batch_{number}")
    files = batches.read_batches(spark, root, community="a").inputFiles()
    assert len(files) == 6 and all("/subreddit=a/" in f for f in files)
    batches.compact_batch(spark, root, target, 1)
    old = batches.read_batches(spark, root, batch=1, times=False).drop("file_path", "file_timestamp")
    new = batches.read_batches(spark, target, times=False).drop("file_path", "file_timestamp")
    assert new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()
    assert len(new.inputFiles()) == 2


def test_hot_community_is_split_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(20_000).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 5))
            .otherwise("hot")
            .alias("subreddit"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.lit(1).alias("score"),
            F.lit("post").alias("type"),
        )
        path = sinks.write_raw_batch(canonicalise(rows), str(tmp_path / "raw"), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

    def files(community):
        return [f for f in os.listdir(f"{path}/subreddit={community}") if f.endswith(".parquet")]

    assert len(files("hot")) > 3
    assert spark.read.parquet(path).count() == 20_000


def test_community_names_survive_the_folder_name(spark, tmp_path):
    names = ["plain", "a b", "a+b", "50%", "x/y", "é=1", None]
    df = rich(spark, [(str(i), n, "t", 1) for i, n in enumerate(names)])
    root = str(tmp_path / "raw dir")
    sinks.write_raw_batch(df, root, 4)
    rows = batches.read_batches(spark, root).orderBy("id").collect()
    assert [(r.subreddit, r.batch_number) for r in rows] == [(n, 4) for n in names]
    some = batches.read_batches(spark, root, community="{plain,a+b}")
    assert sorted(r.subreddit for r in some.collect()) == ["a+b", "plain"]


@pytest.mark.parametrize(
    "path, number", [("/x/batch_7/a", 7), ("/x/none", 0), ("/batch_x/batch_21_refs", 21)]
)
def test_batch_number(spark, path, number):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(batches.batch_number(F.col("p"))).first()[0] == number


def test_newest_file_by_extension(spark, tmp_path):
    def put(name, text, age):
        path = tmp_path / "d" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        stamp = time.time() - age
        os.utime(path, (stamp, stamp))

    root = str(tmp_path / "d")
    put("a.csv", "x,y\n1,hello\n", 500)
    put("ignored.log", "zzz", 0)
    found = batches.file_inventory(spark, root).collect()
    assert [(r.extension, r.length) for r in found] == [("csv", 12)]
    assert tuple(batches.read_newest(spark, root).first()) == (1, "hello")
    put("b.json", '{"x": 1}\n{"x": 2}\n', 400)
    assert batches.read_newest(spark, root).count() == 2
    put("c.json", '[\n{"x": 1},\n{"x": 2},\n{"x": 3}\n]\n', 300)
    assert batches.read_newest(spark, root).count() == 3
    put("e.txt", "q\n9\n", 200)
    assert batches.read_newest(spark, root).first().q == 9
    spark.range(4).write.parquet(f"{root}/f")
    assert batches.read_newest(spark, root).count() in (0, 1, 2, 3, 4)


def test_nothing_to_read(spark, tmp_path):
    assert batches.read_newest(spark, str(tmp_path)) is None
    assert batches.current_batch(spark, str(tmp_path)) is None


def test_json_only_if_any(spark, tmp_path):
    df = rich(spark, [("1", "a", "x", 1)])
    assert sinks.write_json_if_any(df.limit(0), str(tmp_path), 1, "_refs") is None
    path = sinks.write_json_if_any(df, str(tmp_path), 1, "_refs")
    assert path.endswith("batch_1_refs") and spark.read.json(path).count() == 1


def test_published_views_and_named_tables(spark):
    df = rich(spark, [("1", "a", "x", 1)])
    sinks.publish(df, "published_items")
    assert spark.newSession().table("global_temp.published_items").count() == 1
    sinks.publish(df, "local_items", everywhere=False)
    assert items.table_if_exists(spark, "local_items").count() == 1
    assert items.table_if_exists(spark, "no_such_table") is None


def test_shared_folder_is_required(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session, "x")


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark, "x").startswith(f"{base}/x-")
