"""Stored batches whose columns and types changed over time."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postpulse.schemas import RICH_ITEM
from postpulse.sources import batches, merging, sinks
from tests.test_sources import rich


@pytest.fixture
def root(spark, tmp_path):
    """Five batches: as declared, with new columns, with wider types, with other types, elsewhere."""
    root = str(tmp_path / "raw")
    one = rich(spark, [("1", "a", "x", 1), ("2", "b", "y", 2)])
    sinks.write_raw_batch(one, root, 0)
    flair = one.withColumns({"flair": F.lit("new"), "awards": F.lit(3), "More": F.array(F.lit(1))})
    sinks.write_raw_batch(flair, root, 1)
    wide = one.withColumns({"score": F.lit(5_000_000_000), "awards": F.lit(2.5), "batch_number": F.lit(99)})
    sinks.write_raw_batch(wide, root, 2)
    other = one.withColumns({"awards": F.lit("many"), "more": F.array(F.lit(7_000_000_000))})
    sinks.write_raw_batch(other, root, 13)
    one.withColumn("flair", F.lit("old")).write.parquet(f"{root}/elsewhere")
    return root


def test_all_columns_are_kept(spark, root):
    stored = batches.read_batches(spark, root)
    tags = ["batch_number", "file_path", "file_timestamp"]
    assert stored.columns[: len(RICH_ITEM)] == RICH_ITEM.names and stored.columns[-3:] == tags
    assert sorted(c.lower() for c in stored.columns[len(RICH_ITEM) : -3]) == ["awards", "flair", "more"]
    types = dict(stored.dtypes)
    assert types["score"] == "bigint" and types["awards"] == "string" and types["flair"] == "string"
    rows = {(r.batch_number, r.file_path.count("elsewhere"), r.id): r for r in stored.collect()}
    assert len(rows) == 10
    assert {k[0] for k in rows} == {0, 1, 2, 13}
    first, second, third, last = (rows[n, 0, "1"] for n in (0, 1, 2, 13))
    more = next(c for c in stored.columns if c.lower() == "more")
    assert (first.flair, first.awards, first[more], first.score) == (None, None, None, 1)
    assert (second.flair, second.awards, second[more]) == ("new", "3", [1])
    assert (third.score, third.awards, third.batch_number) == (5_000_000_000, "2.5", 2)
    assert (last.awards, last[more], last.subreddit) == ("many", [7_000_000_000], "a")
    assert rows[0, 1, "2"].flair == "old" and rows[0, 1, "2"].subreddit == "b"


def test_one_scan_for_each_schema(spark, root):
    found = merging.schemas_of(spark, batches.Files(spark, root).matching(f"{root}/*"))
    assert sorted(len(p) for p, _ in found) in ([1, 1, 3], [1, 1, 1, 2])
    sinks.write_raw_batch(rich(spark, [("5", "a", "x", 1)]), f"{root}-same", 0)
    sinks.write_raw_batch(rich(spark, [("6", "a", "x", 1)]).withColumn("flair", F.lit("f")), f"{root}-same", 1)
    same = batches.Files(spark, root).matching(f"{root}-same/*")
    assert len(merging.schemas_of(spark, same)) == 1


def test_types_that_differ_within_one_folder(spark, tmp_path):
    root = str(tmp_path / "raw")
    for n, value in enumerate((F.lit(1), F.lit("x"))):
        frame = rich(spark, [(str(n), "a", "x", 1)]).withColumn("extra", value)
        frame.write.mode("append").partitionBy("subreddit").parquet(f"{root}/batch_4")
    rows = batches.read_batches(spark, root, batch=4).collect()
    assert sorted((r.id, r.extra, r.subreddit) for r in rows) == [("0", "1", "a"), ("1", "x", "a")]


def test_without_merging_only_the_declared_columns(spark, root):
    stored = batches.read_batches(spark, root, merge=False, batch="1")
    assert stored.columns == [*RICH_ITEM.names, "batch_number", "file_path", "file_timestamp"]


def test_compaction_and_choice_keep_the_columns(spark, root, tmp_path):
    target = str(tmp_path / "compact")
    batches.compact_batch(spark, root, target, 1)
    assert {"flair", "awards", "More"} <= set(batches.read_batches(spark, target).columns)
    assert "awards" in batches.current_batch(spark, root).columns
    only = batches.read_batches(spark, root, community="a")
    assert {r.subreddit for r in only.collect()} == {"a"} and "flair" in only.columns


def files_opened(df):
    """Files that the scans of an executed frame have listed."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_communities_are_pruned_by_a_filter(spark, tmp_path):
    root = str(tmp_path / "raw")
    for number in range(3):
        sinks.write_raw_batch(rich(spark, [("1", "a", "x", 1), ("2", "b/c d", "y", 2), ("3", "e", "z", 3)]), root, number)
    stored = batches.read_batches(spark, root)
    chosen = stored.filter(batches.in_communities("a", "b/c d"))
    assert sorted(r.subreddit for r in chosen.collect()) == ["a"] * 3 + ["b/c d"] * 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files_opened(stored.select("id")) == 9
        assert files_opened(stored.filter(batches.in_communities("a", "b/c d")).select("id")) == 6
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_empty_root(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert batches.read_batches(spark, str(tmp_path / "raw")).count() == 0


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "float", "double"),
        ("float", "double", "double"), ("int", "string", "string"), ("date", "timestamp", "timestamp"),
        ("decimal(5,2)", "decimal(7,4)", "decimal(7,4)"), ("decimal(38,0)", "decimal(38,9)", "string"),
        ("boolean", "int", "string"), ("array<int>", "array<double>", "array<double>"),
        ("struct<x:int>", "struct<X:bigint,y:string>", "struct<x:bigint,y:string>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("void", "int", "int"),
        ("array<int>", "string", "string"),
    ],
)
def test_wider_types(a, b, both):
    of = lambda t: StructType.fromDDL(f"c {t}")["c"].dataType
    assert merging.wider(of(a), of(b)).simpleString().lower() == both
    assert merging.wider(of(b), of(a)).simpleString().lower() == both


def test_values_in_wider_types(spark, tmp_path):
    root = str(tmp_path / "raw")
    base = rich(spark, [("1", "a", "x", 1)])
    base.withColumn("s", F.struct(F.lit(1).alias("p"))).write.parquet(f"{root}/batch_0")
    base.withColumn("s", F.struct(F.lit("q").alias("p"), F.lit(2).alias("r"))).write.parquet(f"{root}/batch_1")
    base.withColumn("s", F.lit("plain")).write.parquet(f"{root}/batch_2")
    rows = {r.batch_number: r.s for r in batches.read_batches(spark, root).collect()}
    assert rows == {0: '{"p":1}', 1: '{"p":"q","r":2}', 2: "plain"}
