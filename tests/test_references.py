import re

import pytest
from pyspark.sql import functions as F

from postpulse.functions.references import DIALECTS, KINDS
from postpulse.operators import mentions
from postpulse.schemas import REFERENCE_COLUMNS

SAMPLE = "see /u/bob_s and /r/spark http://a.b/c"


def lists(spark, text, dialect):
    df = spark.createDataFrame([(text,)], "text string")
    row = mentions.extract_references(df, dialect=dialect).first()
    return [row[c] for c in REFERENCE_COLUMNS]


@pytest.mark.parametrize(
    "dialect, expected",
    [
        ("name", [["bob_s"], ["spark"], ["http://a.b/c"]]),
        ("token", [["/u/bob_s"], ["/r/spark"], ["http://a.b/c"]]),
        ("word", [["/u/bob_s"], ["/r/spark"], ["http://a.b/c"]]),
    ],
)
def test_dialects(spark, dialect, expected):
    assert lists(spark, SAMPLE, dialect) == expected


def test_producer_dialect(spark):
    text = "menu/foo or/and site.com/r/python /U/Bob-x u/z"
    users, communities, urls = lists(spark, text, "producer")
    assert users == ["foo", "Bob-x", "z"]
    assert communities == ["and", "python"]
    assert urls == []


def test_producer_urls_run_over_blanks(spark):
    assert lists(spark, "see http://a.b/c and more #x", "producer")[2] == ["http://a.b/c and more "]


@pytest.mark.parametrize("dialect", ["producer", "token", "word", "name"])
@pytest.mark.parametrize("text", [None, "", "nothing here"])
def test_empty(spark, dialect, text):
    assert lists(spark, text, dialect) == [[], [], []]


def test_search_before_match_loses_nothing(spark):
    texts = ["/u/a", "u/a", "U/a /R/b", "x/u/", "HTTP://x", "http://", "https://é", "//u//r/x/u/y"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    rows = mentions.extract_references(df, dialect="producer").orderBy("id").collect()
    for text, row in zip(texts, rows, strict=True):
        assert row.user_references == re.findall(r"/?u/([A-Za-z0-9_-]+)", text, re.I)
        assert row.subreddit_references == re.findall(r"/?r/([A-Za-z0-9_-]+)", text, re.I)


def items(spark, rows):
    return spark.createDataFrame(rows, "id string, created_utc double, text string")


def test_one_item_is_in_twelve_windows(spark):
    at = 1700000000.0  # 22:13:20
    df = items(spark, [("a", at, "/u/x /u/y https://z.z")])
    rows = mentions.windowed_references(df).orderBy("window_start").collect()
    assert len(rows) == 12
    assert rows[0].window_start.strftime("%H:%M:%S") == "22:12:25"
    assert rows[-1].window_start.strftime("%H:%M:%S") == "22:13:20"
    assert {(r.user_ref_count, r.subreddit_ref_count, r.url_ref_count) for r in rows} == {(2, 0, 1)}


def test_panes_equal_direct_windows(spark):
    df = items(
        spark, [(str(i), 1700000000.0 + i * 3.7, "/u/x " * (i % 4) + "/r/y") for i in range(60)]
    )
    sizes = df.select(
        F.col("created_utc").cast("timestamp").alias("ts"),
        F.size(F.expr("regexp_extract_all(text, '/u/x', 0)")).alias("n"),
    )
    direct = sizes.groupBy(F.window("ts", "60 seconds", "5 seconds")).agg(F.sum("n").alias("n"))
    expected = {(r.window.start, r.n) for r in direct.collect()}
    got = mentions.windowed_references(df).collect()
    assert {(r.window_start, r.user_ref_count) for r in got} == expected


def test_window_lists_keep_one_list_per_item(spark):
    rows = [("a", 100.0, "/u/x /u/y"), ("b", 101.0, "nothing"), ("c", 102.0, "/r/z")]
    rows.append(("d", 101.5, "nothing"))
    lists = mentions.windowed_reference_lists(items(spark, rows))
    got = lists.filter("window_start = timestamp_seconds(100)").collect()
    found = sorted((r.users, r.subreddits, r.urls, r.copies) for r in got)
    assert found == [([], [], [], 2), ([], ["z"], [], 1), (["x", "y"], [], [], 1)]


def test_a_busy_window_has_the_form_of_any_other(spark):
    # One window with a third of all rows, most of them copies.
    hot = [(f"h{i}", 1000.0 + i % 5, "/u/copy /r/c") for i in range(300)]
    hot += [(f"v{i}", 1000.0 + i % 5, f"/u/n{i}") for i in range(100)]
    cold = [(f"c{i}", 100000.0 + i * 100, f"/u/c{i}") for i in range(800)]
    lists = mentions.windowed_reference_lists(items(spark, hot + cold))
    window = lists.filter("window_start = timestamp_seconds(1000)").collect()
    assert len(window) == 101
    assert max(r.copies for r in window) == 300 and sum(r.copies for r in window) == 400
    totals = mentions.windowed_references(items(spark, hot + cold), dialect="name")
    summed = lists.groupBy("window_start").agg(F.sum(F.size("users") * F.col("copies")).alias("n"))
    assert totals.join(summed, "window_start").filter("n <> user_ref_count").isEmpty()
    assert "collect_list" not in lists._jdf.queryExecution().toString()


def test_mention_counts(spark):
    df = spark.createDataFrame(
        [("1", ["a", "b", None]), ("2", ["a"]), ("3", None), ("4", [])],
        "id string, user_references array<string>",
    )
    counts = mentions.mention_counts(df, "user_references", "user_ref")
    assert [tuple(r) for r in counts.collect()] == [("a", 2), ("b", 1)]
    top = mentions.mention_counts(df, "user_references", "user_ref", top=1)
    assert [tuple(r) for r in top.collect()] == [("a", 2)]


def test_totals(spark):
    df = items(spark, [("a", 1.0, "/u/x /r/y"), ("b", 2.0, None), ("c", 3.0, "/u/é /u/z")])
    assert tuple(mentions.reference_totals(df).first()) == (2, 1, 0)
    assert tuple(mentions.reference_totals(df.limit(0)).first()) == (0, 0, 0)
    assert KINDS == ("user", "subreddit", "url")


def test_the_short_url_class_equals_the_long_one():
    import random
    import re

    rnd = random.Random(1)
    long = re.compile(r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!* ,])+")
    short = re.compile(DIALECTS["producer"]["url"][0])
    signs = [chr(i) for i in range(9, 127)] + ["é", "世"]
    for _ in range(20_000):
        text = "".join(rnd.choices(signs, k=8)) + "http://" + "".join(rnd.choices(signs, k=20))
        assert long.findall(text) == short.findall(text)
