from pyspark.sql import functions as F

from postpulse.operators import ingest
from postpulse.schemas import LEAN_ITEM, RICH_ITEM, canonicalise

RECEIVED = "2024-05-01T00:00:00"


def posts(spark):
    return spark.createDataFrame(
        [
            ("p1", "s", " Title", "body /u/ann", None, 5, None, 2, 1700000000.0, True),
            ("p2", "s", "Only title", None, "bob", 7, 0.5, 0, 1700000000.25, False),
        ],
        "id string, subreddit string, title string, selftext string, author string, score int, "
        "upvote_ratio double, num_comments int, created_utc double, is_self boolean",
    )


def comments(spark):
    return spark.createDataFrame(
        [
            ("c1", "p1", "s", "hi r/x", "ann", 1, 1700000001.0),
            ("c2", "p1", "s", "[removed]", "bob", 1, 1700000002.0),
            ("c3", "p1", "s", "[deleted]", "bob", 1, 1700000003.0),
            ("c4", "p1", "s", "", "bob", 1, 1700000004.0),
            ("c5", "p1", "s", None, "bob", 1, 1700000005.0),
            ("c6", "p2", "s", "last", None, 1, 1700000006.0),
        ],
        "id string, post_id string, subreddit string, body string, author string, score int, "
        "created_utc double",
    )


def test_posts(spark):
    df = ingest.posts_to_items(posts(spark), F.lit(RECEIVED))
    assert [f.name for f in df.schema] == RICH_ITEM.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in RICH_ITEM]
    first, second = df.orderBy("id").collect()
    assert first.full_text == "Title body /u/ann"
    assert (first.author, first.upvote_ratio, first.text) == ("[deleted]", 0.0, "body /u/ann")
    assert first.user_references == ["ann"]
    assert first.created_datetime == "2023-11-14T22:13:20"
    assert second.created_datetime == "2023-11-14T22:13:20.250000"
    assert (second.full_text, second.text, second.upvote_ratio) == ("Only title", "", 0.5)
    assert first.post_id is None and first.is_submitter is None and first.locked is None


def test_comments_drop_removed(spark):
    rows = ingest.comments_to_items(comments(spark), F.lit(RECEIVED)).orderBy("id").collect()
    assert [r.id for r in rows] == ["c1", "c6"]
    assert rows[0].subreddit_references == ["x"]
    assert (rows[0].full_text, rows[0].post_id, rows[0].num_comments) == ("hi r/x", "p1", None)
    assert rows[1].author == "[deleted]"


def test_received_time_is_set(spark):
    row = ingest.posts_to_items(posts(spark)).first()
    assert row.timestamp_received.startswith("20")


def test_lean_items(spark):
    lean = ingest.merge_items(
        ingest.submissions_to_lean(posts(spark)), ingest.comments_to_lean(comments(spark))
    )
    assert lean.columns == LEAN_ITEM.names
    rows = {r.id: r for r in lean.collect()}
    assert rows["p1"].text == " Title body /u/ann"
    assert rows["p2"].text == "Only title"
    assert rows["p2"].type == "submission" and rows["c6"].author == "[deleted]"


def test_canonicalise(spark):
    lean = ingest.submissions_to_lean(posts(spark)).withColumn("batch_number", F.lit(3))
    df = canonicalise(lean)
    assert df.columns == [*RICH_ITEM.names, "batch_number"]
    row = df.filter("id = 'p2'").first()
    assert (row.type, row.full_text, row.title) == ("post", "Only title", None)


def test_dedupe_keeps_the_first_received(spark):
    df = spark.createDataFrame(
        [
            ("post", "1", 2.0, "T01:00", "late copy, smaller content"),
            ("post", "1", 2.0, "T00:00", "received first"),
            ("comment", "1", 9.0, "T02:00", "other kind"),
        ],
        "type string, id string, created_utc double, timestamp_received string, text string",
    )
    rows = {(r.type, r.id): r.text for r in ingest.dedupe(df).collect()}
    assert rows == {("post", "1"): "received first", ("comment", "1"): "other kind"}
    assert ingest.dedupe(df).columns == df.columns
    by_time = ingest.dedupe(df, ["created_utc", "text"]).filter("type = 'post'").first()
    assert by_time.text == "late copy, smaller content"


def test_dedupe_of_one_id_with_very_many_copies(spark):
    df = spark.range(30_000).select(
        F.lit("post").alias("type"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("double").alias("created_utc"),
    )
    out = ingest.dedupe(df, ["created_utc"])
    assert out.count() == 20_001
    assert out.filter("id = 'hot'").first().created_utc == 0.0


def test_white_space_at_the_ends_goes(spark):
    rows = [("t", "body\n\t"), ("\u00a0t ", None), ("", " \x1c "), ("a", "b\u3000")]
    posts = spark.createDataFrame([(str(i), *r, 1.0) for i, r in enumerate(rows)],
                                  "id string, title string, selftext string, created_utc double")
    texts = [r.full_text for r in ingest.posts_to_items(posts).orderBy("id").collect()]
    assert texts == [(t + " " + (b or "")).strip() for t, b in rows]


def test_times_do_not_depend_on_the_session_zone(spark):
    from checks import queries

    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        shifted = queries.items(spark, sf).agg(F.sum("created_utc")).first()[0]
        post = spark.createDataFrame([("1", 1700000000.25), ("2", -1.0)], "id string, created_utc double")
        texts = [r[0] for r in ingest.posts_to_items(post.withColumn("title", F.lit("t")))
                 .orderBy("id").select("created_datetime").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert shifted == queries.items(spark, sf).agg(F.sum("created_utc")).first()[0]
    assert texts == ["2023-11-14T22:13:20.250000", "1969-12-31T23:59:59"]


def test_selection(spark):
    df = spark.createDataFrame(
        [("a", "s", 1.0), ("b", "s", 3.0), ("c", "s", 3.0), ("d", "t", 0.0)],
        "id string, subreddit string, created_utc double",
    )
    newest = ingest.newest_per_community(df, 2)
    assert sorted(r.id for r in newest.collect()) == ["b", "c", "d"]
    assert [r.id for r in ingest.only_communities(df, ["t"]).collect()] == ["d"]
    first = ingest.first_comments(comments(spark), 2)
    assert sorted(r.id for r in first.collect()) == ["c1", "c2", "c6"]
