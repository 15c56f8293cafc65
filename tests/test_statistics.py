import statistics

import pytest
from pyspark.sql import functions as F

from postpulse.operators import authors, distribution, history, tallies
from postpulse.plans import reports
from postpulse.schemas import METRICS, canonicalise

ITEMS = (
    "id string, type string, subreddit string, author string, score int, num_comments int, "
    "created_utc double, user_references array<string>, batch_number int"
)


def items(spark):
    return spark.createDataFrame(
        [
            ("1", "post", "a", "ann", 10, 3, 100.0, ["x", "y"], 0),
            ("2", "post", "b", "ann", 20, None, 161.75, ["x"], 0),
            ("3", "comment", "b", "[deleted]", 0, None, 130.0, None, 0),
            ("4", "comment", "b", None, None, None, 131.0, [], 1),
            ("5", "comment", None, "bob", -4, None, 132.0, [None], 1),
        ],
        ITEMS,
    )


def rich(spark):
    return canonicalise(items(spark))


def test_metrics_of_one_batch(spark):
    df = tallies.batch_metrics(rich(spark), 7, F.lit("now"))
    assert df.columns[: len(METRICS)] == METRICS.names
    assert [f.dataType for f in df.schema][: len(METRICS)] == [f.dataType for f in METRICS]
    row = df.first()
    assert (row.batch_id, row.processing_time, row.total_records) == (7, "now", 5)
    assert row.time_range_seconds == 61
    assert row.earliest_post == "1970-01-01 00:01:40"
    assert row.latest_post == "1970-01-01 00:02:41.750000"
    assert (row.posts_count, row.comments_count) == (2, 3)
    assert (row.unique_subreddits, row.unique_authors) == (3, 2)
    assert row.avg_score == 6.5
    assert (row.max_score, row.min_score) == (20, -4)
    assert (row.total_user_references, row.user_ref_mentions) == (2, 3)
    assert (row.total_subreddit_references, row.total_url_references) == (0, 0)
    assert (row.top_subreddit, row.most_active_author) == ("b", "ann")


def test_top_community_is_that_of_the_largest_kind_group(spark):
    rows = [("post", "a"), ("comment", "a"), ("post", "a"), ("comment", "a"), ("post", "b")]
    rows += [("post", "b"), ("post", "b")]
    df = canonicalise(spark.createDataFrame(rows, "type string, subreddit string"))
    assert tallies.batch_metrics(df, 1).first().top_subreddit == "b"


def test_metrics_without_scores_and_without_rows(spark):
    df = canonicalise(spark.createDataFrame([("post",)], "type string"))
    row = tallies.batch_metrics(df, 1).first()
    assert (row.avg_score, row.max_score, row.min_score) == (0.0, 0, 0)
    assert (row.time_range_seconds, row.earliest_post) == (0, None)
    assert (row.most_active_author, row.unique_authors) == ("unknown", 0)
    empty = tallies.batch_metrics(rich(spark).limit(0), 1).first()
    assert (empty.total_records, empty.posts_count, empty.top_subreddit) == (0, 0, "unknown")


def test_metrics_per_batch(spark):
    rows = tallies.batch_metrics(rich(spark), "batch_number").orderBy("batch_id").collect()
    assert [(r.batch_id, r.total_records, r.posts_count) for r in rows] == [(0, 3, 2), (1, 2, 0)]
    assert [r.most_active_author for r in rows] == ["ann", "bob"]


def test_stats_from_tally_equal_direct_ones(spark):
    tallied = tallies.tally(rich(spark))
    direct = tallies.community_stats(items(spark))
    got = tallies.community_stats_from_tally(tallied).select(*direct.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, direct.collect()))
    direct = tallies.author_stats(items(spark))
    got = tallies.author_stats_from_tally(tallied).select(*direct.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, direct.collect()))
    assert [r.author for r in direct.collect()] == ["ann", "bob"]
    counts = tallies.mention_counts_from_tally(tallied, "user_ref").collect()
    assert sorted(map(tuple, counts)) == [("x", 2), ("y", 1)]


def test_time_range_and_cards(spark):
    row = tallies.time_range(items(spark)).first()
    assert (row.earliest_post, row.latest_post, row.total_items) == (100.0, 161.75, 5)
    assert row.time_range_seconds == 61
    cards = tallies.kpi(items(spark)).first()
    assert (cards.total_records, cards.communities, cards.authors) == (5, 2, 3)
    assert cards.post_comment_ratio == "2:3" and (cards.first_batch, cards.last_batch) == (0, 1)
    few = tallies.kpi(items(spark).select("author"), approximate=True).first()
    assert few.asDict() == {"total_records": 5, "authors": 3}


def test_user_scores(spark):
    rows = {r.author: r for r in authors.user_scores(items(spark)).collect()}
    assert set(rows) == {"ann", "bob", "[deleted]"}
    assert tuple(rows["ann"])[1:] == (2, 30, 15.0, 7.07, 2)
    assert rows["bob"].score_stddev is None
    nulls = spark.createDataFrame([("z", None, "1")], "author string, score int, id string")
    row = authors.user_scores(nulls).first()
    assert (row.score_count, row.total_score, row.avg_score, row.post_count) == (0, 0, None, 1)


def test_activity_levels(spark):
    counts = [1, 2, 3, 4, 10, 11, 0]
    df = spark.createDataFrame([(str(c), c) for c in counts], "author string, post_count int")
    got = {r.post_count: r.activity_level for r in authors.with_activity_level(df).collect()}
    assert got == {
        0: None, 1: "Single Post", 2: "Low (2-3)", 3: "Low (2-3)", 4: "Medium (4-10)",
        10: "Medium (4-10)", 11: "High (10+)",
    }
    levels = authors.activity_levels(df).orderBy("level_order").collect()
    assert [r.authors for r in levels] == [1, 2, 2, 1]


def test_author_summary_sample_and_contributors(spark):
    scores = authors.user_scores(items(spark))
    row = authors.user_summary(scores).first()
    assert (row.authors, row.most_active, row.highest_scoring) == (3, "ann", "ann")
    many = spark.range(500).select(F.col("id").cast("string").alias("author"))
    sample = authors.sample_authors(many, 100, seed=3)
    assert sample.count() == 100
    assert sample.exceptAll(authors.sample_authors(many.repartition(3), 100, seed=3)).isEmpty()
    df = spark.createDataFrame(
        [("a", 1), ("b", 5), ("b", None), ("c", None)], "author string, engagement_score int"
    )
    assert [tuple(r) for r in authors.top_contributors(df, 2).collect()] == [("a", 1), ("b", 5)]
    assert [tuple(r) for r in authors.top_contributors(df, 1).collect()] == [("b", 5)]
    assert authors.top_contributors(df.filter("author = 'a'")).isEmpty()


def test_history(spark):
    rows = history.batch_history(items(spark)).orderBy("batch_number").collect()
    first, second = rows
    assert (first.id_count, first.score_mean, first.score_median) == (3, 10.0, 10.0)
    assert first.score_std == 10.0 and (first.score_min, first.score_max) == (0, 20)
    assert (first.posts, first.unique_authors, first.unique_subreddits) == (2, 2, 2)
    assert second.score_std is None and second.unique_subreddits == 1
    overall = history.overall_history(items(spark)).first()
    assert (overall.label, overall.id_count, overall.score_median) == ("Overall", 5, 5.0)
    assert overall.score_std == round(statistics.stdev([10, 20, 0, -4]), 2)


def test_history_uses_the_columns_at_hand(spark):
    some = items(spark).select("batch_number", "author")
    assert history.batch_history(some).columns == ["batch_number", "unique_authors"]
    approx = history.batch_history(some, approximate=True).orderBy("batch_number").collect()
    assert [r.unique_authors for r in approx] == [2, 1]
    exact = history.overall_history(items(spark).filter("score > 0 or score < 0")).first()
    close = history.overall_history(items(spark).filter("score > 0 or score < 0"), True).first()
    assert exact == close
    with pytest.raises(ValueError):
        history.batch_history(items(spark).select("batch_number"))


def test_insights(spark):
    df = spark.createDataFrame(
        [(0, 5, 1.0), (1, 9, 2.0), (2, 5, 3.0)], "batch_number int, id_count int, score_mean double"
    )
    rows = history.insights(df).orderBy("position").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("id_count", "Id Count", pytest.approx(19 / 3), 5.0, 9.0, "decreasing"),
        ("score_mean", "Score Mean", 2.0, 1.0, 3.0, "increasing"),
    ]
    assert history.insights(df.filter("batch_number = 0")).first().trend is None


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 5, 10)] + [(None,)], "v double")
    rows = distribution.histogram(df, "v", 5).orderBy("bin").collect()
    assert [(r.bin, r.bin_start, r.bin_end, r["count"]) for r in rows] == [
        (0, 0.0, 2.0, 3), (2, 4.0, 6.0, 1), (4, 8.0, 10.0, 1),
    ]
    assert [r.percent for r in rows] == [60.0, 20.0, 20.0]
    same = distribution.histogram(df.filter("v = 5"), "v", 5).collect()
    assert [(r.bin, r["count"]) for r in same] == [(0, 1)]


def test_nan_is_in_no_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 10, "nan")], "v double")
    rows = distribution.histogram(df, "v", 5).orderBy("bin").collect()
    assert [(r.bin, r["count"]) for r in rows] == [(0, 2), (4, 1)]


def test_quantiles_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    groups = {
        "a": rng.normal(size=5000) ** 3, "b": rng.integers(0, 4, 999), "c": np.array([7.0]),
        "d": np.array([1e300, -1e300, 3.0, 3.0]), "e": np.array([-np.inf, 0.0, 1.0, 5.0, np.inf]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    counts = distribution.value_counts(spark.createDataFrame(rows, "g string, v double"), "v", ["g"])
    shares = {"x": 0.25, "y": 0.5, "z": 0.9}
    found = {r.g: (r.x, r.y, r.z) for r in distribution.exact_quantiles(counts, ["g"], shares).collect()}
    for g, values in groups.items():
        if g == "e":
            assert found[g][:2] == (0.0, 1.0)
        else:
            assert found[g] == pytest.approx(tuple(np.quantile(values, list(shares.values()))), rel=1e-12)


def test_box_figures(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 5), (9, 5)], "b int, v int")
    row = distribution.box_stats(df, "v", "b", first=2).filter("b = 0").first()
    assert (row.q1, row.median, row.q3, row.n_items) == (3.0, 5.0, 7.0, 9)
    assert (row.lower_whisker, row.upper_whisker, row.outliers) == (1.0, 8.0, 1)
    assert distribution.box_stats(df, "v", "b", first=2).count() == 2
    assert [tuple(r) for r in distribution.box_outliers(df, "v", "b").collect()] == [(0, 100.0, 1)]


def test_reports_have_rows(spark):
    assert reports.overview(items(spark))["communities"].first().subreddit == "b"
    for name, frame in reports.author_report(items(spark)).items():
        assert not frame.isEmpty(), name
    for name, frame in reports.history_report(items(spark)).items():
        assert not frame.isEmpty() or name == "score_outliers", name
    single = reports.history_report(items(spark).drop("batch_number"))
    assert single["statistics"].first().label == "Overall"
    tallied = tallies.tally(rich(spark))
    report = reports.batch_report(
        rich(spark), tallied, tallies.metrics_from_tally(tallied, 1)
    )
    assert report["sample"].count() == 3
    assert [r.user_ref for r in report["user_ref"].collect()] == ["x", "y"]
