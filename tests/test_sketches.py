"""Mergeable statistics against exact ones, and quantiles whose bins follow the values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.operators import distribution, history, mentions, sketches
from postpulse.schemas import LEAN_ITEM
from postpulse.streaming import job


def items(spark, n=60_000):
    number = F.xxhash64("id")
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(number % 3 == 0, "post").otherwise("comment").alias("type"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("a"), F.pmod(number, F.lit(20_000)))).alias("author"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64(number), F.lit(900))).alias("subreddit"),
        F.when(F.col("id") % 70 != 0, F.pmod(number, F.lit(5_000)) - 100).cast("int").alias("score"),
        (F.col("id") % 5).alias("batch_number"),
    )


def test_batches_add_up_within_the_bounds(spark):
    df = items(spark).cache()
    exact = history.overall_history(df).first()
    parts = sketches.sketch(df, ["batch_number"])
    got = sketches.figures(sketches.merge(parts)).first()
    for name in ("id_count", "score_mean", "score_std", "score_min", "score_max", "posts"):
        assert got[name] == exact[name]
    for name in ("unique_authors", "unique_subreddits"):
        assert got[name] == pytest.approx(exact[name], rel=4 * 0.008)
    scores = np.sort([r.score for r in df.select("score").dropna().collect()])
    for name, share in (("score_q1", 0.25), ("score_median", 0.5), ("score_q3", 0.75)):
        low, high = (np.searchsorted(scores, got[name], side) / len(scores) for side in ("left", "right"))
        assert low - 0.004 <= share <= high + 0.004
    grown = {r.batch_number: r for r in sketches.figures(sketches.running(parts)).collect()}
    for batch, row in grown.items():
        so_far = history.overall_history(df.filter(F.col("batch_number") <= batch)).first()
        assert row.id_count == so_far.id_count
        assert row.unique_authors == pytest.approx(so_far.unique_authors, rel=4 * 0.008)
    df.unpersist()


def test_nothing_to_count(spark):
    schema = "id string, type string, author string, subreddit string, score double, batch_number int"
    none = spark.createDataFrame([], schema)
    row = sketches.figures(sketches.merge(sketches.sketch(none))).first()
    assert (row.id_count, row.unique_authors, row.score_median, row.score_mean) == (0, 0, None, None)
    nulls = spark.createDataFrame([(None, None, None, None, None, 1), ("x", "post", "a", "c", float("nan"), 1)], schema)
    row = sketches.figures(sketches.sketch(nulls, ["batch_number"])).first()
    assert (row.id_count, row.posts, row.unique_authors, row.score_mean) == (1, 1, 1, None)
    assert row.score_median is None and sketches.running(sketches.sketch(none, ["batch_number"])).count() == 0


def test_edges_of_stored_sketches_change_no_quantile(spark, tmp_path):
    df = items(spark)
    path = str(tmp_path / "sketches")
    sketches.sketch(df, ["batch_number"]).write.parquet(path)
    edges = sketches.score_edges(spark.read.parquet(path), ["batch_number"])
    counts = distribution.value_counts(df, "score", ["batch_number"])
    shares = {"a": 0.01, "b": 0.5, "c": 0.97}
    plain = distribution.exact_quantiles(counts, ["batch_number"], shares)
    told = distribution.exact_quantiles(counts, ["batch_number"], shares, edges)
    assert sorted(told.collect()) == sorted(plain.collect())
    expected = df.groupBy("batch_number").agg(*[F.percentile("score", q).alias(c) for c, q in shares.items()])
    assert sorted(plain.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("outlier", [1e15, float("inf")])
def test_no_bin_above_its_share_with_one_far_outlier(spark, outlier):
    counts = spark.range(100_000).select(F.col("id").cast("double").alias("value"), F.lit(1).alias("n"))
    counts = counts.unionByName(spark.createDataFrame([(outlier, 1)], "value double, n int"))
    edges = distribution.sampled_edges(counts, [])
    bins = counts.crossJoin(edges).groupBy(distribution._bin_of(F.col("value"), F.col("edges")).alias("bin"))
    sizes = [r["count"] for r in bins.count().collect()]
    assert sum(sizes) == 100_001 and max(sizes) < 0.02 * 100_000
    row = distribution.exact_quantiles(counts, [], {"m": 0.5, "q": 0.25}).first()
    assert (row.m, row.q) == (50_000.0, 25_000.0)


def rich(spark, batch):
    rows = [
        ("post", f"c{i % 3}", f"{batch}-{i}", f"words of item {i} /u/ann", 1700000000.0 + 9 * batch + i, f"w{i * batch}")
        for i in range(6)
    ]
    return mentions.extract_references(spark.createDataFrame(rows, LEAN_ITEM))


def test_job_keeps_running_figures(spark, tmp_path):
    folders = job.JobFolders(str(tmp_path))
    for batch in range(3):
        job.process_batch(rich(spark, batch), batch, folders)
    job.process_batch(rich(spark, 2), 2, folders)  # a replay adds nothing
    exact = history.overall_history(job.history_items(spark, folders.root)).first()
    got = job.history_figures(spark, folders.root)
    row = got.first()
    assert all("/running/sketches" in f for f in got.inputFiles())
    for name in ("id_count", "posts", "unique_authors", "unique_subreddits", "score_mean"):
        assert row[name] == exact[name]
    growth = job.history_growth(spark, folders.root).orderBy("batch_number").collect()
    assert [r.batch_number for r in growth] == [0, 1, 2] and growth[-1].id_count == exact.id_count
