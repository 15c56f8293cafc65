"""What the plans must look like for the work to scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from postpulse.operators import distribution, ingest, mentions, tallies, texts, tfidf

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Plan after the run, with the exchanges that were reused."""
    df.collect()
    text = planned(df)
    assert "isFinalPlan=true" in text
    return text.split("== Initial Plan ==")[0]


def scans(plan):
    return len(re.findall(r"Scan parquet", plan))


STREAMS = {n for n in q.queries() if "stream" in n or "job" in n or n.startswith("lean_history")}
STORED = {"batch_files", "stored_batches_roundtrip", "current_batch"}


@pytest.mark.parametrize("name", sorted(set(q.queries()) - STREAMS - STORED))
def test_no_python_in_plans(spark, name):
    plan = planned(q.queries()[name](spark, SF))
    # The vector-to-array conversion is a JVM function of the ML library.
    assert "Python" not in plan and "InPandas" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "RoundRobin" not in plan


def test_metrics_scan_once(spark):
    assert scans(planned(q.batch_metrics(spark, SF))) == 1


def test_tfidf_reads_the_texts_once(spark):
    plan = final_plan(q.tfidf_words(spark, SF))
    assert scans(plan) == 1 and "ReusedExchange" in plan
    # Words are counted in their row: nothing is shuffled per item.
    assert "hashpartitioning(word" in plan and "doc_id" not in plan


@pytest.mark.parametrize("name", ["unique_terms", "top_phrases", "cumulative_terms"])
def test_pairs_are_held_after_texts_are_dealt(spark, name):
    counted = {"cumulative_terms": lambda s, sf: texts.term_counts(q.cleaned_documents(s, sf))}
    plan = planned(counted.get(name, getattr(q, name))(spark, SF))
    # Plans print from the result down to the scan.
    assert plan.index("Generate") < plan.index("REPARTITION_BY_COL") < plan.index("Scan parquet")


def test_histogram_reads_the_rows_once(spark):
    plan = final_plan(q.score_histogram(spark, SF))
    assert scans(plan) == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["batch_history", "overall_history", "batch_insights", "score_box",
                                  "score_outliers"])
def test_history_and_boxes_read_the_rows_once(spark, name):
    plan = final_plan(q.queries()[name](spark, SF))
    assert scans(plan) == 1 and "ReusedExchange" in plan
    assert "percentile" not in plan


def test_hashed_weights_start_no_job(spark):
    posts = q.ingest.posts_to_items(q.raw_posts(spark, SF))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    tfidf.tfidf_vectors(posts)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)


def test_shares_read_the_rows_once(spark):
    plan = final_plan(distribution.category_shares(q.items(spark, SF), "subreddit"))
    assert scans(plan) == 1 and "ReusedExchange" in plan


def test_box_figures_read_the_rows_once(spark):
    plan = final_plan(distribution.box_stats(q.items(spark, SF), "score", "batch_number"))
    assert scans(plan) == 1 and "ReusedExchange" in plan


def test_top_n_per_group_is_cut_before_the_shuffle(spark):
    plan = planned(ingest.newest_per_community(q.items(spark, SF)))
    partial, final = plan.find("Partial"), plan.find("Final")
    assert "WindowGroupLimit" in plan and partial > final > 0


def test_counts_are_combined_before_the_shuffle(spark):
    for df in (
        mentions.mention_counts(q.items_with_references(spark, SF), "user_references", "u"),
        tallies.community_stats(q.items(spark, SF)),
        texts.top_terms(q.cleaned_documents(spark, SF)),
    ):
        plan = planned(df)
        assert "partial_count" in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in planned(q.top_terms(spark, SF))
    assert "TakeOrderedAndProject" in planned(q.tfidf_top_words(spark, SF))


def test_only_needed_columns_are_read(spark):
    plan = planned(tallies.community_stats(q.items(spark, SF)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "event_id:bigint,event_type:string,value:double"


def test_filters_reach_the_scan(spark):
    plan = planned(tallies.kpi(q.items(spark, SF).filter(F.col("subreddit") == "click")))
    assert "EqualTo(event_type,click)" in plan


def test_filter_on_a_computed_column_does_not_repeat_the_text_work(spark):
    plain = planned(q.enriched_documents(spark, SF))
    filtered = planned(q.enriched_documents(spark, SF).filter(F.col("topic") == "news"))
    assert filtered.count("regexp_replace") == plain.count("regexp_replace")
    assert filtered.count("split(") == plain.count("split(")


def test_windows_sum_panes_before_they_fan_out(spark):
    plan = planned(mentions.windowed_references(q.items(spark, SF)))
    lines = plan.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("Exchange" in line for line in lines[expand:])


def test_term_statistics_can_be_filtered(spark):
    stats = tfidf.term_stats(q.documents(spark, SF)).filter("word >= 'a' and df > 1")
    assert stats.first().df > 1
