"""Plan guards: pruning, pushdown and the absence of cartesian products in the registered queries."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned(spark):
    p = plan(spark, "histograms")
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_bucket_filter_reaches_parquet(spark):
    p = plan(spark, "port_classes")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p


@pytest.mark.parametrize("name", ["correlation_quality", "stratified_sample", "stratified_split", "dedup_patterns",
                                  "broken_references", "finding_clusters", "index_by_id"])
def test_no_cartesian_product(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["histograms", "risk_stats", "random_split"])
def test_fixed_width_aggregates_are_hash_aggregates(spark, name):
    p = plan(spark, name)
    assert "SortAggregate" not in p


def test_first_row_per_key_combines_before_the_shuffle(spark):
    """The kept row is a struct with strings, so Spark sorts; it still keeps one row per key and task before the shuffle."""
    p = plan(spark, "dedup_patterns")
    assert "partial_" in p and "Window [row_number()" not in p


@pytest.mark.parametrize("name", ["sft_texts", "prompt_pairs", "answer_repair", "repaired_texts", "completion_scores", "chat_messages"])
def test_text_queries_stay_in_the_jvm(spark, name):
    assert "Python" not in plan(spark, name)
