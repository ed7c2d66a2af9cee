"""What the physical plans must keep: one scan, few columns, few shuffles."""

from __future__ import annotations

import re

import pytest

from quillcast.operators import counts, ranking, series, shares
from quillcast.operators.counts import labelled
from quillcast.plans import catalog


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame) -> str:
    frame.collect()
    return plan_of(frame).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "count",
    [
        counts.reposts_per_window,
        counts.reposts_per_post,
        counts.posts_per_language,
        counts.reposts_per_language,
        shares.share_of_posts,
        lambda facts: shares.share_of_posts(facts, lang_of="author"),
    ],
)
def test_a_count_is_one_scan_and_one_shuffle(spark, sf_dir, count):
    plan = plan_of(count(catalog.facts(spark, sf_dir)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "partial_" in plan and "SortAggregate" not in plan


def test_top_posts_sort_no_reposts(spark, sf_dir):
    """Payloads are aggregated behind the join with the winners only."""
    plan = plan_of(ranking.top_posts(catalog.facts(spark, sf_dir), "1 day"))
    below = plan.split("SortAggregate")[-1] if "SortAggregate" in plan else plan
    assert "Join" in below and plan.count("FileScan") == 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(counts.reposts_per_window(catalog.facts(spark, sf_dir)))
    assert "Not(EqualTo(event_type,error))" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {"ts", "event_type", "props"}


def test_predictors_share_their_scan(spark, sf_dir):
    counted = labelled(counts.reposts_per_window(catalog.facts(spark, sf_dir), "1 minute"))
    plan = final_plan(series.predict(counted))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_no_query_uses_a_cross_join(spark, sf_dir):
    for name in ("top_x_retweets", "retweets_per_country_geo", "compare_pct_by_time_of_day", "predict_avg"):
        plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
