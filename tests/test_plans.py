"""Plan shapes the scale design relies on."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_plan_shuffles_documents_once(spark):
    from quire.plans.summarise import extractive_summary
    from quire.sources.tables import table
    p = plan(extractive_summary(table(spark, SF_SMALL, "documents"), "doc_id", "text"))
    # once to count and score, once to pick the sentences; nothing in between is shuffled again
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_scan_filters_are_pushed(spark):
    p = plan(entry.queries()["q_day_scan"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    p = plan(entry.queries()["q_vector_filtered"](spark, SF_SMALL))
    assert "In(lang, [en,fr])" in p


def test_search_is_a_bounded_top_k(spark):
    p = plan(entry.queries()["q_match"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["q_match", "q_hybrid", "q_related", "q_settled_new", "q_topic_score",
                                  "q_extractive", "q_dbscan"])
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
