"""The paths beyond the broadcast bound (shuffle joins, salted dimension joins, hot-key
salting) give the same results as the default paths: the queries are re-checked against
their oracles with the bounds forced to zero."""

import pytest

from sourcelens.plans import joins

SF = "/root/testdata/sf0.001"
NAMES = ["inject_reviews", "review_counts", "search_symbols", "get_definitions", "build_contexts",
         "dispatch_tool_calls", "audit_responses", "review_corpus", "run_conversations", "resolve_imports", "tool_feedback"]


@pytest.fixture()
def no_broadcast(monkeypatch, spark):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 1)  # every repeated key counts as hot: the salted path runs
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def test_queries_without_broadcast_match_oracles(spark, no_broadcast):
    from tests.oracle_check import compare

    rep = compare(spark, SF, NAMES)
    bad = {k: v for k, v in rep.items() if v["status"] != "ok"}
    assert not bad, bad
    assert set(rep) == set(NAMES)
