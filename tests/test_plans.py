"""Shuffles, pushed filters and read columns of the plans, so that a change that costs a pass shows."""

import re

import pytest

from logweave.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name,most",
    [
        ("session_gap_ceiling", 1), ("session_size_hist", 2), ("adjacent_pairs", 1), ("running_seen_types", 2), ("stint_last_value", 1), ("sticky_flag", 1), ("forward_fill_prior", 1), ("last_k_history", 1), ("majority_vote", 1),
        ("entity_first_non_null", 1), ("singleton_groups", 1), ("order_pair_theta", 2), ("interval_tighten", 1), ("budget_constraint", 1), ("audit_report", 3), ("top_n_share", 4), ("first_wins_dedup", 1), ("boundary_search", 0), ("json_extract", 0), ("leak_regex", 0), ("section_split", 0),
    ],
)
def test_shuffles(spark, name, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    initial = text.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"\bExchange (?:hash|range|Single|Round)", initial)) <= most, text


@pytest.mark.parametrize(
    "name,columns",
    [("session_gap_ceiling", {"event_id", "user_id", "ts", "value"}), ("boundary_search", {"p_partkey", "p_size", "p_retailprice"}), ("majority_vote", {"l_orderkey", "l_returnflag"}), ("index_terciles", {"o_orderpriority", "o_totalprice"})],
)
def test_only_needed_columns_are_read(spark, name, columns):
    read = set()
    for m in re.finditer(r"ReadSchema: struct<(.*?)>", plan(spark, name)):
        read |= {c.split(":")[0] for c in m[1].split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(l_quantity,45.0)" in plan(spark, "fallback_chain")
    assert "EqualTo(l_returnflag,R)" in plan(spark, "exists_with_override")


def test_no_python_in_relational_queries(spark):
    for name in ("session_gap_ceiling", "running_seen_types", "nearest_match", "index_terciles", "audit_report", "boundary_search", "fallback_chain", "message_pairing"):
        assert "Python" not in plan(spark, name) and "Arrow" not in plan(spark, name), name
