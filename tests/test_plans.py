"""Physical plans: what has to hold at any size."""

import pytest

from flowspark import catalog

# step functions, order within a key, and the DDL tokenizer
PYTHON = {"flow_statement", "throttle", "ttl_dedup", "ttl_per_request", "ddl_columns", "metadata_ddl", "metadata_by_ending", "build_prompts_ddl"}
ONE_ROW_JOINS = {"cross_small", "model_catalog", "model_catalog_no_rules"}
WRITERS = {n for n in catalog.queries() if n.startswith("stream_")} | {
    "flow_replace_then_append", "flow_rerun", "flow_shared_view", "write_audit", "recent_sessions", "stored_flows",
    "read_description_files", "first_descriptions",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in WRITERS])
def test_no_python_and_no_pairing(spark, sf, name):
    text = plan(catalog.queries()[name](spark, sf))
    assert "CartesianProduct" not in text
    if name not in ONE_ROW_JOINS:
        assert "NestedLoopJoin" not in text
    if name not in PYTHON:
        assert "Python" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["latest_per_key", "statement_lines", "account_info"])
def test_first_row_per_key_is_limited_before_the_shuffle(spark, sf, name):
    assert plan(catalog.queries()[name](spark, sf)).count("WindowGroupLimit") == 2


def test_scan_reads_needed_columns_only(spark, sf):
    text = plan(catalog.queries()["customer_totals"](spark, sf))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "partial_sum" in text


def test_range_reaches_the_scan(spark, sf):
    text = plan(catalog.queries()["filter_range"](spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text
