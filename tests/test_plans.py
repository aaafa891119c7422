"""Physical plans of the batch queries, with broadcasts switched off as on tables too large for them."""

import re

import pytest

from bindings.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "table_", "keyed_"))]


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_keyless_joins_and_no_python_rows(spark, no_broadcast):
    bad = {}
    for name in BATCH:
        text = plan(spark, name)
        found = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Expand") if w in text]
        if found:
            bad[name] = found
    assert not bad


@pytest.mark.parametrize("name", ["cart_top3_by_category", "favor_top3_by_brand", "module_click_rank", "shop_top_visitors"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") == 2


def test_last_days_reach_the_scan(spark):
    scans = re.findall(r"PushedFilters: \[[^\]]*\]", plan(spark, "user_sku_order_nd"))
    assert any("GreaterThanOrEqual(o_orderdate" in s for s in scans)


@pytest.mark.parametrize("name", ["page_path", "page_transitions", "user_flow_path", "product_sales_rank", "totals_with_share", "dedup_newer_only", "related_actions"])
def test_order_and_pairs_need_no_single_task(spark, no_broadcast, name):
    """A total of everything may meet in one task: one row from each task, summed before."""
    text = plan(spark, name)
    met = text.count("Exchange SinglePartition")
    assert met == len(re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[\], functions=\[partial_", text))


def test_routes_are_met_without_a_shuffle(spark, no_broadcast):
    """Records of one table and operation would meet in one task."""
    assert "SortMergeJoin" not in plan(spark, "cdc_route")


def test_dimension_rules_are_met_without_a_sort(spark, no_broadcast):
    """Records of one table would be sorted in one task."""
    assert "SortMergeJoin" not in plan(spark, "cdc_dims_by_config")


@pytest.mark.parametrize("name, times", [("fact_order_detail", 1), ("fact_payment_success", 2)])
def test_benefits_of_lines_need_no_orders(spark, no_broadcast, name, times):
    """A join for the order's day alone would move all lines and orders once more for each benefit."""
    assert plan(spark, name).count("Exchange hashpartitioning(l_orderkey") == times


@pytest.mark.parametrize("name", ["fact_order_detail", "fact_payment_success", "fact_payment_success_by_status"])
def test_benefits_come_to_the_lines(spark, no_broadcast, name):
    """The rows of lines lie by their order; dealt by line for the benefits, all their columns would be moved once more."""
    text = plan(spark, name)
    assert "Exchange hashpartitioning(id#" not in text and text.count("Exchange hashpartitioning(_lookup_within") == 2


def test_daily_payments_move_the_lines_of_their_days_only(spark):
    files = QUERIES["fact_payment_success_daily"](spark, SMALL).inputFiles()
    assert any("lines-of-days" in f for f in files) and not any("lineitem.parquet" in f for f in files)


def test_dimensions_that_name_each_other_are_joined_first(spark, no_broadcast):
    """The rows are moved for items, users and provinces; spu, category and brand meet the items."""
    moved = [line for line in plan(spark, "enrich_order_detail").split("\n") if "Exchange hashpartitioning(coalesce(" in line and "order_detail_id" in line]
    assert len(moved) == 3


def test_stream_dimensions_stay_off_the_driver(spark):
    from bindings.changes import pay_rows
    from bindings.inputs import Inputs

    text = pay_rows(Inputs(spark, SMALL), live=True)._jdf.queryExecution().logical().toString()
    assert text.count("strategy=merge") + text.count("UnresolvedHint merge") + text.count("ResolvedHint (strategy=merge)") >= 2


def test_change_records_are_made_from_one_reading_of_spread_rows(spark):
    text = plan(spark, "cdc_order_wide")
    assert text.count("FileScan parquet [l_orderkey") == 2 and text.count("REPARTITION_BY_COL") >= 2 and "BroadcastHashJoin" not in text


def test_sent_records_are_read_back_with_one_parse(spark):
    text = plan(spark, "stream_topic_routing")
    assert "get_json_object" not in text and len(re.findall(r"Generate explode\(array\(from_json", text)) == 1
