"""The registered queries against their SQL, and the plans they run as."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as registered
from bazar.session import scratch_root
from checks.compare import connect, differences
from checks.queries import ORACLE, QUERIES, _export, _lake
from checks.testdata import TestTables

SLOW = {"layers_full"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_contract(spark, folder):
    assert registered.queries().keys() >= QUERIES.keys() and registered.oracle_sql().keys() <= registered.queries().keys()
    assert set(QUERIES) == set(ORACLE)
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_agrees_with_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(SLOW))
def test_all_layers(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) == []


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("sv_", "gd_", "q_"))])
def test_plans_have_no_pairs_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text)
    # a whole-table window may only run over the ranges
    assert not re.search(r"Window \[r(ank|ow_number)", text) or "__range" in text


def test_filter_reaches_the_scan(spark, folder):
    raw = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_orderstatus", "order_status")
    text = plan(raw.filter("order_status = 'F'").select("o_orderkey"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(o_orderstatus,F\)", text)


def test_scans_read_needed_columns_only(spark, folder):
    text = plan(TestTables(spark, folder)["gold/seller_performance"])
    read = set(re.findall(r"struct<([^>]*)>", text))
    assert any("l_suppkey" in r and "l_shipdate" not in r and "l_partkey" not in r for r in read)


def test_silver_models_do_not_shuffle(spark, folder):
    narrow = ("order_items_silver", "payments_silver", "order_reviews", "orders_only_delivered_silver", "products_silver", "leads_closed_silver")
    for name in narrow:
        assert "Exchange" not in plan(TestTables(spark, folder)[f"silver/{name}"])


@pytest.mark.parametrize("name, scans, shuffles", [("gd_agg_sellers_cancellation_rate_v2", 1, 4)])
def test_risk_score_reads_items_once(spark, folder, name, scans, shuffles):
    text = plan(QUERIES[name](spark, folder))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", text)) == scans
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= shuffles


@pytest.mark.parametrize("name", ["gd_agg_sellers_cancellation_rate", "gd_sellers_order_reviews_score", "gd_sellers_shipment_metrics", "gd_regional_demand_supply_balance"])
def test_items_are_dealt_by_order_only(spark, folder, name):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(QUERIES[name](spark, folder)))
    assert dealt and not any("order_id" in keys and "seller_id" in keys for keys in dealt)


@pytest.mark.parametrize("name", ["gd_geo_sales", "gd_customers_segmented"])
def test_orders_are_not_dealt_by_customer_before_they_meet_their_items(spark, folder, name):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(QUERIES[name](spark, folder)))
    assert dealt and not any("order_id" in keys and "customer_id" in keys for keys in dealt)


def test_exports_and_the_lake_are_packed(spark, folder):
    tables = TestTables(spark, folder)
    lake = _lake(tables)
    _export(tables["bronze/orders_bronze"], f"{lake.root}/exports")
    lake.write(tables["bronze/orders_bronze"], "bronze", "orders_bronze")
    for path, ending in ((f"{lake.root}/exports", ".csv.gz"), (lake.path("bronze", "orders_bronze"), ".zstd.parquet")):
        names = [name for name in os.listdir(path.removeprefix("file:")) if name.startswith("part-")]
        assert names and all(name.endswith(ending) for name in names)


def test_sellers_of_a_region_are_dealt_by_a_short_region(spark, folder):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(QUERIES["gd_regional_demand_supply_balance"](spark, folder)))
    assert any("seller_id" in keys for keys in dealt) and not any("seller_id" in keys and "customer_city" in keys for keys in dealt)


def test_exports_do_not_outlive_their_landing(spark, folder):
    tables = TestTables(spark, folder)
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    QUERIES["layers_full"](spark, tables.folder)
    (lake,) = [name for name in set(os.listdir(root)) - before if name.startswith("lake-")]
    assert os.listdir(f"{root}/{lake}/exports") == [] and len(os.listdir(f"{root}/{lake}/bronze")) == 11
