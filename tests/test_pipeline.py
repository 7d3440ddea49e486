"""Files to gold tables, end to end."""

from __future__ import annotations

import csv
import datetime as dt
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from bazar.plans.pipeline import (
    ALIASES,
    BY_NAME,
    MODELS,
    CsvTable,
    default_sources,
    extract_csv,
    outcome_table,
    run_model,
    run_pipeline,
    run_query,
    sorted_table,
    table,
)
from bazar.sources import Lake, query, register_views

RUN_AT = dt.datetime(2024, 1, 2, 3, 4, 5)

FILES = {
    "customers_dataset.csv": [
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
        ["c1", "u1", "02403", " São Paulo ", "sp"],
        ["c2", "u2", "02403", "são paulo", "SP"],
        ["c3", "u3", "20000", "rio", "rj"],
    ],
    "geolocation_dataset.csv": [
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"],
        ["02403", "-23.5", "-46.5", "São Paulo", "sp"],
        ["02403", "-23.25", "-46.25", "", ""],
        ["02403", "", "", "x", "y"],
    ],
    "order_items_dataset.csv": [
        ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
        ["o1", "1", "p1", "s1", "2018-01-03 00:00:00", "10.00", "3.00"],
        ["o1", "2", "p2", "s1", "2018-01-03 00:00:00", "20.50", "1.00"],
        ["o2", "1", "p1", "s2", "2018-01-09 00:00:00", "12.00", "3.00"],
    ],
    "order_payments_dataset.csv": [
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        ["o1", "1", " Boleto", "1", "30.50"],
        ["o1", "2", "voucher", "", "4.00"],
        ["o2", "1", "", "3", "15.00"],
    ],
    "order_reviews_dataset.csv": [
        ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp"],
        ["r1", "o1", "1", "", 'Bad\n"very"', "2018-01-12 00:00:00", "2018-01-13 01:00:00"],
        ["r2", "o2", "5", "Ok", "", "", ""],
    ],
    "orders_dataset.csv": [
        [
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ],
        ["o1", "c1", "delivered", "2018-01-01 10:00:00", "", "", "2018-01-11 23:00:00", "2018-01-10 00:00:00"],
        ["o2", "c2", "canceled", "2018-01-05 10:00:00", "", "", "", "2018-01-20 00:00:00"],
    ],
    "products_dataset.csv": [
        [
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
        ["p1", "Brinquedos ", "40", "100", "1", "500", "10", "10", "10"],
        ["p2", "", "", "", "", "", "", "", ""],
    ],
    "sellers_dataset.csv": [
        ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
        ["s1", "01001", "Campinas", "sp"],
        ["s2", "01002", "Niterói", "rj"],
    ],
    "product_category_name_translation.csv": [
        ["product_category_name", "product_category_name_english"],
        ["brinquedos", "toys"],
    ],
}


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    folder = tmp_path_factory.mktemp("export")
    for name, rows in FILES.items():
        bom = "utf-8-sig" if "translation" in name else "utf-8"
        with open(folder / name, "w", newline="", encoding=bom) as f:
            csv.writer(f).writerows(rows)
    con = sqlite3.connect(folder / "leads.sqlite")
    con.execute("CREATE TABLE leads_qualified (mql_id TEXT, first_contact_date TEXT, landing_page_id TEXT, origin TEXT)")
    con.execute(
        "CREATE TABLE leads_closed (mql_id TEXT, seller_id TEXT, sdr_id TEXT, sr_id TEXT, won_date TEXT, business_segment TEXT,"
        " lead_type TEXT, lead_behaviour_profile TEXT, has_company INTEGER, has_gtin INTEGER, average_stock TEXT, business_type TEXT,"
        " declared_product_catalog_size REAL, declared_monthly_revenue REAL)"
    )
    con.executemany(
        "INSERT INTO leads_qualified VALUES (?, ?, 'lp', ?)",
        [("m1", "2018-01-01", "Organic "), ("m2", "2018-01-02", None), ("m3", "2018-01-02", "organic")],
    )
    con.execute(
        "INSERT INTO leads_closed VALUES ('m1', 's1', 'x', 'y', '2018-01-05 23:30:00', ' Toys', NULL, 'Eagle, Wolf', NULL, 1, '', 'Reseller', NULL, 5.0)"
    )
    con.commit()
    con.close()
    return str(folder)


@pytest.fixture(scope="module")
def lake(spark, export, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    outcomes = run_pipeline(lake, "full", default_sources(export), run_at=RUN_AT, parallel=3)
    assert [o for o in outcomes if o.status != "ok"] == []
    assert len(outcomes) == 11 + len(MODELS)
    return lake


def all_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_table_is_there(lake):
    assert len(lake.tables("bronze")) == 11
    for layer in ("silver", "gold"):
        assert lake.tables(layer) == sorted(m.name for m in MODELS if m.layer == layer)


def test_models_follow_their_inputs():
    done = {f"bronze/{name}" for name in ()}
    for model in MODELS:
        for source in model.inputs:
            assert source.startswith("bronze/") or source in done
        done.add(f"{model.layer}/{model.name}")
    for layer, names in ALIASES.items():
        assert all(layer == "bronze" or target in BY_NAME for target in names.values())


def test_bronze_keeps_texts_and_types(lake):
    assert [r.customer_zip_code_prefix for r in lake.read("bronze", "customers_bronze").collect()] == ["02403", "02403", "20000"]
    reviews = {r.review_id: r for r in lake.read("bronze", "reviews_bronze").collect()}
    assert reviews["r1"].review_comment_message == 'Bad\n"very"'
    assert lake.read("bronze", "product_category_name_translation_bronze").columns[0] == "product_category_name"


def test_silver_values(lake):
    assert all_rows(table(lake, "silver", "aggregated_customers")) == [
        ("c1", "u1", "02403", "são paulo", "SP", -23.375, -46.375),
        ("c2", "u2", "02403", "são paulo", "SP", -23.375, -46.375),
        ("c3", "u3", "20000", "rio", "RJ", None, None),
    ]
    assert all_rows(table(lake, "silver", "products"))[1] == ("p2", "unknown", 0, 0, 0, 0, 0, 0, 0)
    assert {r.payment_type: (r.payment_installments, r.payment_value) for r in lake.read("silver", "payments_silver").collect()} == {
        "boleto": (1, 30.5),
        "voucher": (0, 4.0),
        "n/a": (3, 15.0),
    }
    leads = {r.mql_id: r for r in lake.read("silver", "aggregated_leads_silver").collect()}
    assert (leads["m1"].days_to_convert, leads["m1"].came_from, leads["m1"].lead_type) == (4, "organic", "n/a")
    assert (leads["m2"].days_to_convert, leads["m2"].came_from, leads["m2"].business_segment) == (None, "n/a", "n/a")
    closed = lake.read("silver", "leads_closed_silver").first()
    assert (closed.average_stock, closed.has_company, closed.declared_product_catalog_size, closed.lead_behaviour_profile) == ("N/A", 0, 0.0, "eagle, wolf")
    assert [r.order_id for r in lake.read("silver", "orders_only_delivered_silver").collect()] == ["o1"]
    filled = {r.review_id: r for r in lake.read("silver", "order_reviews").collect()}
    assert filled["r2"].review_creation_date == RUN_AT


def test_gold_values(lake):
    assert all_rows(lake.read("gold", "geo_sales")) == [("são paulo", "SP", 42.5, 3)]
    assert all_rows(lake.read("gold", "seller_performance")) == [("s1", 30.5, 2), ("s2", 12.0, 1)]
    assert all_rows(lake.read("gold", "freight_analysis")) == [("brinquedos", 22.0, 2, 11.0, 3.0, 500.0)]
    assert all_rows(lake.read("gold", "gold_sellers_order_reviews_score")) == [("s1", "campinas", "SP", 1.0)]
    [late] = lake.read("gold", "gold_sellers_shipment_metrics").collect()
    assert (late.seller_id, late.total_orders, late.delayed_orders, late.delayed_rate_percent, late.avg_delay_days) == ("s1", 2, 2, 100.0, 1.0)
    region = {r.customer_cep: r for r in lake.read("gold", "regional_demand_supply_balance").collect()}
    # o1: payments of 34.50 for each of two item rows, o2: 15.00 for one
    assert (region["02403"].total_customers, region["02403"].total_orders, region["02403"].distinct_sellers) == (2, 2, 2)
    assert (region["02403"].total_sales_value, region["02403"].demand_supply_ratio) == (84.0, 1.0)
    assert (region["20000"].total_orders, region["20000"].total_sales_value, region["20000"].demand_supply_ratio) == (0, None, None)
    customers = {r.customer_id: r for r in lake.read("gold", "gold_customers_segmented").collect()}
    assert (customers["c1"].total_orders, customers["c1"].total_spent, customers["c1"].avg_ticket) == (1, 34.5, 34.5)
    assert (customers["c3"].total_orders, customers["c3"].total_spent, customers["c3"].first_order_date) == (None, None, None)
    ranks = {r.product_id: r.sales_priority for r in lake.read("gold", "gold_product_inventory_priority").collect()}
    assert ranks == {"p1": 1, "p2": 2}


def test_gold_tables_are_read_in_order(lake):
    assert [r.total_sales for r in sorted_table(lake, "gold_product_inventory_priority").collect()] == [22.0, 20.5]
    assert [r.seller_id for r in sorted_table(lake, "agg_sellers_cancellation_rate").collect()] == ["s2", "s1"]
    assert sorted_table(lake, "geo_sales").count() == 1


def test_sql_over_the_lake(lake, spark):
    register_views(lake)
    assert query(spark, "select count(*) as n from order_items_silver join seller_performance using (seller_id)").first().n == 3
    run_query(lake, "select customer_state, count(*) as n from customers_silver group by customer_state", "gold", "states")
    assert all_rows(lake.read("gold", "states")) == [("RJ", 1), ("SP", 2)]


def test_append_mode_and_single_model(lake, spark, export, tmp_path):
    own = Lake(spark, str(tmp_path))
    for _ in range(2):
        extract_csv(own, f"{export}/sellers_dataset.csv", "sellers_bronze", mode="append", multi_line=False)
    run_model(own, "sellers_silver")
    assert own.read("silver", "sellers_silver").count() == 4
    assert dict(own.read("bronze", "sellers_bronze").dtypes)["seller_zip_code_prefix"] == "string"


def test_failure_stops_or_is_reported(spark, tmp_path):
    own = Lake(spark, str(tmp_path / "lake"))
    own.write(spark.range(2), "bronze", "kept")
    sources = [CsvTable("kept", str(tmp_path / "absent.csv"), "a int", False)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_pipeline(own, "bronze", sources)
    outcomes = run_pipeline(own, "bronze", sources, on_error="skip")
    [row] = outcome_table(spark, outcomes).select("layer", "table_name", "status").collect()
    assert tuple(row) == ("bronze", "kept", "failed")
    assert own.read("bronze", "kept").count() == 2
    # nothing but the missing inputs fails
    statuses = {o.status for o in run_pipeline(own, "gold", on_error="skip")}
    assert statuses == {"failed"}


def test_unknown_stage(lake):
    with pytest.raises(ValueError, match="unknown stage"):
        run_pipeline(lake, "platinum")


def test_gold_parameters(lake):
    from bazar.plans.pipeline import run_gold

    run_gold(lake, gold_payment_performance={"canceled_status": "canceled"})
    got = lake.read("gold", "gold_payment_performance").agg(F.sum("cancelled_orders")).first()[0]
    assert got == 1


def test_seller_totals_are_computed_once(lake, monkeypatch):
    from bazar.plans import pipeline

    built = []
    part = pipeline.SHARED["gold"][0]
    monkeypatch.setitem(pipeline.SHARED, "gold", (part._replace(build=lambda *tables: built.append(1) or part.build(*tables)),))
    monkeypatch.setattr(pipeline.gold, "seller_totals", lambda *_: pytest.fail("computed again"))
    pipeline.run_gold(lake)
    assert built == [1]
    assert lake.spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_product_sales_are_computed_once_and_stored(lake, monkeypatch):
    from bazar.plans import pipeline

    built = []
    seller, product = pipeline.SHARED["gold"]
    counted = product._replace(build=lambda *tables: built.append(1) or product.build(*tables))
    monkeypatch.setitem(pipeline.SHARED, "gold", (seller, counted))
    monkeypatch.setattr(pipeline.gold, "product_sales", lambda *_: pytest.fail("computed again"))
    (given,) = product.given
    before = {name: all_rows(lake.read("gold", name)) for name in given.models}
    pipeline.run_gold(lake, parallel=4)
    assert built == [1]
    assert {name: all_rows(lake.read("gold", name)) for name in given.models} == before
    assert lake._folders(f"{lake.root}/_shared") == []


def test_shuffle_files_are_gone_when_a_table_is_stored(lake):
    from bazar.plans import pipeline

    def kept() -> set[str]:
        manager = lake.spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in manager.getAllFiles().mkString("\n").splitlines() if "shuffle_" in name}

    before = kept()
    for model in ("gold_customers_segmented", "gold_product_inventory_priority", "regional_demand_supply_balance"):
        pipeline.run_model(lake, model)
    # they are removed while the driver goes on
    for _ in range(20):
        if not (left := kept() - before):
            break
        time.sleep(0.25)
    assert left == set()


def test_landed_sources_are_handed_back(spark, export, tmp_path):
    from bazar.plans.pipeline import run_bronze

    lake, landed = Lake(spark, str(tmp_path / "lake")), []
    sources = default_sources(export)[:2] + [CsvTable("absent", f"{export}/absent.csv", None, False)]
    run_bronze(lake, sources, on_error="skip", landed=lambda source: landed.append((source.name, lake.exists("bronze", source.name))))
    assert landed == [("customers_bronze", True), ("geolocation_bronze", True)]


def test_items_and_orders_are_dealt_by_order_once_for_sellers_and_regions(lake, monkeypatch):
    from bazar.plans import pipeline

    part = pipeline.SHARED["gold"][0]
    both = part.build(*[lake.read(*source.split("/")) for source in part.inputs])
    before = {k: lake.spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("false", "-1")):
        lake.spark.conf.set(k, v)
    try:
        text = part.build(*[lake.read(*source.split("/")) for source in part.inputs])._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            lake.spark.conf.set(k, v)
    assert text.count("ReadSchema: struct<order_id:string,seller_id:string>") == 1 and text.count("ReadSchema: struct<order_id:string,customer_id:string>") == 1
    # with both parts given, neither is computed again
    monkeypatch.setattr(pipeline.gold, "region_activity", lambda *_: pytest.fail("computed again"))
    counted = part._replace(build=lambda *_: both)
    monkeypatch.setitem(pipeline.SHARED, "gold", (counted,))
    rows = all_rows(lake.read("gold", "regional_demand_supply_balance"))
    pipeline.run_gold(lake, parallel=4)
    assert all_rows(lake.read("gold", "regional_demand_supply_balance")) == rows
