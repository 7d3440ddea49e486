"""Every model on small dirty tables against plain SQL joins over the same tables."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest

from bazar.plans import analyses, gold, silver
from bazar.plans.pipeline import BY_NAME, MODELS
from checks.oracle import GOLD, SILVER, mean, payment_performance, risk_score

SCHEMAS = {
    "customers_silver": "customer_id string, customer_unique_id string, customer_cep string, customer_city string, customer_state string",
    "geolocation_silver": "geolocation_cep string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    "order_items_silver": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price double, freight_value double",
    "payments_silver": "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    "order_reviews": "order_id string, review_id string, review_score int",
    "orders_full_data_silver": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "products_silver": "product_id string, product_category string, product_weight_g int",
    "sellers_silver": "seller_id string, seller_cep string, seller_city string, seller_state string",
    "leads_qualified_silver": "mql_id string, landing_page_id string, first_contact_date timestamp_ntz, came_from string",
    "product_category_name_translation_bronze": "product_category_name string, product_category_name_english string",
}


def dirty(seed: int) -> dict[str, list[tuple]]:
    """Repeated keys, a hot key with a third of the rows, missing keys and values, dangling references."""
    rng = random.Random(seed)

    def key(prefix: str, n: int) -> str | None:
        draw = rng.random()
        return f"{prefix}0" if draw < 0.33 else None if draw < 0.37 else f"{prefix}{rng.randrange(n)}"

    def maybe(value, share: float = 0.1):
        return None if rng.random() < share else value

    def day(spread: int, base: dt.datetime = dt.datetime(2018, 1, 1)) -> dt.datetime:
        return base + dt.timedelta(days=rng.randrange(spread))

    money = lambda top: round(rng.uniform(0, top), 2)
    place = lambda: (maybe(rng.choice(["rio", "são paulo"])), rng.choice(["RJ", "SP"]))
    orders = []
    for _ in range(80):
        bought = day(60)
        orders.append((key("o", 60), key("c", 30), rng.choice(["canceled", "cancelled", "delivered"]), maybe(bought), maybe(bought + dt.timedelta(days=rng.randrange(20)), 0.3), maybe(bought + dt.timedelta(days=10))))
    free = {"p1", "p2"}
    items = []
    for i in range(120):
        product = key("p", 15)
        items.append((key("o", 70), i, product, key("s", 12), day(60), 0.0 if product in free else maybe(money(100)), 0.0 if product == "p2" else maybe(money(30))))
    return {
        "customers_silver": [(key("c", 32), f"u{rng.randrange(12)}", key("z", 6), *place()) for _ in range(50)],
        "geolocation_silver": [(key("z", 8), maybe(round(rng.uniform(-30, 5), 6)), maybe(round(rng.uniform(-70, -30), 6)), "x", "Y") for _ in range(60)],
        "order_items_silver": items,
        "payments_silver": [(key("o", 65), i, rng.choice(["boleto", "voucher", "credit_card"]), 1, maybe(money(200))) for i in range(90)],
        "order_reviews": [(key("o", 65), f"r{i}", maybe(rng.randrange(0, 6))) for i in range(70)],
        "orders_full_data_silver": orders,
        "products_silver": [(key("p", 17), maybe(rng.choice(["toys", "books", "art"])), maybe(rng.randrange(500))) for _ in range(30)],
        "sellers_silver": [(key("s", 14), "02403", *place()) for _ in range(25)],
        "leads_qualified_silver": [(maybe(f"m{i}"), "l", day(60), rng.choice(["organic", "organic", "paid", "email", "other"])) for i in range(40)],
        "product_category_name_translation_bronze": [("toys", "t"), ("books", "b"), ("books", "b2"), ("missing", "m")],
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def tables(request, spark, tmp_path_factory):
    """The same tables for Spark and for SQL."""
    root, con, frames = tmp_path_factory.mktemp("dirty"), duckdb.connect(), {}
    for name, data in dirty(request.param).items():
        frames[name] = spark.createDataFrame(data, SCHEMAS[name])
        frames[name].write.parquet(f"{root}/{name}")
        frames[name] = spark.read.parquet(f"{root}/{name}")
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}/*.parquet')")
    con.execute(f"create table aggregated_customers_silver as {SILVER['aggregated_customers_silver']}")
    return frames, con


def comparable(value):
    return repr(value) if isinstance(value, float) else value


def check(df, con, sql, approx=()):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    ours = Counter(tuple(map(comparable, r)) for r in df.select(*names).collect())
    assert ours == Counter(tuple(map(comparable, r)) for r in found.fetchall())


def located(frames):
    return silver.aggregated_customers(frames["customers_silver"], frames["geolocation_silver"])


def inputs(frames, model):
    names = [path.split("/")[1] for path in model.inputs]
    return [located(frames) if n == "aggregated_customers_silver" else frames[n] for n in names]


# coordinates are compared after rounding: SQL averages them with four decimals here
GOLD_ON_DIRTY = [m.name for m in MODELS if m.layer == "gold" and m.name not in ("gold_customers_segmented", "regional_demand_supply_balance")]


@pytest.mark.parametrize("name", GOLD_ON_DIRTY)
def test_gold_model(tables, name):
    frames, con = tables
    check(BY_NAME[name].build(*inputs(frames, BY_NAME[name])), con, GOLD[name])


@pytest.mark.parametrize("name", ["gold_customers_segmented", "regional_demand_supply_balance"])
def test_gold_model_with_coordinates(tables, name):
    frames, con = tables
    df = BY_NAME[name].build(*inputs(frames, BY_NAME[name]))
    if name == "regional_demand_supply_balance":
        df = df.withColumn("demand_supply_ratio", df["demand_supply_ratio"].cast("double"))
    check(df.drop("avg_latitude", "avg_longitude"), con, f"select * exclude (avg_latitude, avg_longitude) from ({GOLD[name]})")


def test_located_customers(tables):
    frames, con = tables
    ours = {tuple(r)[:5]: tuple(r)[5:] for r in located(frames).collect()}
    sql = SILVER["aggregated_customers_silver"]
    for part in ("geolocation_lat", "geolocation_lng"):
        sql = sql.replace(mean(part), f"avg({part})")
    theirs = {r[:5]: r[5:] for r in con.execute(sql).fetchall()}
    assert ours.keys() == theirs.keys() and len(ours) == located(frames).count()
    for who, place in theirs.items():
        for a, b in zip(ours[who], place):
            assert (a is None and b is None) or a == pytest.approx(b, abs=1e-12)


def test_canceled_spelling_is_a_parameter(tables):
    frames, con = tables
    model = BY_NAME["gold_payment_performance"]
    check(model.build(*inputs(frames, model), canceled_status="canceled"), con, payment_performance("canceled"))


def test_risk_thresholds_and_entity_are_parameters(tables):
    frames, con = tables
    levels = gold.RiskThresholds((0.5, 0.3), (0.6, 0.4), (1.0, -1.0), 20, 8, 6)
    df = gold.agg_sellers_cancellation_rate_v2(*inputs(frames, BY_NAME["agg_sellers_cancellation_rate_v2"]), thresholds=levels, by="product_id")
    check(df, con, risk_score("product_id", (0.5, 0.3), (0.6, 0.4), (1, -1), 20, 8, 6))


def test_payment_analyses(tables):
    frames, con = tables
    payments, orders, items = frames["payments_silver"], frames["orders_full_data_silver"], frames["order_items_silver"]
    check(
        analyses.payment_types(payments, orders),
        con,
        f"""select payment_type, {mean("payment_value")} as avg_payment_value, count(order_id) as total_orders,
              count(*) filter (where order_status = 'cancelled') as cancelled_orders,
              count(*) filter (where order_status = 'cancelled') / count(order_id) as cancellation_rate
            from payments_silver join orders_full_data_silver using (order_id) group by payment_type""",
    )
    check(
        analyses.payment_types_by_seller_mean(payments, orders, items, frames["sellers_silver"]),
        con,
        f"""with per_seller as (
              select payment_type, round({mean("payment_value")}, 2) as payment, count(order_id) as n,
                count(*) filter (where order_status = 'cancelled') as c,
                round({mean("cast(price as decimal(18, 4)) + cast(freight_value as decimal(18, 4))")}, 2) as basket
              from payments_silver join orders_full_data_silver using (order_id) join order_items_silver using (order_id)
                join sellers_silver using (seller_id)
              group by payment_type, seller_id, seller_city, seller_state)
            select payment_type, round({mean("payment")}, 2) as avg_payment_value, cast(sum(n) as bigint) as total_orders,
              cast(sum(c) as bigint) as cancelled_orders, sum(c) / sum(n) as cancellation_rate, round({mean("basket")}, 2) as avg_order_value
            from per_seller group by payment_type""",
    )


def test_lead_priority_median(spark):
    data = [(f"m{i}", "l", None, origin) for i, origin in enumerate("aaabbc")]
    got = gold.gold_qualified_leads_priority(spark.createDataFrame(data, SCHEMAS["leads_qualified_silver"]))
    assert {r.came_from: (r.total_leads, r.priority) for r in got.collect()} == {"a": (3, "high"), "b": (2, "median"), "c": (1, "low")}


def test_free_products_have_an_infinite_freight_share(spark):
    items = spark.createDataFrame([("o", 1, "p", "s", None, 0.0, 5.0), ("o", 1, "q", "s", None, 10.0, 3.0), ("o", 1, "r", "s", None, 10.0, 2.99)], SCHEMAS["order_items_silver"])
    products = spark.createDataFrame([("p", "toys", 1), ("q", "toys", 1), ("r", "toys", None)], SCHEMAS["products_silver"])
    got = {r.product_id: (r.freight_pct_price, r.critical_product, r.avg_weight) for r in gold.gold_product_profitability_analysis(items, products).collect()}
    assert got == {"p": (float("inf"), True, 1.0), "q": (30.0, True, 1.0), "r": (29.9, False, None)}


def test_risk_edges(spark):
    """Sellers exactly on the thresholds: 0.2 and 0.1 canceled, 30 days, 5 and 2 days late."""
    start = dt.datetime(2018, 1, 1)
    orders, items = [], []
    for seller, canceled, late, span in (("a", 2, 5, 30), ("b", 1, 2, 29)):
        for i in range(10):
            bought = start + dt.timedelta(days=span if i == 9 else 0)
            orders.append((f"{seller}{i}", "c", "canceled" if i < canceled else "x", bought, bought + dt.timedelta(days=10 + late), bought + dt.timedelta(days=10)))
            items.append((f"{seller}{i}", 1, "p", seller, None, 1.0, 1.0))
    none = spark.createDataFrame([], SCHEMAS["order_reviews"])
    df = gold.agg_sellers_cancellation_rate_v2(
        spark.createDataFrame(items, SCHEMAS["order_items_silver"]), spark.createDataFrame(orders, SCHEMAS["orders_full_data_silver"]), none
    )
    got = {r.seller_id: r for r in df.collect()}
    a, b = got["a"], got["b"]
    assert (a.score_cancellation, a.score_reviews, a.score_delay, a.score_inexperience, a.total_risk_score, a.risk_level) == (3, 1, 3, 0, 7, "MEDIAN")
    assert (b.score_cancellation, b.score_reviews, b.score_delay, b.score_inexperience, b.total_risk_score, b.risk_level) == (2, 1, 2, 1, 6, "LOW")
    assert a.negative_review_rate is None and a.seller_lifetime_days == 30
    rates = gold.agg_sellers_cancellation_rate(
        spark.createDataFrame(items, SCHEMAS["order_items_silver"]), spark.createDataFrame(orders, SCHEMAS["orders_full_data_silver"]), none
    )
    assert {r.seller_id for r in analyses.high_risk_sellers(rates).collect()} == {"a"}
    assert [r.seller_id for r in analyses.worst_sellers(rates, k=1).collect()] == ["a"]


def test_review_tables_differ_in_the_missing_score(spark):
    raw = spark.createDataFrame(
        [("r1", "o1", None, None, " Bom ", None, None), ("r2", "o1", 4, " Ok", None, dt.datetime(2018, 1, 1), None)],
        "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
    )
    now = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    kept = {r.review_id: r for r in silver.reviews(raw).collect()}
    filled = {r.review_id: r for r in silver.order_reviews(raw, now).collect()}
    assert kept["r1"].review_score is None and filled["r1"].review_score == 0
    assert (kept["r1"].review_comment_title, kept["r1"].review_comment_message) == ("no_title", " Bom ")
    assert (filled["r1"].review_comment_title, filled["r1"].review_comment_message) == ("sem título", "bom")
    assert (filled["r2"].review_comment_title, filled["r2"].review_comment_message) == ("ok", "sem comentário")
    assert filled["r1"].review_creation_date == now and filled["r2"].review_creation_date == dt.datetime(2018, 1, 1)
    assert kept["r1"].review_creation_date is None


def test_results_do_not_depend_on_partitioning(tables):
    frames, _ = tables
    model = BY_NAME["agg_sellers_cancellation_rate_v2"]
    first = Counter(map(tuple, model.build(*inputs(frames, model)).collect()))
    shuffled = [df.repartition(7) for df in inputs(frames, model)]
    assert Counter(map(tuple, model.build(*shuffled).collect())) == first


SELLER_MODELS = ("agg_sellers_cancellation_rate", "agg_sellers_cancellation_rate_v2", "gold_sellers_order_reviews_score", "gold_sellers_shipment_metrics")


@pytest.mark.parametrize("name", SELLER_MODELS)
def test_seller_models_agree_on_shared_totals(tables, name):
    frames, con = tables
    totals = gold.seller_totals(frames["order_items_silver"], frames["orders_full_data_silver"], frames["order_reviews"])
    check(BY_NAME[name].build(*inputs(frames, BY_NAME[name]), totals=totals), con, GOLD[name])


@pytest.mark.parametrize("name", ["freight_analysis", "gold_product_inventory_priority", "gold_product_profitability_analysis", "sales_by_category"])
def test_product_models_agree_on_shared_sales(tables, name):
    frames, con = tables
    sales = gold.product_sales(frames["order_items_silver"])
    check(BY_NAME[name].build(*inputs(frames, BY_NAME[name]), sales=sales), con, GOLD[name])


def test_regions_that_differ_in_missing_parts_only(spark):
    """A hash passes over NULLs and tells 0.0 from -0.0 or not; groups do as before."""
    region = [("x", None, "s", 1.0, None), (None, "x", "s", 1.0, None), (None, None, "s", None, 1.0), (None, None, "s", 1.0, None), ("z", "c", "s", 0.0, float("nan")), ("z", "c", "s", -0.0, float("nan"))]
    places = [(f"c{i}", f"u{i}", *r) for i, r in enumerate(region)]
    customers = spark.createDataFrame(places, "customer_id string, customer_unique_id string, customer_cep string, customer_city string, customer_state string, avg_latitude double, avg_longitude double")
    orders = spark.createDataFrame([(f"o{i}", f"c{i}") for i in range(6)], "order_id string, customer_id string")
    items = spark.createDataFrame([(f"o{i}", f"s{i % 4}") for i in range(6)] + [("o0", "s9")], "order_id string, seller_id string")
    payments = spark.createDataFrame([(f"o{i}", float(i)) for i in range(6)], "order_id string, payment_value double")
    got = gold.regional_demand_supply_balance(customers, orders, items, payments)
    assert got.columns == [*gold.REGION, "total_customers", "total_orders", "distinct_sellers", "total_sales_value", "demand_supply_ratio"]
    found = sorted(([r.customer_cep, r.customer_city, r.avg_latitude, r.total_customers, r.total_orders, r.distinct_sellers, r.total_sales_value] for r in got.collect()), key=repr)
    expected = [["x", None, 1.0, 1, 1, 2, 0.0], [None, "x", 1.0, 1, 1, 1, 1.0], [None, None, None, 1, 1, 1, 2.0], [None, None, 1.0, 1, 1, 1, 3.0], ["z", "c", 0.0, 2, 2, 2, 9.0]]
    assert found == sorted(expected, key=repr)


def test_regions_of_one_hash_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(gold, "_region_id", lambda: [gold.F.lit(0).cast("bigint").alias(c) for c in gold.REGION_ID])
    customers = spark.createDataFrame([("c1", "u1", "1", "a", "s", 1.0, 1.0), ("c2", "u2", "2", "b", "s", 1.0, 1.0)], "customer_id string, customer_unique_id string, customer_cep string, customer_city string, customer_state string, avg_latitude double, avg_longitude double")
    orders, items = spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string"), spark.createDataFrame([("o1", "s1")], "order_id string, seller_id string")
    payments = spark.createDataFrame([("o1", 1.0)], "order_id string, payment_value double")
    with pytest.raises(Exception, match="same hash"):
        gold.regional_demand_supply_balance(customers, orders, items, payments).collect()


def test_regional_balance_agrees_on_shared_activity(tables):
    frames, con = tables
    model = BY_NAME["regional_demand_supply_balance"]
    items, orders, reviews = frames["order_items_silver"], frames["orders_full_data_silver"], frames["order_reviews"]
    both = gold.totals_and_activity(items, orders, reviews, located(frames), frames["payments_silver"])
    df = model.build(*inputs(frames, model), activity=gold.activity_in(both))
    df = df.withColumn("demand_supply_ratio", df["demand_supply_ratio"].cast("double"))
    check(df.drop("avg_latitude", "avg_longitude"), con, f"select * exclude (avg_latitude, avg_longitude) from ({GOLD[model.name]})")
    check(BY_NAME["gold_sellers_shipment_metrics"].build(orders, items, frames["sellers_silver"], totals=gold.totals_in(both)), con, GOLD["gold_sellers_shipment_metrics"])


@pytest.mark.parametrize("shares", [1, 3, 4096])
def test_leads_of_common_and_rare_origins(tables, monkeypatch, shares):
    frames, con = tables
    monkeypatch.setattr(gold.joins, "SHARES", shares)
    model = BY_NAME["gold_qualified_leads_priority"]
    df = model.build(*inputs(frames, model))
    check(df, con, GOLD[model.name])
    # leads of common origins are not dealt out
    assert "LeftAnti" in df._jdf.queryExecution().executedPlan().toString()
