"""Gold models: business tables.

Wherever a model joins several detail tables only to aggregate them, each side is reduced
per key first and the sums are weighted with the row counts of the other sides (see
``bazar.operators.reduce``). "Orders" in the seller and city tables are joined item rows,
as they always were; none of the fan-out is repaired.

Models return unsorted tables. ``ORDER`` holds the order each is read in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from operator import and_
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazar.functions import (
    Band,
    as_double,
    calendar_days,
    days_of,
    elapsed,
    float_ratio,
    ieee_divide,
    ladder,
    mean_of,
    money_of,
    round_half_away,
    seconds_of,
    units,
    whole,
)
from bazar.functions.text import ColumnOrName, _col
from bazar.operators import joins
from bazar.operators import (
    collapse,
    count_product,
    global_rank,
    left_join_unique,
    lookup_join,
    money_product,
    stack_by_key,
)

# The two spellings of the canceled status the models look for.
CANCELED = "canceled"
CANCELLED = "cancelled"

# Review scores that count as negative.
NEGATIVE_SCORES = (1, 2)

REGION = ("customer_cep", "customer_city", "customer_state", "avg_latitude", "avg_longitude")
REGION_ID = ("region", "region_check")

ORDER = {
    "agg_sellers_cancellation_rate": ("-cancellation_rate", "-negative_review_rate"),
    "agg_sellers_cancellation_rate_v2": ("-total_risk_score", "-cancellation_rate"),
    "gold_payment_performance": ("-avg_order_value", "cancellation_rate"),
    "gold_product_inventory_priority": ("-total_sales",),
    "gold_qualified_leads_priority": ("-total_leads",),
    "regional_demand_supply_balance": ("-total_orders",),
}


class RiskThresholds(NamedTuple):
    """Where a seller metric scores 3 and 2; ``lifetime`` scores 1 below it."""

    # Fixed values
    cancellation: tuple[float, float] = (0.2, 0.1)
    negative_reviews: tuple[float, float] = (0.3, 0.15)
    delay_days: tuple[float, float] = (5.0, 2.0)
    lifetime_days: int = 30
    high: int = 10
    median: int = 7


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _filled(c: ColumnOrName) -> Column:
    """1 per value a COUNT or AVG would see."""
    return _flag(_col(c).isNotNull())


def _known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows an inner join on these columns can match."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def _mean_money(total: ColumnOrName, n: ColumnOrName, digits: int = 2) -> Column:
    return round_half_away(mean_of(money_of(total), n), digits)


def _item_rows(items: DataFrame, by: str = "seller_id") -> DataFrame:
    """The one form in which item rows are dealt by order, so that joins of one query share the exchange; a NULL seller is left to what comes after the join."""
    return _known(items, "order_id").select("order_id", by)


def _or(part: DataFrame | None, build: Callable[..., DataFrame], *inputs: Any) -> DataFrame:
    """A part of several models that was computed for all of them, or the same computed here."""
    return build(*inputs) if part is None else part


def seller_totals(items: DataFrame, orders: DataFrame, order_reviews: DataFrame, canceled_status: str = CANCELED, by: str = "seller_id") -> DataFrame:
    """What the seller models sum over the item rows of a seller, in one pass over the items.

    Orders and reviews are stacked into one row per order, which every item row meets in one join; a hot order is
    split there. Totals without a partner are NULL.
    """
    return _totals(items, orders, order_reviews, canceled_status, by)


def _totals(items: DataFrame, orders: DataFrame, order_reviews: DataFrame, canceled_status: str = CANCELED, by: str = "seller_id") -> DataFrame:
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    late = delivered > estimated
    late_by = elapsed("order_estimated_delivery_date", "order_delivered_customer_date")
    given = F.col("review_score")
    per_order = stack_by_key(
        "order_id",
        [
            orders.select(
                "order_id",
                F.lit(1).alias("orders"),
                _flag(F.col("order_status") == canceled_status).alias("canceled"),
                late_by.alias("late_by"),
                _filled(late_by).alias("timed"),
                _flag(late).alias("late"),
                F.when(late, calendar_days(estimated, delivered)).otherwise(0).alias("late_days"),
                F.col("order_purchase_timestamp").alias("first_purchase"),
                F.col("order_purchase_timestamp").alias("last_purchase"),
                F.when(late, delivered).alias("last_late"),
            ),
            order_reviews.select(
                "order_id",
                F.lit(1).alias("reviews"),
                _flag(given.isin(*NEGATIVE_SCORES)).alias("negatives"),
                given.alias("score"),
                _filled(given).alias("scored"),
            ),
        ],
        sums=("orders", "canceled", "late_by", "timed", "late", "late_days", "reviews", "negatives", "score", "scored"),
        least=("first_purchase",),
        greatest=("last_purchase", "last_late"),
    )
    counts = {
        "total_orders": "orders",
        "canceled_orders": "canceled",
        "total_reviews": "reviews",
        "negative_reviews": "negatives",
        "timed": "timed",
        "late": "late",
        "late_days": "late_days",
        "score": "score",
        "scored": "scored",
    }
    return (
        _item_rows(items, by)
        .join(per_order, "order_id")
        .groupBy(by)
        .agg(
            *[count_product(c).alias(name) for name, c in counts.items()],
            F.sum(seconds_of("late_by")).alias("late_seconds"),
            F.min("first_purchase").alias("first_purchase"),
            F.max("last_purchase").alias("last_purchase"),
            F.max("last_late").alias("last_late"),
        )
    )


def _seller_metrics(totals: DataFrame, by: str) -> DataFrame:
    """Order and review rates per seller."""

    def matched(c: str) -> Column:
        # a NULL seller has order totals but finds no partner for anything else
        return F.when(F.col(by).isNotNull(), F.col(c))

    lifetime = days_of(seconds_of(elapsed(matched("first_purchase"), matched("last_purchase"))))
    return totals.filter(F.col("total_orders") > 0).select(
        by,
        "total_orders",
        "canceled_orders",
        round_half_away(mean_of("canceled_orders", "total_orders"), 4).alias("cancellation_rate"),
        matched("total_reviews").alias("total_reviews"),
        matched("negative_reviews").alias("negative_reviews"),
        round_half_away(mean_of(matched("negative_reviews"), "total_reviews"), 4).alias("negative_review_rate"),
        round_half_away(days_of(mean_of(matched("late_seconds"), "timed")), 2).alias("avg_delivery_delay"),
        F.bround(lifetime, 0).cast("int").alias("seller_lifetime_days"),
    )


def agg_sellers_cancellation_rate(
    items: DataFrame,
    orders: DataFrame,
    order_reviews: DataFrame,
    canceled_status: str = CANCELED,
    by: str = "seller_id",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Cancellation and negative-review rate per seller. ``totals`` are those of the same tables and parameters, if they are there already."""
    totals = _or(totals, seller_totals, items, orders, order_reviews, canceled_status, by)
    return _seller_metrics(totals, by).drop("avg_delivery_delay", "seller_lifetime_days")


def agg_sellers_cancellation_rate_v2(
    items: DataFrame,
    orders: DataFrame,
    order_reviews: DataFrame,
    canceled_status: str = CANCELED,
    thresholds: RiskThresholds = RiskThresholds(),
    by: str = "seller_id",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Risk score per seller: three metrics score 1 to 3, a short lifetime adds 1."""
    totals = _or(totals, seller_totals, items, orders, order_reviews, canceled_status, by)

    def three_two_one(metric: str, levels: tuple[float, float]) -> Column:
        return ladder(metric, [Band(levels[0], 3), Band(levels[1], 2)], otherwise=1)

    scored = _seller_metrics(totals, by).select(
        "*",
        three_two_one("cancellation_rate", thresholds.cancellation).alias("score_cancellation"),
        three_two_one("negative_review_rate", thresholds.negative_reviews).alias("score_reviews"),
        three_two_one("avg_delivery_delay", thresholds.delay_days).alias("score_delay"),
        _flag(F.col("seller_lifetime_days") < thresholds.lifetime_days).alias("score_inexperience"),
    )
    total = F.col("score_cancellation") + F.col("score_reviews") + F.col("score_delay") + F.col("score_inexperience")
    level = [Band(thresholds.high, "HIGH"), Band(thresholds.median, "MEDIAN")]
    return scored.withColumn("total_risk_score", total).withColumn("risk_level", ladder("total_risk_score", level, otherwise="LOW"))


def product_sales(items: DataFrame) -> DataFrame:
    """What the product models sum over the item rows of a product, one row per product; joins on product_id after this meet no hot key."""
    return collapse(
        _known(items, "product_id"),
        ["product_id"],
        sums={"sold": _filled("order_id"), "priced": _filled("price"), "freighted": _filled("freight_value")},
        units={"revenue": units("price"), "freight": units("freight_value")},
        copies="lines",
    )


def _weight() -> dict[str, Column]:
    return {"weight": F.col("product_weight_g"), "weighed": _filled("product_weight_g")}


def freight_analysis(items: DataFrame, products: DataFrame, translation: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Revenue, freight and weight per category that has a translation. ``sales`` are those of the same items, if they are there already, as in all product models."""
    described = collapse(_known(products, "product_id", "product_category"), ["product_id", "product_category"], sums=_weight())
    per_category = (
        described.join(_or(sales, product_sales, items), "product_id")
        .groupBy(F.col("product_category").alias("product_category_name"))
        .agg(
            money_product("revenue", "copies").alias("revenue"),
            count_product("sold", "copies").alias("sold"),
            count_product("priced", "copies").alias("priced"),
            money_product("freight", "copies").alias("freight"),
            count_product("freighted", "copies").alias("freighted"),
            count_product("weight", "lines").alias("weight"),
            count_product("weighed", "lines").alias("weighed"),
        )
    )
    names = collapse(translation, ["product_category_name"], copies="names")
    return per_category.join(names, "product_category_name").select(
        "product_category_name",
        money_of(F.col("revenue") * whole("names")).alias("total_revenue"),
        (F.col("sold") * F.col("names")).alias("total_quantity_sold"),
        _mean_money("revenue", "priced").alias("average_price_per_item"),
        _mean_money("freight", "freighted").alias("average_freight"),
        round_half_away(mean_of("weight", "weighed"), 2).alias("average_product_weight_per_category"),
    )


def _customer_orders(orders: DataFrame, dated: bool = False) -> DataFrame:
    """Orders as they are: reducing them by (order, customer) would be a shuffle more before the join by order, and they repeat little."""
    bought = F.col("order_purchase_timestamp")
    dates = [bought.alias("first_purchase"), bought.alias("last_purchase")] if dated else []
    return _known(orders, "customer_id").select("order_id", "customer_id", F.lit(1).alias("copies"), *dates)


def geo_sales(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and item rows per city."""
    basket = collapse(_known(items, "order_id"), ["order_id"], units={"revenue": units("price")}, copies="lines")
    per_customer = (
        _customer_orders(orders)
        .join(basket, "order_id")
        .groupBy("customer_id")
        .agg(money_product("revenue", "copies").alias("revenue"), count_product("lines", "copies").alias("lines"))
    )
    homes = collapse(_known(customers, "customer_id"), ["customer_id", "customer_city", "customer_state"], copies="homes")
    return (
        homes.join(per_customer, "customer_id")
        .groupBy("customer_city", "customer_state")
        .agg(
            money_of(money_product("revenue", "homes")).alias("total_revenue"),
            count_product("lines", "homes").alias("total_orders"),
        )
    )


def _paid_per_order(payments: DataFrame) -> DataFrame:
    return collapse(_known(payments, "order_id"), ["order_id"], units={"paid": units("payment_value")}).drop("copies")


def gold_customers_segmented(orders: DataFrame, payments: DataFrame, aggregated_customers: DataFrame) -> DataFrame:
    """Orders, spending and ticket per customer; customers without orders are kept."""
    per_customer = (
        left_join_unique(_customer_orders(orders, dated=True), _paid_per_order(payments), "order_id")
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(F.col("order_id").isNotNull(), F.col("copies")).otherwise(0)).alias("total_orders"),
            money_product("paid", "copies").alias("spent"),
            F.sum(F.when(F.col("paid").isNotNull(), F.col("copies"))).alias("paid_orders"),
            F.min("first_purchase").alias("first_order_date"),
            F.max("last_purchase").alias("last_order_date"),
        )
    )
    return left_join_unique(aggregated_customers, per_customer, "customer_id").select(
        "customer_id",
        "customer_cep",
        "avg_latitude",
        "avg_longitude",
        "total_orders",
        money_of("spent").alias("total_spent"),
        mean_of(money_of("spent"), "paid_orders").alias("avg_ticket"),
        "first_order_date",
        "last_order_date",
    )


def _payment_groups(payments: DataFrame) -> DataFrame:
    return collapse(
        _known(payments, "order_id"),
        ["order_id", "payment_type"],
        sums={"paid_rows": _filled("payment_value")},
        units={"paid": units("payment_value")},
        copies="payments",
    )


def _order_copies(orders: DataFrame, canceled_status: str) -> DataFrame:
    return orders.select("order_id", F.lit(1).alias("orders"), _flag(F.col("order_status") == canceled_status).alias("canceled"))


def _line_value() -> Column:
    return units("price") + units("freight_value")


def gold_payment_performance(payments: DataFrame, orders: DataFrame, items: DataFrame, canceled_status: str = CANCELLED) -> DataFrame:
    """Value and cancellations per payment type, over payments times items of each order."""
    value = _line_value()
    per_order = stack_by_key(
        "order_id",
        [
            _order_copies(_known(orders, "order_id"), canceled_status),
            _known(items, "order_id").select(
                "order_id", F.lit(1).alias("lines"), value.alias("value"), _filled(value).alias("valued")
            ),
        ],
        sums=("orders", "canceled", "lines", "valued"),
        units=("value",),
    ).filter((F.col("orders") > 0) & (F.col("lines") > 0))
    return (
        _payment_groups(payments)
        .join(per_order, "order_id")
        .groupBy("payment_type")
        .agg(
            money_product("paid", "orders", "lines").alias("paid"),
            count_product("paid_rows", "orders", "lines").alias("paid_rows"),
            # the payment groups are unique per order and type, so rows are distinct orders
            F.count(F.lit(1)).alias("total_orders"),
            count_product("payments", "canceled", "lines").alias("cancelled_orders"),
            money_product("value", "payments", "orders").alias("value"),
            count_product("valued", "payments", "orders").alias("valued"),
        )
        .select(
            "payment_type",
            _mean_money("paid", "paid_rows").alias("avg_payment_value"),
            "total_orders",
            "cancelled_orders",
            mean_of("cancelled_orders", "total_orders").alias("cancellation_rate"),
            _mean_money("value", "valued").alias("avg_order_value"),
        )
    )


def gold_product_inventory_priority(products: DataFrame, items: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Sales per product and their rank over all products."""
    listed = collapse(_known(products, "product_id"), ["product_id", "product_category"])
    totals = listed.join(_or(sales, product_sales, items), "product_id").select(
        "product_id",
        "product_category",
        money_of(F.col("revenue") * whole("copies")).alias("total_sales"),
        (F.col("sold") * F.col("copies")).alias("sales_count"),
        round_half_away(ieee_divide(money_of("revenue"), "sold"), 2).alias("avg_price_per_sale"),
    )
    return global_rank(totals, "total_sales", "sales_priority")


def gold_product_profitability_analysis(
    items: DataFrame, products: DataFrame, critical_percent: float = 30.0, sales: DataFrame | None = None
) -> DataFrame:
    """Mean price and freight per product; freight from 30 % of the price is critical."""
    listed = collapse(_known(products, "product_id"), ["product_id", "product_category"], sums=_weight())
    price, freight = mean_of(money_of("revenue"), "priced"), mean_of(money_of("freight"), "freighted")
    percent = ieee_divide(freight, price) * 100.0
    return listed.join(_or(sales, product_sales, items), "product_id").select(
        "product_id",
        "product_category",
        round_half_away(price, 2).alias("avg_price"),
        round_half_away(freight, 2).alias("avg_freight"),
        (F.col("sold") * F.col("copies")).alias("total_sales"),
        mean_of("weight", "weighed").alias("avg_weight"),
        round_half_away(percent, 2).alias("freight_pct_price"),
        F.coalesce(percent >= critical_percent, F.lit(False)).alias("critical_product"),
    )


def gold_qualified_leads_priority(leads: DataFrame) -> DataFrame:
    """Every lead with the size of its origin and how that compares to the mean origin.

    Origins above a share of the leads are broadcast, at most ``SHARES`` rows; only the leads of all others are dealt out.
    """
    origins = leads.groupBy("came_from").agg(F.count("mql_id").alias("total_leads"))
    mean_size = origins.agg(F.avg("total_leads").alias("mean_size")).scalar()
    all_leads = origins.agg(F.sum("total_leads").alias("all_leads")).scalar()
    size = F.col("total_leads")
    priority = F.when(size > mean_size, "high").when(size == mean_size, "median").otherwise("low")
    rated = origins.withColumn("priority", priority)
    common = F.broadcast(rated.filter(size * joins.SHARES > all_leads))
    others = lookup_join(leads.join(common, "came_from", "left_anti"), rated.filter(size * joins.SHARES <= all_leads), "came_from", "inner")
    return leads.join(common, "came_from").unionByName(others).select(
        "mql_id", "first_contact_date", "landing_page_id", "came_from", "total_leads", "priority"
    )


def _seller_places(sellers: DataFrame) -> DataFrame:
    return collapse(_known(sellers, "seller_id"), ["seller_id", "seller_city", "seller_state"], copies="places")


def _order_sellers(items: DataFrame) -> DataFrame:
    """Item rows as they are, for the same reason; joins by order split a hot one."""
    return _known(items, "order_id", "seller_id").select("order_id", "seller_id", F.lit(1).alias("lines"))


def _scores_per_seller(items: DataFrame, order_reviews: DataFrame) -> DataFrame:
    given = F.col("review_score")
    per_order = collapse(_known(order_reviews, "order_id"), ["order_id"], sums={"score": given, "scored": _filled(given)})
    return (
        _order_sellers(items)
        .join(per_order, "order_id")
        .groupBy("seller_id")
        .agg(count_product("score", "lines").alias("score"), count_product("scored", "lines").alias("scored"))
    )


def gold_sellers_order_reviews_score(
    sellers: DataFrame, items: DataFrame, order_reviews: DataFrame, below: float = 3.0, totals: DataFrame | None = None
) -> DataFrame:
    """Sellers whose mean review, weighted by item rows, is below 3."""
    score = mean_of("score", "scored")
    poor = _or(totals, _scores_per_seller, items, order_reviews).select("seller_id", "score", "scored").filter(score < below)
    return (
        _seller_places(sellers)
        .join(poor, "seller_id")
        .select("seller_id", "seller_city", "seller_state", round_half_away(score, 2).alias("avg_score_review"))
    )


def late_rows_per_seller(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item rows, late item rows and days late per seller, for sellers late at least once."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    late = delivered > estimated
    per_order = collapse(
        _known(orders, "order_id"),
        ["order_id"],
        sums={"late": _flag(late), "late_days": F.when(late, calendar_days(estimated, delivered)).otherwise(0)},
        greatest={"last_late": F.when(late, delivered)},
        copies="orders",
    )
    return (
        _order_sellers(items)
        .join(per_order, "order_id")
        .groupBy("seller_id")
        .agg(
            count_product("lines", "orders").alias("orders"),
            count_product("lines", "late").alias("late"),
            count_product("lines", "late_days").alias("late_days"),
            F.max("last_late").alias("last_late"),
        )
        .filter(F.col("late") > 0)
    )


def gold_sellers_shipment_metrics(orders: DataFrame, items: DataFrame, sellers: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Delays per seller; the mean counts punctual rows as 0 days."""
    if totals is None:
        late = late_rows_per_seller(orders, items)
    else:
        late = totals.filter(F.col("late") > 0).select("seller_id", F.col("total_orders").alias("orders"), "late", "late_days", "last_late")
    return (
        _seller_places(sellers)
        .join(late, "seller_id")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            (F.col("orders") * F.col("places")).alias("total_orders"),
            (F.col("late") * F.col("places")).alias("delayed_orders"),
            round_half_away(as_double("late") * 100.0 / as_double("orders"), 2).alias("delayed_rate_percent"),
            round_half_away(mean_of("late_days", "orders"), 2).alias("avg_delay_days"),
            F.col("last_late").alias("last_order_delayed"),
        )
    )


def _placed(aggregated_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """``order_id`` and region of each order."""
    homes = _known(aggregated_customers, "customer_id").select("customer_id", *_region_id())
    return _known(orders, "order_id", "customer_id").select("order_id", "customer_id").join(homes, "customer_id").select("order_id", *REGION_ID)


def region_activity(aggregated_customers: DataFrame, orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """``total_orders`` and ``sales``, and in other rows ``distinct_sellers``, per region of the orders."""
    placed = _placed(aggregated_customers, orders)
    # orders meet one row each for their items and payments, and only the sellers of a region meet the items themselves
    sales = (
        placed.join(collapse(_known(items, "order_id"), ["order_id"], copies="lines"), "order_id", "left")
        .join(_paid_per_order(payments), "order_id", "left")
        .groupBy("order_id", *REGION_ID, "lines", "paid")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy(*REGION_ID)
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_product("paid", "copies", F.coalesce("lines", F.lit(1))).alias("sales"),
        )
    )
    pairs = placed.join(_item_rows(items), "order_id").select(*REGION_ID, "seller_id").distinct()
    sellers = pairs.groupBy(*REGION_ID).agg(F.count("seller_id").alias("distinct_sellers"))
    return sales.unionByName(sellers, allowMissingColumns=True)


def totals_and_activity(
    items: DataFrame, orders: DataFrame, order_reviews: DataFrame, aggregated_customers: DataFrame, payments: DataFrame
) -> DataFrame:
    """``seller_totals`` and ``region_activity`` in one table, told apart by ``kind``; the item rows are dealt by order once for both."""
    totals = _totals(items, orders, order_reviews).withColumn("kind", F.lit("totals"))
    activity = region_activity(aggregated_customers, orders, items, payments).withColumn("kind", F.lit("activity"))
    return totals.withColumnRenamed("total_orders", "seller_orders").unionByName(activity, allowMissingColumns=True)


def totals_in(both: DataFrame) -> DataFrame:
    found = both.filter(F.col("kind") == "totals").drop("kind", *REGION_ID, "total_orders", "sales", "distinct_sellers")
    return found.withColumnRenamed("seller_orders", "total_orders")


def activity_in(both: DataFrame) -> DataFrame:
    return both.filter(F.col("kind") == "activity").select(*REGION_ID, "total_orders", "sales", "distinct_sellers")


def _region_id() -> list[Column]:
    """A region in 16 bytes instead of five columns; beside each column is whether it is NULL, which a hash passes over."""
    columns = [c for name in REGION for c in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(F.lit(seed), *columns).alias(name) for seed, name in enumerate(REGION_ID)]


def regional_demand_supply_balance(
    aggregated_customers: DataFrame, orders: DataFrame, items: DataFrame, payments: DataFrame, activity: DataFrame | None = None
) -> DataFrame:
    """Customers, orders, sellers and sales per region.

    Sales repeat an order's payments for each of its item rows, once if it has none: that
    is the payment sum times the item rows, and item rows add up over the sellers.

    Orders and pairs of region and seller, of which there may be as many as item rows, carry a region as 128 bits of hash; two regions of one hash stop the job.
    ``activity`` is the ``region_activity`` of the same tables, if it is there already.
    """
    people = aggregated_customers.groupBy(*REGION, "customer_unique_id").agg(_filled("customer_unique_id").alias("known"))
    regions = people.groupBy(*REGION).agg(F.sum("known").alias("total_customers")).select("*", *_region_id(), F.lit(1).alias("regions"))
    # stacked; a region of a customer without an id and no orders is there too
    counted = [regions, _or(activity, region_activity, aggregated_customers, orders, items, payments)]
    merged = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), counted).groupBy(*REGION_ID).agg(
        F.sum("regions").alias("regions"),
        *[F.max(c).alias(c) for c in REGION],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_customers", "total_orders", "distinct_sellers")],
        money_of(F.sum("sales")).alias("total_sales_value"),
    )
    known = F.when(F.col("regions") == 1, F.col("total_customers")).otherwise(F.raise_error(F.lit("two regions have the same hash")))
    merged = merged.withColumn("total_customers", known).drop("regions", *REGION_ID)
    ratio = round_half_away(float_ratio("total_orders", F.nullif("distinct_sellers", F.lit(0))), 2)
    return merged.withColumn("demand_supply_ratio", ratio.cast("float"))


def sales_by_category(items: DataFrame, products: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Revenue, item rows and mean price per category."""
    return (
        collapse(_known(products, "product_id"), ["product_id", "product_category"])
        .join(_or(sales, product_sales, items), "product_id")
        .groupBy("product_category")
        .agg(
            money_product("revenue", "copies").alias("revenue"),
            count_product("sold", "copies").alias("sold"),
            count_product("priced", "copies").alias("priced"),
        )
        .select(
            "product_category",
            round_half_away(money_of("revenue"), 2).alias("total_revenue"),
            F.col("sold").alias("total_quantity_sold"),
            _mean_money("revenue", "priced").alias("average_price_per_item"),
        )
    )


def seller_performance(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Revenue and item rows per seller."""
    sold = collapse(
        _known(items, "seller_id"),
        ["seller_id"],
        sums={"sold": _filled("order_id")},
        units={"revenue": units("price")},
        copies="lines",
    )
    listed = collapse(_known(sellers, "seller_id"), ["seller_id"])
    return listed.join(sold, "seller_id").select(
        "seller_id",
        money_of(F.col("revenue") * whole("copies")).alias("total_revenue"),
        (F.col("sold") * F.col("copies")).alias("total_sales"),
    )
