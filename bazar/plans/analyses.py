"""Questions asked of the tables, outside the stored models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazar.functions import exact_decimal_mean, exact_mean, exact_sum, mean_of, money_of, round_half_away
from bazar.operators import collapse, count_product, money_product, stack_by_key, top_k
from bazar.plans.gold import (
    CANCELLED,
    REGION,
    _filled,
    _known,
    _line_value,
    _mean_money,
    _order_copies,
    _payment_groups,
    _seller_places,
    late_rows_per_seller,
)

# A mean is no money amount: it keeps ten decimals when averaged again.
TICKET = DecimalType(28, 10)


def high_risk_sellers(rates: DataFrame, cancellation: float = 0.1, negative: float = 0.2) -> DataFrame:
    """Sellers above either rate; a seller without reviews counts on cancellations alone."""
    return rates.filter((F.col("cancellation_rate") > cancellation) | (F.col("negative_review_rate") > negative))


def worst_sellers(rates: DataFrame, k: int = 5, cancellation_weight: float = 2.0, tie: Sequence[str] = ("seller_id",)) -> DataFrame:
    """Top ``k`` by cancellations, weighted, plus negative reviews."""
    weighted = F.col("cancellation_rate") * cancellation_weight + F.col("negative_review_rate")
    return top_k(rates, [weighted, *tie], k)


def region_tickets(segments: DataFrame, k: int | None = 10, with_spent: bool = False) -> DataFrame:
    """Customers, mean ticket and mean orders per zip, best ticket first."""
    measures = [
        F.count_distinct("customer_id").alias("num_customers"),
        exact_decimal_mean("avg_ticket", TICKET).alias("region_avg_ticket"),
        F.avg("total_orders").alias("region_avg_orders"),
    ]
    if with_spent:
        measures.append(exact_sum("total_spent").alias("region_total_spent"))
    regions = segments.groupBy("customer_cep").agg(*measures)
    return regions if k is None else top_k(regions, ["-region_avg_ticket", "customer_cep"], k)


def region_customers(aggregated_customers: DataFrame) -> DataFrame:
    """Distinct people per region."""
    return aggregated_customers.groupBy(*REGION).agg(F.count_distinct("customer_unique_id").alias("total_customers"))


def payment_types(payments: DataFrame, orders: DataFrame, canceled_status: str = CANCELLED) -> DataFrame:
    """Payments per type, counted as payment rows and without the items."""
    per_order = stack_by_key("order_id", [_order_copies(_known(orders, "order_id"), canceled_status)], sums=("orders", "canceled"))
    return (
        _payment_groups(payments)
        .join(per_order, "order_id")
        .groupBy("payment_type")
        .agg(
            money_product("paid", "orders").alias("paid"),
            count_product("paid_rows", "orders").alias("paid_rows"),
            count_product("payments", "orders").alias("total_orders"),
            count_product("payments", "canceled").alias("cancelled_orders"),
        )
        .select(
            "payment_type",
            mean_of(money_of("paid"), "paid_rows").alias("avg_payment_value"),
            "total_orders",
            "cancelled_orders",
            mean_of("cancelled_orders", "total_orders").alias("cancellation_rate"),
        )
    )


def payment_types_by_seller_mean(
    payments: DataFrame, orders: DataFrame, items: DataFrame, sellers: DataFrame, canceled_status: str = CANCELLED
) -> DataFrame:
    """Payment types as the mean over sellers: rounded per seller first, then averaged."""
    value = _line_value()
    per_order = stack_by_key("order_id", [_order_copies(_known(orders, "order_id"), canceled_status)], sums=("orders", "canceled"))
    lines = collapse(
        _known(items, "order_id", "seller_id"),
        ["order_id", "seller_id"],
        sums={"valued": _filled(value)},
        units={"value": value},
        copies="lines",
    )
    per_seller = (
        _payment_groups(payments)
        .join(per_order, "order_id")
        .join(lines, "order_id")
        .groupBy("payment_type", "seller_id")
        .agg(
            money_product("paid", "orders", "lines").alias("paid"),
            count_product("paid_rows", "orders", "lines").alias("paid_rows"),
            count_product("payments", "orders", "lines").alias("rows"),
            count_product("payments", "canceled", "lines").alias("canceled_rows"),
            money_product("value", "payments", "orders").alias("value"),
            count_product("valued", "payments", "orders").alias("valued"),
        )
    )
    rounded = _seller_places(sellers).join(per_seller, "seller_id").select(
        "payment_type",
        _mean_money("paid", "paid_rows").alias("avg_payment_value"),
        (F.col("rows") * F.col("places")).alias("rows"),
        (F.col("canceled_rows") * F.col("places")).alias("canceled_rows"),
        _mean_money("value", "valued").alias("avg_order_value"),
    )
    return rounded.groupBy("payment_type").agg(
        round_half_away(exact_mean("avg_payment_value"), 2).alias("avg_payment_value"),
        F.sum("rows").alias("total_orders"),
        F.sum("canceled_rows").alias("cancelled_orders"),
        mean_of(F.sum("canceled_rows"), F.sum("rows")).alias("cancellation_rate"),
        round_half_away(exact_mean("avg_order_value"), 2).alias("avg_order_value"),
    )


def delayed_orders_per_seller(orders: DataFrame, items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Item rows and late item rows of sellers late at least once."""
    return (
        _seller_places(sellers)
        .join(late_rows_per_seller(orders, items), "seller_id")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            (F.col("orders") * F.col("places")).alias("total_pedidos"),
            (F.col("late") * F.col("places")).alias("pedidos_atrasados"),
        )
    )
