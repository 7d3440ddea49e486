"""Registered queries: every model, analysis, function and source over the test tables."""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazar import schemas
from bazar.functions import (
    Band,
    calendar_days,
    clean_lower,
    clean_upper,
    elapsed_days,
    empty_to,
    exact_mean,
    exact_sum,
    ladder,
    lifetime_label,
    lower_or,
    mean_of,
    money_of,
    round_half_away,
    text_or,
    text_to_int,
    units,
    upper_or,
    whole_days,
)
from bazar.operators import (
    collapse,
    distinct_values,
    global_rank,
    global_row_number,
    left_join_split,
    left_join_unique,
    lookup_join,
    money_product,
    null_counts,
    row_counts,
    rows_where,
    stack_by_key,
    count_product,
    top_k,
)
from bazar.plans import analyses, gold, silver
from bazar.plans.pipeline import MODELS, CsvTable, outcome_table, run_bronze, run_model, run_pipeline, run_query, sorted_table
from bazar.session import configure, scratch_root
from bazar.sources import Lake, describe_csv, preview_csv, publish_layer, query, read_csv, read_sqlite, register_views
from checks.oracle import mean, over_tables, payment_performance, risk_score, total
from checks.testdata import BRONZE, RUN_AT, TestTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    """Add ``build(tables)`` under ``name`` with the SQL it must agree with."""

    def add(build: Callable[[TestTables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(TestTables(configure(spark), folder))
        if sql is not None:
            ORACLE[name] = over_tables(sql)
        return build

    return add


def _model_query(path: str) -> Callable[[TestTables], DataFrame]:
    def build(tables: TestTables) -> DataFrame:
        df = tables[path]
        floats = [c for c, dtype in df.dtypes if dtype == "float"]
        return df.withColumns({c: F.col(c).cast("double") for c in floats})

    return build


for _model in MODELS:
    _prefix = {"silver": "sv", "gold": "gd"}[_model.layer]
    _short = _model.name.removesuffix("_silver").removeprefix("gold_")
    register(f"{_prefix}_{_short}", f"select * from {_model.name}")(_model_query(f"{_model.layer}/{_model.name}"))


# Analyses. Means of means are rounded to six decimals on both sides: the SQL averages doubles.

RATES = "gold/agg_sellers_cancellation_rate"
ITEMS, ORDERS, PAYMENTS, SELLERS = "silver/order_items_silver", "silver/orders_full_data_silver", "silver/payments_silver", "silver/sellers_silver"


@register("q_high_risk", "select * from agg_sellers_cancellation_rate where cancellation_rate > 0.1 or negative_review_rate > 0.2")
def _(t: TestTables) -> DataFrame:
    return analyses.high_risk_sellers(t[RATES])


@register(
    "q_composite_topk",
    "select * from agg_sellers_cancellation_rate order by cancellation_rate * 2 + negative_review_rate desc nulls last, seller_id limit 5",
)
def _(t: TestTables) -> DataFrame:
    return analyses.worst_sellers(t[RATES])


def _region_tickets(with_spent: bool) -> str:
    spent = f", {total('total_spent')} as region_total_spent" if with_spent else ""
    return f"""
        select customer_cep, count(distinct customer_id) as num_customers, round(avg(avg_ticket), 6) as region_avg_ticket,
          avg(total_orders) as region_avg_orders{spent}
        from gold_customers_segmented group by customer_cep order by avg(avg_ticket) desc nulls last, customer_cep limit 10"""


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, round_half_away(column, 6))


@register("q_region_ticket", _region_tickets(False))
def _(t: TestTables) -> DataFrame:
    return _rounded(analyses.region_tickets(t["gold/gold_customers_segmented"]), "region_avg_ticket")


@register("q_region_spent", _region_tickets(True))
def _(t: TestTables) -> DataFrame:
    return _rounded(analyses.region_tickets(t["gold/gold_customers_segmented"], with_spent=True), "region_avg_ticket")


@register(
    "q_region_customers",
    """select customer_cep, customer_city, customer_state, avg_latitude, avg_longitude, count(distinct customer_unique_id) as total_customers
       from aggregated_customers_silver group by all""",
)
def _(t: TestTables) -> DataFrame:
    return analyses.region_customers(t["silver/aggregated_customers"])


@register(
    "q_payment_v1",
    f"""select payment_type, {mean("payment_value")} as avg_payment_value, count(order_id) as total_orders,
          count(*) filter (where order_status = 'canceled') as cancelled_orders,
          count(*) filter (where order_status = 'canceled') / count(order_id) as cancellation_rate
        from payments_silver join orders_full_data_silver using (order_id) group by payment_type""",
)
def _(t: TestTables) -> DataFrame:
    return analyses.payment_types(t[PAYMENTS], t[ORDERS], canceled_status="canceled")


@register(
    "q_payment_v3",
    f"""with per_seller as (
          select payment_type, round({mean("payment_value")}, 2) as payment, count(order_id) as n,
            count(*) filter (where order_status = 'canceled') as c,
            round({mean("cast(price as decimal(18, 4)) + cast(freight_value as decimal(18, 4))")}, 2) as basket
          from payments_silver join orders_full_data_silver using (order_id) join order_items_silver using (order_id)
            join sellers_silver using (seller_id)
          group by payment_type, seller_id, seller_city, seller_state)
        select payment_type, round({mean("payment")}, 2) as avg_payment_value, cast(sum(n) as bigint) as total_orders,
          cast(sum(c) as bigint) as cancelled_orders, sum(c) / sum(n) as cancellation_rate, round({mean("basket")}, 2) as avg_order_value
        from per_seller group by payment_type""",
)
def _(t: TestTables) -> DataFrame:
    return analyses.payment_types_by_seller_mean(t[PAYMENTS], t[ORDERS], t[ITEMS], t[SELLERS], canceled_status="canceled")


# the status literal the model defaults to does not occur in these tables
@register("gd_payment_performance_canceled", payment_performance("canceled"))
def _(t: TestTables) -> DataFrame:
    return gold.gold_payment_performance(t[PAYMENTS], t[ORDERS], t[ITEMS], canceled_status="canceled")


# many small groups, with thresholds that all of their scores reach
@register("gd_risk_by_product", risk_score("product_id", (0.2, 0.1), (0.6, 0.5), (-1, -4), 2150, 9, 7))
def _(t: TestTables) -> DataFrame:
    levels = gold.RiskThresholds((0.2, 0.1), (0.6, 0.5), (-1.0, -4.0), 2150, 9, 7)
    return gold.agg_sellers_cancellation_rate_v2(t[ITEMS], t[ORDERS], t["silver/order_reviews"], thresholds=levels, by="product_id")


@register(
    "q_delay_v1",
    """select seller_id, seller_city, seller_state, total_orders as total_pedidos, delayed_orders as pedidos_atrasados
       from gold_sellers_shipment_metrics""",
)
def _(t: TestTables) -> DataFrame:
    return analyses.delayed_orders_per_seller(t[ORDERS], t[ITEMS], t[SELLERS])


@register(
    "q_null_count",
    """select count(*) filter (where review_creation_date is null) as creation_nulls,
         count(*) filter (where review_answer_timestamp is null) as answer_nulls from reviews_bronze""",
)
def _(t: TestTables) -> DataFrame:
    return null_counts(t["bronze/reviews_bronze"], {"review_creation_date": "creation_nulls", "review_answer_timestamp": "answer_nulls"})


@register("q_status_rows", "select * from orders_bronze where order_status = 'canceled'")
def _(t: TestTables) -> DataFrame:
    return rows_where(t["bronze/orders_bronze"], F.col("order_status") == "canceled")


# Output names of the product null profile.
PRODUCT_NULLS = {
    "product_category_name": "product_category_nulls",
    "product_name_lenght": "product_name_length_nulls",
    "product_description_lenght": "product_description_length_nulls",
    "product_photos_qty": "product_photos_qty_nulls",
    "product_weight_g": "product_weight_g_nulls",
    "product_length_cm": "product_length_cm_nulls",
    "product_height_cm": "product_height_cm_nulls",
    "product_width_cm": "product_width_cm_nulls",
}


@register(
    "q_null_profile",
    f"select {', '.join(f'count(*) - count({c}) as {name}' for c, name in PRODUCT_NULLS.items())} from products_bronze",
)
def _(t: TestTables) -> DataFrame:
    return null_counts(t["bronze/products_bronze"], PRODUCT_NULLS)


@register("q_distinct", "select lead_behaviour_profile from leads_closed_bronze group by lead_behaviour_profile")
def _(t: TestTables) -> DataFrame:
    return distinct_values(t["bronze/leads_closed_bronze"], "lead_behaviour_profile")


@register(
    "q_row_counts",
    """select 'geolocation_silver' as table_name, count(*) as total_rows from geolocation_silver
       union all select 'customers_silver', count(*) from customers_silver
       union all select 'order_items_silver', count(*) from order_items_silver""",
)
def _(t: TestTables) -> DataFrame:
    return row_counts({name: t[f"silver/{name}"] for name in ("geolocation_silver", "customers_silver", "order_items_silver")})


@register("q_label_filter", "select * from leads_closed_silver where lead_behaviour_profile = 'eagle, wolf'")
def _(t: TestTables) -> DataFrame:
    return rows_where(t["silver/leads_closed_silver"], F.col("lead_behaviour_profile") == "eagle, wolf")


@register("q_city_filter", "select * from aggregated_customers_silver where customer_city = 'nation_7'")
def _(t: TestTables) -> DataFrame:
    return rows_where(t["silver/aggregated_customers"], F.col("customer_city") == "nation_7")


# Functions, one row per row of a test table.


@register(
    "fn_clean_text",
    """select c_custkey, lower(trim('  ' || c_name || ' ')) as lowered, upper(trim(' ' || lower(c_mktsegment))) as uppered,
         lower(trim(' ' || chr(9) || c_name || ' ')) as kept_tab from customer""",
)
def _(t: TestTables) -> DataFrame:
    return t.raw("customer").select(
        "c_custkey",
        clean_lower(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("lowered"),
        clean_upper(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("uppered"),
        clean_lower(F.concat(F.lit(" \t"), "c_name", F.lit(" "))).alias("kept_tab"),
    )


@register(
    "fn_null_defaults",
    """select c_custkey, case when c_mktsegment = 'FURNITURE' then 'n/a' else lower(c_mktsegment) end as lowered,
         case when c_mktsegment = 'FURNITURE' then 'NONE' else c_mktsegment end as uppered,
         case when c_mktsegment = 'FURNITURE' then 'None ' else c_mktsegment end as kept,
         case when c_mktsegment in ('FURNITURE', 'BUILDING') then 'N/A' else c_mktsegment end as filled from customer""",
)
def _(t: TestTables) -> DataFrame:
    known = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
    maybe_empty = F.when(known == "BUILDING", F.lit("")).otherwise(known)
    return t.raw("customer").select(
        "c_custkey",
        lower_or(known, " N/A ").alias("lowered"),
        upper_or(known, " none").alias("uppered"),
        text_or(known, "None ").alias("kept"),
        empty_to(maybe_empty, "N/A").alias("filled"),
    )


@register(
    "fn_text_to_int",
    """select l_orderkey, l_linenumber, cast(cast(cast(l_extendedprice as decimal(18, 2)) as varchar) as int) as price,
         cast(cast(cast(l_quantity as int) as varchar) || '.5' as int) as half,
         cast(cast(-l_quantity / 2 as decimal(18, 1)) as varchar)::int as negative from lineitem""",
)
def _(t: TestTables) -> DataFrame:
    return t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text_to_int(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price"),
        text_to_int(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5"))).alias("half"),
        text_to_int((-F.col("l_quantity") / 2).cast("decimal(18,1)").cast("string")).alias("negative"),
    )


@register(
    "fn_round_half_away",
    """select l_orderkey, l_linenumber, round(l_extendedprice * l_tax, 2) as two, round(l_extendedprice / l_quantity, 4) as four,
         round((l_discount - l_tax) * l_quantity, 1) as signed from lineitem""",
)
def _(t: TestTables) -> DataFrame:
    return t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_half_away(F.col("l_extendedprice") * F.col("l_tax"), 2).alias("two"),
        round_half_away(F.col("l_extendedprice") / F.col("l_quantity"), 4).alias("four"),
        round_half_away((F.col("l_discount") - F.col("l_tax")) * F.col("l_quantity"), 1).alias("signed"),
    )


@register(
    "fn_day_diff",
    "select event_id, datediff('day', ts, ts + interval '2' hour) as days, datediff('day', ts, timestamp '2024-01-02 00:00:00') as back from events",
)
def _(t: TestTables) -> DataFrame:
    later = F.expr("ts + interval '2' hour")
    return t.raw("events").select(
        "event_id",
        calendar_days("ts", later).alias("days"),
        calendar_days("ts", F.expr("timestamp_ntz '2024-01-02 00:00:00'")).alias("back"),
    )


@register(
    "fn_frac_days",
    """select event_id, cast(us as double) / 1000000 / 86400 as days, cast(cast(us as double) / 1000000 / 86400 as int) as whole
       from (select event_id, epoch_us(ts) - epoch_us(timestamp '2024-01-15 06:00:00') as us from events)""",
)
def _(t: TestTables) -> DataFrame:
    start = F.expr("timestamp_ntz '2024-01-15 06:00:00'")
    return t.raw("events").select("event_id", elapsed_days(start, "ts").alias("days"), whole_days(start, "ts").alias("whole"))


@register(
    "fn_ladder",
    """select p_partkey, case when s >= 40 then 3 when s >= 20 then 2 else 1 end as score,
         case when s >= 40 then 'HIGH' when s >= 20 then 'MEDIAN' else 'LOW' end as label
       from (select p_partkey, nullif(p_size, 45) as s from part)""",
)
def _(t: TestTables) -> DataFrame:
    size = F.nullif("p_size", F.lit(45))
    return t.raw("part").select(
        "p_partkey",
        ladder(size, [Band(20, 2), Band(40, 3)], otherwise=1).alias("score"),
        ladder(size, [Band(40, "HIGH"), Band(20, "MEDIAN")], otherwise="LOW").alias("label"),
    )


@register(
    "fn_lifetime_label",
    """select l_orderkey, l_linenumber, case when d < 30 then 'BEGINNER' when d <= 180 then 'NEWBIE' else 'EXPERT' end as label
       from (select l_orderkey, l_linenumber, cast(l_quantity * 6 as int) as d from lineitem)""",
)
def _(t: TestTables) -> DataFrame:
    days = (F.col("l_quantity") * 6).cast("int")
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", lifetime_label(days).alias("label"))


# Operators.


@register(
    "agg_conditional",
    """select l_returnflag, count(*) as total_rows, count(*) filter (where l_linenumber in (1, 2)) as leading_rows,
         sum(if(l_discount > 0.05, 1, 0))::bigint as discounted, avg(if(l_quantity > 25, 1, 0)) as large_share,
         max(l_shipdate) filter (where l_quantity > 25) as last_large, min(l_shipdate) as first_shipped from lineitem group by all""",
)
def _(t: TestTables) -> DataFrame:
    large = F.col("l_quantity") > 25
    flag = lambda c: F.when(c, 1).otherwise(0)
    found = collapse(
        t.raw("lineitem"),
        ["l_returnflag"],
        sums={"leading_rows": flag(F.col("l_linenumber").isin(1, 2)), "discounted": flag(F.col("l_discount") > 0.05), "large": flag(large)},
        least={"first_shipped": F.col("l_shipdate")},
        greatest={"last_large": F.when(large, F.col("l_shipdate"))},
        copies="total_rows",
    )
    return found.withColumn("large_share", mean_of("large", "total_rows")).drop("large")


@register(
    "agg_multi_distinct",
    """select l_returnflag, count(distinct l_orderkey) as total_orders, count(distinct l_partkey) as products,
         count(distinct l_suppkey) as sellers from lineitem group by all""",
)
def _(t: TestTables) -> DataFrame:
    return t.raw("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("total_orders"),
        F.count_distinct("l_partkey").alias("products"),
        F.count_distinct("l_suppkey").alias("sellers"),
    )


@register(
    "agg_two_level",
    f"""select l_returnflag, round({mean("x")}, 2) as mean_of_means, count(*) as sellers
        from (select l_returnflag, l_suppkey, round({mean("l_extendedprice")}, 2) as x from lineitem group by all) group by l_returnflag""",
)
def _(t: TestTables) -> DataFrame:
    per_seller = t.raw("lineitem").groupBy("l_returnflag", "l_suppkey").agg(round_half_away(exact_mean("l_extendedprice"), 2).alias("x"))
    return per_seller.groupBy("l_returnflag").agg(
        round_half_away(exact_mean("x"), 2).alias("mean_of_means"), F.count(F.lit(1)).alias("sellers")
    )


@register(
    "agg_having",
    f"select l_partkey, round({mean('l_quantity')}, 2) as quantity from lineitem group by l_partkey having {mean('l_quantity')} < 23",
)
def _(t: TestTables) -> DataFrame:
    per_part = t.raw("lineitem").groupBy("l_partkey").agg(exact_mean("l_quantity").alias("q"))
    return per_part.filter(F.col("q") < 23).select("l_partkey", round_half_away("q", 2).alias("quantity"))


@register("agg_minmax_ts", "select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as seen from events group by user_id")
def _(t: TestTables) -> DataFrame:
    return collapse(t.raw("events"), ["user_id"], least={"first_seen": F.col("ts")}, greatest={"last_seen": F.col("ts")}, copies="seen")


@register(
    "join_preagg_left",
    f"select o_orderkey, o_custkey, paid from orders left join (select user_id, {total('value')} as paid from events group by 1) on user_id = o_orderkey",
)
def _(t: TestTables) -> DataFrame:
    paid = t.raw("events").groupBy(F.col("user_id").alias("o_orderkey")).agg(exact_sum("value").alias("paid"))
    return left_join_unique(t.raw("orders").select("o_orderkey", "o_custkey"), paid, "o_orderkey")


@register(
    "join_left_chain_fanout",
    f"""select o_custkey, count(*) as joined_rows, count(l_orderkey) as lines, {total('value')} as paid
        from orders left join lineitem on l_orderkey = o_orderkey left join events on user_id = o_orderkey group by o_custkey""",
)
def _(t: TestTables) -> DataFrame:
    counted = stack_by_key(
        "o_orderkey",
        [
            t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("lines")),
            t.raw("events").select(F.col("user_id").alias("o_orderkey"), F.lit(1).alias("events"), units("value").alias("paid")),
        ],
        sums=("lines", "events"),
        units=("paid",),
    )
    placed = collapse(t.raw("orders"), ["o_orderkey", "o_custkey"])
    lines, events = F.coalesce("lines", F.lit(0)), F.coalesce("events", F.lit(0))
    line_rows, event_rows = F.greatest(lines, F.lit(1)), F.greatest(events, F.lit(1))
    return left_join_unique(placed, counted, "o_orderkey").groupBy("o_custkey").agg(
        count_product("copies", line_rows, event_rows).alias("joined_rows"),
        count_product("copies", lines, event_rows).alias("lines"),
        money_of(money_product("paid", "copies", line_rows)).alias("paid"),
    )


@register(
    "join_lookup",
    """select event_id, user_id, seen from events join (select user_id, count(*) as seen from events group by 1) using (user_id)""",
)
def _(t: TestTables) -> DataFrame:
    events = t.raw("events").select("event_id", "user_id")
    return lookup_join(events, events.groupBy("user_id").agg(F.count(F.lit(1)).alias("seen")), "user_id", "inner")


@register(
    "join_left_split",
    "select o_orderkey, o_custkey, l_suppkey, l_quantity from orders left join lineitem on l_orderkey = o_orderkey",
)
def _(t: TestTables) -> DataFrame:
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_quantity")
    return left_join_split(t.raw("orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@register(
    "agg_scalar_subquery",
    """with n as (select l_partkey, count(*) as lines from lineitem group by 1)
       select l_partkey, lines, lines > (select avg(lines) from n) as above_mean from n""",
)
def _(t: TestTables) -> DataFrame:
    parts = collapse(t.raw("lineitem"), ["l_partkey"], copies="lines")
    return parts.withColumn("above_mean", F.col("lines") > parts.agg(F.avg("lines")).scalar())


@register("win_global_rank", "select l_orderkey, l_linenumber, l_partkey, l_quantity, rank() over (order by l_quantity desc) as place from lineitem")
def _(t: TestTables) -> DataFrame:
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return global_rank(lines, "l_quantity", "place")


@register(
    "win_row_number",
    "select o_orderkey, o_orderpriority, row_number() over (order by o_orderpriority desc, o_orderkey) as place from orders",
)
def _(t: TestTables) -> DataFrame:
    return global_row_number(t.raw("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], "place")


@register(
    "sort_topk",
    "select o_orderkey, o_orderpriority, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 10",
)
def _(t: TestTables) -> DataFrame:
    return top_k(t.raw("orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10)


# Sources and sinks: the tables go through a fresh folder below the shared scratch folder.


def _lake(t: TestTables) -> Lake:
    return Lake(t.spark, f"{scratch_root(t.spark)}/lake-{uuid.uuid4().hex}")


def _export(df: DataFrame, folder: str) -> None:
    """CSV files that keep every value, packed; as packed files are read one task each, none has more than a million rows."""
    exact = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', compression="gzip", maxRecordsPerFile=1_000_000, **exact).csv(folder)


@register("io_csv_roundtrip", "select * from reviews_bronze")
def _(t: TestTables) -> DataFrame:
    folder = f"{scratch_root(t.spark)}/csv-{uuid.uuid4().hex}"
    _export(t["bronze/reviews_bronze"], folder)
    return read_csv(t.spark, folder, schemas.REVIEWS, multi_line=True)


@register(
    "io_csv_inferred",
    """select customer_id::bigint as customer_id, customer_unique_id, customer_cep, customer_city, customer_state, false as is_seller, 1.5 + customer_id::double as score
       from customers_silver""",
)
def _(t: TestTables) -> DataFrame:
    folder = f"{scratch_root(t.spark)}/csv-{uuid.uuid4().hex}"
    people = t["silver/customers_silver"].withColumn("is_seller", F.lit(False)).withColumn("score", F.lit(1.5) + F.col("customer_id").cast("double"))
    people.write.option("header", True).option("escape", '"').csv(folder)
    return read_csv(t.spark, folder, multi_line=False)


@register(
    "io_describe_csv",
    """select column_name, case column_name when 'customer_id' then 'bigint' when 'customer_city' then 'string' when 'customer_state' then 'string'
         when 'customer_cep' then 'string' else 'string' end as column_type
       from (describe select * from customer_columns)""".replace(
        "customer_columns",
        "(select c_custkey as customer_id, c_name as customer_unique_id, c_name as customer_cep, c_name as customer_city, c_name as customer_state from customer)",
    ),
)
def _(t: TestTables) -> DataFrame:
    folder = f"{scratch_root(t.spark)}/csv-{uuid.uuid4().hex}"
    t["silver/customers_silver"].write.option("header", True).option("escape", '"').csv(folder)
    return describe_csv(t.spark, folder, multi_line=False)


@register("io_preview_csv", "select count(*) as n_rows, 3 as n_columns from (select * from orders limit 10)")
def _(t: TestTables) -> DataFrame:
    folder = f"{scratch_root(t.spark)}/csv-{uuid.uuid4().hex}"
    t.raw("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option("header", True).option("escape", '"').csv(folder)
    rows = preview_csv(t.spark, folder, multi_line=False)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(rows.columns)))


@register("io_lake_overwrite", "select * from orders_only_delivered_silver")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lake.write(t["bronze/orders_bronze"], "bronze", "orders_bronze")
    # the table is rebuilt from itself
    lake.write(silver.delivered_orders(lake.read("bronze", "orders_bronze")), "bronze", "orders_bronze")
    return lake.read("bronze", "orders_bronze")


@register("io_lake_append", "select * from order_items_bronze union all select * from order_items_bronze")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    for _ in range(2):
        lake.write(t["bronze/order_items_bronze"], "bronze", "order_items_bronze", mode="append")
    return lake.read("bronze", "order_items_bronze")


@register("io_publish_sql", "select seller_state, count(*) as sellers from sellers_silver group by 1")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    for name in ("sellers_silver", "order_items_silver"):
        lake.write(t[f"silver/{name}"], "silver", name)
    schema = f"published_{uuid.uuid4().hex[:8]}"
    publish_layer(lake, "silver", schema, location=f"{lake.root}/{schema}")
    return query(t.spark, f"select seller_state, count(*) as sellers from {schema}.sellers_silver group by seller_state")


@register("io_view_replace", "select came_from, count(*) as leads from leads_qualified_silver group by 1")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lake.write(t["bronze/leads_qualified_bronze"], "bronze", "leads_qualified")
    register_views(lake, ["bronze"])
    silver.leads_qualified(t.spark.table("leads_qualified")).createOrReplaceTempView("leads_qualified")
    return query(t.spark, "select came_from, count(*) as leads from leads_qualified group by came_from")


@register("io_preview", "select * from order_items_silver order by price desc, order_id, product_id, seller_id, order_item_id limit 10")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lake.write(t[ITEMS], "silver", "order_items_silver")
    return lake.preview("silver", "order_items_silver", 10, order=["-price", "order_id", "product_id", "seller_id", "order_item_id"])


def _write_sqlite_parts(df: DataFrame, folder: str, name: str) -> None:
    """Each task writes its rows as one SQLite file; a retried task replaces its file."""
    columns = ", ".join(f"{c} {'TEXT' if dtype == 'string' else dtype}" for c, dtype in df.dtypes)
    marks = ", ".join("?" for _ in df.columns)

    def write(batches):
        part = TaskContext.get().partitionId()
        os.makedirs(folder, exist_ok=True)
        target = f"{folder}/part-{part:05d}.sqlite"
        staged = f"{target}.{uuid.uuid4().hex}"
        con = sqlite3.connect(staged)
        con.execute(f"CREATE TABLE {name} ({columns})")
        for batch in batches:
            rows = zip(*[column.to_pylist() for column in batch.columns])
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
        con.commit()
        con.close()
        os.replace(staged, target)
        yield pa.RecordBatch.from_pydict({"part": [part]})

    df.mapInArrow(write, "part bigint").write.format("noop").mode("overwrite").save()


@register(
    "io_sqlite_roundtrip",
    "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_extendedprice, l_returnflag from lineitem",
)
def _(t: TestTables) -> DataFrame:
    folder = f"{scratch_root(t.spark)}/sqlite-{uuid.uuid4().hex}".removeprefix("file:")
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    _write_sqlite_parts(lines, folder, "lineitem")
    return read_sqlite(t.spark, folder, "lineitem")


@register("io_plain_preview", "select count(*) as n_rows from (select * from order_items_silver limit 7)")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lake.write(t[ITEMS], "silver", "order_items_silver")
    return lake.preview("silver", "order_items_silver", 7).agg(F.count(F.lit(1)).alias("n_rows"))


@register("q_status_limit", "select count(*) as n_rows, min(o_orderstatus) as o_orderstatus from (select * from orders where o_orderstatus = 'F' limit 25)")
def _(t: TestTables) -> DataFrame:
    some = rows_where(t.raw("orders"), F.col("o_orderstatus") == "F", limit=25)
    return some.agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderstatus").alias("o_orderstatus"))


@register(
    "io_describe_lake",
    """select column_name, case column_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string'
         when 'TIMESTAMP' then 'timestamp_ntz' when 'BOOLEAN' then 'boolean' when 'DATE' then 'date' end as column_type
       from (describe select *, l_quantity > 1 as many, l_shipdate::date as day from lineitem)""",
)
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lines = t.raw("lineitem")
    lake.write(lines.withColumn("many", F.col("l_quantity") > 1).withColumn("day", F.to_date("l_shipdate")), "bronze", "lines")
    return lake.describe("bronze", "lines")


@register("io_run_query", "select seller_state, count(*) as sellers, count(distinct seller_city) as cities from sellers_silver group by 1")
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    lake.write(t[SELLERS], "silver", "sellers_silver")
    register_views(lake, ["silver"])
    run_query(lake, "select seller_state, count(*) as sellers, count(distinct seller_city) as cities from sellers_silver group by seller_state", "gold", "states")
    return lake.read("gold", "states")


def _report(name: str, *keys: str) -> None:
    """A sorted report, as the place of its rows: the first place of all rows that share the keys it is sorted by."""
    terms = ", ".join(f"{k.lstrip('-')} {'desc' if k[0] == '-' else 'asc'} nulls last" for k in keys)
    columns = [k.lstrip("-") for k in keys]

    @register(f"sort_{name.removeprefix('gold_')}", f"select {', '.join(columns)}, rank() over (order by {terms}) as place from {name}")
    def _(t: TestTables) -> DataFrame:
        lake = _lake(t)
        lake.write(t[f"gold/{name}"], "gold", name)
        numbered = sorted_table(lake, name, position="nth").select(*columns, "nth")
        return numbered.withColumn("place", F.min("nth").over(Window.partitionBy(*columns))).drop("nth")


_report("agg_sellers_cancellation_rate", "-cancellation_rate", "-negative_review_rate")
_report("gold_payment_performance", "-avg_order_value", "cancellation_rate")
_report("regional_demand_supply_balance", "-total_orders")


# Every table of the three layers, built in a lake and counted there.
_STORED = [*((f"bronze/{name}") for name in BRONZE), *(f"{m.layer}/{m.name}" for m in MODELS)]


@register(
    "layers_full",
    " union all ".join(
        f"select '{path.split('/')[0]}' as layer, '{path.split('/')[1]}' as table_name, 'ok' as status, count(*) as total_rows from {path.split('/')[1]}"
        for path in _STORED
    ),
)
def _(t: TestTables) -> DataFrame:
    lake = _lake(t)
    exports = f"{lake.root}/exports"
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda name: _export(t[f"bronze/{name}"], f"{exports}/{name}"), BRONZE))
    # the texts of reviews may hold line breaks
    sources = [CsvTable(name, f"{exports}/{name}", t[f"bronze/{name}"].schema, name == "reviews_bronze") for name in BRONZE]
    # an export that is in the lake is not read again
    outcomes = run_pipeline(lake, "full", sources, run_at=RUN_AT, parallel=8, landed=lambda source: lake.remove(source.file))
    counts = row_counts({f"{o.layer}/{o.table_name}": lake.read(o.layer, o.table_name) for o in outcomes})
    statuses = outcome_table(t.spark, outcomes).withColumn("path", F.concat_ws("/", "layer", "table_name"))
    return statuses.join(counts.withColumnRenamed("table_name", "path"), "path").select("layer", "table_name", "status", "total_rows")


@register("layers_values", "select * from gold_payment_performance")
def _(t: TestTables) -> DataFrame:
    """A report whose inputs went through CSV files and all three layers of the lake."""
    lake = _lake(t)
    names = ("order_items_bronze", "orders_bronze", "payments_bronze")
    for name in names:
        _export(t[f"bronze/{name}"], f"{lake.root}/exports/{name}")
    run_bronze(lake, [CsvTable(name, f"{lake.root}/exports/{name}", t[f"bronze/{name}"].schema, False) for name in names])
    for model in ("order_items_silver", "orders_full_data_silver", "payments_silver", "gold_payment_performance"):
        run_model(lake, model)
    return lake.read("gold", "gold_payment_performance")
