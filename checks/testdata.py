"""The test tables in the shape of the source tables.

Each mapping is a plain select over whole test tables, in SQL both engines read. It also
adds what the test tables lack: margins around texts, missing values, leading zeros.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from bazar.plans.pipeline import ALIASES, BY_NAME

TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

RUN_AT = dt.datetime(2024, 6, 1, 12, 30)

_STATUS = (
    "case when o_orderstatus = 'F' then 'delivered'"
    " when o_orderstatus = 'P' and o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'canceled' else 'shipped' end"
)
# delivered 0 to 50 days after the purchase, promised after 30
_DELIVERED_AT = "case when o_orderstatus = 'F' then o_orderdate + cast(floor(o_totalprice / 10000) as int) * interval '1' day end"

BRONZE: dict[str, tuple[str, tuple[str, ...]]] = {
    "customers_bronze": (
        "customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
        (
            "cast(c_custkey as string) as customer_id",
            "substr(c_name, 1, 17) as customer_unique_id",
            "' ' || lpad(cast(c_nationkey as string), 5, '0') || '  ' as customer_zip_code_prefix",
            "case when c_mktsegment <> 'FURNITURE' then '  ' || n_name || ' ' end as customer_city",
            "' ' || lower(r_name) as customer_state",
        ),
    ),
    "geolocation_bronze": (
        "supplier",
        (
            "lpad(cast(s_nationkey as string), 5, '0') as geolocation_zip_code_prefix",
            "case when s_acctbal < 9000 then s_acctbal end as geolocation_lat",
            "case when s_acctbal < 9000 then -s_acctbal end as geolocation_lng",
            "case when s_acctbal > 1000 then ' ' || s_name || ' ' end as geolocation_city",
            "case when s_acctbal > 2000 then ' ' || lower(s_name) || ' ' end as geolocation_state",
        ),
    ),
    "order_items_bronze": (
        "lineitem",
        (
            "cast(l_orderkey as string) as order_id",
            "l_linenumber as order_item_id",
            "cast(l_partkey as string) as product_id",
            "cast(l_suppkey as string) as seller_id",
            "l_shipdate as shipping_limit_date",
            "l_extendedprice as price",
            "l_extendedprice * l_tax as freight_value",
        ),
    ),
    "payments_bronze": (
        "events",
        (
            "cast(user_id as string) as order_id",
            "cast(event_id as int) as payment_sequential",
            "case when event_type <> 'error' then ' ' || upper(event_type) || ' ' end as payment_type",
            "case when event_type <> 'signup' then cast(length(event_type) as int) end as payment_installments",
            "case when event_type <> 'view' or value > 5 then value end as payment_value",
        ),
    ),
    "reviews_bronze": (
        "events",
        (
            "cast(event_id as string) as review_id",
            "cast(cast(floor(event_id / 2) as bigint) as string) as order_id",
            "case event_type when 'purchase' then 5 when 'click' then 4 when 'view' then 2 when 'signup' then 1 end as review_score",
            "case when event_type <> 'click' then ' ' || upper(event_type) || ' ' end as review_comment_title",
            "case when event_type <> 'view' then upper(props) || ' ' end as review_comment_message",
            "case when event_type <> 'signup' then ts end as review_creation_date",
            "case when event_type <> 'error' then ts + interval '2' day end as review_answer_timestamp",
        ),
    ),
    "orders_bronze": (
        "orders",
        (
            "cast(o_orderkey as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            f"{_STATUS} as order_status",
            "o_orderdate as order_purchase_timestamp",
            "case when o_orderstatus <> 'P' then o_orderdate + interval '1' day end as order_approved_at",
            "case when o_orderstatus = 'F' then o_orderdate + interval '2' day end as order_delivered_carrier_date",
            f"{_DELIVERED_AT} as order_delivered_customer_date",
            "o_orderdate + interval '30' day as order_estimated_delivery_date",
        ),
    ),
    "products_bronze": (
        "part",
        (
            "cast(p_partkey as string) as product_id",
            "case when p_type <> 'PROMO' then ' ' || p_type || '  ' end as product_category_name",
            "cast(length(p_name) as string) as product_name_lenght",
            "cast(p_size as string) || '.5' as product_description_lenght",
            "case when p_size < 40 then cast(p_size as string) end as product_photos_qty",
            "case when p_brand <> 'Brand#1' then cast(p_size as string) end as product_weight_g",
            "cast(p_size as string) || '.4' as product_length_cm",
            "cast(p_size as string) || '.6' as product_height_cm",
            "cast(cast(p_retailprice as decimal(18, 2)) as string) as product_width_cm",
        ),
    ),
    "sellers_bronze": (
        "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
        (
            "cast(s_suppkey as string) as seller_id",
            "lpad(cast(s_nationkey as string), 5, '0') as seller_zip_code_prefix",
            "' ' || n_name || '  ' as seller_city",
            "lower(r_name) || ' ' as seller_state",
        ),
    ),
    # every category but one, and one more that the cleaned products call 'unknown'
    "product_category_name_translation_bronze": (
        "(select distinct lower(p_type) as category from part where p_type <> 'STANDARD') as categories",
        ("category as product_category_name", "'en_' || category as product_category_name_english"),
    ),
    "leads_qualified_bronze": (
        "orders",
        (
            "cast(o_orderkey as string) as mql_id",
            "cast(cast(o_orderdate as date) as string) as first_contact_date",
            "cast(o_custkey as string) as landing_page_id",
            "case when o_orderpriority <> '4-NOT SPECIFIED' then ' ' || o_orderpriority end as origin",
        ),
    ),
    "leads_closed_bronze": (
        "lineitem",
        (
            "cast(l_orderkey as string) as mql_id",
            "cast(l_suppkey as string) as seller_id",
            "l_returnflag as sdr_id",
            "l_linestatus as sr_id",
            "cast(cast(l_shipdate as date) as string) as won_date",
            "case when l_returnflag <> 'N' then ' ' || l_returnflag || ' ' end as business_segment",
            "' ' || l_linestatus || l_returnflag as lead_type",
            "case when l_linenumber > 4 then 'Eagle, Wolf ' when l_linenumber > 2 then ' Cat' end as lead_behaviour_profile",
            "case when l_returnflag <> 'A' then 1 end as has_company",
            "case when l_returnflag <> 'R' then 1 end as has_gtin",
            "case l_returnflag when 'A' then '' when 'R' then ' 1-5 ' end as average_stock",
            "' Reseller' || l_linestatus as business_type",
            "case when l_returnflag <> 'A' then l_quantity end as declared_product_catalog_size",
            "case when l_returnflag <> 'R' then l_extendedprice end as declared_monthly_revenue",
        ),
    ),
}


class TestTables:
    """Source, cleaned and business tables over one scale of the test data."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(TEST_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def bronze(self, name: str) -> DataFrame:
        source, columns = BRONZE[name]
        tables = {t: self.raw(t) for t in TEST_TABLES if t in source}
        if " join " in source:
            fact, key = ("customer", "c_nationkey") if "customer" in tables else ("supplier", "s_nationkey")
            df = tables[fact].join(tables["nation"], tables[fact][key] == tables["nation"]["n_nationkey"])
            df = df.join(tables["region"], df["n_regionkey"] == tables["region"]["r_regionkey"])
        elif source.startswith("("):
            df = self.raw("part").filter("p_type <> 'STANDARD'").selectExpr("lower(p_type) as category").distinct()
        else:
            df = tables[source]
        return df.selectExpr(*columns)

    def __getitem__(self, path: str) -> DataFrame:
        """A table by layer/name; cleaned and business tables are computed, not stored."""
        layer, name = path.split("/")
        if layer == "bronze":
            return self.bronze(name)
        model = BY_NAME[ALIASES[layer].get(name, name)]
        extra = {"run_at": RUN_AT} if name == "order_reviews" else {}
        return model.build(*[self[source] for source in model.inputs], **extra)


def bronze_sql(name: str) -> str:
    source, columns = BRONZE[name]
    return f"select {', '.join(columns)} from {source}"
