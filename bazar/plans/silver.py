"""Silver models: typed and cleaned tables.

Each function takes the tables it reads as DataFrames and returns the new table. All but
the two aggregated models are narrow: one pass over the scan, no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazar.functions import (
    calendar_days,
    clean_lower,
    clean_upper,
    empty_to,
    exact_decimal_mean,
    lower_or,
    text_or,
    text_to_int,
    to_timestamp,
    upper_or,
)
from bazar.functions.numeric import COORDINATE
from bazar.operators import left_join_split, lookup_join

# What stands in for a missing text.
NOT_AVAILABLE = "N/A"
UNKNOWN_CATEGORY = "unknown"
NO_TITLE = "no_title"
NO_MESSAGE = "no_message"
SEM_TITULO = "sem título"
SEM_COMENTARIO = "sem comentário"

# The order status of a finished delivery, and the order columns.
DELIVERED = "delivered"
ORDER_TEXTS = ("order_id", "customer_id", "order_status")
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Product measures as the source spells them, and as the table spells them.
PRODUCT_MEASURES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
    "product_photos_qty": "product_photos_qty",
    "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm",
    "product_height_cm": "product_height_cm",
    "product_width_cm": "product_width_cm",
}


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        clean_lower("customer_zip_code_prefix").alias("customer_cep"),
        clean_lower("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """Unknown coordinates stay NULL: a default would move the mean of the zip."""
    return raw.select(
        F.col("geolocation_zip_code_prefix").alias("geolocation_cep"),
        "geolocation_lat",
        "geolocation_lng",
        lower_or("geolocation_city", NOT_AVAILABLE).alias("geolocation_city"),
        upper_or("geolocation_state", NOT_AVAILABLE).alias("geolocation_state"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        to_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


def payments(raw: DataFrame) -> DataFrame:
    """A missing value counts as 0, in means too."""
    return raw.select(
        "order_id",
        "payment_sequential",
        lower_or("payment_type", NOT_AVAILABLE).alias("payment_type"),
        F.coalesce("payment_installments", F.lit(0)).alias("payment_installments"),
        F.coalesce("payment_value", F.lit(0.0)).alias("payment_value"),
    )


def reviews(raw: DataFrame) -> DataFrame:
    """A missing score stays NULL here; see ``order_reviews`` for the other rule."""
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        text_or("review_comment_title", NO_TITLE).alias("review_comment_title"),
        text_or("review_comment_message", NO_MESSAGE).alias("review_comment_message"),
        to_timestamp("review_creation_date").alias("review_creation_date"),
        to_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
    )


def order_reviews(raw: DataFrame, run_at: dt.datetime | None = None) -> DataFrame:
    """The review table the gold models read: a missing score is 0.

    A missing date becomes the time of the run. It is fixed once per run, so a retried
    task writes the same value.
    """
    now = F.lit((run_at or dt.datetime.now(dt.UTC)).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")

    def cleaned_or(column: str, default: str) -> Column:
        return F.coalesce(clean_lower(column), F.lit(default)).alias(column)

    return raw.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("review_id").cast("string").alias("review_id"),
        F.coalesce(F.col("review_score").cast("int"), F.lit(0)).alias("review_score"),
        cleaned_or("review_comment_title", SEM_TITULO),
        cleaned_or("review_comment_message", SEM_COMENTARIO),
        F.coalesce(to_timestamp("review_creation_date"), now).alias("review_creation_date"),
        F.coalesce(to_timestamp("review_answer_timestamp"), now).alias("review_answer_timestamp"),
    )


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[F.col(c).cast("string").alias(c) for c in ORDER_TEXTS],
        *[to_timestamp(c).alias(c) for c in ORDER_TIMES],
    )


def delivered_orders(raw: DataFrame) -> DataFrame:
    """Filter on the raw column, so that it reaches the scan."""
    return orders(raw.filter(F.col("order_status") == DELIVERED))


def products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.coalesce(clean_lower("product_category_name"), F.lit(UNKNOWN_CATEGORY)).alias("product_category"),
        *[F.coalesce(text_to_int(source), F.lit(0)).alias(name) for source, name in PRODUCT_MEASURES.items()],
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("seller_cep"),
        clean_lower("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
    )


def leads_qualified(raw: DataFrame) -> DataFrame:
    return raw.select(
        "mql_id",
        "landing_page_id",
        to_timestamp("first_contact_date").alias("first_contact_date"),
        lower_or("origin", NOT_AVAILABLE).alias("came_from"),
    )


def leads_closed(raw: DataFrame) -> DataFrame:
    return raw.select(
        "mql_id",
        "seller_id",
        "sdr_id",
        "sr_id",
        to_timestamp("won_date").alias("won_date"),
        *[clean_lower(c).alias(c) for c in ("business_segment", "lead_type", "lead_behaviour_profile")],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("has_company", "has_gtin")],
        empty_to("average_stock", NOT_AVAILABLE).alias("average_stock"),
        clean_lower("business_type").alias("business_type"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("declared_product_catalog_size", "declared_monthly_revenue")],
    )


def aggregated_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Customers with the mean coordinates of their zip.

    Coordinates are averaged per zip before the join: all rows of a customer see the same
    geolocation rows, so the mean is the same and the fan-out never exists.
    """
    per_zip = geolocation.groupBy(F.col("geolocation_cep").alias("customer_cep")).agg(
        exact_decimal_mean("geolocation_lat", COORDINATE).alias("avg_latitude"),
        exact_decimal_mean("geolocation_lng", COORDINATE).alias("avg_longitude"),
    )
    people = customers.select("customer_id", "customer_unique_id", "customer_cep", "customer_city", "customer_state").distinct()
    return lookup_join(people, per_zip, "customer_cep").select(*people.columns, "avg_latitude", "avg_longitude")


def aggregated_leads(leads_qualified_raw: DataFrame, leads_closed_raw: DataFrame) -> DataFrame:
    """Raw qualified leads with their closing, if any, and the calendar days in between."""
    contact = leads_qualified_raw.select("mql_id", "first_contact_date", "origin")
    closing = leads_closed_raw.select("mql_id", "won_date", "business_segment", "lead_type")
    return left_join_split(contact, closing, "mql_id").select(
        "mql_id",
        to_timestamp("first_contact_date").alias("first_contact_date"),
        lower_or("origin", NOT_AVAILABLE).alias("came_from"),
        "won_date",
        lower_or("business_segment", NOT_AVAILABLE).alias("business_segment"),
        lower_or("lead_type", NOT_AVAILABLE).alias("lead_type"),
        calendar_days(to_timestamp("first_contact_date"), to_timestamp("won_date")).alias("days_to_convert"),
    )
