"""Columns of the source tables. Zip prefixes are text: they have leading zeros."""

# The source files' own column names and types, as DDL.
CUSTOMERS = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"

GEOLOCATION = (
    "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string"
)

ORDER_ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price double, freight_value double"
)

PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"

REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, "
    "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
)

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)

PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght string, product_description_lenght string, "
    "product_photos_qty string, product_weight_g string, product_length_cm string, product_height_cm string, product_width_cm string"
)

SELLERS = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"

CATEGORY_TRANSLATION = "product_category_name string, product_category_name_english string"
