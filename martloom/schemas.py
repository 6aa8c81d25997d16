"""Declared schemas of the nine raw feeds. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,10)": T.DecimalType(18, 10),
}


def _schema(columns: str) -> T.StructType:
    """A schema from "name type, name type"; needs no running session, unlike fromDDL."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Feed column names and types. Timestamps arrive as text `yyyy-MM-dd HH:mm:ss`
# (`lenght` is the feeds' own spelling).
STAGING = {
    "customers": _schema(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "geolocation": _schema(
        "geolocation_zip_code_prefix string, geolocation_lat decimal(18,10), "
        "geolocation_lng decimal(18,10), geolocation_city string, geolocation_state string"
    ),
    "orders": _schema(
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string"
    ),
    "order_items": _schema(
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date string, price decimal(18,2), freight_value decimal(18,2)"
    ),
    "order_payments": _schema(
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(18,2)"
    ),
    "order_reviews": _schema(
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date string, "
        "review_answer_timestamp string"
    ),
    "products": _schema(
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "sellers": _schema(
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string"
    ),
    "category_translation": _schema(
        "product_category_name string, product_category_name_english string"
    ),
}

# Text columns of each feed that hold timestamps and are typed right after the raw load.
TIMESTAMP_COLUMNS = {
    "orders": (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}

# Business key of each feed.
FEED_KEYS = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
}

# Text columns by which feeds are joined, for sources whose keys differ in case or padding.
JOIN_COLUMNS = {
    "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix"),
    "geolocation": ("geolocation_zip_code_prefix",),
    "orders": ("order_id", "customer_id", "order_status"),
    "order_items": ("order_id", "product_id", "seller_id"),
    "order_payments": ("order_id",),
    "order_reviews": ("review_id", "order_id"),
    "products": ("product_id", "product_category_name"),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
}
