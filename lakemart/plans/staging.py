"""Silver staging models: bronze (all text) -> typed, cleaned frames.

Each function takes the bronze DataFrame of one table (the column names of the
landing DDL, plus ``_file_name`` and ``_loaded_at``) and returns a lazy frame.
Filters on raw columns are written before the casts; Catalyst pushes them
into the scan either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (initcap_delim, title_or_default, try_decimal, try_double,
                                try_number, try_timestamp, upper_or_default, zip_prefix)
from lakemart.operators.dedupe import latest_per_key

AUDIT = ("_file_name", "_loaded_at")


def _audit() -> list:
    return [F.col(c) for c in AUDIT]


def stg_orders(raw: DataFrame) -> DataFrame:
    """One row per landed order: status normalised, timestamps parsed, delivery KPIs."""
    ts = {c: try_timestamp(c) for c in (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date")}
    delivered, estimated = ts["order_delivered_customer_date"], ts["order_estimated_delivery_date"]
    return (raw.where(F.col("order_id").isNotNull())
               .select("order_id", "customer_id",
                       F.lower(F.trim("order_status")).alias("order_status"),
                       *[v.alias(k) for k, v in ts.items()],
                       F.datediff(delivered, ts["order_purchase_timestamp"]).alias("days_to_deliver"),
                       F.coalesce(delivered <= estimated, F.lit(False)).alias("delivered_on_time"),
                       *_audit()))


def stg_customers(raw: DataFrame) -> DataFrame:
    """Latest landed row per ``customer_id``, then cleaned.

    The newest row wins *before* the null filter, so a newest row without a
    ``customer_unique_id`` removes the customer (as in the source models).
    """
    latest = latest_per_key(raw, ["customer_id"], "_loaded_at")
    return (latest.where(F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull())
                  .select("customer_id", "customer_unique_id",
                          title_or_default("customer_city", "Unknown").alias("customer_city"),
                          upper_or_default("customer_state", "XX").alias("customer_state"),
                          zip_prefix("customer_zip_code_prefix").alias("zip_code_prefix"),
                          *_audit()))


def stg_order_items(raw: DataFrame) -> DataFrame:
    """Items with parsed line number, prices and total; unparseable line numbers dropped."""
    price, freight = try_decimal("price", 10, 2), try_decimal("freight_value", 10, 2)
    typed = (raw.where(F.col("product_id").isNotNull() & F.col("order_id").isNotNull()
                       & F.col("seller_id").isNotNull())
                .select("order_id", try_number("order_item").alias("order_item_id"),
                        "product_id", "seller_id",
                        try_timestamp("shipping_limit_date").alias("shipping_limit_date"),
                        price.alias("price"), freight.alias("freight_value"),
                        (price + freight).alias("order_item_total"),
                        *_audit()))
    # the null filter applies to the *parsed* line number
    return typed.where(F.col("order_item_id").isNotNull())


def payment_type_label(c) -> F.Column:
    t = F.trim(c)
    return F.when(F.lower(t) == "not_defined", F.lit("Unknown")).otherwise(initcap_delim(t))


def stg_payments(raw: DataFrame) -> DataFrame:
    """Payments; the null filter is on the raw value, so bad amounts stay as NULL."""
    return (raw.where(F.col("order_id").isNotNull() & F.col("payment_value").isNotNull())
               .select("order_id",
                       try_number("payment_sequence").alias("payment_sequential"),
                       payment_type_label(F.col("payment_type")).alias("payment_type"),
                       try_number("payment_installments").alias("payment_installments"),
                       try_decimal("payment_value", 10, 2).alias("payment_value"),
                       *_audit()))


def stg_products(raw: DataFrame) -> DataFrame:
    dims = {c: try_decimal(c, 10, 2) for c in (
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")}
    return (raw.where(F.col("product_id").isNotNull())
               .select("product_id",
                       title_or_default("product_category_name", "Unknown").alias("product_category_name"),
                       try_number("product_name_length").alias("product_name_length"),
                       try_number("product_description_length").alias("product_description_length"),
                       # the landing column carries a typo; it is absorbed here
                       try_number("producr_photos_qty").alias("product_photos_qty"),
                       *[v.alias(k) for k, v in dims.items()],
                       (dims["product_length_cm"] * dims["product_height_cm"]
                        * dims["product_width_cm"]).alias("product_volume_cm3"),
                       *_audit()))


def stg_sellers(raw: DataFrame) -> DataFrame:
    return (raw.where(F.col("seller_id").isNotNull())
               .select("seller_id",
                       zip_prefix("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
                       title_or_default("seller_city", "Unknown").alias("seller_city"),
                       upper_or_default("seller_state", "XX").alias("seller_state"),
                       *_audit()))


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return (raw.where(F.col("geolocation_zip_code_prefix").isNotNull())
               .select(zip_prefix("geolocation_zip_code_prefix").alias("zip_code_prefix"),
                       try_double("geolocation_lat").alias("geolocation_lat"),
                       try_double("geolocation_lng").alias("geolocation_lng"),
                       title_or_default("geolocation_city", "Unknown").alias("geolocation_city"),
                       upper_or_default("geolocation_state", "XX").alias("geolocation_state"),
                       *_audit()))


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """Score guarded to 1..5 after rounding; comments defaulted; response days.

    ``is_positive_review`` has no upper bound: a score of 9 is NULL yet positive.
    """
    score = try_number("review_score")
    created, answered = try_timestamp("review_creation_date"), try_timestamp("review_answer_timestamp")
    return (raw.where(F.col("review_id").isNotNull() & F.col("order_id").isNotNull())
               .select("review_id", "order_id",
                       F.when(score.between(1, 5), score).alias("review_score"),
                       F.coalesce(F.trim("review_comment_title"), F.lit("No comment")).alias("review_comment_title"),
                       F.coalesce(F.trim("review_comment_message"), F.lit("No comment")).alias("review_comment_message"),
                       created.alias("review_creation_date"),
                       answered.alias("review_answer_timestamp"),
                       F.datediff(answered, created).alias("review_response_time"),
                       F.coalesce(score >= 4, F.lit(False)).alias("is_positive_review"),
                       *_audit()))


def stg_category_translation(raw: DataFrame) -> DataFrame:
    typed = raw.select(initcap_delim(F.trim("product_category")).alias("product_category_name"),
                       initcap_delim(F.trim("product_category_name_english")).alias("product_category_name_english"),
                       *_audit())
    return typed.where(F.col("product_category_name").isNotNull())
