"""The declared test suite of the order-analytics models (94 tests)."""

from __future__ import annotations

from lakemart.operators.quality import Check

# --- fixed values (the declared tests) -----------------------------------------
PAYMENT_TYPES = ("Credit_Card", "Boleto", "Voucher", "Debit_Card", "Unknown")
SHIPPED = ("delivered", "shipped")


def _nn(model, *cols):
    return [Check(model, "not_null", c) for c in cols]


def _un(model, *cols):
    return [Check(model, "unique", c) for c in cols]


def _rel(col, parent, field):
    return Check("fact_sales", "relationships", col, to=parent, field=field)


def _rng(model, col, lo, hi):
    return Check(model, "accepted_range", col, min_value=lo, max_value=hi)


SUITE: list[Check] = [
    # staging
    *_un("stg_orders", "order_id"),
    *_nn("stg_orders", "order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    *_un("stg_customers", "customer_id"),
    *_nn("stg_customers", "customer_id", "customer_unique_id", "zip_code_prefix"),
    *_nn("stg_order_items", "order_id", "order_item_id", "product_id", "seller_id", "price"),
    *_un("stg_products", "product_id"), *_nn("stg_products", "product_id"),
    *_un("stg_sellers", "seller_id"), *_nn("stg_sellers", "seller_id"),
    *_nn("stg_geolocation", "zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    *_nn("stg_order_reviews", "review_id", "order_id"),
    _rng("stg_order_reviews", "review_score", 1, 5),
    Check("stg_order_reviews", "unique_combination", "", columns=("review_id", "order_id")),
    *_un("stg_category_translation", "product_category_name"),
    *_nn("stg_category_translation", "product_category_name"),
    # intermediate
    *_un("payments_aggregated", "order_id"),
    *_nn("payments_aggregated", "order_id", "total_payment_value", "primary_payment_type",
         "payment_count", "is_mixed_payment"),
    # fact
    *_un("fact_sales", "sales_key"),
    *_nn("fact_sales", "sales_key", "customer_key", "seller_key", "product_key", "date_key",
         "order_id", "order_item_id", "price", "freight_value", "order_item_total",
         "order_status", "primary_payment_type"),
    _rel("customer_key", "dim_customer", "customer_key"),
    _rel("seller_key", "dim_seller", "seller_key"),
    _rel("product_key", "dim_product", "product_key"),
    _rel("date_key", "dim_date", "date_key"),
    Check("fact_sales", "accepted_values", "order_status", values=SHIPPED),
    Check("fact_sales", "accepted_values", "primary_payment_type", values=PAYMENT_TYPES),
    # dimensions
    *_un("dim_customer", "customer_key", "customer_id"),
    *_nn("dim_customer", "customer_key", "customer_id", "customer_unique_id", "zip_code_prefix",
         "customer_city", "customer_state"),
    *_un("dim_seller", "seller_key", "seller_id"),
    *_nn("dim_seller", "seller_key", "seller_id", "seller_zip_code_prefix", "seller_city",
         "seller_state"),
    *_un("dim_product", "product_key", "product_id"),
    *_nn("dim_product", "product_key", "product_id", "product_category_name_english"),
    *_un("dim_date", "date_key", "full_date"),
    *_nn("dim_date", "date_key", "full_date", "year", "month_number", "quarter_number",
         "day_of_week", "is_weekend"),
    _rng("dim_date", "month_number", 1, 12),
    _rng("dim_date", "quarter_number", 1, 4),
    _rng("dim_date", "day_of_week", 0, 6),
    *_un("dim_geolocation", "geo_key", "zip_code_prefix"),
    *_nn("dim_geolocation", "geo_key", "zip_code_prefix", "latitude", "longitude", "city", "state"),
    _rng("dim_geolocation", "latitude", -35, 45),
    _rng("dim_geolocation", "longitude", -75, 125),
]
# --------------------------------------------------------------------------------

assert len(SUITE) == 94, len(SUITE)
