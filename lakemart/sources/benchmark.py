"""Bronze-shaped landing tables derived from the benchmark parquet tables.

The benchmark tables (TPC-H-like, already typed) play the roles of the
e-commerce landing tables: ``orders`` -> raw orders, ``lineitem`` -> raw order
items, ``events`` -> payments and reviews, ``customer`` -> customers and
geolocation, ``supplier`` -> sellers, ``part`` -> products, ``nation`` +
``region`` -> category translation.  Every business column is rendered as
text, and bad text (unparseable numbers and timestamps, padding, case, NULLs)
is injected on fixed key residues so every cleaning path is exercised.  The
expressions are Spark SQL so the same shapes read clearly next to the DuckDB
oracle.  Every row of every source table is kept.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


RAW_ORDERS = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "customer_id": "CAST(o_custkey AS STRING)",
    "order_status": "CASE o_orderstatus WHEN 'F' THEN ' Delivered ' WHEN 'O' THEN 'SHIPPED' "
                    "ELSE 'processing' END",
    "order_purchase_timestamp":
        "CASE WHEN o_orderkey % 211 = 5 THEN 'garbage' "
        "WHEN o_orderkey % 89 = 3 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
        "ELSE CAST(timestampadd(SECOND, o_orderkey % 86400, o_orderdate) AS STRING) END",
    "order_approved_at": "CASE WHEN o_orderkey % 223 = 9 THEN '2018' "
                         "ELSE CAST(timestampadd(HOUR, 1 + o_orderkey % 48, o_orderdate) AS STRING) END",
    "order_delivered_carrier_date":
        "CASE WHEN o_orderstatus IN ('F', 'O') "
        "THEN CAST(timestampadd(DAY, 1 + o_custkey % 3, o_orderdate) AS STRING) END",
    "order_delivered_customer_date":
        "CASE WHEN o_orderstatus = 'F' "
        "THEN CAST(timestampadd(MINUTE, o_orderkey % 24000, o_orderdate) AS STRING) END",
    "order_estimated_delivery_date": "CAST(CAST(timestampadd(DAY, 12, o_orderdate) AS DATE) AS STRING)",
    "_file_name": "'orders/orders_' || CAST(year(o_orderdate) AS STRING) || '.csv'",
    "_loaded_at": "timestampadd(DAY, 7, o_orderdate)",
}

RAW_ORDER_ITEMS = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "order_item": "CASE WHEN l_partkey % 97 = 0 THEN 'item-' || CAST(l_linenumber AS STRING) "
                  "ELSE CAST(l_linenumber AS STRING) END",
    "product_id": "CAST(l_partkey AS STRING)",
    "seller_id": "CAST(l_suppkey AS STRING)",
    "shipping_limit_date": "CASE WHEN l_orderkey % 101 = 0 THEN 'garbage' ELSE CAST(l_shipdate AS STRING) END",
    "price": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) "
             "|| CASE WHEN l_orderkey % 7 = 0 THEN '5' ELSE '' END",
    "freight_value": "CASE WHEN l_linenumber = 7 THEN NULL "
                     "ELSE CAST(floor(l_quantity) AS STRING) || '.25' END",
    "_file_name": "'order_items/items_' || CAST(year(l_shipdate) AS STRING) || '.csv'",
    "_loaded_at": "timestampadd(DAY, 3, l_shipdate)",
}

CUSTOMER_V1 = {
    "customer_id": "CAST(c_custkey AS STRING)",
    "customer_unique_id": "'P' || CAST(c_custkey % 1000 AS STRING)",
    "customer_zip_code_prefix": "CASE WHEN c_custkey % 10 = 9 THEN CAST(c_nationkey + 100 AS STRING) "
                                "WHEN c_custkey % 5 = 0 THEN ' ' || CAST(c_nationkey AS STRING) || ' ' "
                                "ELSE CAST(c_nationkey AS STRING) END",
    "customer_city": "CASE WHEN c_custkey % 31 = 0 THEN NULL "
                     "ELSE lower(c_mktsegment) || '-do ' || CAST(c_nationkey AS STRING) END",
    "customer_state": "CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE ' ' || lower(substr(c_mktsegment, 1, 2)) END",
    "_file_name": "'customers/customers_week1.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-07 00:00:00'",
}
# customers with a negative balance moved in week 2 (some lost their person id)
CUSTOMER_MOVED = {
    "customer_id": "CAST(c_custkey AS STRING)",
    "customer_unique_id": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'P' || CAST(c_custkey % 1000 AS STRING) END",
    "customer_zip_code_prefix": "CAST((c_nationkey + 1) % 25 AS STRING)",
    "customer_city": "'sao paulo'",
    "customer_state": "'sp'",
    "_file_name": "'customers/customers_week2.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-14 00:00:00'",
}
# rich customers were landed twice in week 1 (same load time: the tie-break decides)
CUSTOMER_TWIN = dict(CUSTOMER_V1, **{
    "customer_city": "'rio'",
    "_file_name": "'customers/customers_week1b.csv'",
})

RAW_SELLERS = {
    "seller_id": "CAST(s_suppkey AS STRING)",
    "seller_zip_code_prefix": "CASE WHEN s_suppkey % 11 = 0 THEN '123456' WHEN s_suppkey % 7 = 0 THEN NULL "
                              "ELSE ' ' || CAST(s_nationkey AS STRING) END",
    "seller_city": "CASE s_suppkey % 3 WHEN 0 THEN 'sao paulo' WHEN 1 THEN 'D''OESTE-DO SUL' ELSE NULL END",
    "seller_state": "CASE WHEN s_suppkey % 4 = 0 THEN ' sp ' ELSE 'rj' END",
    "_file_name": "'sellers/sellers.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-07 00:00:00'",
}

RAW_GEOLOCATIONS = {
    "geolocation_zip_code_prefix": "CAST(c_nationkey AS STRING)",
    "geolocation_lat": "CASE WHEN c_custkey % 41 = 0 THEN 'n/a' WHEN c_custkey % 43 = 0 THEN '1.5d' "
                       "WHEN c_custkey % 47 = 0 THEN '1f' "
                       "ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END",
    "geolocation_lng": "CAST(c_custkey % 200 - 100 AS STRING)",
    "geolocation_city": "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE lower(c_mktsegment) END",
    "geolocation_state": "'s' || CAST(c_custkey % 3 AS STRING)",
    "_file_name": "'geolocation/geolocation.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-07 00:00:00'",
}

RAW_ORDER_PAYMENTS = {
    "order_id": "CAST(user_id AS STRING)",
    "payment_sequence": "CAST(event_id AS STRING)",
    "payment_type": "CASE event_type WHEN 'purchase' THEN 'credit_card' WHEN 'click' THEN 'boleto' "
                    "WHEN 'view' THEN 'voucher' WHEN 'signup' THEN 'debit_card' ELSE ' NOT_DEFINED ' END",
    "payment_installments": "CASE WHEN event_id % 10 = 0 THEN '1.5' ELSE CAST(event_id % 12 + 1 AS STRING) END",
    "payment_value": "CASE WHEN event_id % 83 = 0 THEN 'abc' WHEN event_id % 89 = 0 THEN NULL "
                     "ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END",
    "_file_name": "'payments/payments_' || CAST(dayofmonth(ts) AS STRING) || '.csv'",
    "_loaded_at": "timestampadd(DAY, 1, ts)",
}

RAW_ORDER_REVIEWS = {
    "review_id": "CAST(event_id % 4000 AS STRING)",
    "order_id": "CAST(user_id AS STRING)",
    "review_score": "CASE WHEN event_id % 50 = 0 THEN '9' WHEN event_id % 50 = 1 THEN '3.5' "
                    "WHEN event_id % 50 = 2 THEN '5.4' WHEN event_id % 50 = 3 THEN NULL "
                    "ELSE CAST(floor(value) % 7 AS STRING) END",
    "review_comment_title": "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '   ' "
                            "ELSE '  ' || event_type || '  ' END",
    "review_comment_message": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END",
    "review_creation_date": "CAST(ts AS STRING)",
    "review_answer_timestamp": "CASE WHEN event_id % 13 = 0 THEN 'garbage' "
                               "ELSE CAST(timestampadd(HOUR, event_id % 100, ts) AS STRING) END",
    "_file_name": "'reviews/reviews.csv'",
    "_loaded_at": "timestampadd(DAY, 1, ts)",
}

RAW_PRODUCTS = {
    "product_id": "CAST(p_partkey AS STRING)",
    "product_category_name": "CASE WHEN p_partkey % 9 = 0 THEN NULL "
                             "ELSE 'NATION_' || CAST(p_partkey % 30 AS STRING) END",
    "product_name_length": "CAST(length(p_name) AS STRING)",
    "product_description_length": "CASE WHEN p_partkey % 13 = 0 THEN 'abc' "
                                  "ELSE CAST(p_size * 10 AS STRING) || '.5' END",
    "producr_photos_qty": "CAST(p_size % 5 AS STRING)",
    "product_weight_g": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)",
    "product_length_cm": "CAST(p_size AS STRING)",
    "product_height_cm": "CAST(p_size % 7 + 1 AS STRING) || '.15'",
    "product_width_cm": "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE '2.5' END",
    "_file_name": "'products/products.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-07 00:00:00'",
}

RAW_CATEGORY_TRANSLATION = {
    "product_category": "CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE ' ' || lower(n_name) || ' ' END",
    "product_category_name_english": "lower(r_name) || '_zone'",
    "_file_name": "'category/translation.csv'",
    "_loaded_at": "TIMESTAMP_NTZ '2024-01-07 00:00:00'",
}


def _project(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in spec.items()])


def raw_orders(spark, sf_dir):
    return _project(table(spark, sf_dir, "orders"), RAW_ORDERS)


def raw_order_items(spark, sf_dir):
    return _project(table(spark, sf_dir, "lineitem"), RAW_ORDER_ITEMS)


def raw_customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return (_project(c, CUSTOMER_V1)
            .unionByName(_project(c.where("c_acctbal < 0"), CUSTOMER_MOVED))
            .unionByName(_project(c.where("c_acctbal > 9000"), CUSTOMER_TWIN)))


def raw_sellers(spark, sf_dir):
    return _project(table(spark, sf_dir, "supplier"), RAW_SELLERS)


def raw_geolocations(spark, sf_dir):
    return _project(table(spark, sf_dir, "customer"), RAW_GEOLOCATIONS)


def raw_order_payments(spark, sf_dir):
    return _project(table(spark, sf_dir, "events"), RAW_ORDER_PAYMENTS)


def raw_order_reviews(spark, sf_dir):
    return _project(table(spark, sf_dir, "events"), RAW_ORDER_REVIEWS)


def raw_products(spark, sf_dir):
    return _project(table(spark, sf_dir, "part"), RAW_PRODUCTS)


def raw_category_translation(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return _project(n.join(r, n.n_regionkey == r.r_regionkey, "left"), RAW_CATEGORY_TRANSLATION)


RAW_BUILDERS = {
    "raw_orders": raw_orders,
    "raw_order_items": raw_order_items,
    "raw_customers": raw_customers,
    "raw_sellers": raw_sellers,
    "raw_geolocations": raw_geolocations,
    "raw_order_payments": raw_order_payments,
    "raw_order_reviews": raw_order_reviews,
    "raw_products": raw_products,
    "raw_product_category_name_translation": raw_category_translation,
}
