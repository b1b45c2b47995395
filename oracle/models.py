"""The silver and gold models as DuckDB SQL, for side-by-side comparison."""

from __future__ import annotations

from oracle.bronze import BRONZE

# fixed values: what stands for NULL in a surrogate key, and the characters after which a
# title-cased word starts
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
TITLE_DELIMITERS = " \t\n\r\v\f!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def initcap(x: str) -> str:
    """Title case by a walk over the characters: upper after a delimiter or at the start."""
    return (f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: "
            f"CASE WHEN i = 1 OR contains('{TITLE_DELIMITERS}', ({x})[i - 1]) "
            f"THEN upper(({x})[i]) ELSE lower(({x})[i]) END), '')")


def sk(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{SURROGATE_NULL_TOKEN}')" for c in cols)
    return f"md5({parts})"


def ts(c: str) -> str:
    return f"try_cast({c} AS TIMESTAMP)"


def dec(c: str, p: int = 38, s: int = 0) -> str:
    return f"try_cast({c} AS DECIMAL({p},{s}))"


def zip5(c: str) -> str:
    return f"lpad(trim({c}), 5, '0')"


def title(c: str, default: str) -> str:
    return initcap(f"trim(coalesce({c}, '{default}'))")


def tiebreak(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


MODELS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def model(name: str, deps: list[str], sql: str) -> None:
    MODELS[name] = sql
    DEPS[name] = deps


for _n, _sql in BRONZE.items():
    model(_n, [], _sql)

model("stg_orders", ["raw_orders"], f"""
SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
  {ts('order_purchase_timestamp')} AS order_purchase_timestamp,
  {ts('order_approved_at')} AS order_approved_at,
  {ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
  {ts('order_delivered_customer_date')} AS order_delivered_customer_date,
  {ts('order_estimated_delivery_date')} AS order_estimated_delivery_date,
  CAST(date_diff('day', {ts('order_purchase_timestamp')}, {ts('order_delivered_customer_date')}) AS INTEGER)
    AS days_to_deliver,
  coalesce({ts('order_delivered_customer_date')} <= {ts('order_estimated_delivery_date')}, false)
    AS delivered_on_time,
  _file_name, _loaded_at
FROM raw_orders WHERE order_id IS NOT NULL""")

_CUST_REST = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
              "_file_name", "_loaded_at"]
model("stg_customers", ["raw_customers"], f"""
SELECT customer_id, customer_unique_id,
  {title('customer_city', 'Unknown')} AS customer_city,
  upper(trim(coalesce(customer_state, 'XX'))) AS customer_state,
  {zip5('customer_zip_code_prefix')} AS zip_code_prefix,
  _file_name, _loaded_at
FROM (SELECT * FROM raw_customers
      QUALIFY row_number() OVER (PARTITION BY customer_id
                                 ORDER BY _loaded_at DESC NULLS FIRST, {tiebreak(_CUST_REST)}) = 1)
WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL""")

model("stg_order_items", ["raw_order_items"], f"""
SELECT * FROM (
  SELECT order_id, {dec('order_item')} AS order_item_id, product_id, seller_id,
    {ts('shipping_limit_date')} AS shipping_limit_date,
    {dec('price', 10, 2)} AS price, {dec('freight_value', 10, 2)} AS freight_value,
    CAST({dec('price', 10, 2)} + {dec('freight_value', 10, 2)} AS DECIMAL(11,2)) AS order_item_total,
    _file_name, _loaded_at
  FROM raw_order_items
  WHERE product_id IS NOT NULL AND order_id IS NOT NULL AND seller_id IS NOT NULL)
WHERE order_item_id IS NOT NULL""")

model("stg_payments", ["raw_order_payments"], f"""
SELECT order_id, {dec('payment_sequence')} AS payment_sequential,
  CASE WHEN lower(trim(payment_type)) = 'not_defined' THEN 'Unknown'
       ELSE {initcap('trim(payment_type)')} END AS payment_type,
  {dec('payment_installments')} AS payment_installments,
  {dec('payment_value', 10, 2)} AS payment_value,
  _file_name, _loaded_at
FROM raw_order_payments WHERE order_id IS NOT NULL AND payment_value IS NOT NULL""")

_dims = {c: dec(c, 10, 2) for c in ("product_weight_g", "product_length_cm", "product_height_cm",
                                    "product_width_cm")}
model("stg_products", ["raw_products"], f"""
SELECT product_id, {title('product_category_name', 'Unknown')} AS product_category_name,
  {dec('product_name_length')} AS product_name_length,
  {dec('product_description_length')} AS product_description_length,
  {dec('producr_photos_qty')} AS product_photos_qty,
  {", ".join(f"{v} AS {k}" for k, v in _dims.items())},
  CAST({_dims['product_length_cm']} * {_dims['product_height_cm']} * {_dims['product_width_cm']}
       AS DECIMAL(32,6)) AS product_volume_cm3,
  _file_name, _loaded_at
FROM raw_products WHERE product_id IS NOT NULL""")

model("stg_sellers", ["raw_sellers"], f"""
SELECT seller_id, {zip5('seller_zip_code_prefix')} AS seller_zip_code_prefix,
  {title('seller_city', 'Unknown')} AS seller_city,
  upper(trim(coalesce(seller_state, 'XX'))) AS seller_state,
  _file_name, _loaded_at
FROM raw_sellers WHERE seller_id IS NOT NULL""")

model("stg_geolocation", ["raw_geolocations"], f"""
SELECT {zip5('geolocation_zip_code_prefix')} AS zip_code_prefix,
  try_cast(geolocation_lat AS DOUBLE) AS geolocation_lat,
  try_cast(geolocation_lng AS DOUBLE) AS geolocation_lng,
  {title('geolocation_city', 'Unknown')} AS geolocation_city,
  upper(trim(coalesce(geolocation_state, 'XX'))) AS geolocation_state,
  _file_name, _loaded_at
FROM raw_geolocations WHERE geolocation_zip_code_prefix IS NOT NULL""")

model("stg_order_reviews", ["raw_order_reviews"], f"""
SELECT review_id, order_id,
  CASE WHEN {dec('review_score')} BETWEEN 1 AND 5 THEN {dec('review_score')} END AS review_score,
  coalesce(trim(review_comment_title), 'No comment') AS review_comment_title,
  coalesce(trim(review_comment_message), 'No comment') AS review_comment_message,
  {ts('review_creation_date')} AS review_creation_date,
  {ts('review_answer_timestamp')} AS review_answer_timestamp,
  CAST(date_diff('day', {ts('review_creation_date')}, {ts('review_answer_timestamp')}) AS INTEGER)
    AS review_response_time,
  coalesce({dec('review_score')} >= 4, false) AS is_positive_review,
  _file_name, _loaded_at
FROM raw_order_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL""")

model("stg_category_translation", ["raw_product_category_name_translation"], f"""
SELECT * FROM (
  SELECT {initcap('trim(product_category)')} AS product_category_name,
         {initcap('trim(product_category_name_english)')} AS product_category_name_english,
         _file_name, _loaded_at
  FROM raw_product_category_name_translation)
WHERE product_category_name IS NOT NULL""")

# the reference's own shape: aggregate, rank, join back
model("payments_aggregated", ["stg_payments"], """
SELECT a.order_id, CAST(a.total AS DECIMAL(20,2)) AS total_payment_value, a.payment_count,
  CAST(a.inst AS DECIMAL(38,0)) AS total_installments, a.is_mixed_payment,
  d.payment_type AS primary_payment_type, d.payment_value AS primary_payment_value
FROM (SELECT order_id, sum(payment_value) AS total, count(*) AS payment_count,
             sum(payment_installments) AS inst, count(DISTINCT payment_type) > 1 AS is_mixed_payment
      FROM stg_payments GROUP BY order_id) a
LEFT JOIN (SELECT * FROM stg_payments
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC NULLS FIRST,
                                      payment_sequential ASC NULLS FIRST, payment_type DESC NULLS LAST) = 1) d
  ON a.order_id = d.order_id""")


def _mode(col: str, out: str) -> str:
    return f"""SELECT zip_code_prefix, {col} AS {out} FROM (
        SELECT zip_code_prefix, {col}, count(*) AS n FROM stg_geolocation
        WHERE {col} IS NOT NULL GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY n DESC, {col} ASC) = 1"""


model("dim_geolocation", ["stg_geolocation"], f"""
SELECT {sk('z.zip_code_prefix')} AS geo_key, z.zip_code_prefix, m.latitude, m.longitude, c.city, s.state
FROM (SELECT DISTINCT zip_code_prefix FROM stg_geolocation) z
LEFT JOIN (SELECT zip_code_prefix, median(geolocation_lat) AS latitude, median(geolocation_lng) AS longitude
           FROM stg_geolocation GROUP BY 1) m ON z.zip_code_prefix = m.zip_code_prefix
LEFT JOIN ({_mode('geolocation_city', 'city')}) c ON z.zip_code_prefix = c.zip_code_prefix
LEFT JOIN ({_mode('geolocation_state', 'state')}) s ON z.zip_code_prefix = s.zip_code_prefix""")

model("dim_customer", ["stg_customers", "dim_geolocation"], f"""
SELECT {sk('c.customer_id')} AS customer_key, c.customer_id, c.customer_unique_id, c.zip_code_prefix,
  c.customer_city, c.customer_state, g.latitude, g.longitude, g.city AS primary_city
FROM stg_customers c LEFT JOIN dim_geolocation g ON c.zip_code_prefix = g.zip_code_prefix""")

model("dim_seller", ["stg_sellers", "dim_geolocation"], f"""
SELECT {sk('s.seller_id')} AS seller_key, s.seller_id, s.seller_zip_code_prefix, s.seller_city,
  s.seller_state, g.latitude, g.longitude, g.city AS primary_city
FROM stg_sellers s LEFT JOIN dim_geolocation g ON s.seller_zip_code_prefix = g.zip_code_prefix""")

model("dim_product", ["stg_products", "stg_category_translation"], f"""
SELECT {sk('p.product_id')} AS product_key, p.product_id,
  p.product_category_name AS product_category_name_portuguese,
  coalesce(ct.product_category_name_english, p.product_category_name, 'Uncategorized')
    AS product_category_name_english,
  p.product_name_length, p.product_description_length, p.product_photos_qty, p.product_weight_g,
  p.product_length_cm, p.product_height_cm, p.product_width_cm, p.product_volume_cm3
FROM stg_products p LEFT JOIN stg_category_translation ct
  ON p.product_category_name = ct.product_category_name""")

# calendar over the purchase dates of the orders; "today" is the last purchase date
model("order_calendar", ["orders"], """
SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders""")
DEPS["order_calendar"] = []

model("dim_date", ["order_calendar"], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter_number,
  'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(month(d) AS INTEGER) AS month_number,
  strftime(d, '%b') AS month_name, strftime(d, '%Y-%m') AS year_month,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
  dayofweek(d) IN (0, 6) AS is_weekend, NOT (dayofweek(d) IN (0, 6)) AS is_weekday,
  d = hi AS is_today, d <= hi AS is_past_or_today
FROM (SELECT CAST(r.range AS DATE) AS d, c.hi
      FROM order_calendar c, range(c.lo, c.hi + INTERVAL 1 DAY, INTERVAL 1 DAY) r)""")

model("fact_sales", ["stg_order_items", "stg_orders", "payments_aggregated", "dim_customer",
                     "dim_seller", "dim_product", "dim_date"], f"""
SELECT {sk('oi.order_id', 'oi.order_item_id')} AS sales_key,
  dc.customer_key, ds.seller_key, dp.product_key, dd.date_key,
  oi.order_id, oi.order_item_id, o.order_status, o.order_purchase_timestamp, o.delivered_on_time,
  o.days_to_deliver, oi.price, oi.freight_value, oi.order_item_total, p.total_payment_value,
  coalesce(p.primary_payment_type, 'Unknown') AS primary_payment_type, p.is_mixed_payment, oi._loaded_at
FROM stg_order_items oi
LEFT JOIN stg_orders o ON oi.order_id = o.order_id
LEFT JOIN payments_aggregated p ON oi.order_id = p.order_id
LEFT JOIN dim_customer dc ON o.customer_id = dc.customer_id
LEFT JOIN dim_seller ds ON oi.seller_id = ds.seller_id
LEFT JOIN dim_product dp ON oi.product_id = dp.product_id
LEFT JOIN dim_date dd ON CAST(o.order_purchase_timestamp AS DATE) = dd.full_date
WHERE o.order_status IN ('delivered', 'shipped')""")


def with_models(final_sql: str, *names: str) -> str:
    """``WITH`` every model ``names`` needs (dependencies first), then ``final_sql``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in MODELS:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({MODELS[n]})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + final_sql
