"""DuckDB SQL for every registered query (same output column names and types)."""

from __future__ import annotations

from oracle.bronze import BRONZE
from oracle.models import with_models

SQL: dict[str, str] = {}

for _name, _model in {
    "stg_orders": "stg_orders", "stg_customers": "stg_customers",
    "stg_order_items": "stg_order_items", "stg_payments": "stg_payments",
    "stg_products": "stg_products", "stg_sellers": "stg_sellers",
    "stg_geolocation": "stg_geolocation", "stg_reviews": "stg_order_reviews",
    "stg_category_translation": "stg_category_translation",
    "payments_aggregated": "payments_aggregated", "dim_date": "dim_date",
    "dim_geolocation": "dim_geolocation", "dim_customer": "dim_customer",
    "dim_seller": "dim_seller", "dim_product": "dim_product", "fact_sales": "fact_sales",
}.items():
    SQL[_name] = with_models(f"SELECT * FROM {_model}", _model)

# --- data tests ----------------------------------------------------------------------
SQL["test_not_null"] = with_models(
    "SELECT * FROM stg_orders WHERE order_purchase_timestamp IS NULL", "stg_orders")
SQL["test_unique"] = with_models(
    "SELECT sales_key, count(*) AS n_records FROM fact_sales WHERE sales_key IS NOT NULL "
    "GROUP BY sales_key HAVING count(*) > 1", "fact_sales")
SQL["test_accepted_values"] = with_models(
    "SELECT order_status, count(*) AS n_records FROM stg_orders WHERE order_status IS NOT NULL "
    "AND order_status NOT IN ('delivered', 'shipped') GROUP BY order_status", "stg_orders")
SQL["test_accepted_range"] = with_models(
    "SELECT * FROM stg_geolocation WHERE NOT (geolocation_lat >= -35 AND geolocation_lat <= 45)",
    "stg_geolocation")
SQL["test_relationships"] = with_models(
    "SELECT * FROM stg_orders o WHERE o.customer_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM stg_customers c WHERE c.customer_id = o.customer_id)", "stg_orders", "stg_customers")
SQL["test_unique_combo"] = with_models(
    "SELECT order_id, order_item_id, count(*) AS n_records FROM stg_order_items "
    "GROUP BY order_id, order_item_id HAVING count(*) > 1", "stg_order_items")


# fixed values: the declared tests, by model
_NOT_NULL = {
    "stg_orders": "order_id customer_id order_status order_purchase_timestamp",
    "stg_customers": "customer_id customer_unique_id zip_code_prefix",
    "stg_order_items": "order_id order_item_id product_id seller_id price",
    "stg_products": "product_id",
    "stg_sellers": "seller_id",
    "stg_geolocation": "zip_code_prefix geolocation_lat geolocation_lng",
    "stg_order_reviews": "review_id order_id",
    "stg_category_translation": "product_category_name",
    "payments_aggregated": "order_id total_payment_value primary_payment_type payment_count "
                           "is_mixed_payment",
    "fact_sales": "sales_key customer_key seller_key product_key date_key order_id order_item_id "
                  "price freight_value order_item_total order_status primary_payment_type",
    "dim_customer": "customer_key customer_id customer_unique_id zip_code_prefix customer_city "
                    "customer_state",
    "dim_seller": "seller_key seller_id seller_zip_code_prefix seller_city seller_state",
    "dim_product": "product_key product_id product_category_name_english",
    "dim_date": "date_key full_date year month_number quarter_number day_of_week is_weekend",
    "dim_geolocation": "geo_key zip_code_prefix latitude longitude city state",
}
_UNIQUE = {
    "stg_orders": "order_id", "stg_customers": "customer_id", "stg_products": "product_id",
    "stg_sellers": "seller_id", "stg_category_translation": "product_category_name",
    "payments_aggregated": "order_id", "fact_sales": "sales_key",
    "dim_customer": "customer_key customer_id", "dim_seller": "seller_key seller_id",
    "dim_product": "product_key product_id", "dim_date": "date_key full_date",
    "dim_geolocation": "geo_key zip_code_prefix",
}
_RANGES = [
    ("stg_order_reviews", "review_score", 1, 5), ("dim_date", "month_number", 1, 12),
    ("dim_date", "quarter_number", 1, 4), ("dim_date", "day_of_week", 0, 6),
    ("dim_geolocation", "latitude", -35, 45), ("dim_geolocation", "longitude", -75, 125),
]
_ACCEPTED = [
    ("fact_sales", "order_status", "'delivered', 'shipped'"),
    ("fact_sales", "primary_payment_type",
     "'Credit_Card', 'Boleto', 'Voucher', 'Debit_Card', 'Unknown'"),
]
_PARENTS = [("fact_sales", "customer_key", "dim_customer"), ("fact_sales", "seller_key", "dim_seller"),
            ("fact_sales", "product_key", "dim_product"), ("fact_sales", "date_key", "dim_date")]
_COMBINED = [("stg_order_reviews", ("review_id", "order_id"))]


def _tests() -> list[tuple[str, str, str, str]]:
    """(model, test, column_name, SQL that counts violations) of every declared test."""
    out = [(m, "not_null", c, f"SELECT count(*) FROM {m} WHERE {c} IS NULL")
           for m, cols in _NOT_NULL.items() for c in cols.split()]
    out += [(m, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                             f"GROUP BY {c} HAVING count(*) > 1)")
            for m, cols in _UNIQUE.items() for c in cols.split()]
    out += [(m, "accepted_range", c, f"SELECT count(*) FROM {m} WHERE NOT ({c} >= {lo} AND {c} <= {hi})")
            for m, c, lo, hi in _RANGES]
    out += [(m, "accepted_values", c, f"SELECT count(DISTINCT {c}) FROM {m} WHERE {c} NOT IN ({v})")
            for m, c, v in _ACCEPTED]
    out += [(m, "relationships", c, f"SELECT count(*) FROM {m} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                                    f"(SELECT 1 FROM {p} pa WHERE pa.{c} = ch.{c})")
            for m, c, p in _PARENTS]
    out += [(m, "unique_combination", ",".join(cs), f"SELECT count(*) FROM (SELECT 1 FROM {m} "
             f"GROUP BY {', '.join(cs)} HAVING count(*) > 1)") for m, cs in _COMBINED]
    assert len(out) == 94
    return out


SQL["data_tests_summary"] = with_models("\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, '{t}' AS test, '{c}' AS column_name, ({body}) AS violations"
    for m, t, c, body in _tests()), *_NOT_NULL)

SQL["data_tests_incremental"] = with_models("\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, '{t}' AS test, '{c}' AS column_name, ({body}) AS violations"
    for m, t, c, body in _tests() if m == "fact_sales"), *_NOT_NULL)

# --- generic operators ---------------------------------------------------------------
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
SQL["dedupe_latest"] = (
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_shipdate DESC NULLS FIRST, "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _LI_REST) + ") = 1")

_TOK = "('NULL', 'null', 'None', '')"
SQL["null_tokens"] = (
    "SELECT " + ", ".join(f"CASE WHEN {n} IN {_TOK} THEN NULL ELSE {n} END AS {n}"
                          for n in ("order_id", "order_priority", "order_status"))
    + " FROM (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, "
      "CASE o_orderkey % 6 WHEN 0 THEN 'NULL' WHEN 1 THEN 'None' WHEN 2 THEN '' "
      "WHEN 3 THEN 'null' WHEN 4 THEN ' NULL ' ELSE o_orderpriority END AS order_priority, "
      "CASE WHEN o_custkey % 4 = 0 THEN 'None' ELSE o_orderstatus END AS order_status FROM orders)")

SQL["hash_sample"] = ("SELECT * FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || '|' || '42') "
                      "LIMIT 500")

# --- incremental fact ------------------------------------------------------------------
_CUT1 = "TIMESTAMP '1997-01-01 00:00:00'"
_FACT_REST = ["customer_key", "seller_key", "product_key", "date_key", "order_id", "order_item_id",
              "order_status", "order_purchase_timestamp", "delivered_on_time", "days_to_deliver",
              "price", "freight_value", "order_item_total", "total_payment_value",
              "primary_payment_type", "is_mixed_payment", "_loaded_at"]

SQL["incremental_filter"] = with_models(
    "SELECT * FROM fact_sales WHERE _loaded_at > (SELECT coalesce(max(_loaded_at), "
    f"TIMESTAMP '1900-01-01 00:00:00') FROM fact_sales WHERE _loaded_at < {_CUT1})", "fact_sales")


def _merged_sql(early_select: str, late_cols: str) -> str:
    return (
        f"SELECT {early_select} FROM fact_sales e WHERE e._loaded_at < {_CUT1} AND NOT EXISTS "
        f"(SELECT 1 FROM fact_sales l WHERE l._loaded_at >= {_CUT1} AND l.sales_key = e.sales_key) "
        f"UNION ALL SELECT {late_cols} FROM (SELECT * FROM fact_sales WHERE _loaded_at >= {_CUT1} "
        "QUALIFY row_number() OVER (PARTITION BY sales_key ORDER BY _loaded_at DESC NULLS FIRST, "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in _FACT_REST) + ") = 1)")


_ALL = "sales_key, " + ", ".join(_FACT_REST)
SQL["incremental_merge"] = with_models(_merged_sql(_ALL, _ALL), "fact_sales")
SQL["schema_sync"] = with_models(
    _merged_sql(_ALL.replace("is_mixed_payment", "CAST(NULL AS BOOLEAN) AS is_mixed_payment"), _ALL),
    "fact_sales")
SQL["schema_sync_types"] = SQL["incremental_merge"]
def _uneven(alias: str, col: str) -> str:
    """How often the thinned-out dimension holds an id: not at all, once or twice."""
    n = f"CAST({alias}.{col} AS BIGINT)"
    return f"CASE WHEN {n} % 7 <> 3 THEN 1 ELSE 0 END + CASE WHEN {n} % 11 = 5 THEN 1 ELSE 0 END"


SQL["fact_sales_members"] = with_models(
    "SELECT " + ", ".join(
        {"seller_key": "CASE WHEN ns > 0 THEN seller_key END AS seller_key",
         "product_key": "CASE WHEN np > 0 THEN product_key END AS product_key"}.get(c.strip(), c.strip())
        for c in _ALL.split(",")) + f""" FROM (
    SELECT f.*, coalesce({_uneven('ds', 'seller_id')}, 0) AS ns, coalesce({_uneven('dp', 'product_id')}, 0) AS np
    FROM fact_sales f LEFT JOIN dim_seller ds USING (seller_key) LEFT JOIN dim_product dp USING (product_key)) t,
    LATERAL (SELECT unnest(range(greatest(ns, 1)))) a, LATERAL (SELECT unnest(range(greatest(np, 1)))) b""",
    "fact_sales", "dim_seller", "dim_product")
SQL["incremental_merge_crashes"] = SQL["incremental_merge"]
_MOVED = ("CAST(order_id AS BIGINT) % 3 = 0")
SQL["incremental_merge_moved_key"] = with_models(
    "SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS purchase_month FROM ("
    f"SELECT {_ALL} FROM fact_sales WHERE NOT ({_MOVED}) UNION ALL "
    "SELECT * REPLACE (order_purchase_timestamp + INTERVAL 45 DAY AS order_purchase_timestamp, "
    f"_loaded_at + INTERVAL 30 YEAR AS _loaded_at) FROM (SELECT {_ALL} FROM fact_sales WHERE {_MOVED} "
    "QUALIFY row_number() OVER (PARTITION BY sales_key ORDER BY _loaded_at DESC NULLS FIRST, "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _FACT_REST) + ") = 1))", "fact_sales")

# --- history ---------------------------------------------------------------------------
def scd2_ctes(runs, feed_sql, key, data_cols, check_cols) -> list[str]:
    """Unrolled SCD2 runs: feed{k} = the source at run k, h{k} = history after run k."""
    data = ", ".join(data_cols)

    def meta(alias, t):
        T = f"TIMESTAMP '{t}'"
        return (f"md5(CAST({alias}.{key} AS VARCHAR) || '|' || CAST({T} AS VARCHAR)) AS dbt_scd_id, "
                f"{T} AS dbt_updated_at, {T} AS dbt_valid_from")
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM s.{c}" for c in check_cols)
    ctes = [f"feed1 AS ({feed_sql(runs[0])})",
            f"h1 AS (SELECT {data}, {meta('f', runs[0])}, CAST(NULL AS TIMESTAMP) AS dbt_valid_to "
            "FROM feed1 f)"]
    for k, t in enumerate(runs[1:], start=2):
        T, prev = f"TIMESTAMP '{t}'", f"h{k - 1}"
        o_cols = ", ".join(f"o.{c}" for c in data_cols)
        s_cols = ", ".join(f"s.{c}" for c in data_cols)
        ctes.append(f"feed{k} AS ({feed_sql(t)})")
        ctes.append(
            f"h{k} AS (SELECT * FROM {prev} WHERE dbt_valid_to IS NOT NULL "
            f"UNION ALL SELECT {o_cols}, o.dbt_scd_id, o.dbt_updated_at, o.dbt_valid_from, "
            f"CASE WHEN s.{key} IS NULL OR {changed} THEN {T} END AS dbt_valid_to "
            f"FROM (SELECT * FROM {prev} WHERE dbt_valid_to IS NULL) o LEFT JOIN feed{k} s ON o.{key} = s.{key} "
            f"UNION ALL SELECT {s_cols}, {meta('s', t)}, CAST(NULL AS TIMESTAMP) AS dbt_valid_to "
            f"FROM feed{k} s LEFT JOIN (SELECT * FROM {prev} WHERE dbt_valid_to IS NULL) o "
            f"ON o.{key} = s.{key} WHERE o.{key} IS NULL OR {changed})")
    return ctes


_RUNS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00",
         "2024-01-29 00:00:00", "2024-02-01 00:00:00"]


def _user_feed(t: str) -> str:
    return ("SELECT user_id, event_type, value, ts FROM (SELECT * FROM events "
            f"WHERE ts < TIMESTAMP '{t}' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "
            "ts DESC NULLS FIRST, event_id ASC NULLS FIRST, ts ASC NULLS FIRST, "
            "event_type ASC NULLS FIRST, value ASC NULLS FIRST, props ASC NULLS FIRST) = 1) "
            "WHERE event_type <> 'error'")


_USER_CTES = scd2_ctes(_RUNS, _user_feed, "user_id", ["user_id", "event_type", "value", "ts"],
                       ["event_type"])
_H = f"h{len(_RUNS)}"
SQL["scd2_snapshot"] = "WITH " + ",\n".join(_USER_CTES) + f"\nSELECT * FROM {_H}"
SQL["scd2_as_of"] = (
    "WITH " + ",\n".join(_USER_CTES) + ",\n"
    f"hx AS (SELECT *, CASE WHEN dbt_valid_from = min(dbt_valid_from) OVER (PARTITION BY user_id) "
    f"THEN NULL ELSE dbt_valid_from END AS eff_from FROM {_H})\n"
    "SELECT e.event_id, e.user_id, e.ts, e.event_type, h.event_type AS state_event_type, "
    "h.dbt_valid_from AS state_valid_from, h.dbt_scd_id AS state_scd_id "
    "FROM events e LEFT JOIN hx h ON e.user_id = h.user_id AND (h.eff_from IS NULL OR e.ts >= h.eff_from) "
    "AND (h.dbt_valid_to IS NULL OR e.ts < h.dbt_valid_to)")

_SNAP_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
              "customer_state", "_loaded_at"]
_CUST_TIE = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
             "_file_name", "_loaded_at"]


def _customer_feed(t: str) -> str:
    return (f"SELECT {', '.join(_SNAP_COLS)} FROM (SELECT * FROM raw_customers "
            f"WHERE _loaded_at < TIMESTAMP '{t}' QUALIFY row_number() OVER (PARTITION BY customer_id "
            "ORDER BY _loaded_at DESC NULLS FIRST, "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in _CUST_TIE) + ") = 1) WHERE customer_id IS NOT NULL")


_SNAP = scd2_ctes(["2024-01-08 00:00:00", "2024-01-15 00:00:00"], _customer_feed, "customer_id",
                  _SNAP_COLS, ["customer_city", "customer_state", "customer_zip_code_prefix"])
SQL["snap_customer"] = with_models("SELECT * FROM h2", "raw_customers").replace(
    "\nSELECT * FROM h2", ",\n" + ",\n".join(_SNAP) + "\nSELECT * FROM h2", 1)

# --- landing ------------------------------------------------------------------------------
_ITEM_COLS = ["order_id", "order_item", "product_id", "seller_id", "shipping_limit_date", "price",
              "freight_value"]
_ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date"]
_REVIEW_COLS = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"]
_FILE_KEYS = {
    "raw_orders": "CAST(order_id AS BIGINT)", "raw_order_items": "CAST(order_id AS BIGINT)",
    "raw_customers": "CAST(customer_id AS BIGINT)", "raw_sellers": "CAST(seller_id AS BIGINT)",
    "raw_geolocations": "CAST(geolocation_zip_code_prefix AS BIGINT)",
    "raw_order_payments": "CAST(payment_sequence AS BIGINT)",
    "raw_order_reviews": "CAST(review_id AS BIGINT)", "raw_products": "CAST(product_id AS BIGINT)",
    "raw_product_category_name_translation": "length(product_category_name_english)",
}
_BAD = "(CAST(order_id AS BIGINT) % 250 IN (7, 11))"


def _csv(cols: list[str]) -> str:
    return " || ',' || ".join(f"coalesce({c}, '')" for c in cols)


def _landing_stats(table: str) -> str:
    """Files are (year, key bucket); the second load is reported: all files but the damaged tables'
    first wave, which are skipped."""
    damaged = {"raw_orders": _ORDER_COLS, "raw_order_items": _ITEM_COLS}.get(table)
    bad = _BAD if damaged else "false"
    wave = "year(_loaded_at) > 1997" if damaged else "true"
    line = (f"CASE CAST(order_id AS BIGINT) % 250 WHEN 7 THEN {_csv(damaged[:-1])} "
            f"ELSE {_csv(damaged)} || ',extra' END" if damaged else "CAST(NULL AS VARCHAR)")
    key = f"coalesce({_FILE_KEYS[table]}, 0)"
    files = (f"SELECT y, b, count(*) FILTER (WHERE ok) AS good, count(*) FILTER (WHERE NOT ok) AS bad, "
             "min_by(line, (k, line)) FILTER (WHERE NOT ok) AS first_error FROM ("
             f"SELECT year(_loaded_at) AS y, {key} % (1 + (SELECT count(*) FROM {table}) // 5000) AS b, "
             f"{key} AS k, NOT {bad} AS ok, {line} AS line, {wave} AS now FROM {table}) "
             "WHERE now = {} GROUP BY y, b")
    return (f"SELECT '{table}' AS \"table\", count(*) FILTER (WHERE bad = 0) AS files_loaded, "
            f"(SELECT count(*) FROM ({files.format('false')})) AS files_skipped, "
            "count(*) FILTER (WHERE bad > 0) AS files_errored, "
            "CAST(coalesce(sum(good), 0) AS BIGINT) AS rows_loaded, "
            "CAST(coalesce(sum(bad), 0) AS BIGINT) AS rows_rejected, "
            "min_by(first_error, (CAST(y AS VARCHAR), CAST(b AS VARCHAR))) FILTER (WHERE bad > 0) "
            f"AS first_error FROM ({files.format('true')})")


SQL["load_report"] = with_models(" UNION ALL ".join(_landing_stats(t) for t in _FILE_KEYS), *_FILE_KEYS)


def _landed(table: str, cols: list[str], loaded_at: str, where: str = "true", more: str = "") -> str:
    """Loaded rows of a table: null tokens are NULL."""
    return with_models(
        "SELECT " + ", ".join(f"CASE WHEN {c} IN {_TOK} THEN NULL ELSE {c} END AS {c}" for c in cols)
        + f", {loaded_at} AS _loaded_at{more} FROM {table} WHERE {where}", table)


_FIRST, _SECOND = "TIMESTAMP '2024-01-07 06:00:00'", "TIMESTAMP '2024-01-14 06:00:00'"
_BY_WAVE = f"CASE WHEN year(_loaded_at) <= 1997 THEN {_FIRST} ELSE {_SECOND} END"
SQL["incremental_load"] = _landed("raw_order_items", _ITEM_COLS, _BY_WAVE, f"NOT {_BAD}")
SQL["load_retry"] = _landed("raw_orders", _ORDER_COLS, _FIRST, f"NOT {_BAD}")
SQL["load_full_then_incremental"] = _landed("raw_orders", _ORDER_COLS, _BY_WAVE, f"NOT {_BAD}")
SQL["landed_reviews"] = _landed("raw_order_reviews", _REVIEW_COLS, _FIRST).replace(
    "CASE WHEN review_comment_message IN", "CASE WHEN replace(review_comment_message, ',', E',\\n') IN").replace(
    "ELSE review_comment_message END", "ELSE replace(review_comment_message, ',', E',\\n') END")
SQL["landed_reviews_split"] = SQL["landed_reviews"]
SQL["landed_sink"] = _landed(
    "raw_sellers", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], _FIRST)
SQL["landed_audit_files"] = _landed(
    "raw_customers", ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                      "customer_state"], _FIRST,
    more=", 'file_group=' || CAST(year(_loaded_at) AS VARCHAR) AS _file_name")

SQL["verify_counts"] = with_models(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS row_count, max(_loaded_at) AS last_loaded_at FROM {t}"
    for t in ["raw_orders", "raw_order_items", "raw_customers", "raw_sellers", "raw_geolocations",
              "raw_order_payments", "raw_order_reviews", "raw_products",
              "raw_product_category_name_translation"]),
    "raw_orders", "raw_order_items", "raw_customers", "raw_sellers", "raw_geolocations",
    "raw_order_payments", "raw_order_reviews", "raw_products", "raw_product_category_name_translation")

SQL["full_reload"] = with_models(
    "SELECT 'raw_orders' AS \"table\", 2 * count(*) AS row_count, "
    f"{_SECOND} AS last_loaded_at FROM raw_orders WHERE NOT {_BAD}", "raw_orders")
_THIRD, _FOURTH = "TIMESTAMP '2024-01-21 06:00:00'", "TIMESTAMP '2024-01-28 06:00:00'"
SQL["forced_load_failed"] = with_models("\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", {n} AS row_count, {at} AS last_loaded_at FROM raw_orders WHERE NOT {_BAD}"
    for name, n, at in (
        ("after the failure", "count(*) FILTER (WHERE year(_loaded_at) <= 1997)", _FIRST),
        ("after the next load", "count(*)", _THIRD), ("after the repetition", "2 * count(*)", _FOURTH),
        ("of the repetition", "count(*)", _FOURTH))), "raw_orders")
SQL["load_isolation"] = with_models(
    "SELECT 'raw_sellers' AS \"table\", count(*) AS reported, count(*) AS loaded, count(*) AS in_landing "
    "FROM raw_sellers UNION ALL SELECT 'raw_customers', NULL, 0, count(*) FROM raw_customers",
    "raw_sellers", "raw_customers")
SQL["as_of_hot_keys"] = """
WITH quotes AS (
    SELECT event_type, event_id AS quote_id, value, ts AS valid_from,
           lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS valid_to
    FROM (SELECT * FROM events WHERE user_id % 3 = 0
          QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) = 1))
SELECT e.event_id, e.event_type, e.ts, q.quote_id, q.value AS quote_value
FROM events e LEFT JOIN quotes q ON e.event_type = q.event_type AND q.quote_id % 5 <> 0
  AND e.ts >= q.valid_from AND (q.valid_to IS NULL OR e.ts < q.valid_to)"""
SQL["hash_shuffle"] = ("SELECT *, row_number() OVER (ORDER BY shuffle_key) AS position FROM ("
                       "SELECT s_suppkey, s_name, md5(CAST(s_suppkey AS VARCHAR) || '|' || '7') AS shuffle_key "
                       "FROM supplier)")

# --- the weekly run -------------------------------------------------------------------------
# every landed row has the time of its run, and all files of a run one name
_RUN = {t: f"SELECT * REPLACE ({_FIRST} AS _loaded_at, '' AS _file_name) FROM ({BRONZE[t]})" for t in BRONZE}
for _t in ("raw_orders", "raw_order_items"):
    _RUN[_t] = (f"SELECT * REPLACE (CASE WHEN _loaded_at < TIMESTAMP '1998-01-01 00:00:00' THEN {_FIRST} "
                f"ELSE {_SECOND} END AS _loaded_at, '' AS _file_name) FROM ({BRONZE[_t]})")


def _weekly_sql() -> str:
    """The fact after two runs: the first as built, then every newer item, or item of a newer order
    that the fact lacks, once per key."""
    gold = ["dim_date", "dim_geolocation", "dim_customer", "dim_seller", "dim_product", "fact_sales"]
    plain = with_models("", *_NOT_NULL)
    for t, sql in _RUN.items():
        plain = plain.replace(f"{t} AS ({BRONZE[t]})", f"{t} AS ({sql})")
    plain = plain.replace("fact_sales AS (", "every_sale AS (", 1).rstrip()
    late = (f"every_sale f JOIN raw_orders o ON f.order_id = o.order_id "
            f"WHERE f._loaded_at = {_SECOND} OR o._loaded_at = {_SECOND} AND f.sales_key NOT IN "
            "(SELECT sales_key FROM first_run)")
    plain += (",\nfirst_run AS (SELECT f.* FROM every_sale f JOIN raw_orders o ON f.order_id = o.order_id "
              f"WHERE f._loaded_at = {_FIRST} AND o._loaded_at = {_FIRST})"
              f",\nsecond_run AS (SELECT f.* FROM {late} QUALIFY row_number() OVER (PARTITION BY f.sales_key "
              "ORDER BY f._loaded_at DESC) = 1)"
              ",\nfact_sales AS (SELECT * FROM first_run WHERE sales_key NOT IN (SELECT sales_key FROM second_run) "
              "UNION ALL SELECT * FROM second_run)")
    fails = {m: " + ".join(f"CAST(({body}) > 0 AS BIGINT)" for mm, _, _, body in _tests() if mm == m)
             for m in gold}
    return plain + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, (SELECT count(*) FROM {m}) AS row_count, {fails[m]} AS failing_tests"
        for m in gold)


SQL["weekly_run"] = _weekly_sql()
SQL["weekly_run_retry"] = _weekly_sql() + "".join(
    f"\nUNION ALL SELECT '{t}', (SELECT count({c}) FROM {t}), 0"
    for t, c in (("raw_orders", "*"), ("raw_order_items", "*"))) + (
    "\nUNION ALL SELECT 'snap_customer', (SELECT count(DISTINCT customer_id) FROM raw_customers), 0")


def _empty_start_sql() -> str:
    """Tables that don't hang on orders or customers are full after either run, the others after the second."""
    plain = with_models("", *_NOT_NULL)
    for t in BRONZE:
        plain = plain.replace(f"{t} AS ({BRONZE[t]})",
                              f"{t} AS (SELECT * REPLACE ({_SECOND} AS _loaded_at, '' AS _file_name) FROM ({BRONZE[t]}))")
    counts = {"dim_date": "count(*)", "dim_geolocation": "count(*)", "dim_seller": "count(*)",
              "dim_product": "count(*)", "dim_customer": "count(*)", "fact_sales": "count(DISTINCT sales_key)"}
    parts = [f"SELECT CAST({w} AS INT) AS week, '{m}' AS model, "
             + (f"(SELECT {c} FROM {m})" if w or m not in ("dim_customer", "fact_sales") else "0") + " AS row_count"
             for w in (0, 1) for m, c in counts.items()]
    parts += ["SELECT 0, 'snap_customer', 0",
              "SELECT 1, 'snap_customer', (SELECT count(DISTINCT customer_id) FROM raw_customers)"]
    return plain + "\n" + "\nUNION ALL\n".join(parts)


SQL["weekly_run_empty_start"] = _empty_start_sql()
