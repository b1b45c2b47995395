"""DuckDB versions of the bronze-shaped landing tables.

Same expressions as ``lakemart.sources.benchmark`` except where DuckDB spells
things differently (interval arithmetic, typed literals, floor()'s type).
"""

from lakemart.sources import benchmark as B


def _ts(unit: str, n: str, ts: str) -> str:
    fn = {"SECOND": "to_seconds", "MINUTE": "to_minutes", "HOUR": "to_hours", "DAY": "to_days"}[unit]
    return f"({ts} + {fn}(CAST({n} AS {'INTEGER' if unit == 'DAY' else 'BIGINT'})))"


NTZ = "TIMESTAMP '{}'"

RAW_ORDERS = dict(B.RAW_ORDERS, **{
    "order_purchase_timestamp":
        "CASE WHEN o_orderkey % 211 = 5 THEN 'garbage' "
        "WHEN o_orderkey % 89 = 3 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) "
        f"ELSE CAST({_ts('SECOND', 'o_orderkey % 86400', 'o_orderdate')} AS VARCHAR) END",
    "order_approved_at": "CASE WHEN o_orderkey % 223 = 9 THEN '2018' "
                         f"ELSE CAST({_ts('HOUR', '1 + o_orderkey % 48', 'o_orderdate')} AS VARCHAR) END",
    "order_delivered_carrier_date":
        "CASE WHEN o_orderstatus IN ('F', 'O') "
        f"THEN CAST({_ts('DAY', '1 + o_custkey % 3', 'o_orderdate')} AS VARCHAR) END",
    "order_delivered_customer_date":
        f"CASE WHEN o_orderstatus = 'F' THEN CAST({_ts('MINUTE', 'o_orderkey % 24000', 'o_orderdate')} AS VARCHAR) END",
    "order_estimated_delivery_date": f"CAST(CAST({_ts('DAY', '12', 'o_orderdate')} AS DATE) AS VARCHAR)",
    "_loaded_at": _ts("DAY", "7", "o_orderdate"),
})

RAW_ORDER_ITEMS = dict(B.RAW_ORDER_ITEMS, **{
    "freight_value": "CASE WHEN l_linenumber = 7 THEN NULL "
                     "ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.25' END",
    "_loaded_at": _ts("DAY", "3", "l_shipdate"),
})

CUSTOMER_V1 = dict(B.CUSTOMER_V1, _loaded_at=NTZ.format("2024-01-07 00:00:00"))
CUSTOMER_MOVED = dict(B.CUSTOMER_MOVED, _loaded_at=NTZ.format("2024-01-14 00:00:00"))
CUSTOMER_TWIN = dict(B.CUSTOMER_TWIN, _loaded_at=NTZ.format("2024-01-07 00:00:00"))
RAW_SELLERS = dict(B.RAW_SELLERS, _loaded_at=NTZ.format("2024-01-07 00:00:00"))
RAW_GEOLOCATIONS = dict(B.RAW_GEOLOCATIONS, _loaded_at=NTZ.format("2024-01-07 00:00:00"))
RAW_PRODUCTS = dict(B.RAW_PRODUCTS, _loaded_at=NTZ.format("2024-01-07 00:00:00"))
RAW_CATEGORY_TRANSLATION = dict(B.RAW_CATEGORY_TRANSLATION, _loaded_at=NTZ.format("2024-01-07 00:00:00"))

RAW_ORDER_PAYMENTS = dict(B.RAW_ORDER_PAYMENTS, _loaded_at=_ts("DAY", "1", "ts"))

RAW_ORDER_REVIEWS = dict(B.RAW_ORDER_REVIEWS, **{
    "review_score": "CASE WHEN event_id % 50 = 0 THEN '9' WHEN event_id % 50 = 1 THEN '3.5' "
                    "WHEN event_id % 50 = 2 THEN '5.4' WHEN event_id % 50 = 3 THEN NULL "
                    "ELSE CAST(CAST(floor(value) AS BIGINT) % 7 AS VARCHAR) END",
    "review_answer_timestamp": "CASE WHEN event_id % 13 = 0 THEN 'garbage' "
                               f"ELSE CAST({_ts('HOUR', 'event_id % 100', 'ts')} AS VARCHAR) END",
    "_loaded_at": _ts("DAY", "1", "ts"),
})


def _sel(spec: dict, src: str, where: str = "") -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in spec.items())
    return f"SELECT {cols} FROM {src}" + (f" WHERE {where}" if where else "")


BRONZE = {
    "raw_orders": _sel(RAW_ORDERS, "orders"),
    "raw_order_items": _sel(RAW_ORDER_ITEMS, "lineitem"),
    "raw_customers": " UNION ALL BY NAME ".join([
        _sel(CUSTOMER_V1, "customer"),
        _sel(CUSTOMER_MOVED, "customer", "c_acctbal < 0"),
        _sel(CUSTOMER_TWIN, "customer", "c_acctbal > 9000")]),
    "raw_sellers": _sel(RAW_SELLERS, "supplier"),
    "raw_geolocations": _sel(RAW_GEOLOCATIONS, "customer"),
    "raw_order_payments": _sel(RAW_ORDER_PAYMENTS, "events"),
    "raw_order_reviews": _sel(RAW_ORDER_REVIEWS, "events"),
    "raw_products": _sel(RAW_PRODUCTS, "part"),
    "raw_product_category_name_translation": _sel(
        RAW_CATEGORY_TRANSLATION, "nation LEFT JOIN region ON n_regionkey = r_regionkey"),
}
