"""Wiring of the model graph: bronze frames -> silver frames -> gold frames.

Everything returned is lazy; nothing is written here.  Callers decide what to
materialise (see :mod:`lakemart.plans.weekly`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.merge import incremental_filter
from lakemart.plans import intermediate, marts, staging


@dataclass
class Bronze:
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocations: DataFrame
    payments: DataFrame
    reviews: DataFrame
    category_translation: DataFrame


@dataclass
class Silver:
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    payments: DataFrame
    reviews: DataFrame
    category_translation: DataFrame
    payments_aggregated: DataFrame


def silver(b: Bronze) -> Silver:
    pay = staging.stg_payments(b.payments)
    return Silver(
        orders=staging.stg_orders(b.orders),
        order_items=staging.stg_order_items(b.order_items),
        customers=staging.stg_customers(b.customers),
        products=staging.stg_products(b.products),
        sellers=staging.stg_sellers(b.sellers),
        geolocation=staging.stg_geolocation(b.geolocations),
        payments=pay,
        reviews=staging.stg_order_reviews(b.reviews),
        category_translation=staging.stg_category_translation(b.category_translation),
        payments_aggregated=intermediate.payments_aggregated(pay),
    )


def calendar_bounds(df: DataFrame, ts_col: str) -> tuple[dt.date, dt.date]:
    """[first, last + 1 day) of a timestamp column: one tiny aggregate row."""
    row = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi")).first()
    return row["lo"], row["hi"] + dt.timedelta(days=1)


class Dimensions(Mapping):
    """Lazily built gold dimensions: a dimension is planned on first access.

    Besides the five dimensions it offers ``customer_keys``/``seller_keys``, the
    key columns of ``dim_customer``/``dim_seller`` (same rows), so a fact build
    does not plan the geography rollup it would only prune away again.
    """

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def settle(self, name: str, written: DataFrame) -> DataFrame:
        """From now on ``name`` is the written table, also for dimensions that build on it."""
        self._built[name] = written
        return written

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def dimensions(spark: SparkSession, s: Silver, calendar: tuple | None = None,
               as_of: dt.date | str | None = None) -> Dimensions:
    start, end = calendar or ("2016-01-01", "2027-12-31")
    d: Dimensions
    d = Dimensions({
        "dim_date": lambda: marts.dim_date(spark, start, end, as_of),
        "dim_geolocation": lambda: marts.dim_geolocation(s.geolocation),
        "dim_customer": lambda: marts.dim_customer(s.customers, d["dim_geolocation"]),
        "dim_seller": lambda: marts.dim_seller(s.sellers, d["dim_geolocation"]),
        "dim_product": lambda: marts.dim_product(s.products, s.category_translation),
        "customer_keys": lambda: marts.customer_keys(s.customers),
        "seller_keys": lambda: marts.seller_keys(s.sellers),
    })
    return d


def fact_sales(s: Silver, dims: Mapping[str, DataFrame], loaded_after=None,
               existing_fact: DataFrame | None = None, by_membership: bool = False) -> DataFrame:
    """The sales fact, or with ``loaded_after`` its increment.

    ``loaded_after`` is the high watermark of the existing fact (a literal, so the filter
    is pushed into the item scan); with ``existing_fact`` as well, older items that
    never made it into the fact come too (see :func:`marts.pending_items`).  An increment
    reduces orders and payments to its own order ids before payments are rolled up.  With
    ``by_membership`` the items are not shuffled for sellers and products (see :func:`marts.fact_sales`).
    """
    customers = dims["customer_keys"] if "customer_keys" in dims else dims["dim_customer"]
    sellers = dims["seller_keys"] if "seller_keys" in dims else dims["dim_seller"]
    items, orders, payments = s.order_items, s.orders, s.payments_aggregated
    if loaded_after is not None:
        items = (incremental_filter(items, loaded_after) if existing_fact is None
                 else marts.pending_items(items, orders, existing_fact, loaded_after))
        ids = items.select("order_id").distinct()
        orders = orders.join(ids, "order_id", "left_semi")
        payments = intermediate.payments_aggregated(s.payments.join(ids, "order_id", "left_semi"))
    return marts.fact_sales(items, orders, payments, customers, sellers, dims["dim_product"],
                            dims["dim_date"], by_membership)


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Expose models as temp views (the view materialisation): SQL over them is
    planned together with the model code by Catalyst."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
