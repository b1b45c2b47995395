"""Gold star schema: calendar, geography, customer, seller, product, sales fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import (date_key, day_abbr, day_of_week0, month_abbr, surrogate_key,
                                year_month)
from lakemart.operators.merge import incremental_filter, ntz_literal
from lakemart.operators.stats import medians_per_key, modes_per_key
from lakemart.session import scratch_path, write_table


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day, ``start`` inclusive, ``end`` exclusive, generated in parallel."""
    s, e = _as_date(start), _as_date(end)
    if e < s:
        raise ValueError(f"the calendar ends ({e}) before it begins ({s})")
    return spark.range((e - s).days).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("date_day"))


def dim_date(spark: SparkSession, start: str | dt.date = "2016-01-01",
             end: str | dt.date = "2027-12-31", as_of: str | dt.date | None = None) -> DataFrame:
    d = F.col("date_day")
    today: Column = F.current_date() if as_of is None else F.lit(_as_date(as_of))
    weekend = day_of_week0(d).isin(0, 6)
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month_number"),
        month_abbr(d).alias("month_name"),
        year_month(d).alias("year_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week0(d).alias("day_of_week"),
        day_abbr(d).alias("day_name"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (d == today).alias("is_today"),
        (d <= today).alias("is_past_or_today"))


def dim_geolocation(stg_geolocation: DataFrame) -> DataFrame:
    """Zip grain: median coordinates and most common city/state per zip."""
    z = "zip_code_prefix"
    g = stg_geolocation
    out = (g.select(z).distinct()
            .join(medians_per_key(g, z, {"latitude": "geolocation_lat", "longitude": "geolocation_lng"}),
                  z, "left")
            .join(modes_per_key(g, z, {"city": "geolocation_city", "state": "geolocation_state"}),
                  z, "left"))
    return out.select(surrogate_key(z).alias("geo_key"), z, "latitude", "longitude", "city", "state")


def _geo_enrich(dim_geo: DataFrame, zip_col: str) -> DataFrame:
    return dim_geo.select(F.col("zip_code_prefix").alias(zip_col), "latitude", "longitude",
                          F.col("city").alias("primary_city"))


def dim_customer(stg_customers: DataFrame, dim_geo: DataFrame) -> DataFrame:
    c = stg_customers.join(_geo_enrich(dim_geo, "zip_code_prefix"), "zip_code_prefix", "left")
    return c.select(surrogate_key("customer_id").alias("customer_key"), "customer_id",
                    "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state",
                    "latitude", "longitude", "primary_city")


def dim_seller(stg_sellers: DataFrame, dim_geo: DataFrame) -> DataFrame:
    s = stg_sellers.join(_geo_enrich(dim_geo, "seller_zip_code_prefix"), "seller_zip_code_prefix", "left")
    return s.select(surrogate_key("seller_id").alias("seller_key"), "seller_id",
                    "seller_zip_code_prefix", "seller_city", "seller_state",
                    "latitude", "longitude", "primary_city")


def customer_keys(stg_customers: DataFrame) -> DataFrame:
    """``dim_customer``'s (customer_id, customer_key) without the geography join.

    The join to the zip-grain geography is 1:1 (one row per zip), so these are
    exactly the dimension's rows; the fact needs nothing else from it.
    """
    return stg_customers.select(surrogate_key("customer_id").alias("customer_key"), "customer_id")


def seller_keys(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select(surrogate_key("seller_id").alias("seller_key"), "seller_id")


def dim_product(stg_products: DataFrame, stg_category_translation: DataFrame) -> DataFrame:
    ct = stg_category_translation.select(
        "product_category_name", F.col("product_category_name_english").alias("_english"))
    p = stg_products.join(ct, "product_category_name", "left")
    return p.select(
        surrogate_key("product_id").alias("product_key"), "product_id",
        F.col("product_category_name").alias("product_category_name_portuguese"),
        F.coalesce("_english", "product_category_name", F.lit("Uncategorized"))
         .alias("product_category_name_english"),
        "product_name_length", "product_description_length", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "product_volume_cm3")


SHIPPED_STATUSES = ("delivered", "shipped")


def pending_items(order_items: DataFrame, orders: DataFrame, existing_fact: DataFrame,
                  loaded_after) -> DataFrame:
    """Items past the watermark plus older items that never reached the fact.

    The plain watermark loses an item whose order was not shipped yet when it
    arrived: later runs only look past the watermark.  This adds those items
    back.  Only orders that landed past the watermark can have changed, so the older items
    are those of such orders, less those whose key the fact has.
    """
    new = incremental_filter(order_items, loaded_after)
    changed = incremental_filter(orders, loaded_after).select("order_id").distinct()
    old = (order_items.where(F.col("_loaded_at") <= ntz_literal(loaded_after))
                      .join(changed, "order_id", "left_semi")
                      .withColumn("_sk", surrogate_key("order_id", "order_item_id"))
                      .join(existing_fact.select(F.col("sales_key").alias("_sk")), "_sk", "left_anti")
                      .drop("_sk"))
    return new.unionByName(old)


#: Ids that may be sent to every task by :func:`exceptional_ids`: some 50 bytes each.
EXCEPTIONS = 200_000


def exceptional_ids(items: DataFrame, dim: DataFrame, id_col: str,
                    limit: int = EXCEPTIONS) -> DataFrame | None:
    """(id, n): ids of ``items`` that ``dim`` doesn't hold exactly once, n being how often it does.

    Only distinct ids are shuffled, after a map-side reduction.  The result is written and counted, and
    None when there are more than ``limit``, so that what is broadcast is known to be small.
    """
    spark = items.sparkSession
    held = dim.groupBy(id_col).agg(F.count("*").alias("n"))
    odd = (items.select(id_col).where(F.col(id_col).isNotNull()).distinct().join(held, id_col, "left")
           .select(id_col, F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1"))
    odd = write_table(odd, scratch_path(spark, f"exceptional-{id_col}"))
    return odd if odd.count() <= limit else None


def keyed_by_membership(items: DataFrame, odd: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """What a left join of ``items`` with a dimension on ``id_col`` gives for ``key_col``, the surrogate key
    of the id, without shuffling the items: NULL for an id that it lacks, a row for each time it holds one."""
    n = F.when(F.col(id_col).isNotNull(), F.coalesce("n", F.lit(1))).otherwise(0)
    return _times_held(items.join(F.broadcast(odd), id_col, "left").withColumn("n", n), "n", id_col, key_col)


def _times_held(j: DataFrame, n: str, id_col: str, key_col: str) -> DataFrame:
    """The key of each id that is held at all, a row for each of the ``n`` times."""
    j = j.withColumn(key_col, F.when(F.col(n) > 0, surrogate_key(id_col)))
    return j.withColumn(n, F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1))))).drop(n)


def counted_in(items: DataFrame, dim: DataFrame, id_col: str, n: str) -> DataFrame:
    """``items`` with ``n``, how often ``dim`` holds their id: by a join with the counts."""
    held = dim.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias(n))
    return items.join(held, id_col, "left").withColumn(n, F.coalesce(n, F.lit(0)))


def fact_sales(order_items: DataFrame, orders: DataFrame, payments: DataFrame,
               dim_customer: DataFrame, dim_seller: DataFrame, dim_product: DataFrame,
               dim_date: DataFrame, by_membership: bool = False) -> DataFrame:
    """Order-line fact of delivered/shipped orders, over the given items.

    Join order: the customer, payment and calendar lookups depend only on the
    order, so they are joined to the (filtered) orders first -- the order-grain
    table is several times smaller than the item-grain one -- and the items
    are shuffled exactly once, on ``order_id``.  Because the status filter
    rejects NULLs the items-orders LEFT JOIN becomes an inner join, and the
    filter itself reaches the orders scan.  Sellers and products are joined
    on the item grain.  No lookup carries a broadcast hint: Spark broadcasts
    those whose known or measured size is small.  A hot order is split by
    AQE's skew-join handling.

    ``by_membership``: sellers and products give only their surrogate keys, which are functions of the
    ids, so the items need no join with them but the exceptions: ids that a dimension lacks or
    repeats.  These are found first, by small jobs over the ids alone, and the items stay where they are.
    (With more than ``EXCEPTIONS`` of them the items are joined with the dimension's counts of its ids before
    they meet their orders, while their rows are short, and the keys are made after that.)
    """
    oi = order_items
    o = (orders.where(F.col("order_status").isin(*SHIPPED_STATUSES))
               .select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                       "delivered_on_time", "days_to_deliver"))
    p = payments.select("order_id", "total_payment_value", "primary_payment_type", "is_mixed_payment")
    dc = dim_customer.select("customer_id", "customer_key")
    ds = dim_seller.select("seller_id", "seller_key")
    dp = dim_product.select("product_id", "product_key")
    dd = dim_date.select("full_date", "date_key")
    enriched_orders = (o.join(p, "order_id", "left")
                        .join(dc, "customer_id", "left")
                        .join(dd, F.to_date(F.col("order_purchase_timestamp")) == F.col("full_date"), "left"))
    lookups = ((ds, "seller_id", "seller_key"), (dp, "product_id", "product_key"))
    odd = {id_col: exceptional_ids(order_items, dim, id_col) if by_membership else None for dim, id_col, _ in lookups}
    if by_membership:
        for dim, id_col, _ in lookups:
            if odd[id_col] is None:
                oi = counted_in(oi, dim, id_col, f"n_{id_col}")
    j = oi.join(enriched_orders, "order_id", "inner")
    for dim, id_col, key_col in lookups:
        if not by_membership:
            j = j.join(dim, id_col, "left")
        elif odd[id_col] is None:
            j = _times_held(j, f"n_{id_col}", id_col, key_col)
        else:
            j = keyed_by_membership(j, odd[id_col], id_col, key_col)
    return j.select(
        surrogate_key("order_id", "order_item_id").alias("sales_key"),
        "customer_key", "seller_key", "product_key", "date_key",
        "order_id", "order_item_id", "order_status", "order_purchase_timestamp",
        "delivered_on_time", "days_to_deliver", "price", "freight_value", "order_item_total",
        "total_payment_value",
        F.coalesce("primary_payment_type", F.lit("Unknown")).alias("primary_payment_type"),
        "is_mixed_payment", "_loaded_at")
