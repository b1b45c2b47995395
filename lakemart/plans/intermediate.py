"""Intermediate models: pre-aggregations that stop join fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payments_aggregated(stg_payments: DataFrame) -> DataFrame:
    """One row per order: totals, count, installments, mixed flag, dominant payment.

    The dominant payment is the highest value (a NULL value ranks first, as the
    warehouse sorts NULLs first under DESC), then the lowest sequence number,
    then the highest type name.  All of it is one partially aggregated
    ``groupBy``: the top-1 is a ``max`` over an ordered struct, and
    ``COUNT(DISTINCT type) > 1`` is ``min(type) <> max(type)`` -- no second
    scan, no self-join, no Expand, and a hot order is combined map-side.
    """
    v, s, t = F.col("payment_value"), F.col("payment_sequential"), F.col("payment_type")
    rank = F.struct(v.isNull().alias("v_null"), v.alias("v"),
                    s.isNull().alias("s_null"), (-s).alias("neg_s"), t.alias("t"))
    agg = stg_payments.groupBy("order_id").agg(
        F.sum(v).alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_installments").alias("total_installments"),
        F.coalesce(F.min(t) != F.max(t), F.lit(False)).alias("is_mixed_payment"),
        F.max(rank).alias("_top"))
    return agg.select("order_id", "total_payment_value", "payment_count", "total_installments",
                      "is_mixed_payment",
                      F.col("_top.t").alias("primary_payment_type"),
                      F.col("_top.v").alias("primary_payment_value"))
