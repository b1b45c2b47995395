import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators import merge


def frame(spark, rows, extra=False):
    schema = "k string, v int, month string, _loaded_at timestamp_ntz" + (", extra string" if extra else "")
    return spark.createDataFrame(rows, schema)


def read(spark, path):
    return sorted(tuple(r) for r in merge.read_table(spark, path).select("k", "v", "month").collect())


def test_watermark(spark):
    assert merge.high_watermark(None) == dt.datetime(1900, 1, 1)
    t = frame(spark, [("a", 1, "m", dt.datetime(2024, 1, 1))])
    wm = merge.high_watermark(t)
    src = frame(spark, [("a", 1, "m", dt.datetime(2024, 1, 1)), ("b", 1, "m", dt.datetime(2024, 1, 2))])
    assert [r.k for r in merge.incremental_filter(src, wm).collect()] == ["b"]
    empty = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert merge.high_watermark(empty) == dt.datetime(1900, 1, 1)


def test_upsert_partitions_dedupe_rerun_and_schema(spark, tmp):
    path = f"{tmp}/fact"
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    first = frame(spark, [("a", 1, "2024-01", d1), ("b", 1, "2024-02", d1)])
    assert merge.upsert_table(first, path, ["k"], ["month"])["mode"] == "create"
    src = frame(spark, [("a", 2, "2024-01", d2), ("a", 3, "2024-01", d1), ("c", 1, "2024-01", d2)])
    rep = merge.upsert_table(src, path, ["k"], ["month"])
    assert rep["partitions"] == [("2024-01",)]
    assert read(spark, path) == [("a", 2, "2024-01"), ("b", 1, "2024-02"), ("c", 1, "2024-01")]
    merge.upsert_table(src, path, ["k"], ["month"])          # rerun: no change
    assert read(spark, path) == [("a", 2, "2024-01"), ("b", 1, "2024-02"), ("c", 1, "2024-01")]
    wider = frame(spark, [("d", 1, "2024-03", d2, "x")], extra=True)
    rep = merge.upsert_table(wider, path, ["k"], ["month"])
    assert rep["schema_synced"]
    got = {r.k: r.extra for r in merge.read_table(spark, path).collect()}
    assert got == {"a": None, "b": None, "c": None, "d": "x"}


def test_merge_frames_sync_drops_removed_columns(spark):
    t = frame(spark, [("a", 1, "m", dt.datetime(2024, 1, 1), "old")], extra=True)
    s = frame(spark, [("b", 2, "m", dt.datetime(2024, 1, 2))])
    out = merge.merge_frames(t, s, ["k"])
    assert out.columns == s.columns and out.count() == 2


def test_open_orders_are_lost_by_default_and_kept_on_request(spark):
    import datetime as dt

    from lakemart.plans import build, marts
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", "1.00", "1.00", d1), ("o2", 1, "p", "s", "1.00", "1.00", d1),
         ("o3", 1, "p", "s", "1.00", "1.00", d2)],
        "order_id string, order_item_id int, product_id string, seller_id string, price string, "
        "freight_value string, _loaded_at timestamp_ntz") \
        .selectExpr("order_id", "CAST(order_item_id AS DECIMAL(38,0)) AS order_item_id", "product_id",
                    "seller_id", "CAST(price AS DECIMAL(10,2)) AS price",
                    "CAST(freight_value AS DECIMAL(10,2)) AS freight_value",
                    "CAST(price AS DECIMAL(10,2)) + CAST(freight_value AS DECIMAL(10,2)) AS order_item_total",
                    "_loaded_at")

    def orders(o2_status, o2_loaded=d1):
        return spark.createDataFrame(
            [("o1", "c", "delivered", d1), ("o2", "c", o2_status, o2_loaded), ("o3", "c", "shipped", d2)],
            "order_id string, customer_id string, order_status string, _loaded_at timestamp_ntz") \
            .selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS order_purchase_timestamp",
                        "true AS delivered_on_time", "1 AS days_to_deliver")
    pays = spark.createDataFrame([], "order_id string, payment_sequential decimal(38,0), payment_type string, "
                                     "payment_installments decimal(38,0), payment_value decimal(10,2)")
    dims = {"customer_keys": spark.createDataFrame([("c", "kc")], "customer_id string, customer_key string"),
            "seller_keys": spark.createDataFrame([("s", "ks")], "seller_id string, seller_key string"),
            "dim_product": spark.createDataFrame([("p", "kp")], "product_id string, product_key string"),
            "dim_date": marts.dim_date(spark, "2024-01-01", "2024-01-02", "2024-01-01")}

    def run(o, wm=None, existing=None):
        from lakemart.plans import intermediate
        s = build.Silver(o, items, None, None, None, None, pays, None, None,
                         intermediate.payments_aggregated(pays))
        return build.fact_sales(s, dims, wm, existing)
    first = run(orders("processing")).where(F.col("_loaded_at") <= merge.ntz_literal(d1))
    assert sorted(r.order_id for r in first.collect()) == ["o1"]
    plain = run(orders("shipped", d2), d1)
    assert sorted(r.order_id for r in plain.collect()) == ["o3"]
    again = run(orders("shipped", d2), d1, first)
    assert sorted(r.order_id for r in again.collect()) == ["o2", "o3"]


def test_upsert_of_a_key_that_moved(spark, tmp):
    path, d1, d2 = f"{tmp}/fact", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    merge.upsert_table(frame(spark, [("a", 1, None, d1), ("b", 1, "2024-02", d1), ("c", 1, "2024-03", d1)]),
                       path, ["k"], ["month"])
    src = frame(spark, [("a", 2, "2024-02", d2), ("c", 2, "2024-01", d2)])
    for _ in range(2):  # the second time changes nothing
        merge.upsert_table(src, path, ["k"], ["month"])
        assert read(spark, path) == [("a", 2, "2024-02"), ("b", 1, "2024-02"), ("c", 2, "2024-01")]


def test_upsert_with_changed_types(spark, tmp):
    import pytest
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    for parts in (["month"], []):
        path = f"{tmp}/fact{len(parts)}"
        merge.upsert_table(frame(spark, [("a", 1, "2024-01", d1), ("b", 7, "2024-02", d1)]), path, ["k"], parts)
        wide = frame(spark, [("c", 5, "2024-01", d2)]).withColumn("v", F.col("v").cast("decimal(12,2)"))
        assert merge.upsert_table(wide, path, ["k"], parts)["schema_synced"]
        assert [(k, float(v), m) for k, v, m in read(spark, path)] == [
            ("a", 1.0, "2024-01"), ("b", 7.0, "2024-02"), ("c", 5.0, "2024-01")]
        assert dict(merge.read_table(spark, path).dtypes)["v"] == "decimal(12,2)"
        narrow = frame(spark, [("d", 5, "2024-01", d2)]).withColumn("k", F.lit(1))
        with pytest.raises(merge.SchemaChangeError, match="k"):
            merge.upsert_table(narrow, path, ["k"], parts)
        assert len(read(spark, path)) == 3
