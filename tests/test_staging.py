import datetime as dt
from decimal import Decimal

from lakemart.plans import intermediate, staging

T = dt.datetime(2024, 1, 1)


def reviews(spark, rows):
    cols = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
            "review_creation_date", "review_answer_timestamp", "_file_name"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return staging.stg_order_reviews(df.selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at"))


def test_review_score_and_comments(spark):
    rows = [(str(i), "o", s, t, None, "2018-01-01 23:59:00", "2018-01-02 00:01:00", "f")
            for i, (s, t) in enumerate([("9", None), ("3.5", "   "), ("5.4", " hi "), (None, None)])]
    out = {r.review_id: r for r in reviews(spark, rows).collect()}
    assert out["0"].review_score is None and out["0"].is_positive_review is True
    assert out["1"].review_score == Decimal(4) and out["1"].is_positive_review is True
    assert out["2"].review_score == Decimal(5) and out["2"].is_positive_review is True
    assert out["3"].review_score is None and out["3"].is_positive_review is False
    assert out["0"].review_comment_title == "No comment"
    assert out["1"].review_comment_title == ""
    assert out["2"].review_comment_title == "hi"
    assert out["0"].review_comment_message == "No comment"
    assert out["0"].review_response_time == 1


def test_orders_delivery_flags(spark):
    cols = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date",
            "order_estimated_delivery_date", "_file_name"]
    rows = [("a", "c", " Delivered ", "2018-01-01 23:59:00", None, None, None, "2018-01-10", "f"),
            ("b", "c", "SHIPPED", "2018-01-01 23:59:00", None, None, "2018-01-10 00:00:00", "2018-01-10", "f"),
            ("c", "c", "x", "2018-01-01 23:59:00", None, None, "2018-01-10 00:00:01", "2018-01-10", "f"),
            (None, "c", "x", None, None, None, None, None, "f")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)) \
        .selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at")
    out = {r.order_id: r for r in staging.stg_orders(df).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["a"].order_status == "delivered"
    assert out["a"].delivered_on_time is False and out["a"].days_to_deliver is None
    assert out["b"].delivered_on_time is True and out["b"].days_to_deliver == 9
    assert out["c"].delivered_on_time is False


def test_customers_latest_row_wins_before_null_filter(spark):
    rows = [("c1", "p1", "1", "sp city", "sp", "f1", dt.datetime(2024, 1, 1)),
            ("c1", None, "2", "rio", "rj", "f2", dt.datetime(2024, 1, 8)),
            ("c2", "p2", " 123 ", None, None, "f1", dt.datetime(2024, 1, 1)),
            ("c2", "p2", "9", "old", "xx", "f0", dt.datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "customer_id string, customer_unique_id string, "
                               "customer_zip_code_prefix string, customer_city string, "
                               "customer_state string, _file_name string, _loaded_at timestamp_ntz")
    out = staging.stg_customers(df).collect()
    assert [r.customer_id for r in out] == ["c2"]
    assert out[0].zip_code_prefix == "00123" and out[0].customer_city == "Unknown"
    assert out[0].customer_state == "XX"


def test_items_and_payments_null_filters(spark):
    items = spark.createDataFrame(
        [("o1", "1", "p", "s", "2018-01-01", "10.005", "1"), ("o1", "x", "p", "s", None, "1", "1")],
        "order_id string, order_item string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string") \
        .selectExpr("*", "'f' AS _file_name", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at")
    out = staging.stg_order_items(items).collect()
    assert len(out) == 1 and out[0].price == Decimal("10.01") and out[0].order_item_total == Decimal("11.01")
    pays = spark.createDataFrame(
        [("o1", "1", "credit_card", "1", "abc"), ("o1", "2", " NOT_DEFINED ", "1", "5"),
         ("o1", "3", "voucher", "1", None)],
        "order_id string, payment_sequence string, payment_type string, "
        "payment_installments string, payment_value string") \
        .selectExpr("*", "'f' AS _file_name", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at")
    p = {r.payment_sequential: r for r in staging.stg_payments(pays).collect()}
    assert set(p) == {Decimal(1), Decimal(2)}
    assert p[Decimal(1)].payment_value is None and p[Decimal(1)].payment_type == "Credit_Card"
    assert p[Decimal(2)].payment_type == "Unknown"


def test_payments_aggregated_rules(spark):
    rows = [("a", 1, "Voucher", 1, "10.00"), ("a", 2, "Credit_Card", 2, "20.00"),
            ("b", 2, "Boleto", 1, "5.00"), ("b", 1, "Boleto", 1, "5.00"),
            ("c", 1, "Boleto", 1, "5.00"), ("c", 2, "Voucher", 1, None)]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, "
                               "payment_installments int, payment_value string") \
        .selectExpr("order_id", "CAST(payment_sequential AS DECIMAL(38,0)) AS payment_sequential",
                    "payment_type", "CAST(payment_installments AS DECIMAL(38,0)) AS payment_installments",
                    "CAST(payment_value AS DECIMAL(10,2)) AS payment_value")
    out = {r.order_id: r for r in intermediate.payments_aggregated(df).collect()}
    assert out["a"].is_mixed_payment is True and out["a"].primary_payment_type == "Credit_Card"
    assert out["a"].total_payment_value == Decimal("30.00") and out["a"].payment_count == 2
    assert out["b"].is_mixed_payment is False and out["b"].primary_payment_value == Decimal("5.00")
    assert out["c"].primary_payment_type == "Voucher" and out["c"].primary_payment_value is None


def test_models_as_sql_views(spark):
    from lakemart.functions.sql import register_sql_functions
    from lakemart.plans import build
    rows = [("o1", "1", "credit_card", "1", "10.00"), ("o1", "2", "voucher", "1", "5.00")]
    pays = spark.createDataFrame(rows, "order_id string, payment_sequence string, payment_type string, "
                                       "payment_installments string, payment_value string") \
        .selectExpr("*", "'f' AS _file_name", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at")
    stg = staging.stg_payments(pays)
    build.register_views(spark, {"stg_payments": stg,
                                 "payments_aggregated": intermediate.payments_aggregated(stg)})
    register_sql_functions(spark)
    r = spark.sql("SELECT a.primary_payment_type, a.is_mixed_payment, surrogate_key(a.order_id) AS k, "
                  "(SELECT count(*) FROM stg_payments) AS n FROM payments_aggregated a").first()
    assert (r.primary_payment_type, r.is_mixed_payment, r.n) == ("Credit_Card", True, 2)
    assert r.k == spark.sql("SELECT md5('o1')").first()[0]
