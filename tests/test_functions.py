import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lakemart.functions import (initcap_delim, normalize_null_tokens, surrogate_key, try_decimal,
                                try_double, try_number, try_timestamp, zip_prefix)


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_initcap_delimiters(spark):
    cases = {"credit_card": "Credit_Card", "d'oeste-do sul": "D'oeste-Do Sul", "": "",
             "SAO PAULO": "Sao Paulo", "a  b,  c": "A  B,  C", "x/y(z)": "X/Y(Z)"}
    for raw, want in cases.items():
        assert one(spark, initcap_delim(F.col("s")), raw) == want
    assert one(spark, initcap_delim(F.col("s")), None) is None


def test_null_tokens(spark):
    df = spark.createDataFrame([("NULL",), ("null",), ("None",), ("",), (" NULL ",), ("x",)], "s string")
    got = [r.s for r in normalize_null_tokens(df).collect()]
    assert got == [None, None, None, None, " NULL ", "x"]


def test_try_casts(spark):
    assert one(spark, try_number(F.col("s")), "1.5") == Decimal("2")
    assert one(spark, try_decimal(F.col("s"), 10, 2), "12.345") == Decimal("12.35")
    assert one(spark, try_decimal(F.col("s"), 10, 2), "123456789.5") is None
    assert one(spark, try_decimal(F.col("s"), 10, 2), "abc") is None
    assert one(spark, try_timestamp(F.col("s")), "garbage") is None
    assert one(spark, try_timestamp(F.col("s")), "2018-01-02") == dt.datetime(2018, 1, 2)
    assert one(spark, try_timestamp(F.col("s")), "2018-01-02 10:00:00.123456") == \
        dt.datetime(2018, 1, 2, 10, 0, 0, 123456)
    for bad in ("2018", "2018-01", "20180102", "10:00"):
        assert one(spark, try_timestamp(F.col("s")), bad) is None
    for bad in ("1.5d", "1f", "NaN", "Infinity", "1e", "--1", ".", ""):
        assert one(spark, try_double(F.col("s")), bad) is None
    for text, want in (("1.5", 1.5), (" -2 ", -2.0), ("+.5e2", 50.0), ("3.", 3.0)):
        assert one(spark, try_double(F.col("s")), text) == want


def test_zip_prefix(spark):
    assert one(spark, zip_prefix(F.col("s")), " 123 ") == "00123"
    assert one(spark, zip_prefix(F.col("s")), "123456") == "12345"
    assert one(spark, zip_prefix(F.col("s")), None) is None


def test_surrogate_key(spark):
    df = spark.createDataFrame([("o1", 1, None)], "a string, b int, c string")
    r = df.select(surrogate_key("a", "b").alias("k"), surrogate_key("c").alias("n")).first()
    assert r.k == "d6deb0c4ae1b1259b4e11dd05bf8d397"
    assert r.n == df.select(F.md5(F.lit("_dbt_utils_surrogate_key_null_"))).first()[0]


def test_sql_functions_match_column_functions(spark):
    from lakemart.functions.sql import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT initcap_delim('credit_card') a, initcap_delim('d''oeste-do sul') b, "
                  "zip_prefix(' 123 ') z, null_if_token('None') n, null_if_token('x') x, "
                  "surrogate_key2('o1', '1') k").first()
    assert (r.a, r.b, r.z, r.n, r.x) == ("Credit_Card", "D'oeste-Do Sul", "00123", None, "x")
    assert r.k == "d6deb0c4ae1b1259b4e11dd05bf8d397"
