import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators.stats import medians_per_key, modes_per_key
from lakemart.plans import marts


def test_median_mode_small(spark):
    rows = [("z", 1.0, "b"), ("z", 2.0, "a"), ("z", 3.0, "a"), ("z", 10.0, "b"), ("z", None, None),
            ("y", 5.0, "q"), ("w", None, None)]
    df = spark.createDataFrame(rows, "k string, v double, c string")
    med = {r.k: r.m for r in medians_per_key(df, "k", {"m": "v"}).collect()}
    mod = {r.k: r.c for r in modes_per_key(df, "k", {"c": "c"}).collect()}
    assert med == {"z": 2.5, "y": 5.0}
    assert mod == {"z": "a", "y": "q"}


def test_median_hot_key_matches_builtin(spark):
    # one key holds most rows and is split over many range partitions
    df = spark.range(0, 20011).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 10007 / 3.0).alias("v"))
    got = {r.k: r.m for r in medians_per_key(df, "k", {"m": "v"}, partitions=16).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k] - want[k]) < 1e-9, k


def test_dim_date_reference_range(spark):
    d = marts.dim_date(spark, "2016-01-01", "2027-12-31", as_of="2020-01-01")
    assert d.count() == 4382
    r = d.agg(F.max("full_date"), F.min("date_key")).first()
    assert r[0] == dt.date(2027, 12, 30) and r[1] == 20160101
    first = d.where("full_date = DATE'2016-01-01'").first()
    assert first.week_of_year == 53 and first.day_name == "Fri" and first.month_name == "Jan"
    sunday = d.where("full_date = DATE'2016-01-03'").first()
    assert sunday.day_of_week == 0 and sunday.is_weekend and not sunday.is_weekday
    assert d.where("is_today").count() == 1
