"""One key holding most of the rows: results stay exact, and the plans reduce
the hot key before the shuffle (partial top-1 / partial aggregation)."""

from pyspark.sql import functions as F

from lakemart.operators import quality
from lakemart.operators.dedupe import latest_per_key
from lakemart.operators.quality import Check
from lakemart.plans import intermediate


def hot(spark, n=50000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id"), (F.col("id") % 977).cast("double").alias("v"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top1_hot_key(spark):
    df = hot(spark)
    out = latest_per_key(df, ["k"], "v")
    p = plan(out)
    assert "WindowGroupLimit" in p and "Partial" in p
    got = {r.k: (r.v, r.id) for r in out.collect()}
    # hot key: highest v, ties broken by the lowest id
    want = df.where("k = 'hot'").orderBy(F.col("v").desc(), F.col("id")).first()
    assert got["hot"] == (want.v, want.id)
    assert len(got) == df.select("k").distinct().count()


def test_payments_rollup_hot_order(spark):
    pays = hot(spark).select(F.col("k").alias("order_id"),
                             F.col("id").cast("decimal(38,0)").alias("payment_sequential"),
                             F.when(F.col("id") % 2 == 0, "Boleto").otherwise("Voucher").alias("payment_type"),
                             F.lit(1).cast("decimal(38,0)").alias("payment_installments"),
                             F.col("v").cast("decimal(10,2)").alias("payment_value"))
    out = intermediate.payments_aggregated(pays)
    assert "partial_" in plan(out)
    r = out.where("order_id = 'hot'").first()
    n_hot = pays.where("order_id = 'hot'").count()
    assert r.payment_count == n_hot and r.is_mixed_payment
    assert float(r.primary_payment_value) == 976.0


def test_value_tests_hot_value(spark):
    df = hot(spark)
    got = {r.test: r.violations for r in quality.run_tests(
        {"t": df}, [Check("t", "unique", "k"), Check("t", "accepted_values", "k", values=("hot",))]).collect()}
    assert got == {"unique": 1, "accepted_values": df.where("k <> 'hot'").count()}


def test_as_of_join_hot_key(spark):
    import datetime as dt

    from lakemart.operators import history
    t1, t2, t3 = (dt.datetime(2024, 1, d) for d in (1, 11, 21))
    src = lambda city: spark.createDataFrame([("hot", city), ("cold", "c")], "id string, city string")
    h = history.scd2_check(None, src("a"), "id", ["city"], t1)
    h = history.scd2_check(h, src("b"), "id", ["city"], t2)
    h = history.scd2_check(h, src("c"), "id", ["city"], t3)
    facts = spark.range(30 * 24 * 60).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.lit("cold")).alias("id"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    got = {(r.id, r.h__city): r.n for r in history.as_of_join(facts, h, "id", "ts")
           .groupBy("id", "h__city").agg(F.count(F.lit(1)).alias("n")).collect()}
    first_version_minutes = 10 * 24 * 60          # [Jan 1, Jan 11)
    assert sum(v for (k, _), v in got.items() if k == "hot") == facts.where("id = 'hot'").count()
    assert got[("hot", "a")] == first_version_minutes * 9 // 10
    assert got[("cold", "c")] == facts.where("id = 'cold'").count()


def test_fact_plan_reads_what_it_needs_at_every_size(spark):
    """No size switch: the same plan shape at both sizes, and only the needed columns are read."""
    import re

    from lakemart.plans.catalog import fact_sales

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shapes = []
        for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
            p = plan(fact_sales(spark, sf))
            schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
            item = next(s for s in schemas if "l_orderkey" in s)
            assert not re.search("l_tax|l_discount|l_returnflag|l_linestatus", item)
            assert "o_orderpriority" not in "".join(schemas)
            shapes.append(re.findall(r"(\w+Join|Exchange \w+|\w*Aggregate|Window|Scan parquet)", p))
        assert shapes[0] == shapes[1]
        assert not re.search("NestedLoop|Cartesian", p)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_membership_keeps_items_where_they_are(spark):
    """Orphans, ids that a dimension holds twice, NULL ids: as the joins give, without their shuffles."""
    from lakemart.functions import surrogate_key
    from lakemart.plans import marts
    items = spark.range(2000).select(
        F.concat(F.lit("o"), F.col("id") % 300).alias("order_id"), F.col("id").cast("decimal(38,0)").alias("order_item_id"),
        F.when(F.col("id") % 50 != 9, F.concat(F.lit("p"), F.col("id") % 40)).alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit("s0")).otherwise(F.concat(F.lit("s"), F.col("id") % 30)).alias("seller_id"),
        F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).cast("decimal(10,2)").alias("freight_value"),
        F.lit(2).cast("decimal(11,2)").alias("order_item_total"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("_loaded_at"))
    orders = spark.range(300).select(
        F.concat(F.lit("o"), F.col("id")).alias("order_id"), F.lit("c").alias("customer_id"),
        F.lit("shipped").alias("order_status"), F.lit("2024-01-01").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(True).alias("delivered_on_time"), F.lit(1).alias("days_to_deliver"))
    pays = spark.createDataFrame([], "order_id string, total_payment_value decimal(20,2), "
                                     "primary_payment_type string, is_mixed_payment boolean")

    def dim(name, ids):
        df = spark.createDataFrame([(f"{name[0]}{i}",) for i in ids], f"{name}_id string")
        return df.select(f"{name}_id", surrogate_key(f"{name}_id").alias(f"{name}_key"))

    dims = (spark.createDataFrame([("c", "kc")], "customer_id string, customer_key string"),
            dim("seller", [0, *range(2, 30), 2, 5, 5]), dim("product", [*range(35), 3]),
            marts.dim_date(spark, "2024-01-01", "2024-01-02", "2024-01-01"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined, members = (marts.fact_sales(items, orders, pays, *dims, by_membership=m) for m in (False, True))
        assert sorted(map(str, members.collect())) == sorted(map(str, joined.collect()))
        assert members.where("seller_key IS NULL").count() and members.where("product_key IS NULL").count()
        for df, shuffled in ((joined, True), (members, False)):
            text = plan(df)
            assert ("hashpartitioning(seller_id" in text) == shuffled == ("hashpartitioning(product_id" in text)
        assert marts.exceptional_ids(items, dims[1], "seller_id", limit=1) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_the_fact_queries_give_item_keys_by_membership(spark, monkeypatch):
    from lakemart.plans import catalog, marts
    looked_up = []
    find = marts.exceptional_ids
    monkeypatch.setattr(marts, "exceptional_ids",
                        lambda items, dim, id_col: looked_up.append(id_col) or find(items, dim, id_col))
    plan = catalog.QUERIES["fact_sales"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert looked_up == ["seller_id", "product_id"]
    assert "part.parquet" not in plan and "supplier.parquet" not in plan


def test_many_exceptional_ids_are_counted_on_short_rows(spark, monkeypatch):
    """More exceptions than may be broadcast: the items meet the dimensions' counts before their orders, with the
    rows of a plain join."""
    from lakemart.plans import build, catalog, marts

    s, dims = catalog.gold(spark, "/root/testdata/sf0.001")
    uneven = lambda d, k: d.where(f"CAST({k} AS BIGINT) % 7 <> 3").unionByName(
        d.where(f"CAST({k} AS BIGINT) % 11 = 5"))
    dims = {**{k: dims[k] for k in ("customer_keys", "dim_date")},
            "seller_keys": uneven(dims["seller_keys"], "seller_id"),
            "dim_product": uneven(dims["dim_product"], "product_id")}
    want = build.fact_sales(s, dims)
    monkeypatch.setattr(marts, "exceptional_ids", lambda *args: None)
    got = build.fact_sales(s, dims, by_membership=True)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    depth = lambda part: min(len(x) - len(x.lstrip(" :+-")) for x in text.splitlines() if part in x)
    assert depth("AS n_product_id") > depth("Join Inner") and depth("AS n_seller_id") > depth("Join Inner")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
