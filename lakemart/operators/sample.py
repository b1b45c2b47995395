"""Repeatable random samples (``ORDER BY RANDOM() LIMIT n``).

The order is an MD5 of the key columns and a seed, so a sample is the same on
every run and every engine.  With ``n`` the plan is a TakeOrderedAndProject:
each task keeps its own best ``n`` and only those are merged, so nothing but
the sample itself reaches one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import scratch_path


def sample_order(keys: Sequence[str], seed: int | str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_sample(df: DataFrame, n: int | None, keys: Sequence[str], seed: int | str = 42) -> DataFrame:
    """``n`` rows in seeded pseudo-random order; ``n=None`` shuffles all rows."""
    ordered = df.orderBy(sample_order(keys, seed))
    return ordered if n is None else ordered.limit(n)


def hash_positions(df: DataFrame, keys: Sequence[str], seed: int | str = 42) -> DataFrame:
    """Every row with its ``position`` (from 1) in the seeded shuffle.

    Rows are range-partitioned by the shuffle key and counted per partition; a row's
    position is its place in its partition after the rows of those before it, so no task
    sees more than one partition.  Rows that share the key follow each other in any order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    (df.withColumn("shuffle_key", sample_order(keys, seed)).repartitionByRange("shuffle_key")
       .withColumn("__pid", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    # one row per partition
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__pid").orderBy("shuffle_key"))
    return (ranged.join(before, "__pid")
                  .withColumn("position", (inside + F.col("__before")).cast("long"))
                  .drop("__pid", "__before"))
