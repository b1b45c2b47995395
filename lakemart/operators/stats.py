"""Exact per-key MODE and MEDIAN that survive a hot key.

The built-in ``mode``/``median`` keep every distinct value of a group in one
aggregation buffer at the final merge, so one key with a third of the rows
would land whole in one task.  Here both are rebuilt from shuffles that split
such a key:

* mode: count (key, value) pairs (map-side combined), then top-1 per key,
  which is itself partially limited before its shuffle.
* median: count (key, value) pairs, range-partition them on (key, value) so a
  hot key spreads over many partitions in value order, pin that layout in a
  written table, turn per-partition counts into rank offsets, and pick the one
  or two values at the middle rank.  No task ever holds more than one range
  partition of one key.

Several columns are handled in one pipeline by stacking them as
(key, column, value) -- one shuffle (and one written table) serves them all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.dedupe import top1_per_key
from lakemart.session import remove_path, scratch_path


def _stack(df: DataFrame, key: str, columns: Mapping[str, str], cast: str | None) -> DataFrame:
    vals = [(F.col(c).cast(cast) if cast else F.col(c)) for c in columns.values()]
    return (df.select(F.col(key).alias("_k"), F.explode(F.array(*[
                F.struct(F.lit(i).alias("_i"), v.alias("_v")) for i, v in enumerate(vals)])).alias("_s"))
              .select("_k", "_s._i", "_s._v")
              .where(F.col("_v").isNotNull()))


def _unstack(per: DataFrame, key: str, columns: Mapping[str, str], value: str) -> DataFrame:
    return per.groupBy(F.col("_k").alias(key)).agg(*[
        F.max(F.when(F.col("_i") == i, F.col(value))).alias(out) for i, out in enumerate(columns)])


def modes_per_key(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """``{out: col}`` -> most frequent non-NULL value of each col per key (ties: lowest)."""
    counts = _stack(df, key, columns, "string").groupBy("_k", "_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
    top = top1_per_key(counts, ["_k", "_i"], [F.col("_n").desc(), F.col("_v").asc()], tiebreak=False)
    return _unstack(top, key, columns, "_v")


def mode_per_key(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return modes_per_key(df, key, {out or value: value})


#: Counted (key, value) pairs in a range partition, about.
PAIRS_PER_PARTITION = 1_000_000


def medians_per_key(df: DataFrame, key: str, columns: Mapping[str, str],
                    partitions: int | None = None) -> DataFrame:
    """``{out: col}`` -> exact interpolated median (DOUBLE) of each col per key, NULLs ignored."""
    spark = df.sparkSession
    counted = scratch_path(spark, "median-pairs")
    (_stack(df, key, columns, "double").groupBy("_k", "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
     .write.parquet(counted))
    pairs = spark.read.parquet(counted)
    # sized from the measured number of pairs, so no range partition grows with the data
    n_parts = partitions or pairs.count() // PAIRS_PER_PARTITION + 1
    # value order inside each (key, column), split across partitions where a key
    # is hot; the written table freezes which partition every pair landed in
    ranged_path = scratch_path(spark, "median-ranged")
    (pairs.repartitionByRange(n_parts, "_k", "_i", "_v").withColumn("_pid", F.spark_partition_id())
     .write.parquet(ranged_path))
    remove_path(spark, counted)
    ranged = spark.read.parquet(ranged_path)
    g = ["_k", "_i"]
    # one row per (partition, key, column) touched: at most partitions + groups
    per_part = ranged.groupBy("_pid", *g).agg(F.sum("_c").alias("_pc"))
    by_group = Window.partitionBy(*g)
    per_part = (per_part
                .withColumn("_off", F.sum("_pc").over(by_group.orderBy("_pid")) - F.col("_pc"))
                .withColumn("_n", F.sum("_pc").over(by_group))
                .withColumn("_pos", (F.col("_n") - 1) / 2.0)
                .withColumn("_lo", F.floor("_pos"))
                .withColumn("_hi", F.ceil("_pos")))
    inside = lambda p: (F.col(p) >= F.col("_off")) & (F.col(p) < F.col("_off") + F.col("_pc"))
    # only partitions holding a middle rank are ranked value by value
    cand = ranged.join(per_part.where(inside("_lo") | inside("_hi")), ["_pid", *g])
    run = Window.partitionBy("_pid", *g).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cand = (cand.withColumn("_end", F.col("_off") + F.sum("_c").over(run))
                .withColumn("_start", F.col("_end") - F.col("_c")))
    at = lambda p: (F.col(p) >= F.col("_start")) & (F.col(p) < F.col("_end"))
    picked = (cand.groupBy(*g)
                  .agg(F.max(F.when(at("_lo"), F.col("_v"))).alias("_lv"),
                       F.max(F.when(at("_hi"), F.col("_v"))).alias("_hv"),
                       F.first("_pos").alias("_pos"), F.first("_lo").alias("_lo")))
    frac = F.col("_pos") - F.col("_lo")
    med = F.when(frac == 0, F.col("_lv")).otherwise(F.col("_lv") + (F.col("_hv") - F.col("_lv")) * frac)
    return _unstack(picked.select("_k", "_i", med.alias("_m")), key, columns, "_m")


def median_per_key(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return medians_per_key(df, key, {out or value: value})
