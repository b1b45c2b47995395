"""Landing CSV drops -> all-text bronze tables (batch path).

Files bind to the declared columns *by position* after a skipped header; every
business column is text.  Rows that do not fit (too few or too many fields,
broken quoting) are not fatal: they go to a quarantine frame with their raw
text and file name.  The null tokens of the load (``NULL``, ``null``,
``None``, empty) become SQL NULL.  Audit columns ``_file_name`` and
``_loaded_at`` are added at load time; files that carry the two themselves, after the
business columns, are read like the others and their values give way to the load's own.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from lakemart.functions.text import NULL_TOKENS, null_if_token
from lakemart.operators.commit import Folder
from lakemart.sources import multiline

CORRUPT = "_corrupt_record"
#: Start of the file split that a rejected row stands in, and its number there.
POSITION = "_position"
AUDIT_COLUMNS = ("_file_name", "_loaded_at")

# --- fixed values: the landing tables, their sub-folders and column order ----------
BRONZE_COLUMNS: dict[str, tuple[str, ...]] = {
    "raw_orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                   "order_approved_at", "order_delivered_carrier_date",
                   "order_delivered_customer_date", "order_estimated_delivery_date"),
    "raw_products": ("product_id", "product_category_name", "product_name_length",
                     "product_description_length", "producr_photos_qty", "product_weight_g",
                     "product_length_cm", "product_height_cm", "product_width_cm"),
    "raw_sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "raw_product_category_name_translation": ("product_category", "product_category_name_english"),
    "raw_customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                      "customer_city", "customer_state"),
    "raw_geolocations": ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                         "geolocation_city", "geolocation_state"),
    "raw_order_items": ("order_id", "order_item", "product_id", "seller_id", "shipping_limit_date",
                        "price", "freight_value"),
    "raw_order_payments": ("order_id", "payment_sequence", "payment_type", "payment_installments",
                           "payment_value"),
    "raw_order_reviews": ("review_id", "order_id", "review_score", "review_comment_title",
                          "review_comment_message", "review_creation_date", "review_answer_timestamp"),
}
SUBFOLDER = {
    "raw_orders": "orders", "raw_order_items": "order_items", "raw_customers": "customers",
    "raw_products": "products", "raw_order_payments": "payments", "raw_order_reviews": "reviews",
    "raw_sellers": "sellers", "raw_geolocations": "geolocation",
    "raw_product_category_name_translation": "category_translation",
}
WEEKLY_TABLES = ("raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews",
                 "raw_customers")
# free text may span lines inside quotes
MULTILINE_TABLES = ("raw_order_reviews",)
# -------------------------------------------------------------------------------------


def landing_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in BRONZE_COLUMNS[table]]
                      + [StructField(CORRUPT, StringType())])


def bronze_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in BRONZE_COLUMNS[table]]
                      + [StructField("_file_name", StringType()),
                         StructField("_loaded_at", TimestampNTZType())])


def csv_options(table: str) -> dict[str, str]:
    # drops may sit in nested folders; paths never carry partition columns.  Whether a record fits
    # is only seen when all its fields are parsed, so a narrow query must not prune them.
    return {"columnPruning": "false", "header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT, "recursiveFileLookup": "true",
            "multiLine": str(table in MULTILINE_TABLES).lower()}


def loaded_at_col(loaded_at: dt.datetime | str | None) -> Column:
    if loaded_at is None:
        return F.localtimestamp()
    text = loaded_at.isoformat(sep=" ") if isinstance(loaded_at, dt.datetime) else loaded_at
    return F.lit(text).cast("timestamp_ntz")


def _carries_audit(corrupt: Column, table: str) -> Column:
    """Whether a record fits once it may end in the audit columns, the last of them a time."""
    fields = [*BRONZE_COLUMNS[table], *AUDIT_COLUMNS, CORRUPT]
    again = F.from_csv(corrupt, ", ".join(f"`{c}` STRING" for c in fields), csv_options(table))
    return (again[CORRUPT].isNull()
            & again[AUDIT_COLUMNS[1]].try_cast("timestamp_ntz").isNotNull())


def with_audit(parsed: DataFrame, table: str, loaded_at=None, file: Column | None = None,
               position: Column | None = None) -> DataFrame:
    """Parsed CSV rows -> business columns (tokens nulled) + audit + corrupt.

    File and position are those of ``_metadata`` unless given."""
    file = F.col("_metadata.file_path") if file is None else file
    position = F.col("_metadata.file_block_start") if position is None else position
    cols = BRONZE_COLUMNS[table]
    # Spark refuses a raw-CSV query whose only parsed column is the corrupt
    # record (e.g. counting rejects), and a filter on it alone would be pushed into the
    # parser, which applies it before it is set; the never-true test keeps the first
    # business column in the read schema without changing the value
    raw = F.coalesce(F.col(CORRUPT), F.when(F.length(F.col(cols[0])) < 0, F.lit("")))
    # only records that did not fit are parsed again
    corrupt = F.when(raw.isNotNull() & ~F.coalesce(_carries_audit(raw, table), F.lit(False)), raw)
    return parsed.select(*[null_if_token(F.col(c), NULL_TOKENS).alias(c) for c in cols],
                         file.alias("_file_name"), loaded_at_col(loaded_at).alias("_loaded_at"),
                         corrupt.alias(CORRUPT), position.alias(POSITION))


def parse_lines(spark: SparkSession, lines: DataFrame, table: str, loaded_at=None,
                block_lines: int = multiline.BLOCK_LINES) -> DataFrame:
    """Rows of a table whose text spans lines, from the lines of its files (:mod:`.multiline`)."""
    found = multiline.records(spark, lines, block_lines)
    parsed = found.withColumn("row", F.from_csv(multiline.RECORD, _ddl(landing_schema(table)),
                                                csv_options(table)))
    position = F.struct(F.col(multiline.BLOCK).alias("block"), F.col(multiline.LINE).alias("row"))
    return with_audit(parsed.select("row.*", multiline.FILE, multiline.BLOCK, multiline.LINE), table,
                      loaded_at, F.col(multiline.FILE), position)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` STRING" for f in schema)


def read_landing(spark: SparkSession, path: str, table: str, loaded_at=None,
                 block_lines: int = multiline.BLOCK_LINES) -> DataFrame:
    """All files under ``path`` parsed positionally; corrupt rows flagged, not dropped.

    Files are split over tasks; those of multi-line tables in blocks of ``block_lines``."""
    if table in MULTILINE_TABLES:
        return parse_lines(spark, multiline.read_lines(spark.read, path), table, loaded_at, block_lines)
    parsed = spark.read.schema(landing_schema(table)).options(**csv_options(table)).csv(path)
    return with_audit(parsed, table, loaded_at)


def split_quarantine(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined raw rows)."""
    good = loaded.where(F.col(CORRUPT).isNull()).drop(CORRUPT, POSITION)
    bad = loaded.where(F.col(CORRUPT).isNotNull()).select(
        "_file_name", "_loaded_at", F.col(CORRUPT).alias("raw_record"))
    return good, bad


def numbered(loaded: DataFrame) -> DataFrame:
    """Gives rejected rows their place: (start of the file split, running number in it)."""
    if isinstance(loaded.schema[POSITION].dataType, StructType):  # rows found by their lines have it
        return loaded.withColumn(POSITION, F.when(F.col(CORRUPT).isNotNull(), F.col(POSITION)))
    return loaded.withColumn(POSITION, F.when(F.col(CORRUPT).isNotNull(), F.struct(
        F.col(POSITION).alias("block"), F.monotonically_increasing_id().alias("row"))))


def file_report(loaded: DataFrame) -> DataFrame:
    """One row per file: rows parsed, rows loaded, rows rejected, first error in the file."""
    bad = F.col(CORRUPT).isNotNull()
    return (loaded.groupBy("_file_name")
                  .agg(F.count(F.lit(1)).alias("rows_parsed"),
                       F.count_if(~bad).alias("rows_loaded"),
                       F.count_if(bad).alias("rows_rejected"),
                       F.min_by(F.when(bad, F.col(CORRUPT)), POSITION).alias("first_error")))


def load_report(files: Mapping[str, DataFrame],
                skipped_files: Mapping[str, int] | None = None) -> DataFrame:
    """Per table: files loaded clean, skipped, with errors; rows loaded and rejected; first error.

    ``files`` has one row per new file (see :func:`file_report`).  A file with at least one
    rejected row counts as errored (its good rows still load); one without data rows
    counts as loaded.  A table with no new files reports zeros.  ``first_error`` is the
    first rejected record of the first errored file by name.
    """
    skipped_files = skipped_files or {}
    parts = []
    for table, df in files.items():
        bad = F.col("rows_rejected") > 0
        parts.append(df.agg(
            F.count_if(~bad).alias("files_loaded"), F.count_if(bad).alias("files_errored"),
            F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("rows_loaded"),
            F.coalesce(F.sum("rows_rejected"), F.lit(0)).cast("long").alias("rows_rejected"),
            F.min_by("first_error", F.when(bad, F.col("_file_name"))).alias("first_error"))
            .select(F.lit(table).alias("table"), "files_loaded",
                    F.lit(int(skipped_files.get(table, 0))).cast("long").alias("files_skipped"),
                    "files_errored", "rows_loaded", "rows_rejected", "first_error"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_counts(tables: Mapping[str, DataFrame], ts_col: str = "_loaded_at") -> DataFrame:
    """Per table: ``COUNT(*)`` and ``MAX(_loaded_at)`` -- one aggregate per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts_col).alias("last_loaded_at"))
               .select(F.lit(name).alias("table"), "row_count", "last_loaded_at")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV sink with a header line (doubled quotes inside quoted fields); blanks are kept."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# --- the landed table: load_time=<time>/load_batch=<batch>/load_status=<loaded|rejected> ------

TIME, BATCH, STATUS = "load_time", "load_batch", "load_status"
_STAMP_FMT = "%Y%m%d%H%M%S%f"


def stamp_of(loaded_at: dt.datetime | str) -> dt.datetime:
    return loaded_at if isinstance(loaded_at, dt.datetime) else dt.datetime.fromisoformat(loaded_at)


def stamp_text(loaded_at: dt.datetime | str) -> str:
    """Partition value of a load time; text order is time order."""
    return stamp_of(loaded_at).strftime(_STAMP_FMT)


def utc_now() -> dt.datetime:
    """The session's clock: UTC without a zone."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def landed_schema(table: str) -> StructType:
    position = StructType([StructField("block", LongType()), StructField("row", LongType())])
    return StructType([*bronze_schema(table).fields, StructField(CORRUPT, StringType()),
                       StructField(POSITION, position),
                       *(StructField(c, StringType()) for c in (TIME, BATCH, STATUS))])


#: Names below the bronze folder: the report of every complete batch, and the batches that were begun.
HISTORY, LOADS = "_load_history", "_loads"


def begun_batches(spark: SparkSession, bronze_root: str, table: str) -> dict[str, dt.datetime]:
    """Batch -> load time of every batch that was begun (kept in a file's name: one listing)."""
    names = [n for n, _ in Folder(spark, os.path.join(bronze_root, LOADS, table)).list()]
    return {b: dt.datetime.strptime(t, _STAMP_FMT) for b, t in (n.split("@") for n in names if "@" in n)}


def complete_batches(spark: SparkSession, bronze_root: str, table: str) -> dict[str, dt.datetime]:
    """Batch -> load time of every batch whose report is written, by listings of folders alone."""
    history = Folder(spark, os.path.join(bronze_root, HISTORY, f"table={table}"))
    return {b.partition("=")[2]: dt.datetime.strptime(t.partition("=")[2], _STAMP_FMT)
            for t, _ in history.list() if t.startswith(f"{TIME}=")
            for b, _ in history.list(t) if b.startswith(f"{BATCH}=")}


def incomplete_batches(spark: SparkSession, table_root: str) -> list[str]:
    """Batches of a landed table that were begun and aren't complete: a load runs, or failed."""
    root, table = os.path.split(table_root.rstrip("/"))
    return sorted(begun_batches(spark, root, table).keys() - complete_batches(spark, root, table).keys())


def land(loaded: DataFrame, table_root: str, batch: str, load_time) -> None:
    """Write one load's good and rejected rows in ONE pass over its files.

    Batch and load time are the same whenever a load is tried again, and the dynamic
    partition overwrite replaces exactly its own output."""
    status = F.when(F.col(CORRUPT).isNull(), F.lit("loaded")).otherwise(F.lit("rejected"))
    (numbered(loaded).withColumns({TIME: F.lit(stamp_text(load_time)), BATCH: F.lit(batch),
                                   STATUS: status})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(TIME, BATCH, STATUS).parquet(table_root))


def landed_batch(spark: SparkSession, table_root: str, table: str, batch: str, load_time) -> DataFrame:
    """The rows that one load has written, complete or not: only its own folder is listed, however many
    batches the table has."""
    folder = f"{TIME}={stamp_text(load_time)}/{BATCH}={batch}"
    if not path_exists(spark, f"{table_root}/{folder}"):  # no row at all
        return spark.createDataFrame([], landed_schema(table))
    return spark.read.schema(landed_schema(table)).option("basePath", table_root).parquet(f"{table_root}/{folder}")


def landed(spark: SparkSession, table_root: str, table: str | None = None,
           complete_only: bool = True) -> DataFrame:
    """All rows of a landed table, rejected ones too; none if no load has written yet.

    Rows of a batch that isn't complete are not seen (a filter on the partition, mostly an
    empty list), unless ``complete_only`` is off."""
    table = table or os.path.basename(table_root.rstrip("/"))
    if not path_exists(spark, table_root):
        return spark.createDataFrame([], landed_schema(table))
    rows = spark.read.schema(landed_schema(table)).parquet(table_root)
    hidden = incomplete_batches(spark, table_root) if complete_only else []
    return rows.where(~F.col(BATCH).isin(*hidden)) if hidden else rows


def bronze_table(spark: SparkSession, table_root: str, loaded_after=None,
                 table: str | None = None) -> DataFrame:
    """The loaded rows of a landed table (partition-pruned to ``loaded``).

    With ``loaded_after`` only load folders stamped at or after it are listed
    and read; the exact ``_loaded_at`` filter is left to the caller."""
    df = landed(spark, table_root, table).where(F.col(STATUS) == "loaded")
    if loaded_after is not None:
        df = df.where(F.col(TIME) >= F.lit(stamp_text(loaded_after)))
    return df.drop(TIME, BATCH, STATUS, CORRUPT, POSITION)


def quarantine(spark: SparkSession, table_root: str, table: str | None = None) -> DataFrame:
    return landed(spark, table_root, table).where(F.col(STATUS) == "rejected").select(
        "_file_name", "_loaded_at", F.col(CORRUPT).alias("raw_record"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
