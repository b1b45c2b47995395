"""lakemart: an order-analytics lakehouse built as plain PySpark DataFrame jobs.

Bronze CSV drops are landed as all-text tables, cleaned into staging frames,
rolled up and joined into a star schema, merged incrementally, tracked with
SCD2 history and guarded by declarative data tests.

The names below are the public surface; everything is importable lazily.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "lakemart.session",
    "initcap_delim": "lakemart.functions", "surrogate_key": "lakemart.functions",
    "normalize_null_tokens": "lakemart.functions", "zip_prefix": "lakemart.functions",
    "try_decimal": "lakemart.functions", "try_number": "lakemart.functions",
    "try_timestamp": "lakemart.functions", "try_double": "lakemart.functions",
    "register_sql_functions": "lakemart.functions.sql",
    "top1_per_key": "lakemart.operators.dedupe", "latest_per_key": "lakemart.operators.dedupe",
    "medians_per_key": "lakemart.operators.stats", "modes_per_key": "lakemart.operators.stats",
    "high_watermark": "lakemart.operators.merge", "incremental_filter": "lakemart.operators.merge",
    "merge_frames": "lakemart.operators.merge", "sync_schema": "lakemart.operators.merge",
    "upsert_table": "lakemart.operators.merge",
    "scd2_check": "lakemart.operators.history", "as_of_join": "lakemart.operators.history",
    "Check": "lakemart.operators.quality", "run_tests": "lakemart.operators.quality",
    "run_changed_tests": "lakemart.operators.quality_state",
    "hash_sample": "lakemart.operators.sample",
    "read_landing": "lakemart.sources.landing", "load_report": "lakemart.sources.landing",
    "verify_counts": "lakemart.sources.landing", "full_reload": "lakemart.streaming.file_ledger",
    "write_csv": "lakemart.sources.landing", "bronze_table": "lakemart.sources.landing",
    "load_incremental": "lakemart.streaming.file_ledger",
    "Layout": "lakemart.plans.weekly", "run_weekly": "lakemart.plans.weekly",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
