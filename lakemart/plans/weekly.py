"""The weekly run: load -> snapshot -> staging -> intermediate -> gold -> tests.

One driver program; stages run in order and the first failing stage stops the
run (its exception propagates).  Staging and intermediate models are lazy
frames; the snapshot, the dimensions and the fact are written.  Every write
goes to the shared folders of :class:`Layout`; lineage is cut at each
written table, so a lost executor only recomputes work since the last write.
Returns the run summary: rows per stage and the test results.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import commit, history, merge, quality, quality_state
from lakemart.operators.commit import Folder
from lakemart.operators.dedupe import latest_per_key
from lakemart.plans import build, data_tests
from lakemart.session import shuffles_freed
from lakemart.sources import landing
from lakemart.streaming import file_ledger

SNAPSHOT_CHECK_COLS = ("customer_city", "customer_state", "customer_zip_code_prefix")
SNAPSHOT_COLS = ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                 "customer_state", "_loaded_at")
DIMENSIONS = ("dim_date", "dim_geolocation", "dim_customer", "dim_seller", "dim_product")
FACT_PARTITION = "purchase_month"


@dataclass
class Layout:
    landing: str
    bronze: str
    snapshots: str
    gold: str
    ledger: str
    runs: str

    @classmethod
    def under(cls, root: str) -> "Layout":
        return cls(*(os.path.join(root, p) for p in ("landing", "bronze", "snapshots", "gold", "ledger", "runs")))


class RunRecord:
    """What a run has done, in ``<runs>/<its time>``: a file for each finished stage, with its result.

    A run is known by its time.  When it is repeated it takes the results of the stages it had finished
    and goes on with the next one."""

    def __init__(self, spark: SparkSession, layout: Layout, run_at: dt.datetime):
        stamp = landing.stamp_text(run_at)
        later = [n for n, _ in Folder(spark, layout.runs).list() if n > stamp]
        if later:
            raise ValueError(f"run {stamp} can't be begun or repeated after {later[-1]}")
        self._folder = Folder(spark, f"{layout.runs}/{stamp}")
        #: whether this run was begun before
        self.again = self._folder.exists("begun.json")
        if not self.again:
            self._folder.write_json("begun.json", {"at": run_at.isoformat()})

    def stage(self, name: str, work: Callable[[], dict]) -> dict:
        """The stage's result, from its first finished execution; results are JSON values."""
        done = self._folder.read_json(f"{name}.json")
        if done is None:
            done = json.loads(json.dumps(work(), default=str))
            self._folder.write_json(f"{name}.json", done)
        return done


def bronze_frames(spark: SparkSession, layout: Layout, items_loaded_after=None) -> build.Bronze:
    """Bronze tables of the layout; with ``items_loaded_after`` the order-item
    read lists only load folders stamped from then on (partition pruning)."""
    def t(name, after=None):
        return landing.bronze_table(spark, os.path.join(layout.bronze, name), after)
    return build.Bronze(
        orders=t("raw_orders"), order_items=t("raw_order_items", items_loaded_after),
        customers=t("raw_customers"),
        products=t("raw_products"), sellers=t("raw_sellers"), geolocations=t("raw_geolocations"),
        payments=t("raw_order_payments"), reviews=t("raw_order_reviews"),
        category_translation=t("raw_product_category_name_translation"))


def customer_snapshot(raw_customers: DataFrame, path: str, run_at) -> DataFrame:
    """One snapshot run: raw (uncleaned) latest landed row per customer vs the history at ``path``."""
    current = latest_per_key(raw_customers, ["customer_id"], "_loaded_at").select(*SNAPSHOT_COLS)
    return history.update_history(current, path, "customer_id", SNAPSHOT_CHECK_COLS, run_at)


def run_weekly(spark: SparkSession, layout: Layout, run_at: dt.datetime,
               calendar: tuple = ("2016-01-01", "2027-12-31"), as_of=None,
               tables=tuple(landing.BRONZE_COLUMNS), run_tests: bool = True,
               full_load: bool = False, reprocess_open_orders: bool = False,
               fail_on_test_errors: bool = True,
               after_stage: Callable[[str], None] | None = None) -> dict:
    """One run, known by its time ``run_at``.  A run that failed is repeated under the same time: it skips
    the stages it had finished and keeps its load and snapshot time, so nothing lands or opens twice; a time before that of
    another run is refused.  ``after_stage`` is called with the name of each finished stage.

    ``full_load`` re-appends every landing file (forced load) instead of only
    new ones; ``reprocess_open_orders`` lets items whose order was not shipped
    on arrival enter the fact later (the default, like the source models, skips
    them once the watermark has passed).  When any test finds violations the run fails with
    :class:`DataTestFailure` (the summary attached), as a failing test step fails a
    scheduled run; without ``fail_on_test_errors`` they are only reported."""
    summary: dict = {"run_at": run_at}
    record = RunRecord(spark, layout, run_at)
    step = after_stage or (lambda name: None)
    fact_path = os.path.join(layout.gold, "fact_sales")

    def load() -> dict:
        """Every new landing file of every table (the streaming ledger skips old ones)."""
        how = file_ledger.full_reload if full_load else file_ledger.load_incremental
        report = how(spark, layout.landing, layout.bronze, layout.ledger, tables, run_at,
                     again=record.again)
        return {r["table"]: r.asDict() for r in report.collect()}

    def snapshot() -> dict:
        snap = customer_snapshot(b.customers, os.path.join(layout.snapshots, "snap_customer"), run_at)
        return {"open_versions": snap.where(F.col(history.VALID_TO).isNull()).count()}

    def gold() -> dict:
        """Dimensions rebuilt, fact merged incrementally; the watermark comes from the fact's state."""
        commit.recover(spark, fact_path)
        exists = commit.exists(spark, fact_path)
        existing = merge.read_table(spark, fact_path) if exists else None
        wm = merge.table_watermark(spark, fact_path) if exists else None
        if wm is not None and not reprocess_open_orders:
            # the increment only needs items landed after the watermark
            items = build.silver(bronze_frames(spark, layout, items_loaded_after=wm)).order_items
        else:
            items = s.order_items
        dims = build.dimensions(spark, s, calendar, as_of or run_at.date())
        for name in DIMENSIONS:
            path = os.path.join(layout.gold, name)
            commit.recover(spark, path)
            commit.replace_partitions(dims[name], path, [], None, dims[name].schema, None,
                                      lambda df: merge.partitioned_writer(df, []))
            written[name] = dims.settle(name, merge.read_table(spark, path))
        fact = build.fact_sales(replace(s, order_items=items), written, wm,
                                existing if reprocess_open_orders else None, by_membership=True)
        fact = fact.withColumn(FACT_PARTITION, F.date_format("order_purchase_timestamp", "yyyy-MM"))
        done = merge.upsert_table(fact, fact_path, ["sales_key"], [FACT_PARTITION])
        written["fact_sales"] = merge.read_table(spark, fact_path).drop(FACT_PARTITION)
        return {"fact_merge": done, "rows": {k: v.count() for k, v in written.items()}}

    def tests() -> dict:
        """Tests on the written tables (staging models are tested as frames)."""
        for name in DIMENSIONS:  # a repeated run has them from its first execution
            if name not in written:
                written[name] = merge.read_table(spark, os.path.join(layout.gold, name))
        written["fact_sales"] = merge.read_table(spark, fact_path).drop(FACT_PARTITION)
        models = {"stg_orders": s.orders, "stg_customers": s.customers,
                  "stg_order_items": s.order_items, "stg_products": s.products,
                  "stg_sellers": s.sellers, "stg_geolocation": s.geolocation,
                  "stg_order_reviews": s.reviews, "stg_category_translation": s.category_translation,
                  "payments_aggregated": s.payments_aggregated, **written}
        # the fact is the one table that grows: its tests read the partitions that changed
        of_fact = [c for c in data_tests.SUITE if c.model == "fact_sales"]
        results, read = quality_state.run_changed_tests(
            spark, fact_path, [FACT_PARTITION], of_fact, models, os.path.join(layout.gold, "_tests", "fact_sales"))
        results = results.collect() + quality.run_tests(
            models, [c for c in data_tests.SUITE if c not in of_fact]).collect()
        summary["fact_partitions_tested"] = read
        summary["tests"] = {(r.model, r.test, r.column_name): r.violations for r in results}
        summary["tests_failed"] = sum(1 for r in results if r.violations > 0)
        if fail_on_test_errors and summary["tests_failed"]:
            raise DataTestFailure(summary)
        return {"tests": [[*k, v] for k, v in summary["tests"].items()], "fact_partitions_tested": read}

    with shuffles_freed(spark):
        summary["load"] = record.stage("load", load)
        step("load")
        b, written = bronze_frames(spark, layout), {}
        s = build.silver(b)  # staging and intermediate: lazy frames over bronze
        summary["snapshot_open_versions"] = record.stage("snapshot", snapshot)["open_versions"]
        step("snapshot")
        summary |= record.stage("gold", gold)
        step("gold")
        if run_tests:
            done = record.stage("tests", tests)
            summary["fact_partitions_tested"] = done.get("fact_partitions_tested")
            summary["tests"] = {(m, t, c): n for m, t, c, n in done["tests"]}
            summary["tests_failed"] = sum(n > 0 for n in summary["tests"].values())
    return summary


class DataTestFailure(RuntimeError):
    def __init__(self, summary: dict):
        failed = sorted(k for k, v in summary["tests"].items() if v > 0)
        super().__init__(f"{len(failed)} data tests failed: {failed[:10]}")
        self.summary = summary


def main(argv=None) -> int:
    """``python -m lakemart.plans.weekly ROOT [--run-at TS] [--full-load] ...``"""
    import argparse
    import json

    from lakemart.session import get_spark
    ap = argparse.ArgumentParser(description="weekly run: load, snapshot, gold, tests")
    ap.add_argument("root", help="shared folder holding landing/ bronze/ snapshots/ gold/ ledger/")
    ap.add_argument("--run-at", default=None, help="run timestamp (default: now)")
    ap.add_argument("--calendar", nargs=2, default=("2016-01-01", "2027-12-31"))
    ap.add_argument("--full-load", action="store_true")
    ap.add_argument("--reprocess-open-orders", action="store_true")
    ap.add_argument("--report-test-errors", action="store_true",
                    help="report failing data tests without failing the run")
    a = ap.parse_args(argv)
    run_at = dt.datetime.fromisoformat(a.run_at) if a.run_at else landing.utc_now().replace(microsecond=0)
    summary = run_weekly(get_spark("lakemart-weekly"), Layout.under(a.root), run_at, tuple(a.calendar),
                         full_load=a.full_load, reprocess_open_orders=a.reprocess_open_orders,
                         fail_on_test_errors=not a.report_test_errors)
    summary["tests"] = {"/".join(k): v for k, v in summary.get("tests", {}).items()}
    print(json.dumps(summary, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
