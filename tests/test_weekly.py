import datetime as dt
import os

from pyspark.sql import functions as F

from lakemart.operators import history
from lakemart.plans import weekly
from lakemart.sources import benchmark as bm
from lakemart.sources import landing

SF = "/root/testdata/sf0.001"
CUT = "TIMESTAMP_NTZ '1998-01-01 00:00:00'"


def drop_week(spark, root, week: int):
    """Land the benchmark-derived tables as CSV: week 1 = older rows, week 2 = the rest."""
    for table, fn in bm.RAW_BUILDERS.items():
        df = fn(spark, SF)
        if table in ("raw_orders", "raw_order_items"):
            df = df.where(f"_loaded_at {'<' if week == 1 else '>='} {CUT}")
        elif week == 2:
            continue
        out = os.path.join(root, landing.SUBFOLDER[table], f"week{week}")
        landing.write_csv(df.select(*landing.BRONZE_COLUMNS[table]).coalesce(1), out)


def test_two_week_rehearsal(spark, tmp):
    layout = weekly.Layout.under(tmp)
    drop_week(spark, layout.landing, 1)
    s1 = weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 7), calendar=("1992-01-01", "2003-01-01"),
                           fail_on_test_errors=False)
    assert s1["load"]["raw_orders"]["files_loaded"] == 1 and len(s1["tests"]) == 94
    drop_week(spark, layout.landing, 2)
    s2 = weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 14), calendar=("1992-01-01", "2003-01-01"),
                           fail_on_test_errors=False)
    assert s2["load"]["raw_orders"]["rows_loaded"] > 0
    assert s2["load"]["raw_customers"]["rows_loaded"] == 0
    assert s2["rows"]["fact_sales"] > s1["rows"]["fact_sales"]
    s3 = weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 21), calendar=("1992-01-01", "2003-01-01"),
                           fail_on_test_errors=False)
    assert all(v["rows_loaded"] == 0 for v in s3["load"].values())
    assert s3["rows"] == s2["rows"]
    snap = history.read_history(spark, os.path.join(layout.snapshots, "snap_customer"))
    # unchanged customers keep one open version across the three runs
    assert snap.where(F.col("dbt_valid_to").isNull()).count() == s3["snapshot_open_versions"]
    assert snap.groupBy("customer_id").count().where("count > 1").count() == 0


def test_command_line_run(spark, tmp, capsys):
    import json
    drop_week(spark, os.path.join(tmp, "landing"), 1)
    assert weekly.main([tmp, "--run-at", "2024-01-07T00:00:00", "--calendar", "1992-01-01", "2003-01-01",
                        "--report-test-errors"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"]["fact_sales"] > 0 and out["load"]["raw_orders"]["files_loaded"] == 1


def test_failing_data_test_fails_the_run(spark, tmp):
    import pytest
    layout = weekly.Layout.under(tmp)
    drop_week(spark, layout.landing, 1)
    with pytest.raises(weekly.DataTestFailure) as failed:
        weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 7), calendar=("1992-01-01", "2003-01-01"))
    assert failed.value.summary["tests_failed"] > 0


class Stopped(RuntimeError):
    pass


def test_a_run_that_failed_is_repeated_under_its_own_time(spark, tmp):
    """Stopped after every stage and in its tests, then repeated: nothing lands or opens twice."""
    import pytest
    layout, at = weekly.Layout.under(tmp), dt.datetime(2024, 1, 7)
    drop_week(spark, layout.landing, 1)
    options = {"calendar": ("1992-01-01", "2003-01-01")}

    def stop_at(stage):
        def after(name):
            if name == stage:
                raise Stopped(stage)
        return after

    for stage in ("load", "snapshot", "gold"):
        with pytest.raises(Stopped):
            weekly.run_weekly(spark, layout, at, after_stage=stop_at(stage), **options)
    with pytest.raises(weekly.DataTestFailure):
        weekly.run_weekly(spark, layout, at, **options)
    done = weekly.run_weekly(spark, layout, at, fail_on_test_errors=False, **options)
    assert done["load"]["raw_orders"]["files_loaded"] == 1 and len(done["tests"]) == 94
    orders = weekly.bronze_frames(spark, layout).orders
    assert orders.count() == done["load"]["raw_orders"]["rows_loaded"]
    assert orders.select("_loaded_at").distinct().collect()[0][0] == at
    snap = history.read_history(spark, os.path.join(layout.snapshots, "snap_customer"))
    assert snap.count() == done["snapshot_open_versions"]
    assert weekly.run_weekly(spark, layout, at, fail_on_test_errors=False, **options) == done
    later = weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 14), run_tests=False, **options)
    assert later["rows"] == done["rows"]
    with pytest.raises(ValueError, match="after"):
        weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 10), **options)


def test_a_first_week_without_orders(spark, tmp):
    layout = weekly.Layout.under(tmp)
    for week in (1, 2):
        for table, fn in bm.RAW_BUILDERS.items():
            late = table in ("raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews", "raw_customers")
            if late == (week == 2):
                landing.write_csv(fn(spark, SF).select(*landing.BRONZE_COLUMNS[table]),
                                  os.path.join(layout.landing, landing.SUBFOLDER[table], f"week{week}"))
        done = weekly.run_weekly(spark, layout, dt.datetime(2024, 1, 7 * week), run_tests=False,
                                 calendar=("1992-01-01", "2003-01-01"))
        assert (done["rows"]["fact_sales"] > 0) == (done["snapshot_open_versions"] > 0) == (week == 2)
