"""Commits cut short at every step, tables without rows, watermarks kept beside the table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators import commit, history, merge

D = [dt.datetime(2024, 1, 1 + 7 * i) for i in range(4)]
STEPS = ("written", "intended", "removed", "cleared", "replaced", "declared")


class Crash(RuntimeError):
    pass


def crash_at(step, nth=1):
    left = [nth]

    def after(name):
        if name == step:
            left[0] -= 1
            if not left[0]:
                raise Crash(step)

    return after


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, month string, _loaded_at timestamp_ntz")


def read(spark, path):
    return sorted(tuple(r) for r in merge.read_table(spark, path).select("k", "v", "month").collect())


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("parts", [["month"], []])
def test_a_crash_at_any_step_leaves_one_row_per_key(spark, tmp, step, parts):
    path = f"{tmp}/fact"
    first = [("a", 1, "x", D[0]), ("b", 1, "y", D[0]), ("c", 1, "y y", D[0])]
    merge.upsert_table(frame(spark, first), path, ["k"], parts)
    moved = frame(spark, [("a", 2, "y", D[1]), ("c", 2, "z", D[1])])  # x and "y y" lose all their rows
    if step == "removed" and not parts:
        pass  # the old files go one by one: the same step
    with pytest.raises(Crash):
        merge.upsert_table(moved, path, ["k"], parts, after_step=crash_at(step))
    # the next increment comes, not the interrupted one; its watermark is that of what was committed
    commit.recover(spark, path)
    wm = merge.table_watermark(spark, path)
    assert wm == (D[0] if step == "written" else D[1])
    if step == "written":
        assert read(spark, path) == [("a", 1, "x"), ("b", 1, "y"), ("c", 1, "y y")]
        merge.upsert_table(moved, path, ["k"], parts)
    merge.upsert_table(frame(spark, [("d", 1, "x", D[2])]), path, ["k"], parts)
    assert read(spark, path) == [("a", 2, "y"), ("b", 1, "y"), ("c", 2, "z"), ("d", 1, "x")]
    assert merge.table_watermark(spark, path) == D[2] == merge.high_watermark(merge.read_table(spark, path))


@pytest.mark.parametrize("step", ["written", "intended", "replaced", "declared"])
def test_a_crash_while_the_table_is_made(spark, tmp, step):
    path = f"{tmp}/fact"
    rows = frame(spark, [("a", 1, "x", D[0]), ("b", 1, "y", D[0])])
    with pytest.raises(Crash):
        merge.upsert_table(rows, path, ["k"], ["month"], after_step=crash_at(step))
    merge.upsert_table(rows, path, ["k"], ["month"])
    assert read(spark, path) == [("a", 1, "x"), ("b", 1, "y")]


@pytest.mark.parametrize("parts", [["month"], []])
def test_a_first_run_without_rows(spark, tmp, parts):
    path = f"{tmp}/fact"
    for _ in range(2):
        merge.upsert_table(frame(spark, []), path, ["k"], parts)
        assert read(spark, path) == [] and merge.table_watermark(spark, path) == merge.EPOCH_DEFAULT
    merge.upsert_table(frame(spark, [("a", 1, "x", D[0])]), path, ["k"], parts)
    merge.upsert_table(frame(spark, []), path, ["k"], parts)
    assert read(spark, path) == [("a", 1, "x")]
    other = f"{tmp}/made"
    merge.create_table(spark, other, frame(spark, []).schema)
    assert read(spark, other) == []
    merge.upsert_table(frame(spark, [("a", 1, "x", D[0])]), other, ["k"], parts)
    assert read(spark, other) == [("a", 1, "x")] and merge.table_watermark(spark, other) == D[0]


def test_watermark_falls_when_its_row_is_replaced_by_an_older_one(spark, tmp):
    path = f"{tmp}/fact"
    merge.upsert_table(frame(spark, [("a", 1, "x", D[3]), ("b", 1, "y", D[1])]), path, ["k"], ["month"])
    assert merge.table_watermark(spark, path) == D[3]
    merge.upsert_table(frame(spark, [("a", 2, "x", D[0])]), path, ["k"], ["month"])
    assert merge.table_watermark(spark, path) == D[1] == merge.high_watermark(merge.read_table(spark, path))


def test_watermark_reads_no_data(spark, tmp):
    import glob
    import os

    path = f"{tmp}/fact"
    merge.upsert_table(frame(spark, [("a", 1, "x", D[1]), ("b", 1, None, None)]), path, ["k"], ["month"])
    for f in glob.glob(f"{path}/month=*/*.parquet"):
        os.remove(f)
    assert merge.table_watermark(spark, path) == D[1]
    assert merge.table_watermark(spark, f"{tmp}/none") == merge.EPOCH_DEFAULT


def test_a_cut_state_file_is_not_seen(spark, tmp):
    path = f"{tmp}/fact"
    merge.upsert_table(frame(spark, [("a", 1, "x", D[1])]), path, ["k"], ["month"])
    with open(f"{path}/._state-000000009.json.draft", "w") as f:
        f.write('{"schema": {"ty')
    assert read(spark, path) == [("a", 1, "x")]
    merge.upsert_table(frame(spark, [("b", 1, "x", D[2])]), path, ["k"], ["month"])
    assert read(spark, path) == [("a", 1, "x"), ("b", 1, "x")]


def src(spark, rows):
    return spark.createDataFrame(rows, "id string, city string")


def versions(h):
    return sorted(((r.id, r.city, r.dbt_valid_from, r.dbt_valid_to) for r in h.collect()), key=repr)


@pytest.mark.parametrize("step", ["written", "intended", "cleared", "replaced", "declared"])
def test_a_history_run_cut_short(spark, tmp, step):
    path = f"{tmp}/history"
    history.update_history(src(spark, [("a", "x"), ("b", "y")]), path, "id", ["city"], D[0])
    week2 = src(spark, [("a", "x2"), ("b", "y")])
    with pytest.raises(Crash):
        history.update_history(week2, path, "id", ["city"], D[1], after_step=crash_at(step))
    h = history.update_history(week2, path, "id", ["city"], D[1])
    want = [("a", "x", D[0], D[1]), ("a", "x2", D[1], None), ("b", "y", D[0], None)]
    assert versions(h) == sorted(want, key=repr)


def test_a_history_that_begins_without_rows(spark, tmp):
    path = f"{tmp}/history"
    h = history.update_history(src(spark, []), path, "id", ["city"], D[0])
    assert versions(h) == [] and "dbt_valid_to" in h.columns
    h = history.update_history(src(spark, [("a", "x")]), path, "id", ["city"], D[1])
    assert versions(h) == [("a", "x", D[1], None)]
    h = history.update_history(src(spark, []), path, "id", ["city"], D[2])
    assert versions(h) == [("a", "x", D[1], D[2])]


def test_two_runs_at_one_time_keep_what_both_closed(spark, tmp):
    path = f"{tmp}/history"
    history.update_history(src(spark, [("a", "x"), ("b", "y")]), path, "id", ["city"], D[0])
    history.update_history(src(spark, [("b", "y")]), path, "id", ["city"], D[1])
    h = history.update_history(src(spark, []), path, "id", ["city"], D[1])
    assert h.where(F.col("dbt_valid_to").isNotNull()).count() == 2 == h.count()


def test_folders_of_a_file(spark):
    df = spark.createDataFrame([("file:/a/t/m=1/n=x%20y/part-0.parquet",)], "p string")
    got = df.select(*(commit.folders_of("p", d) for d in range(3)))
    assert tuple(got.first()) == ("", "n=x%20y", "m=1/n=x%20y")
    # a pattern searched from every character of a path is no cost for each row
    assert "regexp" not in got._jdf.queryExecution().toString().lower()
