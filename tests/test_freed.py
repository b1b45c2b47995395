"""Shuffle files and staged tables go when nothing reads them any more."""

import os
import time

from pyspark.sql import functions as F

from lakemart.llm.common import stage
from lakemart.llm.graph import components
from lakemart.operators import commit, merge
from lakemart.session import checkpoint_dir, shuffles_freed
from lakemart.sources import landing
from lakemart.streaming import file_ledger


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    for _ in range(50):  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def counts(spark):
    return spark.range(10_000).groupBy((F.col("id") * 7 % 5003).alias("k")).count()


def test_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage(counts(spark), "freed")
    with shuffles_freed(spark):
        assert staged.count() == 5003 == len(counts(spark).collect())
    assert not left_over(spark, before)


def test_frame_made_meanwhile_runs_again(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with shuffles_freed(spark):
        df = counts(spark)
    assert spark.conf.get(setting) == before
    assert df.count() == 5003 == len(df.collect()) == len(df.collect())


def test_components_keep_their_last_round_only(spark):
    path = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    out = components(path, "chain-of-nodes")
    assert {r.component for r in out.collect()} == {0}
    scratch = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "lakemart-scratch")
    assert len([n for n in os.listdir(scratch) if n.startswith("chain-of-nodes")]) == 1


def table_rows(spark, path):
    return sorted(tuple(r) for r in merge.read_table(spark, path).select("k", "v", "p").collect())


def test_upsert_in_groups_leaves_no_shuffle_files(spark, tmp, monkeypatch):
    """Partitions merged in several groups: moved keys, new ones and null partitions come out as in one."""
    def rows(n, moved):
        return spark.range(n).selectExpr("id AS k", f"id + {moved} AS v",
                                         f"IF(id % 11 = 3, NULL, concat('p', (id + {moved}) % 7)) AS p",
                                         f"timestampadd(DAY, {moved}, TIMESTAMP_NTZ '2024-01-01') AS _loaded_at")

    second = rows(300, 0).where("k >= 100").union(rows(150, 2)).union(rows(40, 1))
    written, replace = [], commit.replace_partitions
    monkeypatch.setattr(commit, "replace_partitions",
                        lambda frames, *a, **b: (written.append(frames), replace(frames, *a, **b))[1])
    results = []
    for name, size in (("whole", 10 ** 9), ("groups", 50)):
        monkeypatch.setattr(merge, "GROUP_ROWS", size)
        path, before = f"{tmp}/{name}", shuffle_files(spark)
        merge.upsert_table(rows(200, 0), path, ["k"], ["p"])
        merge.upsert_table(second, path, ["k"], ["p"])
        assert not left_over(spark, before)
        results.append(table_rows(spark, path))
    assert results[0] == results[1] and len(results[0]) == 300
    assert len(written[1]) == 1 and len(written[3]) > 3


def test_batch_is_read_from_its_own_folder(spark, tmp):
    """A load reports on what it has written without listing the folders of all loads before."""
    root, table = f"{tmp}/raw_sellers", "raw_sellers"
    columns = ", ".join(f"'x' AS {c}" for c in landing.BRONZE_COLUMNS[table])
    rows = spark.sql(f"SELECT {columns}, 'f' AS _file_name, TIMESTAMP_NTZ '2024-01-01' AS _loaded_at, "
                     f"IF(id = 1, 'bad', NULL) AS {landing.CORRUPT}, 0L AS {landing.POSITION} FROM range(3)")
    for batch in ("s0", "s1"):
        landing.land(rows, root, batch, "2024-01-01 00:00:00")
    got = landing.landed_batch(spark, root, table, "s1", "2024-01-01 00:00:00")
    assert {f.split("/load_batch=")[1].split("/")[0] for f in got.inputFiles()} == {"s1"}
    assert "InMemoryFileIndex(1 paths)" in got._jdf.queryExecution().toString()
    report = landing.file_report(got).first()
    assert (report.rows_parsed, report.rows_loaded, report.rows_rejected) == (3, 2, 1)
    want = landing.landed(spark, root, table, complete_only=False).where(f"{landing.BATCH} = 's1'")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert landing.landed_batch(spark, root, table, "s2", "2024-01-01 00:00:00").isEmpty()


def test_load_leaves_no_shuffle_files(spark, tmp):
    table, before = "raw_sellers", shuffle_files(spark)
    rows = spark.range(50).selectExpr(*(f"concat('{c}', id) AS {c}" for c in landing.BRONZE_COLUMNS[table]))
    with shuffles_freed(spark):
        landing.write_csv(rows, f"{tmp}/landing/{landing.SUBFOLDER[table]}/a")
        report = file_ledger.load_incremental(spark, f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ledger", [table],
                                              "2024-01-07 06:00:00")
        assert report.first().rows_loaded == 50
    assert not left_over(spark, before)
