import glob

import pytest

from lakemart.operators import commit, merge, quality, quality_state
from lakemart.operators.quality import Check

CHECKS = [Check("t", "not_null", "name"), Check("t", "unique", "id"),
          Check("t", "accepted_values", "kind", values=("x", "y")),
          Check("t", "accepted_range", "score", min_value=1, max_value=10),
          Check("t", "relationships", "score", to="p", field="id"),
          Check("t", "unique_combination", "", columns=("id", "kind"))]
SCHEMA = "id int, name string, score int, kind string, _loaded_at timestamp_ntz, month string"
COLS = ["month"]


class Table:
    def __init__(self, spark, tmp):
        self.spark, self.path, self.state = spark, f"{tmp}/t", f"{tmp}/counts"
        self.models = {"p": spark.createDataFrame([(5,), (5,), (6,)], "id long")}

    def put(self, *rows, key="name", cols=COLS):
        df = self.spark.createDataFrame([(*r[:4], None, r[4]) for r in rows], SCHEMA)
        merge.upsert_table(df, self.path, [key], cols)

    def agree(self, checks=CHECKS, cols=COLS):
        """The partitions read; the results are those of a full run."""
        got, read = quality_state.run_changed_tests(self.spark, self.path, cols, checks, self.models, self.state)
        whole = quality.run_tests({"t": merge.read_table(self.spark, self.path), **self.models}, checks)
        assert sorted(got.collect()) == sorted(whole.collect()) and got.dtypes == whole.dtypes
        return read


@pytest.fixture()
def table(spark, tmp):
    return Table(spark, tmp)


def test_only_changed_partitions_are_read(table):
    table.put((1, "a", 5, "x", "m=1 é"), (2, "b", 99, "bad", "m2"), (2, "c", None, "bad", "m3"), (3, "d", 6, None, None))
    assert len(table.agree()) == 4
    assert table.agree() == []
    file, = glob.glob(f"{table.path}/month=m2/*.parquet")
    with open(file, "r+b") as f:   # a partition that is read again would fail
        whole = f.read()
        f.seek(0)
        f.write(b"x" * len(whole))
    table.spark.catalog.refreshByPath(table.path)
    table.models["p"] = table.spark.createDataFrame([(99,)], "id int")
    assert quality_state.update_counts(table.spark, table.path, COLS, CHECKS, table.state) == []
    got = {(r.test, r.column_name): r.violations for r in quality_state.summary(
        table.spark, table.path, CHECKS, table.state, table.models).collect()}
    assert got == {("not_null", "name"): 0, ("unique", "id"): 1, ("accepted_values", "kind"): 1,
                   ("accepted_range", "score"): 1, ("relationships", "score"): 2,
                   ("unique_combination", "id,kind"): 1}


def test_rows_that_come_move_and_go(table):
    table.put((1, "a", 5, "x", "m1"), (2, "b", 5, "y", "m2"), (3, "c", 5, "y", "m3"))
    table.agree()
    table.put((2, "d", 7, "z", "m3"))                     # a repeated id across partitions
    assert table.agree() == ["month=m3"]
    table.put((1, "a", 5, "x", "m4"))                     # m1 lost its only row
    assert table.agree() == ["month=m4"]
    assert len(commit.units(commit.Folder(table.spark, table.state), "", 2)) == 3
    more = [*CHECKS, Check("t", "not_null", "score")]     # another suite counts everything anew
    assert len(table.agree(more)) == 3


@pytest.mark.parametrize("step", ["written", "intended", "replaced", "declared"])
def test_a_crash_leaves_no_wrong_counts(table, step):
    table.put((1, "a", 5, "x", "m1"), (2, "b", 50, "y", "m2"))
    table.agree()
    table.put((1, "c", 50, "q", "m2"), (4, "e", 5, "x", "m3"))

    def crash(name):
        if name == step:
            raise RuntimeError(step)

    with pytest.raises(RuntimeError, match=step):
        quality_state.update_counts(table.spark, table.path, COLS, CHECKS, table.state, crash)
    table.agree()
    assert table.agree() == []


def test_without_partitions_and_without_rows(table):
    merge.create_table(table.spark, table.path, table.spark.createDataFrame([], SCHEMA).schema)
    assert table.agree(cols=[]) == []
    table.put((1, None, 5, "x", "m1"), (1, "b", 5, "y", "m1"), cols=[])
    assert table.agree(cols=[]) == [""]
