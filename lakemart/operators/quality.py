"""Declarative data tests as Spark jobs.

Each test has a *violations* form (the offending rows or values; empty means
pass) and all of them together have a *summary* form, :func:`run_tests`,
returning ``(model, test, column_name, violations)``.  Violation counts follow
the usual test semantics: not_null / accepted_range / relationships count
rows, unique / unique_combination count duplicated values, accepted_values
counts distinct unexpected values.  NULLs pass every test except not_null.

The summary does not run one query per test.  Per model it makes
  * one scan for all row- and value-level tests.  With value tests present,
    every row is stacked into ``(test, value)`` pairs, grouped (partially
    aggregated map-side, so a hot value or a mass of violations costs one row
    per map task), then folded into one count per test; with row tests only,
    it is one plain ``count_if`` aggregate,
  * one left-anti join per relationships test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.keys import SURROGATE_NULL_TOKEN


@dataclass(frozen=True)
class Check:
    model: str
    test: str                      # not_null | unique | accepted_values | accepted_range
    column: str                    # | relationships | unique_combination
    values: tuple = ()             # accepted_values
    min_value: float | None = None  # accepted_range (inclusive)
    max_value: float | None = None
    to: str | None = None          # relationships: parent model ...
    field: str | None = None       # ... and its column
    columns: tuple = ()            # unique_combination

    @property
    def column_name(self) -> str:
        return ",".join(self.columns) if self.columns else self.column


ROW_TESTS = ("not_null", "accepted_range")
VALUE_TESTS = ("unique", "accepted_values", "unique_combination")


# --- violations, one test at a time ----------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _in_range(c: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.where(~_in_range(F.col(column), min_value, max_value))


def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
              .where("n_records > 1"))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(*values)).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in ``parent.field``."""
    keys = parent.select(F.col(field).alias("__parent_key"))
    return (child.where(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("__parent_key"), "left_anti"))


# --- fused summary ----------------------------------------------------------------

def _row_condition(c: Check) -> Column:
    col = F.col(c.column)
    if c.test == "not_null":
        return col.isNull()
    return ~_in_range(col, c.min_value, c.max_value)


def _stacked_value(c: Check) -> Column:
    if c.test == "unique_combination":
        tok = F.lit(SURROGATE_NULL_TOKEN)
        return F.concat_ws("\u0001", *[F.coalesce(F.col(x).cast("string"), tok) for x in c.columns])
    col = F.col(c.column)
    if c.test == "unique":
        return col.cast("string")
    return F.when(~col.isin(*c.values), col.cast("string"))


def stacked_entry(c: Check) -> Column:
    """A row's value for a test that counts values, or a constant if it violates a row test; else NULL."""
    if c.test in ROW_TESTS:
        return F.when(_row_condition(c), F.lit(_VIOLATION))
    if c.test == "relationships":
        return F.col(c.column).cast("string")
    return _stacked_value(c)


def labelled(row: DataFrame, checks: Sequence[Check], names: Sequence[str]) -> DataFrame:
    """One aggregate row with a column per test -> one labelled row per test."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c.model).alias("model"), F.lit(c.test).alias("test"),
                 F.lit(c.column_name).alias("column_name"),
                 F.col(n).cast("long").alias("violations"))
        for c, n in zip(checks, names)])).alias("r")).select("r.*")


def run_tests(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = models[model]
        row_cs = [c for c in cs if c.test in ROW_TESTS]
        if any(c.test in VALUE_TESTS for c in cs):
            parts.append(_fused_counts(df, [c for c in cs if c.test in ROW_TESTS + VALUE_TESTS]))
        elif row_cs:
            # row tests alone: one plain aggregate, no explode and no shuffle
            names = [f"t{i}" for i in range(len(row_cs))]
            agg = df.agg(*[F.count_if(_row_condition(c)).alias(n) for c, n in zip(row_cs, names)])
            parts.append(labelled(agg, row_cs, names))
        for c in cs:
            if c.test == "relationships":
                orphans = relationships(df, c.column, models[c.to], c.field)
                parts.append(labelled(orphans.agg(F.count(F.lit(1)).alias("t0")), [c], ["t0"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_VIOLATION = ""


def _fused_counts(df: DataFrame, cs: Sequence[Check]) -> DataFrame:
    """All row and value tests of one model from ONE scan and one small shuffle.

    Each row is stacked into ``(test, value)`` pairs: a row test contributes a
    constant marker only when the row violates it (so all its violations
    collapse into one group, combined map-side), a value test contributes the
    value under test.  Grouping by (test, value) then folds into one count per
    test: violating rows, duplicated values, or distinct unexpected values.
    """
    stacked = (df.select(F.explode(F.array(*[
                  F.struct(F.lit(i).alias("t"), stacked_entry(c).alias("v")) for i, c in enumerate(cs)])).alias("s"))
                 .select("s.t", "s.v").where(F.col("v").isNotNull()))
    counted = stacked.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    return folded(counted, cs, list(range(len(cs))))


def folded(counted: DataFrame, cs: Sequence[Check], ids: Sequence) -> DataFrame:
    """Counts ``n`` of each test and value, (t, v, n), into one row per test; ``ids`` are the tests' ``t``."""
    t, n = F.col("t"), F.col("n")

    def fold(i, c: Check) -> Column:
        if c.test in ROW_TESTS:
            return F.coalesce(F.sum(F.when(t == i, n)), F.lit(0))
        if c.test == "accepted_values":
            return F.count_if(t == i)
        return F.count_if((t == i) & (n > 1))
    names = [f"t{i}" for i in range(len(cs))]
    return labelled(counted.agg(*[fold(i, c).alias(nm) for i, c, nm in zip(ids, cs, names)]), cs, names)
