"""Incremental materialisation: high watermark, keyed upsert, schema sync.

A fact table is a directory of parquet files, optionally partitioned (e.g. by
purchase month), with its state (declared schema, watermarks) beside them.  An upsert
reads only the partitions the increment touches -- those its rows belong to and those
that hold its keys now -- replaces matched keys and puts the merged partitions in the
place of the old ones by a commit that can be replayed (:mod:`lakemart.operators.commit`).  The increment itself is staged on shared storage first (computed once; a
lineage cut that survives executor loss).  Untouched partitions are never rewritten:
columns that came or went are a matter of the declared schema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators import commit
from lakemart.operators.dedupe import latest_per_key
from lakemart.session import remove_path, scratch_path, shuffles_freed, write_table

#: Touched partitions are merged in groups of about so many rows, so that the shuffle files of one group
#: are there at a time; in more rows each if that would be over ``MOST_GROUPS``.
GROUP_ROWS = 2_000_000
MOST_GROUPS = 8
EPOCH_DEFAULT = dt.datetime(1900, 1, 1)


def ntz_literal(v: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (folds to a constant; pushed into scans)."""
    text = v.isoformat(sep=" ") if isinstance(v, dt.datetime) else str(v)
    return F.lit(text).cast("timestamp_ntz")


def high_watermark(target: DataFrame | None, col: str = "_loaded_at",
                   default: dt.datetime = EPOCH_DEFAULT) -> dt.datetime:
    """``COALESCE(MAX(col), default)`` of the existing table -- one scalar on the driver."""
    if target is None:
        return default
    v = target.agg(F.max(col)).first()[0]
    return default if v is None else v


def incremental_filter(source: DataFrame, watermark, col: str = "_loaded_at") -> DataFrame:
    """Rows strictly newer than the watermark (a row equal to it is skipped)."""
    return source.where(F.col(col) > ntz_literal(watermark))


class SchemaChangeError(ValueError):
    """A changed type would turn values into NULL; the table is left as it was."""


def sync_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """Project ``target`` onto ``source``'s columns: new ones NULL, removed ones dropped.

    A column of another type is cast; see :func:`lost_in_cast` for values that don't convert."""
    have = dict(target.dtypes)
    cols = []
    for f in source.schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] != f.dataType.simpleString():
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return target.select(*cols)


def changed_types(target: DataFrame, source: DataFrame) -> list:
    """Fields of ``source`` that ``target`` has under another type."""
    have = dict(target.dtypes)
    return [f for f in source.schema.fields
            if f.name in have and have[f.name] != f.dataType.simpleString()]


def lost_in_cast(target: DataFrame, source: DataFrame) -> dict[str, int]:
    """Column -> values of ``target`` that the type in ``source`` can't hold: one aggregate row."""
    fields = changed_types(target, source)
    if not fields:
        return {}
    row = target.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull()
                                  & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
                       for f in fields]).first()
    return {k: n for k, n in row.asDict().items() if n}


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_col: str = "_loaded_at") -> DataFrame:
    """MERGE by key: newest source row per key replaces the target's rows with that key.

    The source is reduced to one row per key first (latest ``order_col``,
    total tie-break), which a MERGE needs to be deterministic.
    """
    keys = list(keys)
    src = latest_per_key(source, keys, order_col)
    return _replaced(target, src, src, keys)


def _replaced(target: DataFrame, src: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``src``, and the rows of ``target`` whose key ``gone`` doesn't have."""
    kept = sync_schema(target, src).join(gone.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _partition_filter(cols: Sequence[str], values: list[tuple]) -> Column:
    if len(cols) == 1:
        vals = [v[0] for v in values]
        c = F.col(cols[0])
        cond = c.isin(*[v for v in vals if v is not None]) if any(v is not None for v in vals) else F.lit(False)
        return cond | c.isNull() if None in vals else cond
    cond = F.lit(False)
    for row in values:
        term = F.lit(True)
        for c, v in zip(cols, row):
            term = term & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        cond = cond | term
    return cond


#: Surrogate keys in hexadecimal take half the room that they take under the default, which finds no repeats in them.
COMPRESSION = "zstd"


def partitioned_writer(df: DataFrame, partition_cols: Sequence[str]):
    """Writer that clusters rows by the partition columns first.

    The ``rebalance`` hint lets AQE hash rows by the partition columns (few
    files per partition) while splitting oversized partitions, so a month
    holding a third of the data is still written by many tasks.
    """
    if not partition_cols:
        return df.write.option("compression", COMPRESSION)
    return (df.hint("rebalance", *partition_cols).write.option("compression", COMPRESSION)
            .partitionBy(*partition_cols))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`upsert_table`, with its declared columns: those that older files
    lack are NULL, those that were removed are not read.  It may have no rows."""
    state = commit.read_state(spark, path)
    if state is None:
        return spark.read.parquet(path)
    return spark.read.schema(state.schema).parquet(path)


def create_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """A table with declared columns and no rows (nothing happens if there is one)."""
    commit.recover(spark, path)
    if not commit.exists(spark, path):
        commit.declare(spark, path, commit.State(schema))


def table_watermark(spark: SparkSession, path: str, col: str = "_loaded_at",
                    default: dt.datetime = EPOCH_DEFAULT) -> dt.datetime:
    """:func:`high_watermark` of the table at ``path`` from its state: reads no data.

    Only a table whose commits kept another column, or none, is scanned.  A table that isn't
    there has the default."""
    if not commit.exists(spark, path):
        return default
    state = commit.read_state(spark, path)
    if state is None or state.order_col != col:
        return high_watermark(read_table(spark, path), col, default)
    found = state.watermark()
    return default if found is None else found


def _held_keys(target: DataFrame, src: DataFrame, keys: list[str], partition_cols: list[str]) -> DataFrame:
    """Keys of the increment that the table holds, with their partitions there (only those columns are read)."""
    return (target.select(*dict.fromkeys([*keys, *partition_cols]))
            .join(src.select(*keys), keys, "left_semi").distinct())


def _rows_by_partition(rows: DataFrame, partition_cols: list[str]) -> dict[tuple, int]:
    """One value per partition, bounded by their number."""
    return {tuple(r)[:-1]: r[-1] for r in rows.groupBy(*partition_cols).agg(F.count("*")).collect()}


def _groups(sizes: dict[tuple, int]) -> list[list[tuple]]:
    """Partitions in groups of about equal numbers of rows."""
    total, so_far, groups = sum(sizes.values()), 0, {}
    n = min(MOST_GROUPS, 1 + total // GROUP_ROWS)
    for part in sorted(sizes, key=repr):
        groups.setdefault(so_far * n // max(total, 1), []).append(part)
        so_far += sizes[part]
    return list(groups.values())


def upsert_table(source: DataFrame, path: str, keys: Sequence[str],
                 partition_cols: Sequence[str] = (), order_col: str = "_loaded_at",
                 after_step: Callable[[str], None] | None = None) -> dict:
    """Merge ``source`` into the parquet table at ``path``; create it on the first run.

    The first run writes the build as is (like CREATE TABLE AS SELECT; without rows it makes an empty
    table).  Later runs merge by ``keys``:
      1. the increment is computed once, reduced to a row per key and staged on shared storage;
      2. the touched partitions are those its rows belong to and those that hold
         its keys now, since a key may have moved (one value per partition, bounded by the
         partition count, not the data; the second is a semi-join on keys alone, staged too);
      3. only those partitions of the table are read (partition pruning), merged and written
         beside the table, a group of them at a time so that not all are in shuffle files at once,
         and then replaced in one commit that a crash can't leave half done (see
         :mod:`lakemart.operators.commit`); a partition that all its rows left is removed in it.
    Columns that came or went need no rewrite (see :func:`read_table`).  If a type changed
    under an unchanged name every partition is rewritten in one commit; when a value
    would not survive that, :class:`SchemaChangeError` is raised and nothing changes.
    A run that failed, at whatever point, can be run again, or be followed by the next one.
    ``after_step`` is called with the name of each step of the commit.  Returns a small report.
    """
    spark = source.sparkSession
    partition_cols = list(partition_cols)
    commit.recover(spark, path)
    if not commit.exists(spark, path):
        _replace(source, path, partition_cols, None, source.schema, order_col, after_step)
        return {"mode": "create", "partitions": None}
    staged = scratch_path(spark, "upsert")
    try:
        src = write_table(latest_per_key(source, list(keys), order_col), f"{staged}/source", COMPRESSION)
        with shuffles_freed(spark):
            return _merge_into(src, path, list(keys), partition_cols, order_col, after_step, f"{staged}/keys")
    finally:
        remove_path(spark, staged)


def _replace(rows: DataFrame | Sequence[DataFrame], path: str, partition_cols: list[str], old: list[str] | None,
             schema: StructType, order_col: str, after_step) -> None:
    commit.replace_partitions(rows, path, partition_cols, old, schema,
                              order_col if order_col in schema.names else None,
                              lambda df: partitioned_writer(df, partition_cols), after_step)


def _merge_into(src: DataFrame, path: str, keys: list[str], partition_cols: list[str],
                order_col: str, after_step, scratch: str) -> dict:
    spark = src.sparkSession
    target = read_table(spark, path)
    synced = set(target.columns) != set(src.columns)
    retyped = bool(changed_types(target, src))
    if lost := lost_in_cast(target, src):
        raise SchemaChangeError(f"values that the new type can't hold: {lost}")
    rows = _rows_by_partition(src, partition_cols) if partition_cols else {(): 1} if not src.isEmpty() else {}
    if not rows and not retyped:
        if synced and (state := commit.read_state(spark, path)) is not None:
            state.schema = src.schema
            commit.declare(spark, path, state)
        return {"mode": "noop", "partitions": [], "schema_synced": synced}
    if not partition_cols:
        _replace(_replaced(target, src, src, keys), path, [], None, src.schema, order_col, after_step)
        return {"mode": "rewrite", "partitions": None, "schema_synced": synced or retyped}
    held = write_table(_held_keys(target, src, keys, partition_cols), scratch, COMPRESSION)
    sizes = _rows_by_partition(target, partition_cols)
    touched = set(rows) | set(sizes if retyped else _rows_by_partition(held, partition_cols))
    part = target if retyped else target.where(_partition_filter(partition_cols, sorted(touched, key=repr)))
    old = None if retyped else commit.partition_names(part, partition_cols)
    merged = []
    for group in _groups({p: rows.get(p, 0) + sizes.get(p, 0) for p in touched}) or [[]]:
        here = _partition_filter(partition_cols, group)
        merged.append(_replaced(target.where(here), src.where(here), held.where(here), keys))
    _replace(merged, path, partition_cols, old, src.schema, order_col, after_step)
    return {"mode": "rewrite" if retyped else "merge",
            "partitions": None if retyped else sorted(touched, key=repr), "schema_synced": synced or retyped}
