"""Exact duplicates by content sort.

Texts are normalised (each run of ASCII white space becomes one space) and
range-partitioned by their leading bytes, digest and id; the splitters are
sampled by Spark from those short keys, so no text reaches the driver.  An
external sort inside each partition puts equal texts next to each other, each
row is compared with its neighbour in full, and the smallest id of a run stays.
Since the id is part of the range key, a text with millions of copies spreads
over many partitions; the runs at partition edges (at most two for each
partition) are then joined by their full text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_arrow, stage

#: Bytes of the normalised text that lead the range key.
HEAD = 16
_RUNS = ("id long, row_hash long, text_sha256 string, run_first long, run_size long, pos long, "
         "edge long, edge_text string")
_ARROW = pa.schema([("id", pa.int64()), ("row_hash", pa.int64()), ("text_sha256", pa.string()),
                    ("run_first", pa.int64()), ("run_size", pa.int64()), ("pos", pa.int64()),
                    ("edge", pa.int64()), ("edge_text", pa.string())])


def normalised(text: str = "text"):
    """The text with each run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _run_rows(rows: pa.RecordBatch | pa.Table, sizes, edge=None, text=None) -> pa.RecordBatch:
    """Output rows of closed runs.  ``sizes`` splits ``rows``; ``edge`` and ``text`` go with a
    single run at the partition's edge, the text on its first row alone."""
    n, sizes = rows.num_rows, np.asarray(sizes, np.int64)
    starts = np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    ids, none = rows.column("id"), [None] * n
    return pa.RecordBatch.from_arrays([
        ids, rows.column("row_hash"), rows.column("sha"), ids.take(pa.array(starts)),
        pa.array(np.repeat(sizes, sizes)), pa.array(np.arange(n) - starts),
        pa.array(none if edge is None else [edge] * n, pa.int64()),
        pa.array(none if edge is None else [text, *none[1:]], pa.string())], schema=_ARROW)


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close runs of equal texts in sorted rows.  Holds the open run without its texts, and one text."""
    pid = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    text, at_head = None, True

    def close(edge):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return _run_rows(rows, [rows.num_rows], edge, text if edge is not None else None)

    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        texts, slim = b.column("norm"), b.select(["id", "row_hash", "sha"])
        new = np.ones(n, bool)
        new[0] = text is None or texts[0].as_py() != text
        if n > 1:
            new[1:] = ~pc.equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(
                zero_copy_only=False)
        starts = np.flatnonzero(new)
        if starts.size == 0 or starts[0] > 0:  # rows that go on with the open run
            held.append(slim.slice(0, int(starts[0]) if starts.size else n))
        if starts.size == 0:
            continue
        if text is not None:
            yield close(2 * pid if at_head else None)
            at_head = False
        if starts.size > 1 and at_head:  # the partition's first run ends in this batch
            m = int(starts[1])
            yield _run_rows(slim.slice(0, m), [m], 2 * pid, texts[0].as_py())
            starts, at_head = starts[1:], False
        lo, hi = int(starts[0]), int(starts[-1])
        if hi > lo:  # runs that begin and end inside this batch
            yield _run_rows(slim.slice(lo, hi - lo), np.diff(starts))
        held, text = [slim.slice(hi)], texts[hi].as_py()
    if text is not None:
        yield close(2 * pid + (0 if at_head else 1))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the id that stays, the group's size, whether it stays.

    Columns: ``id_col``, keep_id, group_size, kept, text_sha256, row_hash (of the raw text).  Null texts
    count as empty; a null id sorts after all others and stays only in a group
    without another id.  Of rows repeated with one id, exactly one is kept.
    Only the two named columns are read, so extra columns never clash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised(text_col).alias("norm"),
                       F.xxhash64(text_col).alias("row_hash"))
    rows = rows.select("id", "norm", "row_hash", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"))
    head = F.substring(F.encode("norm", "UTF-8"), 1, HEAD)
    keyed = rows.withColumn("head", head)
    last = F.col("id").asc_nulls_last()
    ordered = (keyed.repartitionByRange("head", "sha", last)
               .sortWithinPartitions("head", "sha", "norm", last, "row_hash")
               .select("id", "norm", "row_hash", "sha"))
    runs = stage(map_arrow(ordered, _compare_neighbours, _RUNS), "exact-runs")

    # at most two rows for each partition: runs that may go on in the next one
    edges = (runs.where("edge_text is not null").groupBy("edge_text")
             .agg(F.min("edge").alias("first_edge"),
                  F.min_by("run_first", "edge").alias("keep"),
                  F.sum("run_size").alias("total"), F.collect_list("edge").alias("edges"))
             .select(F.explode("edges").alias("edge"), "first_edge", "keep", "total"))
    joined = runs.drop("edge_text").join(F.broadcast(edges), "edge", "left")
    keep = F.when(F.col("edge").isNull(), F.col("run_first")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("total", "run_size").alias("group_size"),
        ((F.col("pos") == 0) & F.coalesce(F.col("edge") == F.col("first_edge"), F.lit(True)))
        .alias("kept"), "text_sha256", "row_hash")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row with a smaller id has."""
    found = exact_duplicates(docs, id_col, text_col).select(
        F.col(id_col).alias("__id"), F.col("row_hash").alias("__hash"), "kept")
    gone = found.groupBy("__id", "__hash").agg(F.max("kept").alias("__stays"),
                                              F.count("*").alias("__n"))
    gone = gone.where("not __stays or __n > 1")
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
            & (F.xxhash64(text_col) == F.col("__hash")))
    once = docs.join(gone, same, "left_anti")
    again = docs.join(gone.where("__stays"), same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again)
