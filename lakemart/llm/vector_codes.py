"""Vector compression by product codes, with memoised grid cells in the nearest-entry search.

Every component x becomes the integer floor(4096 x), every vector is cut into eight
consecutive parts, and each part is replaced by the number of its nearest codebook entry.  The
codebooks start as the parts of the vectors with the smallest ids and take six rounds of
assignment and averaging, all in integers, so that the result depends on no order.

Nearest entry: a part's coarse grid cell (its components without their low bits) is looked up
in a table that remembers, for each cell met before, the entries that can be nearest somewhere in the cell's
box.  An entry is left out when its least distance to the box exceeds the greatest distance of some
other entry: it is farther than that one from every point of the box, so even ties keep their
lower index.  Only the entries that remain are evaluated, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import map_arrow, mix, stage
from lakemart.llm.vectors import common_length, finite, matrix

# --- fixed values of the code ------------------------------------------------------
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# -------------------------------------------------------------------------------------
#: Components are at most so many bits long as integers; squares then fit in 64 bits.
COMPONENT_BITS = 29
#: Cells that a task remembers for each part before it begins anew: bounds its memory.
MEMO_CELLS = 1 << 17


class Cells:
    """Nearest entries of one part's codebook, with the candidates of every cell met so far."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # (entries, width) integers
        # a cell's side: the power of two next below a quarter of the codebook's extent
        extent = int((entries.max(axis=0) - entries.min(axis=0)).max()) if entries.size else 0
        self.bits = max(0, (extent // 4).bit_length() - 1)
        self._forget()

    def _forget(self) -> None:
        width, n = self.entries.shape[1], len(self.entries)
        self.keys, self.cells = np.empty(0, np.uint64), np.empty((0, width), np.int64)
        self.can_win = np.empty((0, n), bool)

    def _hash(self, cells: np.ndarray) -> np.ndarray:
        h = np.zeros(len(cells), np.uint64)
        for j in range(cells.shape[1]):
            h = mix(h ^ (cells[:, j].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        return h

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell the entries that no other one dominates across its box."""
        lo = (cells << self.bits)[:, None, :]
        hi = lo + ((1 << self.bits) - 1)
        e = self.entries[None, :, :]
        outside = np.maximum(np.maximum(lo - e, e - hi), 0)
        across = np.maximum(np.abs(e - lo), np.abs(hi - e))
        return (outside * outside).sum(axis=2) <= (across * across).sum(axis=2).min(
            axis=1, keepdims=True)

    def _masks(self, cells: np.ndarray) -> np.ndarray:
        """Candidates of every row's cell, from the table where it has them."""
        keys, first, back = np.unique(self._hash(cells), return_index=True, return_inverse=True)
        own = cells[first]
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        known[known] = (self.cells[at[known]] == own[known]).all(axis=1)
        can_win = np.empty((len(keys), len(self.entries)), bool)
        can_win[known] = self.can_win[at[known]]
        new = np.flatnonzero(~known)
        for i in range(0, len(new), 4096):
            can_win[new[i:i + 4096]] = self.candidates(own[new[i:i + 4096]])
        if len(self.keys) + len(new) > MEMO_CELLS:
            self._forget()
        fresh = new[:MEMO_CELLS]
        fresh = fresh[~np.isin(keys[fresh], self.keys)]
        order = np.argsort(all_keys := np.concatenate([self.keys, keys[fresh]]))
        self.keys = all_keys[order]
        self.cells = np.concatenate([self.cells, own[fresh]])[order]
        self.can_win = np.concatenate([self.can_win, can_win[fresh]])[order]
        masks = can_win[back]
        clash = np.flatnonzero((own[back] != cells).any(axis=1))  # two cells with one hash
        masks[clash] = self.candidates(cells[clash])
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every row (ties: the lowest), and the squared distance."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        row, entry = np.nonzero(self._masks(x >> self.bits))
        gap = x[row] - self.entries[entry]
        dist = (gap * gap).sum(axis=1)
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        least = np.minimum.reduceat(dist, starts)
        hit = np.flatnonzero(dist == np.repeat(least, np.diff(np.append(starts, len(row)))))
        hit = hit[np.concatenate(([True], row[hit][1:] != row[hit][:-1]))]
        return entry[hit], least


def _cuts(dim: int) -> list[int]:
    return [p * dim // PARTS for p in range(PARTS + 1)]


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    x = np.floor(matrix(column, dim) * SCALE)
    if x.size and np.abs(x).max() >= 1 << COMPONENT_BITS:
        raise ValueError(f"a component is not below 2**{COMPONENT_BITS} times 1/{SCALE}")
    return x.astype("<i4")


def _decoded(column: pa.Array, dim: int) -> np.ndarray:
    raw = b"".join(v.as_py() for v in column)
    return np.frombuffer(raw, "<i4").reshape(len(column), dim).astype(np.int64)


def as_integers(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(id, label, x) of every row that has a code, x being its integers; and their number."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                     F.col(vec_col).cast("array<double>").alias("vec")).where(finite("vec"))
    dim = common_length(rows, "vec")
    rows = rows.where(F.size("vec") == dim)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _integers(b.column("vec"), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["id", "label", "x"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"],
                           T.StructField("x", T.BinaryType())])
    return stage(map_arrow(rows, convert, schema), "codes-integers"), dim


def fit_codebooks(rows: DataFrame, dim: int) -> list[np.ndarray]:
    """The final codebooks: for each part an array of entries.  One pass over ``rows`` a round.

    A pass sends at most a row for each part and entry from every task; the driver holds the codebooks.
    """
    cuts = _cuts(dim)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    start = np.array([np.frombuffer(r.x, "<i4") for r in first], np.int64).reshape(len(first), dim)
    books = [start[:, i:j].copy() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    for _ in range(ROUNDS if len(first) else 0):
        def sums(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            cells = [Cells(b) for b in books]
            count = [np.zeros(len(b), np.int64) for b in books]
            total = [np.zeros(b.shape, np.int64) for b in books]
            for b in batches:
                x = _decoded(b.column("x"), dim)
                for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    at, _ = cells[p].nearest(x[:, i:j])
                    n = len(books[p])
                    count[p] += np.bincount(at, minlength=n)
                    for k in range(j - i):  # sums of a batch are below 2**53, so exact as doubles
                        total[p][:, k] += np.bincount(at, x[:, i + k], n).astype(np.int64)
            rows = [(p, e, int(count[p][e]), total[p][e].tolist())
                    for p in range(PARTS) for e in np.flatnonzero(count[p]).tolist()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)],
                    ["part", "entry", "n", "total"])

        made = (map_arrow(rows.select("x"), sums, "part int, entry int, n long, total array<long>")
                .select("part", "entry", "n", F.posexplode("total").alias("at", "value"))
                .groupBy("part", "entry", "at")
                .agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("s"))
                .collect())
        books = [b.copy() for b in books]
        for r in made:
            books[r.part][r.entry, r["at"]] = int(r.s) // int(r.n)
    return books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist())
                          .encode()).hexdigest()


def encode(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """``id_col``, code, error, label_error and codebooks_sha256 of every row with a usable vector.

    Dropped: rows whose vector is null, holds a null or non-finite component, or hasn't the commonest
    length (the greater of equally common ones).  A length that eight doesn't divide is cut at p * length // 8.  Rows with a null id
    have codes and come last in the choice of the first entries, repeated rows count as often as they
    stand there; with fewer than 16 rows the codebooks are as much smaller.  Null labels form one class.
    Components of 2**17 and more can't be held and raise an error.  An empty table gives no rows.
    """
    rows, dim = as_integers(df, id_col, vec_col, label_col)
    books, cuts = fit_codebooks(rows, dim), _cuts(dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        for b in batches:
            x = _decoded(b.column("x"), dim)
            at = np.empty((len(x), PARTS), np.uint8)
            error = np.zeros(len(x), np.int64)
            for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                at[:, p], far = cells[p].nearest(x[:, i:j])
                error += far
            code = at.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"),
                 pa.array([code[k:k + 2 * PARTS] for k in range(0, len(code), 2 * PARTS)], pa.string()),
                 pa.array(error)], ["id", "label", "code", "error"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"],
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stage(map_arrow(rows, assign, schema), "codes-assigned")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("class"), "label_error")
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("class")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error",
                    F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))


def sql() -> str:
    """The same codes in SQL: assignment by a full scan of the codebook, a CTE for each round."""
    nearest = """
    SELECT vec_id, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
        SELECT vec_id, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM parts, book{r}) GROUP BY vec_id, p, x"""
    nearest = nearest.replace("FROM parts, book{r}", "FROM parts JOIN book{r} USING (p)")
    ctes = [f"""kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x
    FROM kept, range({PARTS}) AS t(p))""",
            f"""book0 AS MATERIALIZED (
    SELECT p, rank - 1 AS e, x AS c FROM (
        SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS rank FROM parts)
    WHERE rank <= {ENTRIES})"""]
    for r in range(ROUNDS):
        ctes.append(f"""book{r + 1} AS MATERIALIZED (
    WITH near AS ({nearest.format(r=r)}),
    sums AS (SELECT p, e, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
             FROM near, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS k) GROUP BY p, e, k),
    means AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM sums GROUP BY p, e)
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {", ".join(ctes)},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                 CAST(sum(d) AS BIGINT) AS error
          FROM ({nearest.format(r=ROUNDS)}) GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
        FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       codebooks_sha256
FROM coded JOIN kept USING (vec_id), sha"""
