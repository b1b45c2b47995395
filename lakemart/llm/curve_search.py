"""Approximate nearest neighbours by largest inner product, along shifted Hilbert curves.

Inner products become distances by one more component that brings every candidate to the same
norm (sqrt(M² - |x|²), M being the greatest norm; 0 for a query, which is scaled to norm M).  Several times these vectors are
projected to a few random orthonormal directions, put on a grid with a random shift, and ordered by
their place on a Hilbert curve through the grid.  Spark range-partitions and sorts the
places of all curves at once; a candidate's rank on a curve gives it a block of ``BLOCK`` neighbours, and a query
meets the blocks around its own place.  Blocks hold equally many candidates whatever the data, since
equal vectors are one candidate, so no block can be hot.  Products are taken on the original vectors, the
lists of all blocks and curves are merged, and only the best are kept between passes; what
is worse than a query's best so far (at first, among the fitting vectors) doesn't leave its task.

How many blocks a query meets is fitted, not fixed: for a bounded sample of queries the true neighbours are found by
brute force, and the narrowest window that holds ``RECALL`` of them is used for all.  Clustered vectors
need a block or two; vectors without any structure (such as random directions in 64 dimensions) need windows that grow with
the table, as no ordering keeps their neighbours together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import map_arrow, stage
from lakemart.llm.vectors import common_length, finite, matrix

CURVES, DIRECTIONS, BITS = 8, 6, 10
#: Candidates of a block.
BLOCK = 1024
#: Curves that are followed in one pass over the vectors: bounds what is shuffled at once.
CURVES_A_PASS = 4
#: Vectors that the grid's scale is fitted on, and queries that the window is fitted on.
FIT_VECTORS, FIT_QUERIES = 4096, 256
#: Share of the true neighbours of the fitting queries that the windows have to hold.
RECALL = 0.95


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every row of ``grid``, whose integers are below 2**bits.

    Skilling's transform on columns of all rows at once; columns times bits may be 62 at most.
    """
    x = [grid[:, j].astype(np.int64) for j in range(grid.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for j in range(len(x)):
            swap = np.where(x[j] & q, 0, (x[0] ^ x[j]) & low)
            x[0] = np.where(x[j] & q, x[0] ^ low, x[0] ^ swap)
            if j:
                x[j] ^= swap
        q >>= 1
    for j in range(1, len(x)):
        x[j] ^= x[j - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            place = place << 1 | ((c ^ turn) >> b & 1)
    return place


class Curves:
    """Directions, scale and shift of every curve; the scale is fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, top_norm: float, curves: int = CURVES):
        dim = sample.shape[1]
        n = min(DIRECTIONS, dim + 1)
        self.top, self.turns, self.spread, self.shift = top_norm, [], [], []
        lifted = self.lift(sample)
        for c in range(curves):
            rng = np.random.default_rng(c)
            turn = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0][:, :n]
            self.turns.append(turn)
            at = lifted @ turn
            self.spread.append((at.mean(axis=0), np.maximum(at.std(axis=0), 1e-12)))
            self.shift.append(rng.uniform(size=n))

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Candidates with the component that brings them to the greatest norm, over that norm."""
        x = x / self.top
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))
        return np.hstack([x, rest])

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries as directions, the added component being 0."""
        q = q / np.abs(q).max(axis=1, keepdims=True)
        return np.hstack([q / np.sqrt((q * q).sum(axis=1, keepdims=True)), np.zeros((len(q), 1))])

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """(rows, curves): places on the curves.  Four deviations either way cover half of the grid, and the
        shift moves that half along the other."""
        out = []
        for turn, (mean, dev), shift in zip(self.turns, self.spread, self.shift, strict=True):
            cells = ((lifted @ turn - mean) / (8 * dev) + 0.5 + shift) * (1 << (BITS - 1))
            out.append(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS))
        return np.stack(out, axis=1)


def _rows_of(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    single = df.schema[vec_col].dataType.elementType == T.FloatType()
    rows = df.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    return rows.where(F.col("id").isNotNull() & finite("vec") & F.exists("vec", lambda x: x != 0))


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")})


def _classes(rows: DataFrame, dim: int, keep: int, name: str) -> DataFrame:
    """Equal vectors as one row: (h1, h2, id, ids, vec, norm2), ids being the ``keep`` smallest of the class.

    Only so many rows of a class leave a task (a partial window limit), whatever the class holds.
    """
    order = Window.partitionBy("h1", "h2").orderBy("id")
    some = (_hashed(rows.where(F.size("vec") == dim)).withColumn("n", F.dense_rank().over(order))
            .where(F.col("n") <= keep))
    classes = some.groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.array_sort(F.collect_set("id")).alias("ids"),
        F.any_value("vec").alias("vec"))

    kind = "<f4" if rows.schema["vec"].dataType.elementType == T.FloatType() else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("vec"), dim)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("h1", "h2", "id", "ids")),
                 pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()),
                 pa.array((x * x).sum(axis=1))],
                ["h1", "h2", "id", "ids", "vec", "norm2"])

    return stage(map_arrow(classes, pack, "h1 long, h2 long, id long, ids array<long>, vec binary, "
                                          "norm2 double"), name)


def _unpacked(column, dim: int) -> np.ndarray:
    """Packed vectors, all single or all double precision, as rows of doubles."""
    raw = [v if isinstance(v, (bytes, bytearray)) else v.as_py() for v in column]
    kind = "<f4" if raw and len(raw[0]) == 4 * dim else "<f8"
    return np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), dim)


def _places(classes: DataFrame, curves: Curves, dim: int, query: int) -> DataFrame:
    """(curve, place, query, id): a row for each vector and curve."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unpacked(b.column("vec"), dim)
            at = curves.places(curves.aim(x) if query else curves.lift(x))
            n, k = at.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(k, dtype=np.int32), n)), pa.array(at.ravel()),
                 pa.array(np.full(n * k, query, np.int32)),
                 pa.array(np.repeat(b.column("id").to_numpy(), k))], ["curve", "place", "query", "id"])

    return map_arrow(classes.select("id", "vec"), work, "curve int, place long, query int, id long")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers a sorted partition: how many candidates of its curve stand before a row, in this partition."""
    from pyspark import TaskContext

    part, curve, seen = TaskContext.get().partitionId(), -1, 0
    for b in batches:
        if not b.num_rows:
            continue
        curves, is_cand = b.column("curve").to_numpy(), b.column("query").to_numpy() == 0
        before = np.cumsum(is_cand) - is_cand
        first = np.concatenate(([0], np.flatnonzero(np.diff(curves)) + 1))
        base = before[first].copy()
        if curves[0] == curve:
            base[0] -= seen
        pos = before - np.repeat(base, np.diff(np.append(first, len(curves))))
        curve, seen = int(curves[-1]), int(pos[-1] + is_cand[-1])
        yield pa.RecordBatch.from_arrays(
            [b.column("curve"), b.column("query"), b.column("id"),
             pa.array(np.full(len(pos), part, np.int32)), pa.array(pos.astype(np.int64))],
            ["curve", "query", "id", "part", "pos"])


def _blocks(places: DataFrame) -> DataFrame:
    """(query, id, blocks): the block of every vector on each curve.

    One range-partitioned sort of small rows; the counts of partitions, two numbers for each partition and
    curve that meet, are all that the driver sees.
    """
    spark = places.sparkSession
    by = ["curve", "place", "query", "id"]
    numbered = stage(map_arrow(places.repartitionByRange(*by).sortWithinPartitions(*by), _number,
                               "curve int, query int, id long, part int, pos long"), "curves-numbered")
    counts = (numbered.groupBy("curve", "part").agg(F.count_if(F.col("query") == 0).alias("n"))
              .orderBy("curve", "part").collect())
    before, offsets = {}, []
    for r in counts:
        offsets.append((r.curve, r.part, before.get(r.curve, 0)))
        before[r.curve] = offsets[-1][2] + r.n
    table = spark.createDataFrame(offsets, "curve int, part int, before long")
    # the last block takes what stands after the last candidate
    last = max([0, *before.values()]) - 1
    block = F.floor(F.least(F.col("before") + F.col("pos"), F.lit(max(last, 0))) / BLOCK).cast("int")
    return (numbered.join(F.broadcast(table), ["curve", "part"])
            .select("query", "id", F.struct("curve", block.alias("block")).alias("at"))
            .groupBy("query", "id").agg(F.array_sort(F.collect_list("at")).alias("at"))
            .select("query", "id", F.transform("at", lambda s: s["block"]).alias("blocks")))


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, components added up in their order."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * q[:, j]
    return out


def _best(x: np.ndarray, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
    """(query row, id, score) of every pair that may be among a query's ``k`` best of these, ties included,
    and that reaches the query's ``floor``."""
    s = q @ x.T
    slack = 1e-12 * np.sqrt((q * q).sum(axis=1) * (x * x).sum(axis=1).max())  # products differ in last bits
    need = floor - slack
    if s.shape[1] > k:
        need = np.maximum(need, -np.partition(-s, k - 1, axis=1)[:, k - 1] - 2 * slack)
    row, at = np.nonzero(s >= need[:, None])
    return row, ids[at], _scores(x[at], q[row])


_HITS = "query_id long, id long, score double"


def _hits(rows, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()),
                                       pa.array(scores, pa.float64())], ["query_id", "id", "score"])


def _meet(dim: int, k: int):
    """Scores the queries of a block against its candidates, which come first; holds one block's."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, x, ids = None, [], None, None
        for b in batches:
            key = b.column("curve").to_numpy().astype(np.int64) << 32 | b.column("block").to_numpy()
            kind, floor = b.column("query").to_numpy(), b.column("floor").to_numpy()
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if i == j:
                    continue
                if key[i] != now:
                    now, held, x = key[i], [], None
                part_ids, part = b.column("id").slice(i, j - i).to_numpy(), _unpacked(
                    b.column("vec").slice(i, j - i), dim)
                if kind[i] == 0:
                    held.append((part_ids, part))
                    continue
                if x is None and held:
                    ids, x = (np.concatenate(c) for c in zip(*held, strict=True))
                for m in range(0, (j - i) if x is not None else 0, 512):
                    row, found, score = _best(x, ids, part[m:m + 512], floor[i:j][m:m + 512], k)
                    if len(row):
                        yield _hits(part_ids[m:m + 512][row], found, score)

    return work


def _merged(hits: DataFrame, k: int) -> DataFrame:
    # a pair has one score, so its repeats share a rank
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (hits.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k).drop("n")
            .dropDuplicates(["query_id", "id"]))


def fit_window(queries: DataFrame, base: DataFrame, dim: int, k: int, recall: float = RECALL) -> int:
    """Blocks to either side of a query that hold ``recall`` of the true neighbours of the fitting
    queries: the ``FIT_QUERIES`` smallest by a hash of their id, against all candidates."""
    chosen = (queries.orderBy(F.xxhash64("id"), "id").limit(FIT_QUERIES)
              .select("id", "vec", "blocks").collect())
    q = _unpacked([r.vec for r in chosen], dim)
    own = np.array([r.id for r in chosen], np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.full(len(q), -np.inf)
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                ids = part.column("id").to_numpy()
                row, found, score = _best(_unpacked(part.column("vec"), dim), ids, q, floor, k + 1)
                if len(row):
                    yield _hits(own[row], found, score)

    true = _merged(map_arrow(base.select("id", "vec"), search, _HITS)
                   .where("query_id <> id"), k).select("query_id", "id")
    near = {r.id: np.array(r.blocks) for r in chosen}
    gaps = [int(np.abs(near[r.query_id] - np.array(r.blocks)).min()) for r in
            base.select("id", "blocks").join(F.broadcast(true), "id").select("query_id", "blocks").collect()]
    if not gaps:
        return 1
    return max(1, int(np.sort(gaps)[min(len(gaps) - 1, int(np.ceil(recall * len(gaps))) - 1)]))


def _first(queries: DataFrame, ids: np.ndarray, x: np.ndarray, dim: int, k: int) -> DataFrame:
    """Hits among the fitting vectors, which every task holds: they give each query a first floor."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                own, q = part.column("id").to_numpy(), _unpacked(part.column("vec"), dim)
                row, found, score = _best(x, ids, q, np.full(len(q), -np.inf), k)
                if len(row):
                    yield _hits(own[row], found, score)

    return map_arrow(queries.select("id", "vec"), work, _HITS)


def _pass(queries: DataFrame, base: DataFrame, curves: range, window: int, dim: int, k: int,
          floors: DataFrame) -> DataFrame:
    """Hits of the blocks around every query on some curves, none below the query's floor."""
    at = F.explode(F.array(*[F.struct(F.lit(c).alias("curve"), F.col("blocks")[c].alias("block"))
                             for c in curves])).alias("at")
    cand = base.select("id", "vec", at).select("at.curve", "at.block", F.lit(0).alias("query"), "id", "vec",
                                               F.lit(0.0).alias("floor"))
    queries = queries.join(floors, F.col("id") == F.col("query_id"), "left").drop("query_id")
    met = queries.select("id", "vec", "floor", at).select(
        "at.curve", F.explode(F.sequence(F.greatest(F.col("at.block") - window, F.lit(0)),
                                         F.col("at.block") + window)).alias("block"),
        F.lit(1).alias("query"), "id", "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    together = (cand.unionByName(met).repartition("curve", "block")
                .sortWithinPartitions("curve", "block", "query", "id"))
    return map_arrow(together, _meet(dim, k), _HITS)


def search(queries: DataFrame, base: DataFrame, k: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding", exclude_self: bool = True, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` candidates of ``base`` with the largest inner products found.

    Nearest first, ties to the smaller id.  With ``exclude_self`` a query's own id is no candidate of
    it (give the same table, or a part of it, as ``queries``).  Take no part, as query or
    candidate: rows whose id or vector is null, empty, zero, holds null or non-finite components, or hasn't the
    commonest length of ``base`` (the greater of equally common ones).  Repeated rows count
    once; an id with several vectors is a query and a candidate with each of them.  With fewer candidates than
    ``k`` a query has all of them; an empty table gives no rows.
    """
    spark = base.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    base, queries = _rows_of(base, id_col, vec_col), _rows_of(queries, id_col, vec_col)
    if base.schema["vec"] != queries.schema["vec"]:
        base, queries = (c.withColumn("vec", F.col("vec").cast("array<double>")) for c in (base, queries))
    dim = common_length(base, "vec")
    queries = queries.where(F.size("vec") == dim)
    n = k + 1 if exclude_self else k  # a query's own id may be among the best
    base0 = _classes(base, dim, n, "curves-base")
    top = base0.agg(F.max("norm2")).first()[0]
    if top is None:
        return spark.createDataFrame([], schema)
    query0 = _classes(queries, dim, 1, "curves-queries")
    fit = base0.orderBy("h1", "h2").limit(FIT_VECTORS).select("id", "vec").collect()
    fit_ids, fit = np.array([r.id for r in fit]), _unpacked([r.vec for r in fit], dim)
    curves = Curves(fit, float(np.sqrt(top)))
    blocks = stage(_blocks(_places(base0, curves, dim, 0).unionByName(
        _places(query0, curves, dim, 1))), "curves-blocks")
    placed = [stage(c.select("id", "vec").join(blocks.where(F.col("query") == kind).drop("query"), "id"),
                    f"curves-placed-{kind}") for kind, c in enumerate((base0, query0))]
    window = fit_window(placed[1], placed[0], dim, k, recall)
    found = stage(_merged(_first(placed[1], fit_ids, fit, dim, n), n), "curves-found")
    for c in range(0, CURVES, CURVES_A_PASS):
        floors = found.groupBy("query_id").agg(
            F.when(F.count("*") == n, F.min("score")).alias("floor"))
        hits = _pass(placed[1], placed[0], range(c, min(c + CURVES_A_PASS, CURVES)), window, dim, n, floors)
        found = stage(_merged(hits.unionByName(found), n), "curves-found")
    # classes back to ids: the best n classes hold the best n ids
    many = base0.where(F.size("ids") > 1).select("id", "ids")
    ids = (found.join(many, "id", "left")
           .select("query_id", "score", F.explode(F.coalesce("ids", F.array("id"))).alias("id")))
    lists = (_merged(ids, n).groupBy("query_id")
             .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "id"))).alias("near"))
             .join(query0.select(F.col("id").alias("query_id"), "h1", "h2"), "query_id").drop("query_id"))
    asked = _hashed(queries).select("id", "h1", "h2").distinct()
    own = F.col("id")
    near = F.filter("near", lambda s: s["id"] != own) if exclude_self else F.col("near")
    return (asked.join(lists, ["h1", "h2"]).select("id", F.posexplode(F.slice(near, 1, k)))
            .select(F.col("id").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("col.id").alias("vec_id"), (-F.col("col.less")).alias("score")))
