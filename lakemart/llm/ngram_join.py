"""Near duplicates by a blocked sparse product of documents and word n-grams.

Rows of the incidence matrix are documents, columns their distinct 5-word
shingles.  Two documents with Jaccard similarity t or more share a shingle among
the first ``n - ceil(t n) + 1`` of each, in any order common to all documents;
the order here puts shingles that many documents have last, as counted by a sketch
of fixed size over all documents.  Only those entries are multiplied.

* Columns are dealt into blocks; each block multiplies its columns and adds up the
  overlap of each pair.  A column with few documents gives all their pairs.
* A longer column gives a star (each document with one hub of about its
  size, in half of the columns the one with the fewest rarer shingles) and is set aside.  Linked documents get a common label, and then the
  set-aside columns give the pairs of documents with *different* labels; pairs
  with one label can no longer change the result.
* Sizes of two documents give the least overlap of a link.  The first column that they
  share must leave enough of both sets for it, and so must the sum of overlaps over
  all blocks with what lies beyond the last shared column.  Other pairs are discarded.
* What is left is verified on the whole texts, and all links are contracted to
  components.

So no link between different components is lost, and copies are never expanded
into all their pairs.  Documents with the same shingle set are joined by a digest
of it, and a task multiplies each set once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import distinct, map_arrow, mix, reach_workers, shingle_set, stage
from lakemart.llm.graph import components

SHINGLE_WORDS = 5
#: Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: The sketch of document frequencies: 2**22 counters, sent to the tasks as one byte each.
SKETCH_BITS = 22
_CHUNK_BITS = 16
#: Columns with more documents are set aside after their star.
SHORT_COLUMN = 8
#: Columns that may have more documents are dealt out to several blocks.
LONG_COLUMN = 50_000
#: Entries of the matrix in a block, about.
BLOCK_ENTRIES = 200_000
#: Entries that a task holds before it deals them out to their blocks, about.
DEALT_ENTRIES = 200_000
#: Turns of stars on set-aside columns before their remaining pairs are listed.
STAR_TURNS = 2
#: Columns before an entry that it carries when the remaining pairs are listed.
EARLIER = 8
#: Bits of the map that keeps most texts out of a verification's shuffle (1 MB at any input size).
MAP_BITS = 23
_U64 = np.uint64
_I64 = pa.int64()


# --- what a document is -----------------------------------------------------

_FACTS = "id long, n_shingles long, set_key binary, chunk int, counts binary"


def _describe(docs: DataFrame) -> DataFrame:
    """Per document the size and digest of its set; per task the sketch's counters.

    A row has either an id or a chunk of counters (of sets, each once in a task).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, one = np.zeros(1 << SKETCH_BITS, np.uint32), set(), np.uint32(1)
        for b in batches:
            sizes, keys = [], []
            for text in b.column("text"):
                s = shingle_set(text.as_py(), SHINGLE_WORDS)
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if s.size else None
                sizes.append(s.size)
                keys.append(key)
                if key and key not in seen:
                    seen.add(key)
                    np.add.at(counts, (s >> _U64(64 - SKETCH_BITS)).astype(np.int64), one)
            none = [None] * b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, _I64), pa.array(keys, pa.binary()),
                 pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=_facts)
        for k in range(1 << (SKETCH_BITS - _CHUNK_BITS)):
            part = counts[k << _CHUNK_BITS:(k + 1) << _CHUNK_BITS]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None], _I64), pa.array([None], _I64), pa.array([None], pa.binary()),
                     pa.array([k], pa.int32()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], schema=_facts)

    _facts = pa.schema([("id", _I64), ("n_shingles", _I64), ("set_key", pa.binary()),
                        ("chunk", pa.int32()), ("counts", pa.binary())])
    return stage(map_arrow(docs, run, _FACTS), "ngram-facts")


def _weights(facts: DataFrame) -> np.ndarray:
    """The summed sketch on a logarithmic scale: one byte for each counter, 4 MB at any input size."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("chunk").to_pylist(), b.column("counts"), strict=True):
                part = np.frombuffer(zlib.decompress(c.as_py()), np.uint32).astype(np.int64)
                sums[k] = sums[k] + part if k in sums else part
        scaled = {k: np.minimum(255, 8 * np.log2(1 + v)).astype(np.uint8) for k, v in sums.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(scaled), pa.int32()),
             pa.array([v.tobytes() for v in scaled.values()], pa.binary())], ["chunk", "scaled"])

    chunks = facts.where("chunk is not null").select("chunk", "counts")
    parts = map_arrow(chunks.repartition(1 << (SKETCH_BITS - _CHUNK_BITS), "chunk"), add,
                      "chunk int, scaled binary")
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in parts.collect():
        out[r.chunk << _CHUNK_BITS:(r.chunk + 1) << _CHUNK_BITS] = np.frombuffer(r.scaled, np.uint8)
    return out


# --- the blocked product ----------------------------------------------------

def _entries(docs: DataFrame, weights: np.ndarray, blocks: int, percent: int) -> DataFrame:
    """Entries of the matrix within the prefixes, as arrays: (block, columns, rows, sizes, places,
    split).

    A column's number leads with its weight, so the order of numbers is the common
    order; an entry's place is its number in its row.  Columns that may be very long are split over blocks by row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, seen, held, n_held = shared.value, set(), [], 0
        typical = float(np.mean(2.0 ** (weight[weight > 0] / 8))) if weight.any() else 0.0
        may_have = 2.0 ** (np.arange(256) / 8) - 2 * typical
        parts_of = np.maximum(1, np.ceil(may_have / LONG_COLUMN)).astype(np.int64)

        def deal():
            col = np.concatenate([c for c, _, _ in held])
            reps = [c.size for c, _, _ in held]
            row = np.repeat(np.array([r for _, r, _ in held], np.int64), reps)
            size = np.repeat(np.array([s for _, _, s in held], np.int32), reps)
            place = np.concatenate([np.arange(n, dtype=np.int32) for n in reps])
            parts = parts_of[(col >> _U64(56)).astype(np.int64)]
            part = (mix(row.astype(_U64)) % parts.astype(_U64)).astype(_U64)
            block = (mix(col + part * _U64(0x9E3779B97F4A7C15)) % _U64(blocks)).astype(np.int64)
            order = np.lexsort((row, block))
            block, col, row, size, place = (x[order] for x in (block, col, row, size, place))
            split = (parts[order] > 1).astype(np.uint8)
            at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
            cut = [(int(block[i]), col[i:j].tobytes(), row[i:j].tobytes(), size[i:j].tobytes(),
                    place[i:j].tobytes(), split[i:j].tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
            cols = list(zip(*cut, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], _I64), *(pa.array(c, pa.binary()) for c in cols[1:])],
                ["block", "cols", "rows", "sizes", "places", "split"])

        for b in batches:
            for row, text in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                s = shingle_set(text.as_py(), SHINGLE_WORDS)
                if row is None or not s.size:
                    continue
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if key in seen:
                    continue
                seen.add(key)
                cols = (weight[s >> _U64(64 - SKETCH_BITS)].astype(_U64) << _U64(56)) | (s >> _U64(8))
                n = s.size - -(-percent * s.size // 100) + 1
                held.append((np.sort(np.partition(cols, n - 1)[:n]), row, s.size))
                n_held += n
                if n_held > DEALT_ENTRIES:
                    yield deal()
                    held, n_held = [], 0
        if held:
            yield deal()

    return map_arrow(docs, run,
                     "block long, cols binary, rows binary, sizes binary, places binary, "
                     "split binary")


#: kind 0: a pair, its overlap in the block, and the last column there with what lies beyond it;
#: 1: a star's pair; 2: an entry of a set-aside column.
_PRODUCT = ("kind int, a long, b long, n long, size_a long, size_b long, col long, beyond long, "
            "place_a long, may_link boolean")
_PRODUCT_COLS = ["kind", "a", "b", "n", "size_a", "size_b", "col", "beyond", "place_a", "may_link"]


def _rows(kind: int, **columns: np.ndarray) -> pa.RecordBatch:
    m = len(columns["a"])
    full = [np.full(m, kind, np.int32)] + [
        columns.get(c, np.zeros(m, np.int64)).astype(np.int64) for c in _PRODUCT_COLS[1:-1]]
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x) for x in full), pa.array(columns.get("may_link", np.ones(m, bool)))],
        _PRODUCT_COLS)


def _least_overlap(size_a, size_b, percent: int):
    """The smallest intersection of two linked sets of these sizes."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def _multiply(percent: int):
    def run(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.concatenate([np.frombuffer(v.as_py(), kind) for v in table.column(name)])

        col, row, split = joined("cols", _U64), joined("rows", np.int64), joined("split", np.uint8)
        size, place = (joined(c, np.int32).astype(np.int64) for c in ("sizes", "places"))
        order = np.lexsort((row, col))
        col, row, size, place, split = (x[order] for x in (col, row, size, place, split))
        starts = np.flatnonzero(np.concatenate(([True], col[1:] != col[:-1])))
        length = np.diff(np.append(starts, col.size))
        aside = (length > SHORT_COLUMN) | (split[starts] > 0)

        def plausible(i, j):
            """Whether a column that is the first shared one leaves both rows enough for a link."""
            need = _least_overlap(size[i], size[j], percent)
            return (place[i] <= size[i] - need) & (place[j] <= size[j] - need)

        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for m in range(2, SHORT_COLUMN + 1):
            at = starts[(length == m) & ~aside]
            i, j = np.triu_indices(m, 1)
            left.append((at[:, None] + i).ravel())
            right.append((at[:, None] + j).ravel())
        i, j = np.concatenate(left), np.concatenate(right)
        near = (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])) & (
            row[i] != row[j])
        i, j = i[near], j[near]
        out = []
        if i.size:
            order = np.lexsort((col[i], row[j], row[i]))
            i, j = i[order], j[order]
            first = np.flatnonzero(np.concatenate(
                ([True], (row[i][1:] != row[i][:-1]) | (row[j][1:] != row[j][:-1]))))
            n = np.diff(np.append(first, i.size))
            may = np.logical_or.reduceat(plausible(i, j), first)
            i, j = i[first + n - 1], j[first + n - 1]  # the last column of each pair
            beyond = np.minimum(size[i] - place[i], size[j] - place[j]) - 1
            out.append(_rows(0, a=row[i], b=row[j], n=n, size_a=size[i], size_b=size[j],
                             col=col[i].view(np.int64), beyond=beyond, may_link=may))
        member = np.flatnonzero(np.repeat(aside, length))
        if member.size:
            out.append(_rows(2, a=row[member], size_a=size[member], place_a=place[member],
                             col=col[member].view(np.int64)))
            step = np.floor(np.log(size[member]) / np.log(100 / percent)).astype(np.int64)
            # two orders of rows, by column, so that a row meets more than one hub: that with the smallest
            # share of rarer shingles first (see star_pairs), or any
            share = np.where(col[member] & _U64(1), 0.0, place[member] / size[member])
            order = np.lexsort((mix(row[member].astype(_U64)), share, step, col[member]))
            member, step = member[order], step[order]
            c = col[member]
            new = np.concatenate(([True], (c[1:] != c[:-1]) | (step[1:] != step[:-1])))
            hub = member[np.flatnonzero(new)[np.cumsum(new) - 1]]
            good = (row[member] != row[hub]) & plausible(member, hub)
            ends = row[member][good], row[hub][good]
            pairs = np.unique(np.stack((np.minimum(*ends), np.maximum(*ends)), 1), axis=0)
            if pairs.size:
                out.append(_rows(1, a=pairs[:, 0], b=pairs[:, 1]))
        return pa.Table.from_batches(out or [_rows(0, a=np.empty(0, np.int64))])

    return run


# --- verification -------------------------------------------------------------

def few_texts(docs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """``docs`` whose ``key`` is in ``ids`` (a column of that name).

    A bit map of fixed size first keeps most other rows out of the join's shuffle; as it
    fills up it keeps out fewer, and the join decides at any size.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(1 << MAP_BITS))
    words = ids.select(F.shiftright(bit, 6).alias("__word"), F.expr(
        f"shiftleft(1L, CAST(pmod(xxhash64({key}), 64) AS INT))").alias("__bit")) \
        .groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    words = stage(words, "bit-map")  # at most 2**(MAP_BITS - 6) rows
    marked = docs.join(F.broadcast(words), F.shiftright(bit, 6) == F.col("__word")).where(
        F.expr(f"(shiftright(__bits, CAST(pmod(xxhash64({key}), 64) AS INT)) & 1L) = 1L"))
    # an inner join with distinct ids: a semi-join would be moved below the map
    return marked.select(*docs.columns).join(ids.select(key).distinct(), key)


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough.

    The texts wanted are shuffled by id once, for both joins, and travel once for each pair.
    """
    ends = stage(pairs.select(F.col("a").alias("id")).distinct().union(
        pairs.select("b").distinct()).distinct(), f"{name}-ends")
    texts = few_texts(docs, ends)
    full = (pairs.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
            .join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, left = None, np.empty(0, _U64)
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a"),
                                         batch.column("text_b"), strict=True):
                if of is None or of != (a, text_a.as_buffer().size):
                    of, left = (a, text_a.as_buffer().size), shingle_set(text_a.as_py())
                right = shingle_set(text_b.as_py(), SHINGLE_WORDS)
                both = left.size + right.size
                common = both - distinct(np.concatenate((left, right))).size
                keep.append(100 * common >= percent * (both - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stage(map_arrow(full, run, "a long, b long").distinct(), name)


def quick_labels(links: DataFrame) -> DataFrame:
    """(node, component): the smallest neighbour's smallest neighbour, or the node if smaller.

    Nodes with one label are connected; connected ones may still have several.
    """
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("component"))
    two = one.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return one.join(two, "component").select("node", F.col("further").alias("component"))


def unresolved(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries, with their row's label, of set-aside columns that hold several labels."""
    labelled = entries.join(labels.withColumnRenamed("node", "a"), "a", "left").select(
        "col", "a", "size_a", "place_a", F.coalesce("component", "a").alias("component"))
    mixed = (labelled.groupBy("col").agg(F.min("component").alias("lo"),
                                         F.max("component").alias("hi"))
             .where("lo <> hi").select("col"))
    return labelled.join(mixed, "col", "left_semi")


def _plausible(a: str, b: str, place_a: str, place_b: str, low_a: str, low_b: str, percent: int):
    """As in the product, over columns of sizes and places; ``low_`` sizes set the least overlap."""
    need = F.ceil(percent * (F.col(low_a) + F.col(low_b)) / (100 + percent))
    return (F.col(place_a) <= F.col(a) - need) & (F.col(place_b) <= F.col(b) - need)


def star_pairs(entries: DataFrame, links: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of each row with one linked row of each of its set-aside columns, of another label.

    In turn 0 it is the row of about its size that has the smallest share of rarer shingles: of mutated copies the
    one nearest to what they all come from, which most of them link with.  Later the row is
    drawn by a hash that differs by column and turn: a row that its component's first
    hubs do not resemble meets as many others as it has columns.
    """
    linked = links.select("a").union(links.select("b")).distinct()
    drawn = F.xxhash64("col", "a", F.lit(turn))
    keys, entries = ["col"], entries.withColumn("step", F.lit(0))
    if turn == 0:
        keys, entries = ["col", "step"], entries.withColumn("step", F.floor(F.log(
            100 / percent, F.col("size_a"))).cast("int"))
        first = -F.col("place_a") / F.col("size_a")
    else:
        first = F.lit(0.0)
    hubs = entries.join(linked, "a").groupBy(*keys).agg(F.max(F.struct(
        first.alias("first"), drawn.alias("drawn"), "a", "size_a", "place_a", "component")).alias("hub")).select(
        *keys, F.col("hub.a").alias("b"), F.col("hub.size_a").alias("size_b"),
        F.col("hub.place_a").alias("place_b"), F.col("hub.component").alias("other"))
    pairs = entries.join(hubs, keys).where(
        (F.col("component") != F.col("other"))
        & _plausible("size_a", "size_b", "place_a", "place_b", "size_a", "size_b", percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cross_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """The plausible pairs of rows of different labels in a set-aside column.

    Rows that are alike share many columns.  Each entry carries the few columns before it in
    its row (of smaller place, so that they are plausible where it is); a pair that has one
    of them in common is listed there already, and not again.  The first column that a pair
    shares always lists it.
    """
    earlier = Window.partitionBy("a", "size_a").orderBy("place_a", "col").rowsBetween(-EARLIER, -1)
    near = F.collect_list(F.struct("col", "place_a")).over(earlier)
    entries = stage(entries.withColumn("near", near).withColumn("before", F.transform(
        F.filter("near", lambda x: x["place_a"] < F.col("place_a")), lambda x: x["col"])).drop("near"),
        "cross-entries")
    groups = stage(entries.groupBy("col", "component").agg(
        F.count("*").alias("n"), F.min("size_a").alias("low"), F.max("size_a").alias("high"),
        F.min("place_a").alias("place")), "cross-groups")
    far_groups = groups.select("col", *(F.col(c).alias(f"{c}_b") for c in
                                        ("component", "n", "low", "high", "place")))
    # the smaller group is repeated for each other one; the larger is only read beside it
    sides = groups.join(far_groups, "col").where(
        (F.struct("n", "component") < F.struct("n_b", "component_b"))
        & _plausible("high", "high_b", "place", "place_b", "low", "low_b", percent)) \
        .select("col", "component", "component_b")
    far = entries.select("col", F.col("component").alias("component_b"), F.col("a").alias("b"),
                         F.col("size_a").alias("size_b"), F.col("place_a").alias("place_b"),
                         F.col("before").alias("before_b"))
    pairs = (entries.join(sides, ["col", "component"]).join(far, ["col", "component_b"])
             .where(_plausible("size_a", "size_b", "place_a", "place_b", "size_a", "size_b", percent)
                    & ~F.arrays_overlap("before", "before_b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """``id_col``, n_shingles and component_id (smallest id reachable by links) per row of ``docs``.

    Texts without words, null texts and null ids link with nothing; a text of
    fewer than five words is one shingle.  Repeated rows come back repeated; rows
    that share an id share their links.  Only the two named columns are read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("binary").alias("text"))
    facts = _describe(rows)
    sets = facts.where("chunk is null").select("id", "n_shingles", "set_key")
    weights = _weights(facts)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = max(16, int(total * (100 - percent) / 100 / BLOCK_ENTRIES))

    reach_workers(spark)
    product = stage(_entries(rows, weights, blocks, percent).groupBy("block")
                    .applyInArrow(_multiply(percent), _PRODUCT), "ngram-product")
    aside = product.where("kind = 2").select("col", "a", "size_a", "place_a")

    copies = sets.where("set_key is not null and id is not null")
    leads = copies.groupBy("set_key").agg(F.min("id").alias("b"), F.count("*").alias("n"))
    same = stage(copies.join(leads.where("n > 1"), "set_key").select(F.col("id").alias("a"), "b"), "ngram-same")

    # overlaps over all blocks, and the last column of all; set-aside columns before that may add
    # one for each that both rows have
    last = F.struct("col", "beyond")
    short = product.where("kind = 0").groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"),
        F.max(last)["beyond"].alias("beyond"), F.max("may_link").alias("may_link"))
    more = aside.groupBy("a").agg(F.count("*").alias("more"))
    reach = (F.col("n") + F.col("beyond")
             + F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0))))
    need = F.ceil(percent * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    listed = (short.join(more.withColumnRenamed("more", "more_a"), "a", "left")
              .join(more.withColumnsRenamed({"a": "b", "more": "more_b"}), "b", "left")
              .where((F.col("may_link") | (F.coalesce("more_a", F.lit(0)) > 0)
                      & (F.coalesce("more_b", F.lit(0)) > 0)) & (reach >= need)).select("a", "b"))
    stars = product.where("kind = 1").select("a", "b")
    tried = stage(listed.union(stars).distinct(), "ngram-pairs")
    links = _verified(tried, rows, percent, "ngram-links").union(same)

    for turn in range(STAR_TURNS):
        left = stage(unresolved(aside, quick_labels(links)), "ngram-open")
        fresh = stage(star_pairs(left, links, percent, turn).join(tried, ["a", "b"], "left_anti"),
                      "ngram-pairs")
        links = links.union(_verified(fresh, rows, percent, "ngram-links"))
        tried = tried.union(fresh)
    labels = stage(components(links, "ngram-label"), "ngram-labels")
    left = stage(unresolved(aside, labels), "ngram-open")
    fresh = stage(cross_pairs(left, percent).join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    if not fresh.isEmpty():
        links = links.union(_verified(fresh, rows, percent, "ngram-links"))
        labels = components(links, "ngram-components")
    return sets.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.coalesce("component", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that link, directly or not, to a document with a smaller id."""
    found = near_duplicates(docs, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")
